"""Reading back an archive of raw snapshots, as ``sinks.files.append_archive`` lays it out: by datasource and UTC day.

A reader over the whole folder would list every file of every year. Here the names of the folders are walked, and only
those of the days between two times are opened.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docklake.functions.text import snapshot_file_time
from docklake.session import child_names

ARCHIVED = "timestamp_ms bigint, key string, content string, snapshot_name string, datasource string, day string"


def day_folders(
    spark: SparkSession, path: str, start: datetime, end: datetime, datasources: Sequence[str] | None = None
) -> list[str]:
    """Folders of the days that hold times from ``start`` up to, not including, ``end``, in order of datasource and day."""
    found = []
    first, last = start.date(), (end - timedelta(microseconds=1)).date()
    for source in sorted(child_names(spark, path)):
        name, _, value = source.partition("=")
        if name != "datasource" or (datasources is not None and unquote(value) not in datasources):
            continue
        for day in sorted(child_names(spark, f"{path}/{source}")):
            name, _, value = day.partition("=")
            if name == "day" and first.isoformat() <= value <= last.isoformat():
                found.append(f"{path}/{source}/{day}")
    return found


def archived_between(
    spark: SparkSession, path: str, start: datetime, end: datetime, datasources: Sequence[str] | None = None,
    schema: str = ARCHIVED, file_format: str = "parquet",
) -> DataFrame:
    """Archived snapshots from ``start`` up to, not including, ``end`` (UTC), with ``snapshot_time`` from their names.

    Days without any of those are not listed. Names carry whole seconds. An archive that doesn't exist has no rows.
    """
    folders = day_folders(spark, path, start, end, datasources)
    if folders:
        rows = spark.read.format(file_format).schema(schema).option("basePath", path).load(folders)
    else:
        rows = spark.createDataFrame([], schema)
    name = F.concat(F.col("datasource"), F.lit("_"), F.col("snapshot_name"), F.lit(".xml"))
    dated = rows.withColumn("snapshot_time", snapshot_file_time(name))
    return dated.where((F.col("snapshot_time") >= F.lit(start)) & (F.col("snapshot_time") < F.lit(end)))
