"""Facts of a stream whose rows may be late by any time.

A late row changes two facts: its own, and the one that follows it at the same station, which so far compared with an
earlier count. The follower is found by day: in the day itself, or as the first row of the station's next day, which the
small table of day ends knows. Only days with new rows and such next days are read and rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from docklake.functions.measures import fact_measures
from docklake.operators.keyed import earliest_per_key, latest_per_key
from docklake.operators.ordered import day_bucket, with_previous
from docklake.session import delete_path, path_exists
from docklake.sinks.files import staged, touched, upsert

RAW = ("status", "raw_slots", "bikes")  # what a fact is computed from, kept beside it
STATION_DAY = ["station", "day"]
OBSERVED = [*STATION_DAY, "timetag"]


def unique_rows(obs: DataFrame, tie: Sequence[str]) -> DataFrame:
    """Observations by (station, day, time): the last by ``tie``."""
    rows = obs.select("station", F.to_date("timetag").alias("day"), "timetag", *tie, "status", F.col("slots").alias("raw_slots"), "bikes")
    return latest_per_key(rows, OBSERVED, _rank(tie))


def _rank(tie: Sequence[str]) -> list[str]:
    return [*tie, "bikes", "raw_slots", "status"]


def merged_days(fresh: DataFrame, known: DataFrame, tie: Sequence[str]) -> DataFrame:
    """All rows, known and fresh, of the stations and days that ``fresh`` has."""
    days = fresh.select(*STATION_DAY).distinct()
    stored = touched(known, days, ["day"]).join(days, STATION_DAY, "left_semi")
    return latest_per_key(fresh.unionByName(stored.select(*fresh.columns)), OBSERVED, _rank(tie))


def ends_after(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """The counts that all days of the stations of ``rows`` end on: of whole days ``rows``, of others as known."""
    own = rows.groupBy(*STATION_DAY).agg(F.max_by("bikes", "timetag").alias("bikes"))
    others = ends.join(own.select("station").distinct(), "station", "left_semi").join(own, STATION_DAY, "left_anti")
    return own.unionByName(others.select(*own.columns))


def following_days(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """The station's next day after each of the days of ``rows``, unless that is one of them. A station has a row a day here."""
    days = rows.select(*STATION_DAY).distinct()
    later = ends.withColumn("next", F.lead("day").over(Window.partitionBy("station").orderBy("day")))
    after = later.join(days, STATION_DAY, "left_semi").where(F.col("next").isNotNull())
    return after.select("station", F.col("next").alias("day")).join(days, STATION_DAY, "left_anti")


def facts_of(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Facts of ``rows``, the count before a day being the one the station's day before ends on."""
    moved = with_previous(rows.drop("day"), ["station"], "timetag", "bikes", "previous", [day_bucket()], ends=ends)
    measures = fact_measures(F.col("status"), F.col("raw_slots"), F.col("bikes"), F.col("previous"))
    return moved.select(*rows.columns, *(column.alias(name) for name, column in measures.items()))


def merge_late(obs: DataFrame, path: str, ends_path: str, staging: str, tie: Sequence[str], merge_id: str | int) -> None:
    """Merge observations of any time into the facts at ``path`` and the day ends at ``ends_path``.

    The tables hold what the batch facts of all observations so far would be. Steps are staged below ``staging``; one
    that is lost on the way resumes when it is run again with its ``merge_id``, and running it twice changes nothing.
    """
    spark, work = obs.sparkSession, f"{staging}/rows-{merge_id}"
    fresh = staged(unique_rows(obs, tie), f"{work}/fresh")
    if path_exists(spark, path):
        known = spark.read.parquet(path).select(*fresh.columns)
        before = spark.read.parquet(ends_path).select(*STATION_DAY, "bikes")
    else:
        known, before = fresh.limit(0), fresh.select(*STATION_DAY, "bikes").limit(0)
    rows = staged(merged_days(fresh, known, tie), f"{work}/rows")
    ends = staged(ends_after(rows, before), f"{work}/all-ends")
    next_days = staged(following_days(rows, ends), f"{work}/next-days")
    later = touched(known, next_days, ["day"]).join(next_days, STATION_DAY, "left_semi")
    followers = earliest_per_key(later.select(*rows.columns), STATION_DAY, ["timetag"])
    changed = staged(facts_of(rows.unionByName(followers), ends), f"{work}/facts")
    own_ends = ends.join(rows.select(*STATION_DAY).distinct(), STATION_DAY, "left_semi")
    upsert(changed, path, ["station", "timetag"], f"{staging}/facts", partition_by=["day"], merge_id=merge_id)
    upsert(own_ends, ends_path, STATION_DAY, f"{staging}/ends", partition_by=["day"], merge_id=merge_id)
    delete_path(spark, work)


def late_fact_batches(obs: DataFrame, path: str, ends_path: str, staging: str, tie: Sequence[str] = ()) -> DataStreamWriter:
    """Keep a fact table by day below ``path`` right, however late rows come. It has the columns of facts, those of
    ``tie``, and the raw counts they are computed from."""

    def process(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            merge_late(batch, path, ends_path, staging, tie, batch_id)

    return obs.writeStream.foreachBatch(process)
