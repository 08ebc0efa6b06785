"""Archives, message rows and stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docklake.functions.calendar import day_string, snapshot_name, utc_from_millis
from docklake.functions.text import message_key
from docklake.operators.keyed import latest_per_key, merge_by_key
from docklake.schemas import MONTH_PARTITIONS
from docklake.session import delete_path, path_exists


def archive_rows(raw: DataFrame) -> DataFrame:
    """Raw snapshots with the UTC day they belong to and their archive name."""
    at = utc_from_millis(F.col("timestamp_ms"))
    return raw.withColumns({"day": day_string(at), "snapshot_name": snapshot_name(at)})


def append_archive(raw: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Append raw snapshots below ``path`` by datasource and day; ``avro`` needs its package.
    The rebalance hint splits a busy datasource over several writers and merges small ones."""
    rows = archive_rows(raw).hint("rebalance", "datasource", "day")
    rows.write.format(file_format).mode("append").partitionBy("datasource", "day").save(path)


def message_rows(raw: DataFrame) -> DataFrame:
    """Raw snapshots as messages: one topic per datasource."""
    return raw.select(
        F.col("datasource").alias("topic"),
        message_key(F.col("datasource"), F.col("timestamp_ms")).alias("key"),
        F.col("content").alias("value"),
    )


def write_messages(raw: DataFrame, servers: str, **options: str) -> None:
    """Send raw snapshots to Kafka; needs the Kafka package on the cluster."""
    writer = message_rows(raw).write.format("kafka").option("kafka.bootstrap.servers", servers)
    for name, value in options.items():
        writer = writer.option(name.replace("__", "."), value)
    writer.save()


def append(rows: DataFrame, path: str) -> None:
    """Add rows without looking at those already there."""
    rows.write.mode("append").parquet(path)


def write_table(rows: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """Store a table anew. Sorting inside files keeps a station's rows together for row-group skipping."""
    shaped = rows.hint("rebalance", *partition_by)
    if sort_by:
        shaped = shaped.sortWithinPartitions(*partition_by, *sort_by)
    shaped.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_big_table(big: DataFrame, path: str) -> None:
    write_table(big, path, MONTH_PARTITIONS, ["station", "timetag"])


def truncate(spark: SparkSession, path: str) -> None:
    """Delete all rows; the schema stays."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def upsert(
    new: DataFrame,
    path: str,
    keys: Sequence[str],
    staging: str,
    order: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    merge_id: str | int | None = None,
    merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> None:
    """Merge ``new`` into the Parquet table at ``path`` by key; new rows win.

    ``partition_by`` must be determined by the key. Only partitions that ``new`` touches are read
    and rewritten, the partition of null values among them. Every step ends in a complete table below
    ``staging``, so a job that is lost on the way and run again with the same ``merge_id`` resumes, and
    running it twice changes nothing. Before the staged tables are deleted a marker beside them says
    that the merge is complete: a job lost half-way through the deletion only goes on deleting.
    ``merge(existing, new)`` replaces the rule that new rows win.
    """
    spark = new.sparkSession
    work = f"{staging}/{uuid.uuid4().hex if merge_id is None else merge_id}"
    marker = f"{work}.done"
    if path_exists(spark, f"{marker}/_SUCCESS"):
        delete_path(spark, work)
        delete_path(spark, marker)
        return
    fresh = staged(new, f"{work}/new")
    if path_exists(spark, path):
        existing = touched(spark.read.schema(fresh.schema).parquet(path), fresh, partition_by)
    else:
        existing = fresh.limit(0)
    merged = staged(
        merge_by_key(existing, fresh, keys, order) if merge is None else merge(existing, fresh), f"{work}/merged"
    )
    writer = merged.hint("rebalance", *partition_by).write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)
    _mark(spark, marker)
    delete_path(spark, work)
    delete_path(spark, marker)


def insert_new(
    new: DataFrame, path: str, keys: Sequence[str], staging: str, partition_by: Sequence[str] = (), merge_id: str | int | None = None
) -> None:
    """``upsert`` with the same result for rows that seldom change once they are stored.

    Of the stored rows only keys and a hash of the rest are compared. Rows of unknown keys are appended, rows stored as they
    are stay where they are; only a key that comes with other values has its partition rewritten. A job that is lost on the
    way and run again adds what is missing, and running it twice changes nothing. An empty text in a partition
    column is null, as its folder gives it back.
    """
    spark = new.sparkSession
    new = new.withColumns({c: _partition_value(new, c) for c in partition_by})
    if merge_id is not None and any(path_exists(spark, f"{staging}/{merge_id}{end}") for end in ("", ".done")):
        upsert(new, path, keys, staging, partition_by=partition_by, merge_id=merge_id)  # goes on with one that was lost
    rest = [c for c in new.columns if c not in keys]
    digest = lambda row: F.xxhash64(*(x for c in rest for x in (row(c), row(c).isNull())))
    both = new.withColumn("_stored", F.lit(None).cast("bigint"))
    if path_exists(spark, path):
        existing = touched(spark.read.schema(new.schema).parquet(path), new, partition_by)
        both = both.unionByName(existing.select(*keys, digest(F.col).alias("_stored")), allowMissingColumns=True)
    last = F.max(F.when(F.col("_stored").isNull(), F.struct(*rest))).alias("_row")
    rows = both.groupBy(*keys).agg(last, F.max("_stored").alias("_stored")).where(F.col("_row").isNotNull())
    other = F.col("_stored").isNull() | (F.col("_stored") != digest(lambda c: F.col("_row")[c]))
    work = f"{staging}/{uuid.uuid4().hex}"
    rows.where(other).select(*keys, "_row.*", "_stored").write.parquet(work)
    found = spark.read.schema(both.schema).parquet(work)
    changed = found.where(F.col("_stored").isNotNull()).drop("_stored")
    if not changed.isEmpty():
        upsert(changed, path, keys, staging, partition_by=partition_by, merge_id=merge_id)
    missing = found.where(F.col("_stored").isNull()).drop("_stored")
    if not (missing.isEmpty() and path_exists(spark, path)):
        missing.hint("rebalance", *partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)
    delete_path(spark, work)


def _mark(spark: SparkSession, marker: str) -> None:
    spark.range(0).write.mode("overwrite").parquet(marker)


def merge_newest(
    new: DataFrame, path: str, keys: Sequence[str], staging: str, order: Sequence[str],
    partition_by: Sequence[str] = (), merge_id: str | int | None = None,
) -> None:
    """``upsert`` in which the last row of a key by ``order`` wins, whether it is new or stored."""

    def merge(existing: DataFrame, fresh: DataFrame) -> DataFrame:
        return latest_per_key(existing.unionByName(fresh.select(*existing.columns)), keys, order)

    upsert(new, path, keys, staging, partition_by=partition_by, merge_id=merge_id, merge=merge)


def staged(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` as a table at ``path``, which is kept if an earlier try has completed it."""
    spark = rows.sparkSession
    if not path_exists(spark, f"{path}/_SUCCESS"):
        rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def touched(existing: DataFrame, new: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` in the partitions that ``new`` has rows of."""
    if not partition_by:
        return existing
    # The range of each partition column prunes the listing at run time, the semi join makes it exact.
    keys = {c: _partition_value(new, c) for c in partition_by}
    parts = new.select(*(value.alias(f"_{c}") for c, value in keys.items())).distinct()
    inside, same = F.lit(True), F.lit(True)
    for c, value in keys.items():
        low, high, some_null = (
            new.agg(pick.alias("bound")).scalar() for pick in (F.min(value), F.max(value), F.bool_or(value.isNull()))
        )
        inside = inside & (F.col(c).between(low, high) | (F.col(c).isNull() & some_null))
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return existing.where(inside).join(parts, same, "left_semi")


def _partition_value(rows: DataFrame, column: str) -> Column:
    """The value a partition folder gives back: an empty text is stored as null."""
    value = F.col(column)
    return F.nullif(value, F.lit("")) if rows.schema[column].dataType == StringType() else value
