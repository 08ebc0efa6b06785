"""Values carried along the time order of a key, without putting a whole key into one task.

A window over ``partitionBy(key)`` sorts all rows of a key in a single task, so one busy station or
feed would decide the run time. Here each key is cut into time buckets. One partial aggregate per
bucket gives the value the bucket hands on; the hand-over itself runs over bucket summaries only
and enters the next bucket as a seed row that sorts before the bucket's own rows. The summaries may
be cut again by coarser buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bucket:
    """A named SQL expression over the order column, or over the next finer bucket.
    It must never decrease as that column grows."""

    name: str
    expr: str


def day_bucket(order: str = "timetag", name: str = "day") -> Bucket:
    """One day. A feed stamped in whole seconds with unique (key, time) has at most 86,400 rows in it."""
    return Bucket(name, f"to_date({order})")


def span_bucket(order: str, width: int, name: str = "slice") -> Bucket:
    """Stretches of ``width`` of a whole-number column: at most ``width`` distinct values in each."""
    return Bucket(name, f"{order} div {width}")


RANGE = Bucket("_range", "_range")


def in_ranges(df: DataFrame, keys: Sequence[str], order: str, path: str, ranges: int | None = None) -> DataFrame:
    """``df`` stored at ``path`` with the number of the range of (keys, order) that each row is in, for the bucket ``RANGE``.

    Where the ranges end comes from the data: quantiles that Spark samples, so that ranges hold about as many rows each,
    whether one key has nearly all rows or all rows are of one day. Rows of one key and place in the order share a range,
    and within a key a later row never has a smaller number. A carry over the bucket ``RANGE`` is then a prefix scan:
    one summary a range and key, a scan over the summaries, and a pass inside each range. ``ranges`` defaults to the
    shuffle partitions of the session; the numbers are stored, so a lost executor can't shift them.
    """
    spark = df.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions")) if ranges is None else ranges
    cut = df.repartitionByRange(count, *keys, order).withColumn(RANGE.name, F.spark_partition_id())
    cut.write.parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    out: str,
    buckets: Sequence[Bucket],
    initial: DataFrame | None = None,
    ends: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: ``value`` of the row before, in ``order``, within ``keys``.

    ``order`` is unique per key and never null. ``initial`` (keys, value) stands before the first
    row of a key. Without ``buckets`` a whole key is sorted in one task, which has to be asked for by
    an empty list. ``ends`` (keys, first bucket, value) replaces the summary computed here, where a
    cheaper one is at hand. Bucket columns stay in the result.
    """
    if not buckets:
        body = df if initial is None else _seeded(df, initial, order)
        result = body.withColumn(out, F.lag(value).over(Window.partitionBy(*keys).orderBy(order)))
        return result if initial is None else result.where(F.col(order).isNotNull())
    bucket, coarser = buckets[0], buckets[1:]
    body = df.withColumn(bucket.name, F.expr(bucket.expr))
    if ends is None:
        ends = body.groupBy(*keys, bucket.name).agg(F.max_by(value, order).alias(value))
    seeds = (
        with_previous(ends, keys, bucket.name, value, "_seed", coarser, initial)
        .where(F.col("_seed").isNotNull())
        .select(*keys, bucket.name, F.col("_seed").alias(value))
    )
    frame = Window.partitionBy(*keys, bucket.name).orderBy(order)
    return _seeded(body, seeds, order).withColumn(out, F.lag(value).over(frame)).where(F.col(order).isNotNull())


def with_running_max(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    out: str,
    buckets: Sequence[Bucket],
    initial: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: the largest ``value`` of all earlier rows of the key, null before any."""
    if not buckets:
        body = df if initial is None else _seeded(df, initial, order)
        frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        result = body.withColumn(out, F.max(value).over(frame))
        return result if initial is None else result.where(F.col(order).isNotNull())
    bucket, coarser = buckets[0], buckets[1:]
    body = df.withColumn(bucket.name, F.expr(bucket.expr))
    tops = body.groupBy(*keys, bucket.name).agg(F.max(value).alias(value))
    seeds = (
        with_running_max(tops, keys, bucket.name, value, "_seed", coarser, initial)
        .where(F.col("_seed").isNotNull())
        .select(*keys, bucket.name, F.col("_seed").alias(value))
    )
    frame = Window.partitionBy(*keys, bucket.name).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return _seeded(body, seeds, order).withColumn(out, F.max(value).over(frame)).where(F.col(order).isNotNull())


def _seeded(body: DataFrame, seeds: DataFrame, order: str) -> DataFrame:
    # The order of a seed is a null literal: it sorts first, and where the carried column is not
    # used Catalyst drops the seed branch together with the window.
    missing = F.lit(None).cast(body.schema[order].dataType)
    return body.unionByName(seeds.withColumn(order, missing), allowMissingColumns=True)
