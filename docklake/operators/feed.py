"""What a feed's own snapshot times tell about it, and dropping stale snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklake.operators.keyed import earliest_per_key
from docklake.operators.ordered import Bucket, span_bucket, with_previous, with_running_max


def refresh_gaps(times: DataFrame, seconds: int = 86_400) -> DataFrame:
    """Gaps between successive distinct snapshot times of (datasource, updatetime in seconds)."""
    distinct = times.select("datasource", "updatetime").distinct()
    before = with_previous(
        distinct.withColumn("at", F.col("updatetime")),
        ["datasource"], "updatetime", "at", "before", [span_bucket("updatetime", seconds)],
    )
    return before.where(F.col("before").isNotNull()).select(
        "datasource", "updatetime", (F.col("updatetime") - F.col("before")).alias("gap")
    )


def refresh_interval(times: DataFrame) -> DataFrame:
    """How often each feed changes: the first gap seen and the spread of all of them."""
    return refresh_gaps(times).groupBy("datasource").agg(
        F.min_by("gap", "updatetime").alias("first_gap"),
        F.min("gap").alias("min_gap"),
        F.max("gap").alias("max_gap"),
        F.avg("gap").alias("avg_gap"),
        F.count(F.lit(1)).alias("gaps"),
    )


def monotone(
    raw: DataFrame, buckets: Sequence[Bucket], order: str = "arrival", initial: DataFrame | None = None
) -> DataFrame:
    """Snapshots strictly newer than every earlier arrival of their datasource. ``order`` is the
    unique arrival position; ``buckets`` cut it so that no task sees a whole datasource;
    ``initial`` (datasource, timestamp_ms) is the newest time already passed on."""
    seen = with_running_max(raw, ["datasource"], order, "timestamp_ms", "_seen", buckets, initial)
    newer = seen.where(F.col("_seen").isNull() | (F.col("timestamp_ms") > F.col("_seen")))
    return newer.select(*raw.columns)


def deduplicated(raw: DataFrame, order: Sequence[str] = ("arrival",)) -> DataFrame:
    """One row per (datasource, snapshot time): the first to arrive."""
    return earliest_per_key(raw, ["datasource", "timestamp_ms"], order)
