"""Observations to per-station facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklake.functions.measures import fact_measures
from docklake.operators.ordered import Bucket, day_bucket, with_previous


def unique_observations(obs: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """One row per (station, timetag): the last by ``tie``. Combined before the shuffle, so what a
    busy station sends on is bounded by its distinct seconds, not by its repeats."""
    row = F.max(F.struct(*tie, "bikes", "slots", "status")).alias("_row")
    fields = [f"_row.{name}" for name in ("status", "slots", "bikes")]
    return obs.groupBy("station", "day", "timetag").agg(row).select("station", "day", "timetag", *fields)


def facts(
    obs: DataFrame,
    tie: Sequence[str] = (),
    unique: bool = False,
    initial: DataFrame | None = None,
    buckets: Sequence[Bucket] | None = None,
) -> DataFrame:
    """Fact rows of observations (station, timetag, status, slots, bikes).

    ``tie`` orders repeated (station, timetag) rows; ``unique`` says there are none. ``initial``
    (station, bikes) is the count before the first row, as carried by a stream. The result keeps
    the ``day`` of each row for partitioned writes and for calendar predicates.
    """
    buckets = [day_bucket()] if buckets is None else buckets
    dated = obs.withColumn("day", F.to_date("timetag"))
    ends = None
    if unique:
        rows = dated.select("station", "day", "timetag", "status", "slots", "bikes")
    else:
        rows = unique_observations(dated, tie)
        if buckets[0].name == "day":
            # The last count of a day needs no prior de-duplication, only the same tie order.
            last = F.max(F.struct("timetag", *tie, "bikes"))["bikes"]
            ends = dated.groupBy("station", "day").agg(last.alias("bikes"))
    moved = with_previous(rows, ["station"], "timetag", "bikes", "previous", buckets, initial, ends)
    measures = fact_measures(F.col("status"), F.col("slots"), F.col("bikes"), F.col("previous"))
    return moved.select("station", "timetag", "day", "status", *(c.alias(n) for n, c in measures.items()))


def last_counts(obs: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """The count and time each station ends on."""
    last = F.max(F.struct("timetag", *tie, "bikes")).alias("_row")
    return obs.groupBy("station").agg(last).select("station", "_row.bikes", "_row.timetag")


def facts_between(inside: DataFrame, before: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Facts of the observations ``inside`` a stretch of time. The first of a station compares with its last count
    ``before``, of which only one row a station is kept: neither lies in the other's scan."""
    return facts(inside, tie, initial=last_counts(before, tie).select("station", "bikes"))
