"""The newest state of every station, for a map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docklake.functions.text import point_text
from docklake.operators.keyed import insert_missing, latest_per_key, update_matching

POINT = ["longitude", "latitude"]
STATE_FIELDS = ["station", "latitude", "longitude", "status", "bikes"]


def newest_per_station(obs: DataFrame, tie: tuple[str, ...] = ()) -> DataFrame:
    return latest_per_key(obs.select("timetag", *tie, *STATE_FIELDS), ["station"], ["timetag", *tie])


def state_rows(newest: DataFrame) -> DataFrame:
    """State rows, keyed by point: of two stations on one point the newer is shown."""
    placed = latest_per_key(newest.select("timetag", *STATE_FIELDS), POINT, ["timetag", "station"])
    return placed.select(
        *POINT,
        point_text(F.col("longitude"), F.col("latitude")).alias("the_geom"),
        "status",
        F.col("bikes").alias("num_available_bikes"),
    )


def updated_rows(state: DataFrame, new: DataFrame) -> DataFrame:
    return update_matching(state, new, POINT)


def inserted_rows(state: DataFrame, new: DataFrame) -> DataFrame:
    return insert_missing(state, new, POINT)


def kept_rows(state: DataFrame, new: DataFrame) -> DataFrame:
    return insert_missing(new, state, POINT)


def merged_state(state: DataFrame, new: DataFrame) -> DataFrame:
    """``state`` with matching points updated and missing ones inserted, in one join."""
    fields = [c for c in state.columns if c not in POINT]
    old, fresh = state.alias("old"), new.alias("new")
    hit = F.col("new.longitude").isNotNull()
    return old.join(fresh, POINT, "full").select(
        *POINT, *(F.when(hit, F.col(f"new.{f}")).otherwise(F.col(f"old.{f}")).alias(f) for f in fields)
    )


def newest_per_window(
    obs: DataFrame, length: int = 60, slide: int = 90, tie: tuple[str, ...] = (), time: str = "timetag"
) -> DataFrame:
    """The newest row of each station per window of ``length`` seconds, one every ``slide`` seconds.
    Windows that slide further than they are long leave gaps, whose rows belong to no window. ``time`` decides in which
    windows a row is, ``timetag`` which one is the newest."""
    ranked = F.struct("timetag", *tie, "latitude", "longitude", "status", "bikes")
    newest = in_windows(obs, length, slide, time).groupBy("window", "station").agg(F.max(ranked).alias("_row"))
    return newest.select(
        _opening(length).alias("window_start"),
        F.col("window.end").alias("window_end"),
        "station",
        "_row.timetag",
        "_row.latitude",
        "_row.longitude",
        "_row.status",
        "_row.bikes",
    )


def in_windows(obs: DataFrame, length: int, slide: int, time: str = "timetag") -> DataFrame:
    """Add ``window``. Spark wants slide <= length, so a longer slide becomes a tumbling window of
    which only rows of the last ``length`` seconds are kept."""
    if slide <= length:
        return obs.withColumn("window", F.window(time, f"{length} seconds", f"{slide} seconds"))
    tumbling = obs.withColumn("window", F.window(time, f"{slide} seconds"))
    return tumbling.where(F.col(time) >= _opening(length))


def _opening(length: int) -> Column:
    return F.col("window.end") - F.expr(f"interval {length} seconds")
