"""The star schema and the wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklake.functions.bands import district_bands
from docklake.functions.calendar import calendar_parts
from docklake.schemas import BIG_TABLE_COLUMNS, FACT_COLUMNS, TIME_DIM_COLUMNS

DIM_FIELDS = ("district", "neighborhood", "postal_code", "address", "pop_density", "population", "size")


def time_dimension(facts: DataFrame, week_rule: str = "us") -> DataFrame:
    """One row per distinct observation time, made distinct before the calendar is computed."""
    times = facts.select("timetag").distinct()
    return times.withColumns(calendar_parts(F.col("timetag"), week_rule)).select(*TIME_DIM_COLUMNS)


def _dimension(stations: DataFrame) -> DataFrame:
    return stations.select(F.col("id").alias("station"), *DIM_FIELDS)


def big_table(
    facts: DataFrame, stations: DataFrame, week_rule: str = "us", label_mode: str = "compatible", on: str = "station"
) -> DataFrame:
    """The wide table of facts and a station dimension with unique ids. Facts of unknown stations
    are left out; their counts have already moved on. The join carries no broadcast hint: Spark
    broadcasts the dimension while its size allows and otherwise splits busy stations at run time. Tables
    in the same buckets are joined ``on`` their slots instead, without moving the facts."""
    day = F.col("day") if "day" in facts.columns else None
    dimension = _dimension(stations) if on == "station" else stations.select(on, *DIM_FIELDS)
    wide = facts.join(dimension, on).withColumns(
        {
            "traffic": F.col("lent") + F.col("returned"),
            **district_bands(F.col("pop_density"), F.col("population"), F.col("size"), label_mode),
            **calendar_parts(F.col("timetag"), week_rule, day),
        }
    )
    return wide.select(*BIG_TABLE_COLUMNS)


def located(obs: DataFrame, stations: DataFrame, week_rule: str = "us") -> DataFrame:
    """Observations of known stations with their place and calendar, without any measure. It has
    the members of the wide table, so "last" members are found here without computing facts."""
    wide = obs.select("station", "timetag").join(_dimension(stations), "station")
    return wide.withColumns(calendar_parts(F.col("timetag"), week_rule))


def star_join(facts: DataFrame, stations: DataFrame, times: DataFrame) -> DataFrame:
    """Facts with both stored dimensions joined on."""
    joined = facts.select(*FACT_COLUMNS).join(_dimension(stations), "station").join(times, "timetag")
    return joined.select(*FACT_COLUMNS, *DIM_FIELDS, *TIME_DIM_COLUMNS[1:])
