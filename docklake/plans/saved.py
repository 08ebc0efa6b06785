"""The saved usage reports over the wide table.

Each takes the wide table, stored or computed. A table that is computed for a period already (``plans.periods``) needs
no slicer, its ``period`` is None. "Last" slicers compare with the last member found in
``within``, by default the wide table itself. Of a stored wide table only the last month is then
read; ``last_month_of`` it as ``within`` also finds the last week and hour there. A computed wide
table is cheaper with ``plans.star.located`` as ``within``.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from docklake.plans.cubes import DAY_SIXTH_AXIS, LAST_HOUR, STATION_CUBE
from docklake.schemas import MONTH_PARTITIONS
from docklake.session import child_names

STATIONS = [("StationDistrict", "StationId")]
DISTRICTS = [("StationDistrict", "District")]
USAGE = ["average_bikes_available", "average_lent", "average_returned"]


def last_month_of(big: DataFrame) -> DataFrame:
    """Rows of the last month, which also holds the last week and the last hour."""
    return STATION_CUBE.in_set(big, "last_month")


def stored_months(spark: SparkSession, path: str) -> DataFrame:
    """The months of a wide table stored by month, from its folder names: a frame to look for the last month in that
    opens no file."""
    kinds = ", ".join(f"{name} int" for name in MONTH_PARTITIONS)
    found: list[tuple[int, ...]] = [()]
    for _ in MONTH_PARTITIONS:
        found = [(*outer, name) for outer in found for name in child_names(spark, "/".join([path, *outer])) if "=" in name]
    values = [tuple(int(name.partition("=")[2]) for name in folders) for folders in found]
    return spark.createDataFrame(values, kinds)


def _rows(big: DataFrame, period: str | None, within: DataFrame | None) -> DataFrame:
    return big if period is None else STATION_CUBE.in_set(big, period, within)


def lent_by_station(big: DataFrame, period: str | None = None, within: DataFrame | None = None) -> DataFrame:
    """Bikes lent per station and day sixth in the ``last_week`` or ``last_month``, most lent first."""
    return _moved_by_station(big, period, "total_bikes_lent", within)


def returned_by_station(big: DataFrame, period: str | None = None, within: DataFrame | None = None) -> DataFrame:
    return _moved_by_station(big, period, "total_bikes_returned", within)


def _moved_by_station(big: DataFrame, period: str | None, measure: str, within: DataFrame | None) -> DataFrame:
    rows = _rows(big, period, within)
    return STATION_CUBE.query(rows, STATIONS, [measure], DAY_SIXTH_AXIS, [(measure, "desc")])


def movement_by_district(
    big: DataFrame, period: str | None = "last_month", within: DataFrame | None = None
) -> DataFrame:
    """Returned and lent per district and day sixth, most returned first."""
    rows = _rows(big, period, within)
    measures = ["total_bikes_returned", "total_bikes_lent"]
    return STATION_CUBE.query(rows, DISTRICTS, measures, DAY_SIXTH_AXIS, [(measures[0], "desc")])


def movement_by_size(big: DataFrame) -> DataFrame:
    """Average movements per district size, least lent first."""
    rows = [("DistrictSize", "SizeRange")]
    return STATION_CUBE.query(big, rows, ["average_lent", "average_returned"], order=[("average_lent", "asc")])


def where_to_place(big: DataFrame, period: str | None = None, within: DataFrame | None = None) -> DataFrame:
    """Districts short of bikes: fewest available first, then most traffic."""
    rows = _rows(big, period, within)
    measures = ["average_bikes_available", "total_traffic"]
    order = [("average_bikes_available", "asc"), ("total_traffic", "desc")]
    return STATION_CUBE.query(rows, DISTRICTS, measures, order=order)


def station_last_hour(
    big: DataFrame, station_path: Sequence[Any], within: DataFrame | None = None, sliced: bool = False
) -> DataFrame:
    """One station by minute of the last hour; the hour is the last of the whole table, unless that is ``sliced`` already."""
    at_station = STATION_CUBE.at_member(big, "StationDistrict", "StationId", station_path)
    rows = at_station if sliced else STATION_CUBE.in_set(at_station, LAST_HOUR, big if within is None else within)
    return STATION_CUBE.query(rows, [("Time", "Minute")], USAGE)


def district_by_minute(big: DataFrame, district: str | None) -> DataFrame:
    """One district by minute, over all time."""
    rows = STATION_CUBE.at_member(big, "StationDistrict", "District", [district])
    return STATION_CUBE.query(rows, [("Time", "Minute")], USAGE)


def station_by_hour(big: DataFrame, station_path: Sequence[Any]) -> DataFrame:
    """One station by hour, over all time."""
    rows = STATION_CUBE.at_member(big, "StationDistrict", "StationId", station_path)
    return STATION_CUBE.query(rows, [("Time", "Hour")], USAGE)
