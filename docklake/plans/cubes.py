"""The two cubes: station usage over the big table, and the flat sample cube."""

from __future__ import annotations

from docklake.functions.calendar import DAY_SIXTHS
from docklake.operators.cube import Axis, Cube, Hierarchy, Level, Measure, NamedSet

# Hierarchies, levels, measures and named sets of the station cube.
STATION_CUBE = Cube(
    name="stations",
    hierarchies=(
        Hierarchy(
            "StationDistrict",
            (
                Level("District", "district"),
                Level("Neighborhood", "neighborhood"),
                Level("PostalCode", "postal_code"),
                Level("StationId", "station"),
            ),
            "All Districts",
        ),
        Hierarchy("Population", (Level("PopulationRange", "pop_range"),), "All Populations"),
        Hierarchy(
            "PopulationDensity", (Level("PopulationDensityRange", "pop_density_range"),), "All Population Densities"
        ),
        Hierarchy("DistrictSize", (Level("SizeRange", "size_range"),), "All Sizes"),
        Hierarchy("StationStatus", (Level("Status", "status"),), "All Status"),
        Hierarchy(
            "Time",
            (
                Level("Year", "year"),
                Level("Quarter", "trimester"),
                Level("Month", "month"),
                Level("Week", "month_week"),
                Level("Day", "month_day"),
                Level("Hour", "hour"),
                Level("Minute", "minute"),
            ),
            "All Periods",
        ),
        Hierarchy("DaySixths", (Level("DaySixth", "daysixth"),)),
        Hierarchy("DayParts", (Level("DayPart", "part"),)),
    ),
    measures=(
        Measure("total_bikes_available", "available", "sum"),
        Measure("total_bike_slots", "slots", "sum"),
        Measure("total_capacity", "capacity", "sum"),
        Measure("total_bikes_lent", "lent", "sum"),
        Measure("total_bikes_returned", "returned", "sum"),
        Measure("total_traffic", "traffic", "sum"),
        Measure("average_bikes_available", "available", "avg"),
        Measure("average_bike_slots", "slots", "avg"),
        Measure("average_capacity", "capacity", "avg"),
        Measure("average_lent", "lent", "avg"),
        Measure("average_returned", "returned", "avg"),
        Measure("average_traffic", "traffic", "avg"),
        Measure("total_station_count", "station", "distinct-count"),
    ),
    named_sets=(
        NamedSet("last_month", "Time", "Month"),
        NamedSet("last_week", "Time", "Week"),
    ),
)

LAST_HOUR = NamedSet("last_hour", "Time", "Hour")

# Hierarchies and measures of the flat sample cube.
FLAT_CUBE = Cube(
    name="flat",
    hierarchies=tuple(
        Hierarchy(name, (Level(name, name.lower()),), "All Types") for name in ("HOST", "DOMAIN", "FEATURE", "DATE")
    ),
    measures=tuple(Measure(name, name, "sum") for name in ("core", "db", "active_visitor")),
)

DAY_SIXTH_SUFFIXES = {label: f"{label[1:3]}_{label[9:11]}" for label in DAY_SIXTHS}
DAY_SIXTH_AXIS = Axis("DaySixths", "DaySixth", DAY_SIXTH_SUFFIXES)
