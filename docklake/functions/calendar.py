"""Calendar parts of an observation time, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the six four-hour slices of a day, from midnight on.
DAY_SIXTHS = (
    "[00:00 - 04:00)",
    "[04:00 - 08:00)",
    "[08:00 - 12:00)",
    "[12:00 - 16:00)",
    "[16:00 - 20:00)",
    "[20:00 - 00:00)",
)

# Named day parts as (label, first hour, hour after the last); other hours are NIGHT.
DAY_PARTS = (
    ("GO-WORK", 6, 10),
    ("MORNING", 10, 13),
    ("LUNCH", 13, 15),
    ("AFTERNOON", 15, 17),
    ("BACK-HOME", 17, 19),
)
NIGHT = "NIGHT"

SNAPSHOT_NAME_FORMAT = "yyyy-MM-dd_HH.mm.ss'_UTC'"


def in_zone(ts: Column, zone: str) -> Column:
    """A UTC time as wall-clock time of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def utc_from_millis(ms: Column) -> Column:
    """The UTC wall-clock time of epoch milliseconds, whatever the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=ms.cast("decimal(18,3)") / 1000)


def day_sixth(ts: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, DAY_SIXTHS)), F.floor(F.hour(ts) / 4).cast("int") + 1)


def day_part(ts: Column) -> Column:
    hour = F.hour(ts)
    label = F.when(ts.isNull(), F.lit(None))
    for name, first, end in DAY_PARTS:
        label = label.when((hour >= first) & (hour < end), name)
    return label.otherwise(NIGHT)


def month_week(ts: Column, rule: str = "us") -> Column:
    """Week of the month.

    ``us``: weeks start on Sunday and the first, possibly short, week counts (1..6).
    ``es``: weeks start on Monday and a first week of under four days is week 0 (0..5).
    """
    first = F.trunc(ts, "MM")
    day = F.dayofmonth(ts)
    if rule == "us":
        return (F.floor((day + F.dayofweek(first) - 2) / 7) + 1).cast("int")
    if rule == "es":
        lead = F.weekday(first)
        return (F.floor((day - 1 + lead) / 7) + F.when(lead <= 3, 1).otherwise(0)).cast("int")
    raise ValueError(f"unknown week rule {rule!r}")


def time_of_day_parts(ts: Column) -> dict[str, Column]:
    return {
        "minute": F.minute(ts),
        "hour": F.hour(ts),
        "daysixth": day_sixth(ts),
        "part": day_part(ts),
    }


def date_parts(day: Column, week_rule: str = "us") -> dict[str, Column]:
    return {
        "month_day": F.dayofmonth(day),
        "year_day": F.dayofyear(day),
        "month_week": month_week(day, week_rule),
        "year_week": F.weekofyear(day),
        "month": F.month(day),
        "trimester": F.quarter(day),
        "year": F.year(day),
    }


def calendar_parts(ts: Column, week_rule: str = "us", day: Column | None = None) -> dict[str, Column]:
    """All eleven parts. Give ``day`` where the frame already carries the date of ``ts``:
    predicates on the date parts then move below any window partitioned by that date."""
    return time_of_day_parts(ts) | date_parts(F.to_date(ts) if day is None else day, week_rule)


def snapshot_name(ts: Column) -> Column:
    return F.date_format(ts, SNAPSHOT_NAME_FORMAT)


def day_string(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def current_year_text() -> Column:
    return F.date_format(F.current_date(), "yyyy")
