"""Members of the time hierarchy as stretches of time.

A member, such as the third week of a month, is a path of calendar numbers in the tables. Turned into the first moment it
holds and the first one after it, it is a bound on the observation time itself, which reaches the scan of observations
and of whatever the tables are computed from.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = ("Year", "Quarter", "Month", "Week", "Day", "Hour", "Minute")


@dataclass(frozen=True)
class Period:
    """From ``start`` up to, not including, ``end``. Without both it holds nothing, and nothing is before it."""

    start: datetime | None
    end: datetime | None

    def holds(self, time: str | Column) -> Column:
        column = F.col(time) if isinstance(time, str) else time
        return F.lit(False) if self.start is None else (column >= F.lit(self.start)) & (column < F.lit(self.end))

    def before(self, time: str | Column) -> Column:
        column = F.col(time) if isinstance(time, str) else time
        return F.lit(False) if self.start is None else column < F.lit(self.start)


def bounds(time: Column, level: str, week_rule: str = "us") -> tuple[Column, Column]:
    """The first moment of the member of ``level`` that ``time`` is in, and the first one after it.

    A week is one of a month: it starts on its Sunday (``us``) or Monday (``es``) or with the month, and ends with the month.
    """
    day = F.to_date(time)
    if level in ("Year", "Quarter", "Month"):
        months = {"Year": 12, "Quarter": 3, "Month": 1}[level]
        start = F.trunc(day, level)
        return start.cast("timestamp_ntz"), F.add_months(start, months).cast("timestamp_ntz")
    if level == "Week":
        if week_rule not in ("us", "es"):
            raise ValueError(f"unknown week rule {week_rule!r}")
        month = F.trunc(day, "Month")
        start = F.date_sub(day, F.dayofweek(day) - 1 if week_rule == "us" else F.weekday(day))
        return (
            F.greatest(start, month).cast("timestamp_ntz"),
            F.least(F.date_add(start, 7), F.add_months(month, 1)).cast("timestamp_ntz"),
        )
    if level not in LEVELS:
        raise ValueError(f"unknown level {level!r}")
    hours = F.hour(time) if level in ("Hour", "Minute") else F.lit(0)
    minutes = F.minute(time) if level == "Minute" else F.lit(0)
    start = day.cast("timestamp_ntz") + F.make_dt_interval(hours=hours, mins=minutes)
    length = {"Day": "1 day", "Hour": "1 hour", "Minute": "1 minute"}[level]
    return start, start + F.expr(f"interval {length}")


def last_periods(
    table: DataFrame, level: str, count: int = 1, time: str = "timetag", week_rule: str = "us"
) -> list[Period]:
    """The last ``count`` members of ``level`` that occur in ``table``, the last one first; fewer if there are no more."""
    if count == 1:
        times = table.agg(F.max(time).alias("at")).where(F.col("at").isNotNull())
        members = times.select(*_named(bounds(F.col("at"), level, week_rule)))
    else:
        members = table.select(*_named(bounds(F.col(time), level, week_rule))).where(F.col("start").isNotNull()).distinct()
        members = members.orderBy(F.desc("start")).limit(count)
    return [Period(row["start"], row["end"]) for row in members.collect()]


def last_period(table: DataFrame, level: str, time: str = "timetag", week_rule: str = "us") -> Period:
    """The last member of ``level``, found in one aggregate over ``table``."""
    found = last_periods(table, level, 1, time, week_rule)
    return found[0] if found else Period(None, None)


def span(periods: list[Period]) -> Period:
    """The shortest period that holds all of ``periods``."""
    if not periods:
        return Period(None, None)
    return Period(min(p.start for p in periods), max(p.end for p in periods))


def in_any(periods: list[Period], time: str = "timetag") -> Column:
    return reduce(or_, (period.holds(time) for period in periods), F.lit(False))


def _named(pair: tuple[Column, Column]) -> tuple[Column, Column]:
    return pair[0].alias("start"), pair[1].alias("end")
