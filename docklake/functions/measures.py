"""Measures of one observation, shared by the batch and the streaming jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_STATUS = "OPN"


def is_open(status: Column) -> Column:
    return F.coalesce(status == OPEN_STATUS, F.lit(False))


def while_open(status: Column, value: Column) -> Column:
    """``value`` at an open station, 0 at any other."""
    return F.when(is_open(status), value).otherwise(0)


def lent(previous: Column, bikes: Column) -> Column:
    return F.coalesce(F.greatest(previous - bikes, F.lit(0)), F.lit(0))


def returned(previous: Column, bikes: Column) -> Column:
    return F.coalesce(F.greatest(bikes - previous, F.lit(0)), F.lit(0))


def fact_measures(status: Column, slots: Column, bikes: Column, previous: Column) -> dict[str, Column]:
    """Status zeroes what is on offer; movements always use the raw count. A null or negative
    ``previous`` means nothing is known and counts as no movement."""
    known = F.when(previous >= 0, previous)
    return {
        "slots": while_open(status, slots).cast("bigint"),
        "available": while_open(status, bikes).cast("bigint"),
        "capacity": while_open(status, slots + bikes).cast("bigint"),
        "lent": lent(known, bikes).cast("bigint"),
        "returned": returned(known, bikes).cast("bigint"),
    }
