from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docklake.catalog import QUERIES
from docklake.functions.calendar import calendar_parts
from docklake.plans import periods
from docklake.plans.cubes import STATION_CUBE

SF_DIR = "/root/testdata/sf0.001"


def _times(spark):
    """Every 37 hours of seven years, and moments around the ends of months."""
    made = spark.range(1600).selectExpr("timestamp_ntz'2012-01-01 00:00:00' + make_dt_interval(0, id * 37, id % 60, 0) AS timetag")
    edges = [datetime(2014, m, 1) + timedelta(seconds=s) for m in range(1, 13) for s in (-1, 0, 1)]
    return made.unionByName(spark.createDataFrame([(t,) for t in edges], "timetag timestamp_ntz"))


@pytest.mark.parametrize("rule", ["us", "es"])
@pytest.mark.parametrize("level", periods.LEVELS)
def test_a_period_is_the_member_of_its_path(spark, level, rule):
    """Times share a member exactly if they share a period, and every time lies in its own."""
    path = STATION_CUBE.path("Time", level)
    start, end = periods.bounds(F.col("timetag"), level, rule)
    rows = _times(spark).withColumns({**calendar_parts(F.col("timetag"), rule), "start": start, "end": end})
    assert rows.where("timetag < start OR timetag >= end").count() == 0
    members, stretches = rows.select(*path).distinct().count(), rows.select("start", "end").distinct().count()
    assert members == stretches == rows.select(*path, "start", "end").distinct().count()


def test_last_members_and_an_empty_table(spark):
    times = _times(spark).where("timetag < '2014-03-01'")
    assert periods.last_period(times, "Month") == periods.Period(datetime(2014, 2, 1), datetime(2014, 3, 1))
    weeks = periods.last_periods(times, "Week", 2)
    assert weeks == [periods.Period(datetime(2014, 2, 23), datetime(2014, 3, 1)), periods.Period(datetime(2014, 2, 16), datetime(2014, 2, 23))]
    assert periods.span(weeks) == periods.Period(datetime(2014, 2, 16), datetime(2014, 3, 1))
    none = periods.last_period(times.limit(0), "Week")
    assert none == periods.Period(None, None) == periods.span([]) and times.where(none.holds("timetag") | none.before("timetag")).count() == 0
    with pytest.raises(ValueError):
        periods.bounds(F.col("timetag"), "Century")


@pytest.mark.parametrize("name", ["m1", "m5", "m7", "m9", "usage_last_hour", "last_three_weeks", "m7_many_months"])
def test_the_period_bounds_every_scan_of_a_report(spark, name):
    plan = QUERIES[name].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    time = "o_orderdate" if "months" in name else "ts"
    scans = [line for line in plan.splitlines() if "FileScan" in line and f"{time}#" in line]
    assert 2 <= len(scans) <= 3 and all(f"LessThan({time}," in scan for scan in scans)
    assert sum(f"GreaterThanOrEqual({time}," in scan for scan in scans) == len(scans) - 1  # but for what came before it
    assert len(plan) < 60_000 and "Subquery" not in plan
