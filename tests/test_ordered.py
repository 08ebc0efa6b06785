import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from docklake.operators.facts import facts
from docklake.operators.feed import monotone, refresh_interval
from docklake.operators.ordered import RANGE, Bucket, in_ranges, span_bucket, with_previous, with_running_max

ONE = [span_bucket("at", 10)]
TWO = [span_bucket("at", 3, "fine"), Bucket("coarse", "fine div 4")]


def series(spark, seed, keys=4, n=300):
    pick = random.Random(seed)
    values = [(pick.randrange(keys), t, pick.choice([None, *range(20)])) for t in pick.sample(range(2000), n)]
    # One key holds most rows.
    skewed = [(0 if pick.random() < 0.6 else k, t, v) for k, t, v in values]
    return spark.createDataFrame(skewed, "k int, at int, v int")


@pytest.mark.parametrize("buckets", [[], ONE, TWO], ids=["plain", "one", "two"])
def test_previous_equals_a_plain_window(spark, buckets):
    df = series(spark, 1)
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("at")))
    got = with_previous(df, ["k"], "at", "v", "p", buckets).select("k", "at", "v", "p")
    # A null value that ends a bucket is handed on as null as well.
    assert rows(got) == rows(want)


@pytest.mark.parametrize("buckets", [[], ONE, TWO], ids=["plain", "one", "two"])
def test_running_max_equals_a_plain_window(spark, buckets):
    df = series(spark, 2)
    frame = Window.partitionBy("k").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("m", F.max("v").over(frame))
    assert rows(with_running_max(df, ["k"], "at", "v", "m", buckets).select("k", "at", "v", "m")) == rows(want)


@pytest.mark.parametrize("buckets", [[], ONE, TWO], ids=["plain", "one", "two"])
def test_initial_values_stand_before_the_first_row(spark, buckets):
    df = spark.createDataFrame([(1, 5, 10), (1, 50, 20), (2, 7, 30)], "k int, at int, v int")
    before = spark.createDataFrame([(1, 99), (3, 98)], "k int, v int")
    got = with_previous(df, ["k"], "at", "v", "p", buckets, before).select("k", "at", "p")
    assert rows(got) == [(1, 5, 99), (1, 50, 10), (2, 7, None)]
    top = with_running_max(df, ["k"], "at", "v", "m", buckets, before).select("k", "at", "m")
    assert rows(top) == [(1, 5, 99), (1, 50, 99), (2, 7, None)]


def test_no_window_sorts_a_whole_key(spark):
    df = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("at"), F.col("id").alias("v"))
    plan = with_previous(df, ["k"], "at", "v", "p", ONE)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # The rows are windowed by key and slice; only slice summaries are windowed by key.
    assert len(windows) == 2 and "slice" in windows[0] and "Aggregate" in plan


def test_an_unused_previous_value_costs_nothing(spark):
    df = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("at"), F.col("id").alias("v"))
    used = with_previous(df, ["k"], "at", "v", "p", ONE).groupBy("k").agg(F.sum("v"))
    plan = used._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Union" not in plan


OBS = "station int, timetag timestamp_ntz, seq int, status string, slots int, bikes int"


def fold(observations):
    """The fact rows, one observation after the other."""
    last_of_second = {}
    for station, second, seq, status, slots, bikes in sorted(observations):
        last_of_second[station, second] = (status, slots, bikes)
    count, out = {}, []
    for (station, second), (status, slots, bikes) in sorted(last_of_second.items()):
        before = count.get(station)
        opened = status == "OPN"
        moves = (0, 0) if before is None else (max(before - bikes, 0), max(bikes - before, 0))
        shown = (slots, bikes, slots + bikes) if opened else (0, 0, 0)
        out.append((station, second, status, *shown, *moves))
        count[station] = bikes
    return out


observation = st.tuples(
    st.integers(1, 3), st.integers(0, 400_000), st.integers(0, 5), st.sampled_from(["OPN", "CLS"]),
    st.integers(0, 9), st.integers(0, 9),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(observation, min_size=1, max_size=40, unique_by=lambda o: o[:3]))
def test_facts_equal_a_fold(spark, observations):
    from datetime import datetime, timedelta

    start = datetime(2014, 5, 24)
    data = [(s, start + timedelta(seconds=t), *rest) for s, t, *rest in observations]
    got = facts(spark.createDataFrame(data, OBS), ["seq"]).drop("day")
    want = [(s, start + timedelta(seconds=t), *rest) for s, t, *rest in fold(observations)]
    assert rows(got) == sorted(want, key=repr)


def test_monotone_drops_repeated_and_older_snapshots(spark):
    arrivals = [("a", 5), ("a", 5), ("a", 3), ("b", 1), ("a", 9), ("b", 1), ("b", 2), ("a", 8)]
    raw = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(arrivals)], "datasource string, timestamp_ms bigint, arrival int")
    want = [("a", 5, 0), ("a", 9, 4), ("b", 1, 3), ("b", 2, 6)]
    for buckets in ([], [span_bucket("arrival", 2)]):
        assert rows(monotone(raw, buckets=buckets)) == want
    known = spark.createDataFrame([("a", 5)], "datasource string, timestamp_ms bigint")
    assert rows(monotone(raw, [], initial=known)) == want[1:]


def test_refresh_interval(spark):
    times = [("a", t) for t in (100, 100, 160, 220, 90_000)] + [("b", 7)]
    got = refresh_interval(spark.createDataFrame(times, "datasource string, updatetime bigint"))
    assert rows(got) == [("a", 60, 60, 89_780, 89_900 / 3, 3)]


@pytest.mark.parametrize("ranges", [1, 7])
def test_scan_over_ranges_of_the_data(spark, folder, ranges):
    """One key has nine tenths of the rows, all of one day; nulls among the values are carried like others."""
    made = spark.range(4000).select(
        F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id") % 7 + 2).alias("station"),
        F.expr("timestamp_ntz'2024-01-16 00:00:00' + make_dt_interval(0, 0, 0, pmod(id * 977, 4001))").alias("timetag"),
        F.when(F.col("id") % 13 > 0, F.pmod(F.xxhash64("id"), F.lit(50))).alias("bikes"),
    )
    cut = in_ranges(made, ["station"], "timetag", f"{folder}/ranges", ranges)
    sizes = [row["count"] for row in cut.groupBy(RANGE.name).count().collect()]
    assert len(sizes) == ranges and max(sizes) <= 2 * 4000 / ranges
    for function, plain in ((with_previous, with_previous), (with_running_max, with_running_max)):
        found = function(cut, ["station"], "timetag", "bikes", "out", [RANGE]).drop(RANGE.name)
        assert rows(found) == rows(plain(made, ["station"], "timetag", "bikes", "out", []))


def test_no_window_of_a_scan_takes_a_whole_key(spark, folder):
    made = spark.range(100).select(F.lit(1).alias("station"), F.col("id").alias("timetag"), F.col("id").alias("bikes"))
    cut = in_ranges(made, ["station"], "timetag", f"{folder}/ranges", 4)
    moved = with_previous(cut, ["station"], "timetag", "bikes", "previous", [RANGE])
    plan = moved._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and "[station#" in windows[0]
    assert "_range" in windows[0].split("windowspecdefinition(")[1].split(" ASC")[0]  # rows: by station and range
    assert "_range" in windows[1].split(" ASC")[0].split("windowspecdefinition(")[1]  # summaries: ordered by range
