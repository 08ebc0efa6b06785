from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from docklake.operators.cube import NamedSet
from docklake.operators.facts import facts
from docklake.plans import saved
from docklake.plans.cubes import FLAT_CUBE, STATION_CUBE
from docklake.plans.star import big_table, located, star_join, time_dimension
from docklake.schemas import BIG_TABLE_COLUMNS, STATION_DIM
from docklake.sinks.files import write_big_table

DIM = [
    (1, 2.180042, 41.397952, 21, "Eixample", "El Fort Pienc", "08013", "Gran Via Corts Catalanes 760", 35678.34, 266874, 7.48),
    (2, 2.1, 41.3, 20, "Eixample", "Dreta", "08010", "Ausias 1", 35678.34, 266874, 7.48),
    (5, 2.18, 41.39, 16, "Ciutat Vella", "El Born", "08003", "Pg 11", 24582.61, 107426, 4.37),
    (27, 2.16, 41.39, 49, None, None, "08037", "Provença 322", None, None, None),
]

OBS = [
    # station, time, status, slots, bikes
    (1, datetime(2014, 4, 30, 23, 59), "OPN", 10, 9),
    (1, datetime(2014, 5, 24, 14, 4, 6), "OPN", 13, 4),
    (1, datetime(2014, 5, 31, 23, 0), "OPN", 5, 6),
    (2, datetime(2014, 5, 31, 8, 0), "OPN", 5, 3),
    (2, datetime(2014, 5, 31, 23, 30), "CLS", 5, 7),
    (5, datetime(2014, 5, 26, 9, 0), "OPN", 2, 2),
    (5, datetime(2014, 5, 27, 9, 0), "OPN", 3, 1),
    (27, datetime(2014, 5, 27, 10, 0), "OPN", 3, 1),
    (99, datetime(2014, 6, 15, 10, 0), "OPN", 3, 1),
]


@pytest.fixture(scope="module")
def obs(spark):
    return spark.createDataFrame(OBS, "station bigint, timetag timestamp_ntz, status string, slots int, bikes int")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(DIM, STATION_DIM)


@pytest.fixture(scope="module")
def big(obs, dim):
    return big_table(facts(obs), dim).cache()


def test_golden_row(spark, dim):
    one = [(1, datetime(2014, 5, 24, 14, 4, 6), "OPN", 13, 9)]
    obs = spark.createDataFrame(one, "station bigint, timetag timestamp_ntz, status string, slots int, bikes int")
    zero = spark.createDataFrame([(1, 0)], "station bigint, bikes int")
    got = big_table(facts(obs, initial=zero), dim).first()
    assert tuple(got) == (
        1, datetime(2014, 5, 24, 14, 4, 6), "OPN", 13, 9, 22, 0, 9, 9, "Eixample", "El Fort Pienc", "08013",
        "Gran Via Corts Catalanes 760", 35678.34, 266874, 7.48, "[30+", "[200+", "[5 - 10)", 4, 14,
        "[12:00 - 16:00)", "LUNCH", 24, 144, 4, 21, 5, 2, 2014,
    )
    assert got.__fields__ == list(BIG_TABLE_COLUMNS)


def test_unknown_stations_are_left_out_but_move_on(obs, dim, big):
    assert big.where("station = 99").count() == 0
    late = big_table(facts(obs.withColumn("station", F.when(F.col("station") == 2, 99).otherwise(F.col("station")))), dim)
    assert late.where("station = 2").count() == 0


def test_star_join_has_the_same_rows(obs, dim, big):
    joined = star_join(facts(obs), dim, time_dimension(obs))
    same = [c for c in joined.columns]
    assert rows(joined) == rows(big.select(*same))


def test_last_month_is_the_last_in_the_data(big, obs, dim):
    assert rows(STATION_CUBE.last_members(big, "Time", "Month")) == [(2014, 2, 5)]
    assert rows(STATION_CUBE.last_members(big, "Time", "Week", 2)) == [(2014, 2, 5, 4), (2014, 2, 5, 5)]
    assert rows(STATION_CUBE.last_members(located(obs, dim), "Time", "Hour")) == [(2014, 2, 5, 5, 31, 23)]


def test_lent_by_station(big):
    got = [tuple(r) for r in saved.lent_by_station(big, "last_month").collect()]
    assert [(r[3], r[4], r[5:]) for r in got] == [
        (1, 5, (None, None, None, 5, None, 0)),
        (5, 1, (None, None, 1, None, None, None)),
        (27, 0, (None, None, 0, None, None, None)),
        (2, 0, (None, None, 0, None, None, 0)),
    ]


def test_movement_by_district_orders_by_returned(big):
    got = saved.movement_by_district(big)
    assert [(r.district, r.total_bikes_returned, r.total_bikes_lent) for r in got.collect()] == [
        ("Eixample", 6, 5), (None, 0, 0), ("Ciutat Vella", 0, 1),
    ]
    assert [c for c in got.columns if c.endswith("20_00")] == ["total_bikes_returned_20_00", "total_bikes_lent_20_00"]


def test_movement_by_size_puts_least_lent_first(big):
    got = [tuple(r) for r in saved.movement_by_size(big).collect()]
    assert got == [(None, 0.0, 0.0), ("[0 - 5)", 0.5, 0.0), ("[5 - 10)", 1.0, 6 / 5)]


def test_where_to_place_orders_by_available_then_traffic(big):
    got = [tuple(r) for r in saved.where_to_place(big, "last_month").collect()]
    assert got == [(None, 1.0, 0), ("Ciutat Vella", 1.5, 1), ("Eixample", 13 / 4, 11)]
    week = [tuple(r) for r in saved.where_to_place(big, "last_week").collect()]
    assert week == [(None, 1.0, 0), ("Ciutat Vella", 1.5, 1), ("Eixample", 3.0, 6)]


def test_station_reports(big):
    path = ["Eixample", "El Fort Pienc", "08013", 1]
    assert rows(saved.station_last_hour(big, path)) == [(2014, 2, 5, 5, 31, 23, 0, 6.0, 0.0, 2.0)]
    hours = [tuple(r)[:6] for r in saved.station_by_hour(big, path).collect()]
    assert hours == [(2014, 2, 4, 5, 30, 23), (2014, 2, 5, 4, 24, 14), (2014, 2, 5, 5, 31, 23)]
    # The last hour of the whole table, in which this station has no row.
    assert rows(saved.station_last_hour(big, ["Ciutat Vella", "El Born", "08003", 5])) == []
    assert saved.district_by_minute(big, None).count() == 1
    with pytest.raises(ValueError):
        STATION_CUBE.at_member(big, "StationDistrict", "StationId", ["Eixample"])


def test_rollup_lists_parents_first(big):
    got = STATION_CUBE.rollup(big, "StationDistrict", "Neighborhood", ["total_station_count"]).collect()
    assert [tuple(r) for r in got] == [
        (None, None, 0, 4),
        (None, None, 1, 1), (None, None, 2, 1),
        ("Ciutat Vella", None, 1, 1), ("Ciutat Vella", "El Born", 2, 1),
        ("Eixample", None, 1, 2), ("Eixample", "Dreta", 2, 1), ("Eixample", "El Fort Pienc", 2, 1),
    ]


def test_a_last_member_with_a_null_part(spark):
    big = spark.createDataFrame([("A", "x", 1), ("Z", None, 2), ("Z", None, 3)], "district string, neighborhood string, station int")
    for count in (1, 2):
        last = STATION_CUBE.in_set(big, NamedSet("last", "StationDistrict", "Neighborhood", count))
        assert rows(last.select("station")) == ([(2,), (3,)] if count == 1 else [(1,), (2,), (3,)])
    none = big.where("station > 9")
    assert STATION_CUBE.at_last(big, "StationDistrict", "Neighborhood", none).count() == 0


def test_rollups_expand_aggregated_rows_only(big):
    plans = [
        STATION_CUBE.rollup(big, "StationDistrict", "Neighborhood", ["total_traffic", "average_lent", "total_station_count"]),
        STATION_CUBE.combinations(big, [("StationStatus", "Status"), ("DayParts", "DayPart")], ["total_traffic"]),
    ]
    for frame in plans:
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("Expand") :].split("\n")[1:]
        assert "Aggregate" in next(line for line in below if "Project" not in line)


def test_unknown_names(big):
    with pytest.raises(KeyError):
        STATION_CUBE.query(big, [("StationDistrict", "Street")], ["total_traffic"])
    with pytest.raises(KeyError):
        STATION_CUBE.query(big, [("StationDistrict", "District")], ["total_noise"])


def test_limit_follows_the_order(big):
    got = STATION_CUBE.query(big, saved.DISTRICTS, ["total_traffic"], order=[("total_traffic", "desc")], limit=1)
    assert rows(got) == [("Eixample", 11)]


def test_flat_cube(spark):
    data = [("h1", "d", "f", "2014-01-01", 1, 2, 3), ("h1", "e", "f", "2014-01-01", 4, 5, 6), ("h2", "d", "f", "2014-01-02", 7, 8, 9)]
    flat = spark.createDataFrame(data, "host string, domain string, feature string, date string, core int, db int, active_visitor int")
    assert rows(FLAT_CUBE.query(flat, [("HOST", "HOST")], ["core", "db", "active_visitor"])) == [("h1", 5, 7, 9), ("h2", 7, 8, 9)]


def test_last_month_of_a_stored_table_prunes_partitions(spark, big, folder):
    write_big_table(big, f"{folder}/big")
    stored = spark.read.parquet(f"{folder}/big")
    got = saved.where_to_place(stored, "last_month")
    assert rows(got) == rows(saved.where_to_place(big, "last_month"))
    weekly = saved.where_to_place(saved.last_month_of(stored), "last_week")
    assert rows(weekly) == rows(saved.where_to_place(big, "last_week"))
    assert stored.select("year", "month").distinct().count() == 2
    assert partitions_read(got) == partitions_read(weekly) == {1}


def partitions_read(frame):
    """Numbers of partitions that the scans of the rows themselves (not of subqueries) have read."""
    frame.collect()
    found, todo = set(), [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.metrics().contains("numPartitions") and "Scan" in node.nodeName():
            found.add(node.metrics().apply("numPartitions").value())
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_slicers_reach_the_scan_of_a_computed_table(spark, dim, obs, folder):
    obs.write.parquet(f"{folder}/obs")
    computed = big_table(facts(spark.read.parquet(f"{folder}/obs"), unique=True), dim)
    of_station = STATION_CUBE.at_member(computed, "StationDistrict", "StationId", ["Eixample", "Dreta", "08010", 2])
    plan = of_station._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [EqualNullSafe(station,2)") == 2


def test_calendar_slicers_move_below_the_window(spark, dim, obs, folder):
    obs.write.parquet(f"{folder}/obs")
    stored = spark.read.parquet(f"{folder}/obs")
    report = saved.where_to_place(big_table(facts(stored), dim), "last_month", located(stored, dim))
    plan = report._jdf.queryExecution().optimizedPlan().toString().splitlines()
    window = next(i for i, line in enumerate(plan) if "Window [lag" in line)
    filters = [i for i, line in enumerate(plan) if "Filter" in line and "year(" in line and "scalar-subquery" in line]
    assert filters and min(filters) > window
