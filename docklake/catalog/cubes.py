"""Cube queries and the saved reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from docklake.catalog import adapter, sql
from docklake.catalog.registry import named_query
from docklake.operators.cube import SKETCH_ERROR, Axis, NamedSet
from docklake.operators.facts import facts
from docklake.plans import saved
from docklake.plans.cubes import FLAT_CUBE, STATION_CUBE
from docklake.plans.periods import Period, bounds, in_any, last_periods, span
from docklake.plans.star import big_table, located
from docklake.schemas import FACT_COLUMNS
from docklake.session import scratch_dir
from docklake.sinks.files import write_big_table

PATH = "district, neighborhood, postal_code, station"
HOUR_PATH = "year, trimester, month, month_week, month_day, hour"
MINUTE_PATH = HOUR_PATH + ", minute"
USAGE_SQL = (
    "avg(available) AS average_bikes_available, avg(lent) AS average_lent, avg(returned) AS average_returned"
)


@named_query(
    "traffic_by_district",
    f"""WITH {sql.BIG} SELECT district, CAST(sum(available) AS BIGINT) AS total_bikes_available,
      CAST(sum(slots) AS BIGINT) AS total_bike_slots, CAST(sum(capacity) AS BIGINT) AS total_capacity,
      CAST(sum(lent) AS BIGINT) AS total_bikes_lent, CAST(sum(returned) AS BIGINT) AS total_bikes_returned,
      CAST(sum(traffic) AS BIGINT) AS total_traffic FROM big GROUP BY district""",
)
def traffic_by_district(spark, sf_dir):
    measures = [m.name for m in STATION_CUBE.measures if m.aggregator == "sum"]
    return STATION_CUBE.query(adapter.wide_table(spark, sf_dir), saved.DISTRICTS, measures)


@named_query(
    "avg_by_status",
    f"""WITH {sql.BIG} SELECT status, avg(available) AS average_bikes_available, avg(slots) AS average_bike_slots,
      avg(capacity) AS average_capacity, avg(lent) AS average_lent, avg(returned) AS average_returned,
      avg(traffic) AS average_traffic FROM big GROUP BY status""",
)
def avg_by_status(spark, sf_dir):
    measures = [m.name for m in STATION_CUBE.measures if m.aggregator == "avg"]
    return STATION_CUBE.query(adapter.wide_table(spark, sf_dir), [("StationStatus", "Status")], measures)


@named_query(
    "station_count_by_district",
    f"WITH {sql.BIG} SELECT district, count(DISTINCT station) AS total_station_count FROM big GROUP BY district",
)
def station_count_by_district(spark, sf_dir):
    return STATION_CUBE.query(adapter.wide_table(spark, sf_dir), saved.DISTRICTS, ["total_station_count"])


@named_query(
    "traffic_by_neighborhood",
    f"WITH {sql.BIG} SELECT neighborhood, CAST(sum(traffic) AS BIGINT) AS total_traffic FROM big GROUP BY neighborhood",
)
def traffic_by_neighborhood(spark, sf_dir):
    rows = [("StationDistrict", "Neighborhood")]
    return STATION_CUBE.query(adapter.wide_table(spark, sf_dir), rows, ["total_traffic"], paths=False)


@named_query(
    "usage_by_demography",
    f"""WITH {sql.BIG} SELECT pop_range, pop_density_range, size_range, part, avg(traffic) AS average_traffic
    FROM big GROUP BY ALL""",
)
def usage_by_demography(spark, sf_dir):
    rows = [
        ("Population", "PopulationRange"),
        ("PopulationDensity", "PopulationDensityRange"),
        ("DistrictSize", "SizeRange"),
        ("DayParts", "DayPart"),
    ]
    return STATION_CUBE.query(adapter.wide_table(spark, sf_dir), rows, ["average_traffic"])


@named_query(
    "rollup_district",
    f"""WITH {sql.BIG} SELECT district, neighborhood, CAST(2 - grouping(district) - grouping(neighborhood) AS INTEGER) AS depth,
      CAST(sum(traffic) AS BIGINT) AS total_traffic, count(DISTINCT station) AS total_station_count
    FROM big GROUP BY ROLLUP (district, neighborhood)""",
)
def rollup_district(spark, sf_dir):
    big = adapter.wide_table(spark, sf_dir)
    return STATION_CUBE.rollup(big, "StationDistrict", "Neighborhood", ["total_traffic", "total_station_count"])


@named_query(
    "rollup_time",
    f"""WITH {sql.BIG} SELECT year, trimester, month, month_week,
      CAST(4 - grouping(year) - grouping(trimester) - grouping(month) - grouping(month_week) AS INTEGER) AS depth,
      CAST(sum(lent) AS BIGINT) AS total_bikes_lent, avg(available) AS average_bikes_available
    FROM big GROUP BY ROLLUP (year, trimester, month, month_week)""",
)
def rollup_time(spark, sf_dir):
    big = adapter.wide_table(spark, sf_dir)
    return STATION_CUBE.rollup(big, "Time", "Week", ["total_bikes_lent", "average_bikes_available"])


@named_query(
    "all_combinations",
    f"""WITH {sql.BIG} SELECT status, part, CAST(2 - grouping(status) - grouping(part) AS INTEGER) AS depth,
      CAST(sum(traffic) AS BIGINT) AS total_traffic FROM big GROUP BY CUBE (status, part)""",
)
def all_combinations(spark, sf_dir):
    levels = [("StationStatus", "Status"), ("DayParts", "DayPart")]
    return STATION_CUBE.combinations(adapter.wide_table(spark, sf_dir), levels, ["total_traffic"])


@named_query("members_distinct", f"WITH {sql.BIG} SELECT DISTINCT district, neighborhood, postal_code FROM big")
def members_distinct(spark, sf_dir):
    return STATION_CUBE.members(adapter.located_observations(spark, sf_dir), "StationDistrict", "PostalCode")


def _last_sql(path):
    return f"WITH {sql.BIG} SELECT {path} FROM big ORDER BY timetag DESC LIMIT 1"


@named_query("last_month_set", _last_sql("year, trimester, month"))
def last_month_set(spark, sf_dir):
    return STATION_CUBE.last_members(adapter.located_observations(spark, sf_dir), "Time", "Month")


@named_query("last_week_set", _last_sql("year, trimester, month, month_week"))
def last_week_set(spark, sf_dir):
    return STATION_CUBE.last_members(adapter.located_observations(spark, sf_dir), "Time", "Week")


@named_query("last_hour_set", _last_sql(HOUR_PATH))
def last_hour_set(spark, sf_dir):
    return STATION_CUBE.last_members(adapter.located_observations(spark, sf_dir), "Time", "Hour")


@named_query(
    "last_three_weeks",
    f"""WITH {sql.BIG}, weeks AS (SELECT DISTINCT year, trimester, month, month_week FROM big ORDER BY ALL DESC LIMIT 3)
    SELECT part, CAST(sum(traffic) AS BIGINT) AS total_traffic FROM big
    WHERE (year, trimester, month, month_week) IN (SELECT (year, trimester, month, month_week) FROM weeks) GROUP BY part""",
)
def last_three_weeks(spark, sf_dir):
    weeks = last_periods(adapter.located_observations(spark, sf_dir), "Week", 3)
    rows = adapter.wide_in(spark, sf_dir, span(weeks)).where(in_any(weeks))
    return STATION_CUBE.query(rows, [("DayParts", "DayPart")], ["total_traffic"])


def _station_axis_sql(measure, column, period):
    return f"WITH {sql.BIG} SELECT {PATH}, {sql.pivoted(measure, column)} FROM big WHERE {sql.LAST[period]} GROUP BY {PATH}"


@named_query("m1", _station_axis_sql("total_bikes_lent", "lent", "last_week"))
def m1(spark, sf_dir):
    return saved.lent_by_station(adapter.wide_in_last(spark, sf_dir, "Week"))


@named_query("m2", _station_axis_sql("total_bikes_lent", "lent", "last_month"))
def m2(spark, sf_dir):
    return saved.lent_by_station(adapter.wide_in_last(spark, sf_dir, "Month"))


@named_query("m3", _station_axis_sql("total_bikes_returned", "returned", "last_week"))
def m3(spark, sf_dir):
    return saved.returned_by_station(adapter.wide_in_last(spark, sf_dir, "Week"))


@named_query("m4", _station_axis_sql("total_bikes_returned", "returned", "last_month"))
def m4(spark, sf_dir):
    return saved.returned_by_station(adapter.wide_in_last(spark, sf_dir, "Month"))


@named_query(
    "m5",
    f"""WITH {sql.BIG} SELECT district, {sql.pivoted('total_bikes_returned', 'returned')},
      {sql.pivoted('total_bikes_lent', 'lent')} FROM big WHERE {sql.LAST['last_month']} GROUP BY district""",
)
def m5(spark, sf_dir):
    return saved.movement_by_district(adapter.wide_in_last(spark, sf_dir, "Month"), None)


@named_query(
    "m6",
    f"""WITH {sql.BIG} SELECT size_range, avg(lent) AS average_lent, avg(returned) AS average_returned
    FROM big GROUP BY size_range""",
)
def m6(spark, sf_dir):
    return saved.movement_by_size(adapter.wide_table(spark, sf_dir))


def _where_sql(period):
    return f"""WITH {sql.BIG} SELECT district, avg(available) AS average_bikes_available,
      CAST(sum(traffic) AS BIGINT) AS total_traffic FROM big WHERE {sql.LAST[period]} GROUP BY district"""


@named_query("m7", _where_sql("last_month"))
def m7(spark, sf_dir):
    return saved.where_to_place(adapter.wide_in_last(spark, sf_dir, "Month"))


@named_query("m8", _where_sql("last_week"))
def m8(spark, sf_dir):
    return saved.where_to_place(adapter.wide_in_last(spark, sf_dir, "Week"))


@named_query("stored_where_to_place", _where_sql("last_week"))
def stored_where_to_place(spark, sf_dir):
    """The same report from a stored wide table: both the last week and its rows are looked for in
    the last month's partition only."""
    path = scratch_dir(spark, "big")
    write_big_table(adapter.wide_table(spark, sf_dir), path)
    stored = spark.read.parquet(path)
    return saved.where_to_place(saved.last_month_of(stored), "last_week")


# The station of these two reports is the one seen last; its path comes with the time it was seen, from one aggregate.
AT_LAST_STATION = f"({PATH}) IS NOT DISTINCT FROM (SELECT ({PATH}) FROM big ORDER BY timetag DESC, station DESC LIMIT 1)"


def last_seen(spark, sf_dir):
    """The path of the station seen last, and the last hour."""
    path = STATION_CUBE.path("StationDistrict", "StationId")
    seen = adapter.located_observations(spark, sf_dir).agg(
        F.max_by(F.struct(*path), F.struct("timetag", "station")).alias("path"), F.max("timetag").alias("timetag")
    )
    row = seen.select("path", *(side.alias(name) for side, name in zip(bounds(F.col("timetag"), "Hour"), ("start", "end")))).first()
    return list(row["path"] or [None] * len(path)), Period(row["start"], row["end"])


@named_query(
    "m9",
    f"""WITH {sql.BIG} SELECT {MINUTE_PATH}, {USAGE_SQL} FROM big
    WHERE {AT_LAST_STATION} AND {sql.LAST['last_hour']} GROUP BY {MINUTE_PATH}""",
)
def m9(spark, sf_dir):
    path, hour = last_seen(spark, sf_dir)
    return saved.station_last_hour(adapter.wide_in(spark, sf_dir, hour), path, sliced=True)


@named_query(
    "m10",
    f"WITH {sql.BIG} SELECT {MINUTE_PATH}, {USAGE_SQL} FROM big WHERE district = 'EUROPE' GROUP BY {MINUTE_PATH}",
)
def m10(spark, sf_dir):
    return saved.district_by_minute(adapter.wide_table(spark, sf_dir), "EUROPE")


@named_query(
    "m11",
    f"WITH {sql.BIG} SELECT {HOUR_PATH}, {USAGE_SQL} FROM big WHERE {AT_LAST_STATION} GROUP BY {HOUR_PATH}",
)
def m11(spark, sf_dir):
    path, _ = last_seen(spark, sf_dir)
    return saved.station_by_hour(adapter.wide_table(spark, sf_dir), path)


@named_query(
    "usage_last_hour",
    f"WITH {sql.BIG} SELECT {MINUTE_PATH}, {USAGE_SQL} FROM big WHERE {sql.LAST['last_hour']} GROUP BY {MINUTE_PATH}",
)
def usage_last_hour(spark, sf_dir):
    rows = adapter.wide_in_last(spark, sf_dir, "Hour")
    return STATION_CUBE.query(rows, [("Time", "Minute")], saved.USAGE)


@named_query(
    "top_stations",
    f"""WITH {sql.BIG} SELECT {PATH}, CAST(sum(traffic) AS BIGINT) AS total_traffic FROM big GROUP BY {PATH}
    ORDER BY total_traffic DESC, district NULLS FIRST, neighborhood, postal_code, station LIMIT 20""",
)
def top_stations(spark, sf_dir):
    order = [("total_traffic", "desc")]
    return STATION_CUBE.query(adapter.wide_table(spark, sf_dir), saved.STATIONS, ["total_traffic"], order=order, limit=20)


# The reports over many months: orders are the observations.

ORDER_MEMBERS = "year, trimester, month"


def _over_months(spark, sf_dir, period):
    obs, stations = adapter.order_observations(spark, sf_dir), adapter.customer_stations(spark, sf_dir)
    return big_table(facts(obs, adapter.TIE), stations), period, located(obs, stations)


@named_query("facts_with_ties", sql.over_months(f"WITH {sql.FACT} SELECT * FROM fact"))
def facts_with_ties(spark, sf_dir):
    return facts(adapter.order_observations(spark, sf_dir), adapter.TIE).select(*FACT_COLUMNS)


@named_query("m2_many_months", sql.over_months(_station_axis_sql("total_bikes_lent", "lent", "last_month")))
def m2_many_months(spark, sf_dir):
    return saved.lent_by_station(adapter.wide_in_last(spark, sf_dir, "Month", "orders"))


@named_query(
    "m5_many_months",
    sql.over_months(f"""WITH {sql.BIG} SELECT district, {sql.pivoted('total_bikes_returned', 'returned')},
      {sql.pivoted('total_bikes_lent', 'lent')} FROM big WHERE {sql.LAST['last_month']} GROUP BY district"""),
)
def m5_many_months(spark, sf_dir):
    return saved.movement_by_district(adapter.wide_in_last(spark, sf_dir, "Month", "orders"), None)


@named_query("m7_many_months", sql.over_months(_where_sql("last_month")))
def m7_many_months(spark, sf_dir):
    return saved.where_to_place(adapter.wide_in_last(spark, sf_dir, "Month", "orders"))


@named_query(
    "rollup_months",
    sql.over_months(f"""WITH {sql.BIG} SELECT {ORDER_MEMBERS},
      CAST(3 - grouping(year) - grouping(trimester) - grouping(month) AS INTEGER) AS depth,
      CAST(sum(lent) AS BIGINT) AS total_bikes_lent, avg(available) AS average_bikes_available,
      count(DISTINCT station) AS total_station_count
    FROM big GROUP BY ROLLUP ({ORDER_MEMBERS})"""),
)
def rollup_months(spark, sf_dir):
    big, _, _ = _over_months(spark, sf_dir, "last_month")
    measures = ["total_bikes_lent", "average_bikes_available", "total_station_count"]
    return STATION_CUBE.rollup(big, "Time", "Month", measures)


@named_query("stored_month_reports", sql.over_months(_where_sql("last_month")))
def stored_month_reports(spark, sf_dir):
    """From a stored table of many months, of which the report reads the last one's partition."""
    path = scratch_dir(spark, "big")
    write_big_table(_over_months(spark, sf_dir, "last_month")[0], path)
    return saved.where_to_place(spark.read.parquet(path), "last_month", saved.stored_months(spark, path))


def _without_neighborhoods(spark, sf_dir):
    """Stations of which those in Europe have no neighborhood: the last member of the level has a null part."""
    stations = adapter.customer_stations(spark, sf_dir)
    known = F.when(F.coalesce(F.col("district") != "EUROPE", F.lit(True)), F.col("neighborhood"))
    return adapter.fact_rows(spark, sf_dir), stations.withColumn("neighborhood", known)


def _last_neighborhoods_sql(count):
    return f"""WITH {sql.BIG}, placed AS (
      SELECT * REPLACE (CASE WHEN district = 'EUROPE' THEN NULL ELSE neighborhood END AS neighborhood) FROM big),
    members AS (SELECT DISTINCT district, neighborhood FROM placed
      ORDER BY district DESC NULLS LAST, neighborhood DESC NULLS LAST LIMIT {count})
    SELECT district, neighborhood, CAST(sum(traffic) AS BIGINT) AS total_traffic FROM placed
    WHERE EXISTS (SELECT 1 FROM members m WHERE m.district IS NOT DISTINCT FROM placed.district
      AND m.neighborhood IS NOT DISTINCT FROM placed.neighborhood) GROUP BY ALL"""


def _last_neighborhoods(spark, sf_dir, count):
    big = big_table(*_without_neighborhoods(spark, sf_dir))
    rows = STATION_CUBE.in_set(big, NamedSet("last_neighborhoods", "StationDistrict", "Neighborhood", count))
    return STATION_CUBE.query(rows, [("StationDistrict", "Neighborhood")], ["total_traffic"])


@named_query("last_neighborhood_set", _last_neighborhoods_sql(1))
def last_neighborhood_set(spark, sf_dir):
    return _last_neighborhoods(spark, sf_dir, 1)


@named_query("last_two_neighborhoods", _last_neighborhoods_sql(2))
def last_two_neighborhoods(spark, sf_dir):
    return _last_neighborhoods(spark, sf_dir, 2)


@named_query(
    "rollup_distinct_sketch",
    f"""WITH {sql.BIG} SELECT district, neighborhood, CAST(2 - grouping(district) - grouping(neighborhood) AS INTEGER) AS depth,
      count(DISTINCT station) AS total_station_count, true AS sketch_is_near
    FROM big GROUP BY ROLLUP (district, neighborhood)""",
)
def rollup_distinct_sketch(spark, sf_dir):
    """Stations counted once at every level, exactly and from stored sketches of the finest members, which lie within
    three standard errors of it."""
    path = scratch_dir(spark, "sketches")
    big = adapter.wide_table(spark, sf_dir)
    STATION_CUBE.sketches(big, "StationDistrict", "Neighborhood", "total_station_count").write.parquet(path)
    near = STATION_CUBE.rollup_sketches(spark.read.parquet(path), "StationDistrict", "Neighborhood", "total_station_count")
    exact = STATION_CUBE.rollup(big, "StationDistrict", "Neighborhood", ["total_station_count"])
    keys = ["district", "neighborhood", "depth"]
    alike = [exact[key].eqNullSafe(near[key]) for key in keys]
    error = F.abs(near["total_station_count"] - exact["total_station_count"])
    bound = 3 * SKETCH_ERROR * exact["total_station_count"]
    return exact.join(near, alike, "left").select(
        *(exact[key] for key in keys), exact["total_station_count"], F.coalesce(error <= bound, F.lit(False)).alias("sketch_is_near")
    )


FLAT = """flat AS (
  SELECT l_returnflag AS host, l_linestatus AS domain, l_linenumber AS feature, CAST(l_shipdate AS DATE) AS date,
         CAST(l_quantity AS DECIMAL(12,2)) AS core, CAST(l_discount AS DECIMAL(12,2)) AS db,
         CAST(l_tax AS DECIMAL(12,2)) AS active_visitor FROM lineitem)"""


def _flat_measures(result):
    return result.withColumns({m.name: F.col(m.name).cast("double") for m in FLAT_CUBE.measures})


FLAT_SUMS = ", ".join(f"CAST(sum({m}) AS DOUBLE) AS {m}" for m in ("core", "db", "active_visitor"))


@named_query("flat_cube_sums", f"WITH {FLAT} SELECT host, domain, feature, date, {FLAT_SUMS} FROM flat GROUP BY ALL")
def flat_cube_sums(spark, sf_dir):
    rows = [(h.name, h.name) for h in FLAT_CUBE.hierarchies]
    measures = [m.name for m in FLAT_CUBE.measures]
    return _flat_measures(FLAT_CUBE.query(adapter.flat_rows(spark, sf_dir), rows, measures))


@named_query(
    "flat_cube_by_host",
    f"""WITH {FLAT} SELECT host, {FLAT_SUMS}, CAST(sum(core) FILTER (WHERE domain = 'O') AS DOUBLE) AS core_open,
      CAST(sum(core) FILTER (WHERE domain = 'F') AS DOUBLE) AS core_final,
      CAST(sum(db) FILTER (WHERE domain = 'O') AS DOUBLE) AS db_open,
      CAST(sum(db) FILTER (WHERE domain = 'F') AS DOUBLE) AS db_final,
      CAST(sum(active_visitor) FILTER (WHERE domain = 'O') AS DOUBLE) AS active_visitor_open,
      CAST(sum(active_visitor) FILTER (WHERE domain = 'F') AS DOUBLE) AS active_visitor_final FROM flat GROUP BY host""",
)
def flat_cube_by_host(spark, sf_dir):
    axis = Axis("DOMAIN", "DOMAIN", {"O": "open", "F": "final"})
    measures = [m.name for m in FLAT_CUBE.measures]
    result = FLAT_CUBE.query(adapter.flat_rows(spark, sf_dir), [("HOST", "HOST")], measures, axis, [("core", "desc")])
    return result.select("host", *(F.col(c).cast("double").alias(c) for c in result.columns if c != "host"))


@named_query(
    "flat_cube_combinations",
    f"""WITH {FLAT} SELECT host, domain, feature,
      CAST(3 - grouping(host) - grouping(domain) - grouping(feature) AS INTEGER) AS depth, {FLAT_SUMS}
    FROM flat GROUP BY CUBE (host, domain, feature)""",
)
def flat_cube_combinations(spark, sf_dir):
    levels = [(name, name) for name in ("HOST", "DOMAIN", "FEATURE")]
    measures = [m.name for m in FLAT_CUBE.measures]
    return _flat_measures(FLAT_CUBE.combinations(adapter.flat_rows(spark, sf_dir), levels, measures))
