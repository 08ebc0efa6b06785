"""Facts, dimensions, the wide table and the keyed operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from docklake.catalog import adapter, sql
from docklake.catalog.registry import named_query
from docklake.functions.bands import district_bands
from docklake.functions.calendar import current_year_text, day_part, day_sixth, day_string, month_week, snapshot_name
from docklake.operators import keyed
from docklake.operators.facts import facts, unique_observations
from docklake.operators.ordered import RANGE, day_bucket, in_ranges, with_previous
from docklake.plans.star import big_table, star_join, time_dimension
from docklake.session import scratch_dir
from docklake.schemas import FACT_COLUMNS
from docklake.sinks import buckets
from docklake.sinks.files import truncate, upsert, write_big_table

CUT = "2024-01-16"


@named_query("fact", f"WITH {sql.FACT} SELECT * FROM fact")
def fact(spark, sf_dir):
    return adapter.fact_rows(spark, sf_dir).select(*FACT_COLUMNS)


@named_query(
    "previous_counts",
    f"WITH {sql.FACT} SELECT station, timetag, bikes, previous FROM moved",
)
def previous_counts(spark, sf_dir):
    dated = adapter.observations(spark, sf_dir).withColumn("day", F.to_date("timetag"))
    rows = unique_observations(dated, adapter.TIE)
    moved = with_previous(rows, ["station"], "timetag", "bikes", "previous", [day_bucket()])
    return moved.select("station", "timetag", "bikes", "previous")


@named_query(
    "previous_counts_scan",
    f"WITH {sql.FACT} SELECT station, timetag, bikes, previous FROM moved",
)
def previous_counts_scan(spark, sf_dir):
    """The same by a prefix scan over ranges that the data decides on, without any day."""
    dated = adapter.observations(spark, sf_dir).withColumn("day", F.to_date("timetag"))
    rows = unique_observations(dated, adapter.TIE).drop("day")
    cut = in_ranges(rows, ["station"], "timetag", scratch_dir(spark, "ranges"))
    moved = with_previous(cut, ["station"], "timetag", "bikes", "previous", [RANGE])
    return moved.select("station", "timetag", "bikes", "previous")


@named_query(
    "time_dim",
    f"WITH {sql.OBS} SELECT timetag, {sql.calendar('timetag')} FROM (SELECT DISTINCT timetag FROM obs)",
)
def time_dim(spark, sf_dir):
    return time_dimension(adapter.observations(spark, sf_dir))


@named_query("station_dim", f"WITH {sql.CUSTOMER_DIM} SELECT * FROM dim")
def station_dim(spark, sf_dir):
    return adapter.customer_stations(spark, sf_dir)


@named_query("big_table", f"WITH {sql.BIG} SELECT * FROM big")
def wide(spark, sf_dir):
    return adapter.wide_table(spark, sf_dir)


@named_query("big_table_missing_dim", f"WITH {sql.BIG_SUPPLIER} SELECT * FROM big")
def wide_missing_dim(spark, sf_dir):
    return big_table(adapter.fact_rows(spark, sf_dir), adapter.supplier_stations(spark, sf_dir))


@named_query(
    "fact_star_join",
    f"""WITH {sql.FACT}, {sql.CUSTOMER_DIM},
    times AS (SELECT timetag AS t, {sql.calendar('timetag')} FROM (SELECT DISTINCT timetag FROM obs))
    SELECT fact.*, {sql.DIM_FIELDS}, times.* EXCLUDE (t) FROM fact JOIN dim ON station = id JOIN times ON timetag = t""",
)
def fact_star_join(spark, sf_dir):
    obs = adapter.observations(spark, sf_dir)
    return star_join(facts(obs, adapter.TIE), adapter.customer_stations(spark, sf_dir), time_dimension(obs))


@named_query(
    "ranges",
    f"""WITH {sql.CUSTOMER_DIM} SELECT pop_density_range, pop_range, size_range, count(*) AS stations
    FROM (SELECT {sql.bands()} FROM dim) GROUP BY ALL""",
)
def ranges(spark, sf_dir):
    c = F.col
    labels = district_bands(c("pop_density"), c("population"), c("size"))
    stations = adapter.customer_stations(spark, sf_dir).withColumns(labels)
    return stations.groupBy(*labels).agg(F.count(F.lit(1)).alias("stations"))


@named_query(
    "ranges_in_thousands",
    f"""WITH {sql.CUSTOMER_DIM} SELECT pop_density_range, replace(pop_range, '- 20)', '- 200)') AS pop_range, size_range,
      count(*) AS stations
    FROM (SELECT {sql.bands('d', 'p', 'size')}
          FROM (SELECT pop_density * 1000 / 1000 AS d, population * 1000 / 1000 AS p, size FROM dim)) GROUP BY ALL""",
)
def ranges_in_thousands(spark, sf_dir):
    c = F.col
    labels = district_bands(c("pop_density") * 1000, c("population") * 1000, c("size"), "thousands")
    stations = adapter.customer_stations(spark, sf_dir).withColumns(labels)
    return stations.groupBy(*labels).agg(F.count(F.lit(1)).alias("stations"))


def _event_counts(spark, sf_dir, **labels):
    events = adapter.table(spark, sf_dir, "events")
    named = [expression.alias(name) for name, expression in labels.items()]
    return events.groupBy(*named).agg(F.count(F.lit(1)).alias("events"))


@named_query(
    "day_sixth",
    f"SELECT daysixth, count(*) AS events FROM (SELECT {sql.calendar('ts')} FROM events) GROUP BY daysixth",
)
def day_sixths(spark, sf_dir):
    return _event_counts(spark, sf_dir, daysixth=day_sixth(F.col("ts")))


@named_query("day_part", f"SELECT part, count(*) AS events FROM (SELECT {sql.calendar('ts')} FROM events) GROUP BY part")
def day_parts(spark, sf_dir):
    return _event_counts(spark, sf_dir, part=day_part(F.col("ts")))


def _ship_weeks(spark, sf_dir, rule):
    day = F.to_date("l_shipdate")
    days = adapter.table(spark, sf_dir, "lineitem").groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("items"))
    return days.select("day", month_week(F.col("day"), rule).alias("month_week"), "items")


def _ship_weeks_sql(week):
    return f"""SELECT day, {week('day')} AS month_week, items
    FROM (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS items FROM lineitem GROUP BY 1)"""


@named_query("week_of_month_us", _ship_weeks_sql(sql.month_week_us))
def week_of_month_us(spark, sf_dir):
    return _ship_weeks(spark, sf_dir, "us")


@named_query("week_of_month_es", _ship_weeks_sql(sql.month_week_es))
def week_of_month_es(spark, sf_dir):
    return _ship_weeks(spark, sf_dir, "es")


@named_query(
    "time_text",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d_%H.%M.%S_UTC') AS snapshot_name
    FROM events""",
)
def time_text(spark, sf_dir):
    ts = F.col("ts")
    return adapter.table(spark, sf_dir, "events").select(
        "event_id", day_string(ts).alias("day"), snapshot_name(ts).alias("snapshot_name")
    )


@named_query(
    "dimension_last_wins",
    """SELECT o_custkey AS id, o_orderkey AS seq, o_orderpriority AS district, o_totalprice AS size
    FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""",
)
def dimension_last_wins(spark, sf_dir):
    c = F.col
    loads = adapter.table(spark, sf_dir, "orders").select(
        c("o_custkey").alias("id"), c("o_orderkey").alias("seq"),
        c("o_orderpriority").alias("district"), c("o_totalprice").alias("size"),
    )
    return keyed.latest_per_key(loads, ["id"], ["seq"])


@named_query(
    "exists_semi",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE CAST(o_orderdate AS DATE) IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)""",
)
def exists_semi(spark, sf_dir):
    ordered = adapter.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    shipped = adapter.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    return keyed.exists_in(ordered, shipped, ["day"])


@named_query(
    "insert_missing_anti",
    "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)",
)
def insert_missing_anti(spark, sf_dir):
    c = F.col
    customers = adapter.table(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"))
    known = adapter.table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("id"))
    return keyed.insert_missing(known, customers, ["id"])


@named_query("upsert_merge", f"WITH {sql.FACT} SELECT * FROM fact")
def upsert_merge(spark, sf_dir):
    """Facts stored in two overlapping merges into a day-partitioned table, the second one twice."""
    path, staging = scratch_dir(spark, "facts"), scratch_dir(spark, "staging")
    rows = adapter.fact_rows(spark, sf_dir)
    keys = ["station", "timetag"]
    stale = rows.where(F.col("day") <= CUT).withColumn("lent", F.lit(-1).cast("bigint"))
    upsert(stale, path, keys, staging, partition_by=["day"])
    later = rows.where(F.col("day") >= CUT)
    upsert(later, path, keys, staging, partition_by=["day"])
    upsert(rows, path, keys, staging, partition_by=["day"], merge_id="again")
    upsert(rows, path, keys, staging, partition_by=["day"], merge_id="again")
    return spark.read.parquet(path).select(*FACT_COLUMNS)


@named_query("upsert_null_partition", f"WITH {sql.CUSTOMER_DIM} SELECT * FROM dim")
def upsert_null_partition(spark, sf_dir):
    """Stations kept by district, which some lack, in merges that each touch some districts only."""
    path, staging = scratch_dir(spark, "stations"), scratch_dir(spark, "staging")
    stations = adapter.customer_stations(spark, sf_dir)
    parts = [stations.where(F.col("id") % 3 == 0), stations.where("id % 3 = 1 AND (district IS NULL OR district = 'ASIA')")]
    for part in [*parts, stations.where("district IS NOT NULL"), stations.where("id % 3 = 2 AND district IS NULL")]:
        upsert(part, path, ["id"], staging, partition_by=["district"])
    return spark.read.schema(stations.schema).parquet(path)


@named_query("dimension_upsert", f"WITH {sql.CUSTOMER_DIM} SELECT * FROM dim")
def dimension_upsert(spark, sf_dir):
    """The supplier stations stored first, then all customer stations merged over them by id."""
    path, staging = scratch_dir(spark, "stations"), scratch_dir(spark, "staging")
    upsert(adapter.supplier_stations(spark, sf_dir), path, ["id"], staging)
    upsert(adapter.customer_stations(spark, sf_dir), path, ["id"], staging)
    return spark.read.parquet(path)


@named_query(
    "big_table_stored",
    f"""WITH {sql.BIG} SELECT year, month, count(*) AS facts, CAST(sum(lent) AS BIGINT) AS lent
    FROM big GROUP BY year, month""",
)
def big_table_stored(spark, sf_dir):
    path = scratch_dir(spark, "big")
    write_big_table(adapter.wide_table(spark, sf_dir), path)
    stored = spark.read.parquet(path).groupBy("year", "month")
    return stored.agg(F.count(F.lit(1)).alias("facts"), F.sum("lent").alias("lent"))


def _in_buckets(spark, sf_dir):
    """Facts and the stations they look up, in the same buckets: one for each 5,000 facts, so that small tables have several too."""
    path = scratch_dir(spark, "buckets")
    name = path.rpartition("-")[2]
    rows = adapter.fact_rows(spark, sf_dir)
    plan = buckets.planned(rows, "station", path, 5_000)
    stations = adapter.customer_stations(spark, sf_dir).withColumnRenamed("id", "station")
    return plan, plan.write(rows, f"facts_{name}", "timetag"), plan.write_lookup(stations, f"stations_{name}")


@named_query("big_table_bucketed", f"WITH {sql.BIG} SELECT * FROM big")
def big_table_bucketed(spark, sf_dir):
    _, facts_table, stations = _in_buckets(spark, sf_dir)
    return big_table(facts_table, stations, on=buckets.SLOT)


@named_query(
    "busiest_station_bucketed",
    f"""WITH {sql.FACT} SELECT * FROM fact
    WHERE station = (SELECT station FROM fact GROUP BY station ORDER BY count(*) DESC, station LIMIT 1)""",
)
def busiest_station_bucketed(spark, sf_dir):
    """All facts of the station that has most, read from its buckets alone."""
    plan, facts_table, _ = _in_buckets(spark, sf_dir)
    counts = facts_table.groupBy("station").agg(F.count(F.lit(1)).alias("n"))
    busiest = counts.orderBy(F.desc("n"), "station").first()
    return plan.rows_of(facts_table, busiest["station"] if busiest else -1).select(*FACT_COLUMNS)


@named_query("truncated_fact", f"WITH {sql.FACT} SELECT count(*) AS stored, CAST(0 AS BIGINT) AS left_over FROM fact")
def truncated_fact(spark, sf_dir):
    path = scratch_dir(spark, "facts")
    adapter.fact_rows(spark, sf_dir).write.parquet(path)
    stored = spark.read.parquet(path).count()
    truncate(spark, path)
    left = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("left_over"))
    return left.select(F.lit(stored).cast("bigint").alias("stored"), "left_over")


@named_query(
    "numbers_and_year",
    """SELECT c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS number, strftime(current_date, '%Y') AS year FROM customer""",
)
def numbers_and_year(spark, sf_dir):
    c = F.col
    return adapter.table(spark, sf_dir, "customer").select(
        c("c_custkey").alias("id"), c("c_nationkey").cast("string").alias("number"), current_year_text().alias("year")
    )
