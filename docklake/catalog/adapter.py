"""The driver tables seen as station telemetry: events are observations, customers are stations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docklake.operators.facts import facts, facts_between
from docklake.plans.periods import Period, last_period
from docklake.plans.star import big_table, located
from docklake.sources.feeds import tag_snapshots
from docklake.sources.tables import clean_station_dim

TIE = ("event_id",)


# Stated, so that no job has to read file footers first.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a time without zone, whatever the session zone."""
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    return days * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)


def observations_of(events: DataFrame, timetag: Column | None = None) -> DataFrame:
    """Observations, by default in whole seconds as the feed stamps them."""
    c = F.col
    timetag = F.window("ts", "1 second")["start"] if timetag is None else timetag
    return events.select(
        c("user_id").alias("station"),
        timetag.alias("timetag"),
        "event_id",
        (c("user_id") / 1000 + 41).alias("latitude"),
        (c("user_id") / 500 + 2).alias("longitude"),
        F.when(c("event_type") == "error", "CLS").otherwise("OPN").alias("status"),
        F.get_json_object("props", "$.k").cast("int").alias("slots"),
        F.floor("value").cast("int").alias("bikes"),
    )


def order_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations_of_orders(table(spark, sf_dir, "orders"))


def observations_of_orders(orders: DataFrame) -> DataFrame:
    """Observations over many months: customers are stations, an order is a count of bikes on its day. Several orders of
    a customer on one day share their time, so the tie decides."""
    c = F.col
    return orders.select(
        c("o_custkey").alias("station"),
        c("o_orderdate").alias("timetag"),
        c("o_orderkey").alias("event_id"),
        (c("o_custkey") / 1000 + 41).alias("latitude"),
        (c("o_custkey") / 500 + 2).alias("longitude"),
        F.when(c("o_orderstatus") == "F", "CLS").otherwise("OPN").alias("status"),
        (c("o_orderkey") % 30).cast("int").alias("slots"),
        F.floor(c("o_totalprice") % 40).cast("int").alias("bikes"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations_of(table(spark, sf_dir, "events"))


def fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(observations(spark, sf_dir), TIE)


def customer_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stations(spark, sf_dir, "customer", "c")


def supplier_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension that lacks many of the observed stations."""
    return _stations(spark, sf_dir, "supplier", "s", segment=F.lit("NONE"))


def _stations(spark: SparkSession, sf_dir: str, name: str, prefix: str, segment: Column | None = None) -> DataFrame:
    c = F.col
    key = {"c": "c_custkey", "s": "s_suppkey"}[prefix]
    balance = c(f"{prefix}_acctbal")
    sites = (
        table(spark, sf_dir, name)
        .join(table(spark, sf_dir, "nation"), c(f"{prefix}_nationkey") == c("n_nationkey"))
        .join(table(spark, sf_dir, "region"), c("n_regionkey") == c("r_regionkey"))
    )
    rows = sites.select(
        c(key).alias("id"),
        F.when(c("r_name") == "MIDDLE EAST", "NULL").otherwise(c("r_name")).alias("district"),
        c("n_name").alias("neighborhood"),
        (c("c_mktsegment") if segment is None else segment).alias("postal_code"),
        c(f"{prefix}_name").alias("address"),
        (balance / 300).alias("pop_density"),
        F.floor(balance / 40).cast("bigint").alias("population"),
        (balance / 500).alias("size"),
    )
    return clean_station_dim(rows)


def wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return big_table(fact_rows(spark, sf_dir), customer_stations(spark, sf_dir))


def wide_and_located(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The wide table and the frame to look for its last members in, over the same inputs."""
    obs, stations = observations(spark, sf_dir), customer_stations(spark, sf_dir)
    return big_table(facts(obs, TIE), stations), located(obs, stations)


def wide_in(spark: SparkSession, sf_dir: str, period: Period, name: str = "events") -> DataFrame:
    """The wide table of one stretch of time, which bounds the scan of the observations."""
    made, time = {"events": (observations_of, "ts"), "orders": (observations_of_orders, "o_orderdate")}[name]
    source = table(spark, sf_dir, name)
    inside, before = made(source.where(period.holds(time))), made(source.where(period.before(time)))
    return big_table(facts_between(inside, before, TIE), customer_stations(spark, sf_dir))


def wide_in_last(spark: SparkSession, sf_dir: str, level: str, name: str = "events") -> DataFrame:
    """The wide table of the last member of a level of time, which one aggregate over known stations finds."""
    obs = observations(spark, sf_dir) if name == "events" else order_observations(spark, sf_dir)
    period = last_period(located(obs, customer_stations(spark, sf_dir)), level)
    return wide_in(spark, sf_dir, period, name)


def located_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return located(observations(spark, sf_dir), customer_stations(spark, sf_dir))


# XML snapshots: one document per event with the event's station and a sparsely filled one.
# A document of a high value is cut short and cannot be parsed.

CUT_VALUE = 100


WHOLE_DOCUMENT = (
    '<?xml version="1.0" encoding="UTF-8"?><snapshot><updatetime><![CDATA[%s]]></updatetime>'
    "<station><id>%s</id><lat>41.%s</lat><long>2.%s</long><street><![CDATA[Street %s]]></street>"
    "<height>%s</height><streetNumber>%s</streetNumber><nearbyStationList>%s,%s,x</nearbyStationList>"
    "<status>%s</status><slots>%s</slots><bikes>%s</bikes></station>"
    "<station><id>%s</id><lat>41.%s</lat><long>41.%s</long><street></street><height></height>"
    "<streetNumber>12b</streetNumber><nearbyStationList></nearbyStationList><status>OPN</status>"
    "<bikes>99999999999%s</bikes></station></snapshot>"
)
CUT_DOCUMENT = "<snapshot><updatetime>soon</updatetime><station>"


def snapshot_contents(events: DataFrame) -> DataFrame:
    number = F.col("user_id").cast("string")
    digits = F.lpad(number, 9, "0")
    bikes = F.floor("value").cast("int")
    status = F.when(F.col("event_type") == "error", "CLS").otherwise("OPN")
    slots = F.get_json_object("props", "$.k")
    second = F.when(F.col("event_type") == "view", "none").otherwise(F.concat(F.lit("-"), number))
    whole = F.format_string(
        WHOLE_DOCUMENT,
        epoch_seconds(F.col("ts")), number, digits, digits, "event_type",
        bikes, "event_id", number, "event_id", status, slots, bikes,
        second, digits, digits, number,
    )
    content = F.when(F.col("value") > CUT_VALUE, CUT_DOCUMENT).otherwise(whole)
    return events.select(
        F.col("event_id").alias("arrival"), F.col("event_type").alias("feed"), content.alias("content")
    )


def raw_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw snapshot rows; every event type is a feed of its own."""
    contents = snapshot_contents(table(spark, sf_dir, "events"))
    tagged = tag_snapshots(contents, "feed")
    return tagged.select(F.col("feed").alias("datasource"), "timestamp_ms", "key", "arrival", "content")


def order_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot times that arrive out of order and repeat: orders by key, dated by day."""
    c = F.col
    return table(spark, sf_dir, "orders").select(
        c("o_orderpriority").alias("datasource"),
        (epoch_seconds(c("o_orderdate")) * 1000).alias("timestamp_ms"),
        c("o_orderkey").alias("arrival"),
    )


def flat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the flat sample table, with exact decimals."""
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        c("l_returnflag").alias("host"),
        c("l_linestatus").alias("domain"),
        c("l_linenumber").alias("feature"),
        F.to_date("l_shipdate").alias("date"),
        c("l_quantity").cast("decimal(12,2)").alias("core"),
        c("l_discount").cast("decimal(12,2)").alias("db"),
        c("l_tax").cast("decimal(12,2)").alias("active_visitor"),
    )
