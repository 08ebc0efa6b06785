"""Building the station dimension: places, address texts and district figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from docklake.catalog import adapter
from docklake.catalog.registry import named_query
from docklake.functions import text
from docklake.operators import stations
from docklake.session import scratch_dir
from docklake.sinks.files import upsert, write_table


def _districts(spark, sf_dir):
    """Regions with their nations; the schema fixes 25 of them, so the lists are short."""
    c = F.col
    nations = adapter.table(spark, sf_dir, "nation").join(
        adapter.table(spark, sf_dir, "region"), c("n_regionkey") == c("r_regionkey")
    )
    return nations.groupBy(c("r_name").alias("district")).agg(F.collect_list("n_name").alias("neighborhoods"))


@named_query(
    "neighborhood_to_district",
    "SELECT n_name AS neighborhood, r_name AS district FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def neighborhood_to_district(spark, sf_dir):
    return stations.neighborhood_districts(_districts(spark, sf_dir))


def _located(spark, sf_dir):
    c = F.col
    return (
        adapter.table(spark, sf_dir, "customer")
        .join(adapter.table(spark, sf_dir, "nation"), c("c_nationkey") == c("n_nationkey"))
        .join(adapter.table(spark, sf_dir, "region"), c("n_regionkey") == c("r_regionkey"))
    )


@named_query(
    "fallback_geo",
    """SELECT c_custkey AS id,
      CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD') THEN r_name END AS district,
      CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY') THEN n_name END AS neighborhood
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def fallback_geo(spark, sf_dir):
    """Buildings are located already; automobile and machinery sites have a neighborhood among
    their places, households only a district, others neither."""
    c = F.col
    located = _located(spark, sf_dir)
    segment = c("c_mktsegment")
    known = segment == "BUILDING"
    sites = located.select(
        c("c_custkey").alias("id"),
        F.when(known, c("r_name")).alias("district"),
        F.when(known, c("n_name")).alias("neighborhood"),
    )
    place = F.when(segment.isin("AUTOMOBILE", "MACHINERY"), c("n_name")).when(segment == "HOUSEHOLD", c("r_name"))
    places = F.posexplode(F.array(c("c_name"), place, F.lit("elsewhere"))).alias("rank", "place")
    candidates = located.select(c("c_custkey").alias("id"), places)
    return stations.resolve_geography(sites, candidates, _districts(spark, sf_dir))


@named_query(
    "geocoded",
    """WITH results AS (
      SELECT o_custkey AS id, o_orderkey AS rank, nullif(o_orderpriority, '1-URGENT') AS district,
        nullif(o_orderstatus, 'F') AS neighborhood,
        CASE WHEN o_orderstatus = 'O' THEN lpad(CAST(o_orderkey AS VARCHAR), 9, '0') END AS postal_code
      FROM orders)
    SELECT c_custkey AS id, min_by(district, rank) FILTER (WHERE district IS NOT NULL) AS district,
      min_by(neighborhood, rank) FILTER (WHERE neighborhood IS NOT NULL) AS neighborhood,
      min_by(postal_code, rank) FILTER (WHERE postal_code IS NOT NULL) AS postal_code
    FROM customer LEFT JOIN results ON c_custkey = id GROUP BY c_custkey""",
)
def geocoded(spark, sf_dir):
    """The first district, neighborhood and postal code among each site's geocoder answers."""
    c = F.col
    sites = adapter.table(spark, sf_dir, "customer").select(c("c_custkey").alias("id"))
    number = F.lpad(c("o_orderkey").cast("string"), 9, "0")
    city = F.when(c("o_orderstatus") == "O", " Barcelona, Spain").otherwise(" Girona, Spain")
    results = adapter.table(spark, sf_dir, "orders").select(
        c("o_custkey").alias("id"),
        c("o_orderkey").alias("rank"),
        F.nullif(c("o_orderpriority"), F.lit("1-URGENT")).alias("sublocality"),
        F.nullif(c("o_orderstatus"), F.lit("F")).alias("neighborhood"),
        F.concat(F.lit("Carrer 7, "), number, city).alias("formatted"),
    )
    return stations.geocoded(sites, results)


@named_query(
    "address",
    """SELECT c_custkey AS id,
      CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment = 'MACHINERY' THEN '"' || c_name || '"'
           ELSE '"' || c_name || '" ' || c_nationkey END AS address FROM customer""",
)
def address(spark, sf_dir):
    c = F.col
    street = F.when(c("c_mktsegment") != "BUILDING", F.concat(F.lit("'"), c("c_name"), F.lit("'")))
    number = F.when(c("c_mktsegment") != "MACHINERY", c("c_nationkey"))
    rows = adapter.table(spark, sf_dir, "customer")
    return rows.select(c("c_custkey").alias("id"), text.double_quotes(text.address(street, number)).alias("address"))


def _pages(spark, sf_dir, parts=None, district="p_brand"):
    """District pages made of parts: page texts vary in form, some lack a figure."""
    c = F.col
    parts = adapter.table(spark, sf_dir, "part") if parts is None else parts
    hundredths = F.lpad(c("p_size").cast("string"), 2, "0")
    thousands = F.lpad(c("p_size").cast("string"), 3, "0")
    whole = F.floor("p_retailprice").cast("string")
    size = F.when(c("p_type") != "ECONOMY", F.concat(F.lit("  "), c("p_size"), F.lit(","), hundredths, F.lit(" km2")))
    density = F.concat(F.lit("1."), thousands, F.lit(","), hundredths)
    people = F.concat(whole, F.lit(","), thousands, F.lit(" hab ("), density, F.lit(" hab/km2)"))
    return parts.select(
        c(district).alias("district"),
        c("p_partkey").alias("rank"),
        F.coalesce(size, F.lit("unknown")).alias("size_text"),
        F.when(c("p_type") != "SMALL", people).otherwise("none").alias("population_text"),
    )


PAGES_SQL = """
pages_of AS (
  SELECT p_brand AS district, p_partkey AS rank,
    CASE WHEN p_type <> 'ECONOMY' THEN CAST(p_size || '.' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS DOUBLE) END AS size,
    CASE WHEN p_type <> 'SMALL'
      THEN CAST(floor(p_retailprice) AS BIGINT) * 1000 + p_size END AS population,
    CASE WHEN p_type <> 'SMALL'
      THEN CAST('1' || lpad(CAST(p_size AS VARCHAR), 3, '0') || '.' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS DOUBLE)
    END AS density
  FROM part
),
figures AS (
  SELECT * EXCLUDE (rank) FROM pages_of WHERE size IS NOT NULL AND population IS NOT NULL AND density IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY district ORDER BY rank) = 1
)"""


@named_query("number_normalise", f"WITH {PAGES_SQL} SELECT * FROM pages_of")
def number_normalise(spark, sf_dir):
    return stations.page_statistics(_pages(spark, sf_dir))


@named_query("district_statistics", f"WITH {PAGES_SQL} SELECT * FROM figures")
def district_statistics(spark, sf_dir):
    return stations.district_statistics(stations.page_statistics(_pages(spark, sf_dir)))


@named_query(
    "station_dimension",
    f"""WITH {PAGES_SQL} SELECT c_custkey AS id, c_custkey / 500.0 AS longitude, c_custkey / 1000.0 AS latitude,
      CAST(c_nationkey AS BIGINT) AS heigh, 'Brand#' || c_nationkey AS district, 'near ' || c_mktsegment AS neighborhood,
      lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS postal_code, c_name || ' ' || c_nationkey AS address,
      density AS pop_density, population, size
    FROM customer LEFT JOIN figures ON district = 'Brand#' || c_nationkey""",
)
def station_dimension(spark, sf_dir):
    c = F.col
    sites = adapter.table(spark, sf_dir, "customer").select(
        c("c_custkey").alias("id"),
        (c("c_custkey") / 500).alias("longitude"),
        (c("c_custkey") / 1000).alias("latitude"),
        c("c_nationkey").alias("height"),
        F.concat(F.lit("Brand#"), c("c_nationkey").cast("string")).alias("district"),
        F.concat(F.lit("near "), c("c_mktsegment")).alias("neighborhood"),
        F.lpad(c("c_nationkey").cast("string"), 5, "0").alias("postal_code"),
        c("c_name").alias("street"),
        c("c_nationkey").alias("street_number"),
    )
    figures = stations.district_statistics(stations.page_statistics(_pages(spark, sf_dir)))
    return stations.station_dimension(sites, figures)


@named_query(
    "synonyms",
    """SELECT CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'HOME' ELSE c_mktsegment END AS district, count(*) AS stations
    FROM customer GROUP BY 1""",
)
def synonyms(spark, sf_dir):
    c = F.col
    segments = adapter.table(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), c("c_mktsegment").alias("district"))
    spellings = segments.where("district = 'HOUSEHOLD'").select(c("district").alias("spelling"), F.lit("HOME").alias("name"))
    merged = stations.apply_synonyms(segments, spellings.distinct(), "district")
    return merged.groupBy("district").agg(F.count(F.lit(1)).alias("stations"))


# Every third site has no geocoder answers; those of urgent orders name the district.
ANSWERS_SQL = """
answers AS (
  SELECT o_custkey AS id, o_orderkey AS rank, CASE WHEN o_orderpriority = '1-URGENT' THEN r_name END AS district,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'O' THEN n_name END AS neighborhood,
    CASE WHEN o_orderstatus = 'O' THEN lpad(CAST(o_orderkey AS VARCHAR), 9, '0') END AS postal_code
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE o_custkey % 3 <> 0),
geo AS (
  SELECT c_custkey AS id, min_by(district, rank) FILTER (WHERE district IS NOT NULL) AS district,
    min_by(neighborhood, rank) FILTER (WHERE neighborhood IS NOT NULL) AS neighborhood,
    min_by(postal_code, rank) FILTER (WHERE postal_code IS NOT NULL) AS postal_code
  FROM customer LEFT JOIN answers ON c_custkey = id GROUP BY c_custkey),
near AS (
  SELECT c_custkey AS id, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN n_name END AS near,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN r_name END AS near_district,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN r_name END AS within
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
resolved AS (
  SELECT id, coalesce(CASE WHEN neighborhood IS NULL THEN near_district END, district, within) AS district,
    coalesce(neighborhood, near) AS neighborhood, postal_code FROM geo JOIN near USING (id))"""


@named_query(
    "dimension_build",
    f"""WITH {PAGES_SQL.replace("p_brand AS district", "r_name AS district").replace("FROM part", "FROM part JOIN region ON p_size % 5 = r_regionkey")},
    {ANSWERS_SQL}
    SELECT c_custkey AS id, c_custkey / 500.0 AS longitude, c_custkey / 1000.0 AS latitude, CAST(c_nationkey AS BIGINT) AS heigh,
      r.district, r.neighborhood, r.postal_code, c_name || ' ' || c_nationkey AS address, density AS pop_density, population, size
    FROM customer JOIN resolved r ON c_custkey = r.id LEFT JOIN figures f ON r.district = f.district""",
)
def dimension_build(spark, sf_dir):
    """The dimension built without a geocoder and stored, then built with its answers and merged by station."""
    c = F.col
    located = _located(spark, sf_dir)
    sites = located.select(
        c("c_custkey").alias("id"), (c("c_custkey") / 500).alias("longitude"), (c("c_custkey") / 1000).alias("latitude"),
        c("c_nationkey").alias("height"), c("c_name").alias("street"), c("c_nationkey").alias("street_number"),
    )
    segment = c("c_mktsegment")
    place = F.when(segment.isin("AUTOMOBILE", "MACHINERY"), c("n_name")).when(segment == "HOUSEHOLD", c("r_name"))
    places = F.posexplode(F.array(c("c_name"), place, F.lit("elsewhere"))).alias("rank", "place")
    candidates = located.select(c("c_custkey").alias("id"), places)
    open_, priority = c("o_orderstatus") == "O", c("o_orderpriority")
    city = F.when(open_, " Barcelona, Spain").otherwise(" Girona, Spain")
    orders = adapter.table(spark, sf_dir, "orders").where("o_custkey % 3 <> 0")
    answers = orders.join(located, c("o_custkey") == c("c_custkey")).select(
        c("o_custkey").alias("id"), c("o_orderkey").alias("rank"),
        F.when(priority == "1-URGENT", c("r_name")).alias("sublocality"),
        F.when(priority.isin("1-URGENT", "2-HIGH") & open_, c("n_name")).alias("neighborhood"),
        F.concat(F.lit("Carrer 7, "), F.lpad(c("o_orderkey").cast("string"), 9, "0"), city).alias("formatted"),
    )
    parts = adapter.table(spark, sf_dir, "part").join(adapter.table(spark, sf_dir, "region"), c("p_size") % 5 == c("r_regionkey"))
    sources = candidates, _districts(spark, sf_dir), _pages(spark, sf_dir, parts, "r_name")
    path, staging = scratch_dir(spark, "dimension"), scratch_dir(spark, "staging")
    write_table(stations.built_dimension(sites, answers.limit(0), *sources), path)
    upsert(stations.built_dimension(sites.where("id % 3 <> 0"), answers, *sources), path, ["id"], staging)
    return spark.read.parquet(path)
