"""Snapshots, XML parsing, repeated and stale snapshots, archives, current state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Observation
from pyspark.sql import functions as F

from docklake.catalog import adapter, sql
from docklake.catalog.registry import QUERIES, named_query
from docklake.functions.text import point_text, updatetime_millis
from docklake.operators import current_state, feed, keyed
from docklake.operators.facts import facts
from docklake.operators.ordered import RANGE, in_ranges, span_bucket
from docklake.session import scratch_dir
from docklake.sinks.files import append, append_archive, archive_rows, message_rows, truncate
from docklake.sources import xml
from docklake.sources.archive import archived_between
from docklake.sources.feeds import message_columns, readable, tag_snapshots

WHOLE = "SELECT * FROM pieces WHERE value <= 100"


@named_query(
    "parse_xml",
    f"""WITH {sql.RAW} SELECT event_id AS arrival, updatetime, CAST(user_id AS INTEGER) AS station,
      CAST('41.' || digits AS DOUBLE) AS latitude, CAST('2.' || digits AS DOUBLE) AS longitude,
      'Street ' || event_type AS street, whole AS height, CAST(event_id AS INTEGER) AS street_number,
      number || ',' || event_id || ',-1' AS nearby,
      CASE WHEN event_type = 'error' THEN 'CLS' ELSE 'OPN' END AS status,
      CAST(k AS INTEGER) AS slots, whole AS bikes FROM ({WHOLE})""",
)
def parse_xml(spark, sf_dir):
    rows = xml.observations(adapter.raw_snapshots(spark, sf_dir), "arrival")
    first = rows.where(F.col("longitude") < 41)
    return first.drop("timetag").withColumn("nearby", F.array_join(F.transform("nearby", lambda n: n.cast("string")), ","))


@named_query(
    "parse_defaults",
    f"""WITH {sql.RAW} SELECT event_id AS arrival, CAST(-user_id AS INTEGER) AS station, '' AS street, 0 AS height,
      -1 AS street_number, '-1' AS nearby, 'OPN' AS status, 0 AS slots, 0 AS bikes
    FROM ({WHOLE}) WHERE event_type <> 'view'""",
)
def parse_defaults(spark, sf_dir):
    rows = xml.observations(adapter.raw_snapshots(spark, sf_dir), "arrival")
    sparse = rows.where(F.col("longitude") >= 41)
    return sparse.select(
        "arrival", "station", "street", "height", "street_number",
        F.array_join(F.transform("nearby", lambda n: n.cast("string")), ",").alias("nearby"),
        "status", "slots", "bikes",
    )


ALL_STATIONS = f"""{sql.RAW},
whole_station AS (
  SELECT event_id AS arrival, updatetime, CAST(user_id AS INTEGER) AS station, CAST('41.' || digits AS DOUBLE) AS latitude,
    CAST('2.' || digits AS DOUBLE) AS longitude, 'Street ' || event_type AS street, whole AS height,
    CAST(event_id AS INTEGER) AS street_number, number || ',' || event_id || ',-1' AS nearby,
    CASE WHEN event_type = 'error' THEN 'CLS' ELSE 'OPN' END AS status, CAST(k AS INTEGER) AS slots, whole AS bikes
  FROM ({WHOLE})),
sparse_station AS (
  SELECT event_id AS arrival, updatetime, CASE WHEN event_type <> 'view' THEN CAST(-user_id AS INTEGER) END AS station,
    CAST('41.' || digits AS DOUBLE) AS latitude, CAST('41.' || digits AS DOUBLE) AS longitude, '' AS street, 0 AS height,
    -1 AS street_number, '-1' AS nearby, 'OPN' AS status, 0 AS slots, 0 AS bikes
  FROM ({WHOLE}))"""


def _as_text(rows):
    return rows.withColumn("nearby", F.array_join(F.transform("nearby", lambda n: n.cast("string")), ","))


@named_query(
    "parse_all",
    f"""WITH {ALL_STATIONS}
    SELECT *, 'station' AS outcome FROM whole_station UNION ALL
    SELECT *, CASE WHEN station IS NULL THEN 'station without id or place' ELSE 'station' END FROM sparse_station UNION ALL
    SELECT arrival, NULL, NULL, NULL, NULL, NULL, 0, -1, NULL, NULL, 0, 0, 'document without time' FROM raw WHERE timestamp_ms IS NULL""",
)
def parse_all(spark, sf_dir):
    """Every station of every document, rejected ones and unreadable documents among them, from one parse of each."""
    return _as_text(xml.outcomes(adapter.raw_snapshots(spark, sf_dir), "arrival").drop("timetag"))


@named_query(
    "parse_outcomes",
    f"""WITH {ALL_STATIONS} SELECT
      CAST((SELECT count(*) FROM whole_station) + (SELECT count(*) FROM sparse_station WHERE station IS NOT NULL) AS BIGINT) AS stations,
      (SELECT count(*) FROM sparse_station WHERE station IS NULL) AS no_place,
      (SELECT count(*) FROM raw WHERE timestamp_ms IS NULL) AS no_time,
      CAST((SELECT count(*) FROM whole_station) * 2 + (SELECT count(*) FROM raw WHERE timestamp_ms IS NULL) AS BIGINT) AS stored""",
)
def parse_outcomes(spark, sf_dir):
    """The counts by cause that come with storing the outcomes, beside the number of rows stored."""
    path, counts = scratch_dir(spark, "outcomes"), Observation("outcomes")
    rows = xml.outcomes(adapter.raw_snapshots(spark, sf_dir), "arrival")
    xml.counted_outcomes(rows, counts).write.partitionBy("outcome").parquet(path)
    stored = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("stored"))
    return stored.select(*(F.lit(counts.get[name]).cast("bigint").alias(name) for name in ("stations", "no_place", "no_time")), "stored")


@named_query(
    "nearby_explode",
    f"""WITH {sql.RAW} SELECT near, count(*) AS mentions FROM (
      SELECT CAST(user_id AS INTEGER) AS near FROM ({WHOLE}) UNION ALL
      SELECT CAST(event_id AS INTEGER) FROM ({WHOLE}) UNION ALL SELECT -1 FROM ({WHOLE}) UNION ALL
      SELECT -1 FROM ({WHOLE}) WHERE event_type <> 'view') GROUP BY near""",
)
def nearby_explode(spark, sf_dir):
    rows = xml.observations(adapter.raw_snapshots(spark, sf_dir))
    return rows.select(F.explode("nearby").alias("near")).groupBy("near").agg(F.count(F.lit(1)).alias("mentions"))


@named_query(
    "facts_from_xml",
    f"""WITH {sql.RAW},
    seen AS (
      SELECT CAST(user_id AS INTEGER) AS station, updatetime, event_id, CAST(k AS INTEGER) AS slots, whole AS bikes,
             CASE WHEN event_type = 'error' THEN 'CLS' ELSE 'OPN' END AS status FROM ({WHOLE})
      UNION ALL
      SELECT CAST(-user_id AS INTEGER), updatetime, event_id, 0, 0, 'OPN' FROM ({WHOLE}) WHERE event_type <> 'view'
    ),
    uniq AS (
      SELECT * FROM seen QUALIFY row_number() OVER (
        PARTITION BY station, updatetime ORDER BY event_id DESC, bikes DESC, slots DESC, status DESC) = 1
    ),
    moved AS (SELECT *, lag(bikes) OVER (PARTITION BY station ORDER BY updatetime) AS previous FROM uniq)
    SELECT station, updatetime, status, CAST(CASE WHEN status = 'OPN' THEN slots ELSE 0 END AS BIGINT) AS slots,
      CAST(CASE WHEN status = 'OPN' THEN bikes ELSE 0 END AS BIGINT) AS available,
      CAST(coalesce(greatest(previous - bikes, 0), 0) AS BIGINT) AS lent,
      CAST(coalesce(greatest(bikes - previous, 0), 0) AS BIGINT) AS returned FROM moved""",
)
def facts_from_xml(spark, sf_dir):
    """From documents to facts. The parsed observations are stored, since facts read them twice."""
    path = scratch_dir(spark, "observations")
    parsed = xml.observations(adapter.raw_snapshots(spark, sf_dir), "arrival")
    parsed.select("arrival", "station", "timetag", "status", "slots", "bikes").write.parquet(path)
    return facts(spark.read.parquet(path), ["arrival"]).select(
        "station", F.unix_seconds("timetag").alias("updatetime"), "status", "slots", "available", "lent", "returned"
    )


@named_query("regex_updatetime", f"WITH {sql.RAW} SELECT arrival, timestamp_ms FROM raw")
def regex_updatetime(spark, sf_dir):
    raw = adapter.raw_snapshots(spark, sf_dir)
    return raw.select("arrival", updatetime_millis(F.col("content")).alias("timestamp_ms"))


@named_query("snapshot_times", f"WITH {sql.RAW} SELECT updatetime, count(*) AS documents FROM ({WHOLE}) GROUP BY updatetime")
def snapshot_times(spark, sf_dir):
    times = xml.snapshot_times(adapter.raw_snapshots(spark, sf_dir))
    return times.groupBy("updatetime").agg(F.count(F.lit(1)).alias("documents"))


@named_query(
    "quarantine",
    f"""WITH {sql.RAW} SELECT datasource, arrival, content, true AS bad_time, true AS bad_xml
    FROM raw WHERE timestamp_ms IS NULL""",
)
def quarantine(spark, sf_dir):
    raw = adapter.raw_snapshots(spark, sf_dir)
    keys = ["datasource", "arrival", "content"]
    return xml.flagged(raw).where("bad_time OR bad_xml").select(*keys, "bad_time", "bad_xml")


@named_query(
    "rejected_stations",
    f"WITH {sql.RAW} SELECT event_id AS arrival, '' AS street FROM ({WHOLE}) WHERE event_type = 'view'",
)
def rejected_stations(spark, sf_dir):
    return xml.rejected_stations(adapter.raw_snapshots(spark, sf_dir), "arrival").select("arrival", "street")


@named_query(
    "feeds_tagged",
    f"""WITH {sql.RAW} SELECT datasource, count(*) AS snapshots, CAST(count(timestamp_ms) AS BIGINT) AS dated,
      count(DISTINCT content) AS contents FROM raw GROUP BY datasource""",
)
def feeds_tagged(spark, sf_dir):
    raw = adapter.raw_snapshots(spark, sf_dir)
    return raw.groupBy("datasource").agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.count("timestamp_ms").alias("dated"),
        F.count_distinct("key").alias("contents"),
    )


@named_query(
    "kafka_rows",
    f"""WITH {sql.RAW} SELECT datasource AS topic, datasource || timestamp_ms AS key, content AS value
    FROM raw WHERE timestamp_ms IS NOT NULL""",
)
def kafka_rows(spark, sf_dir):
    return message_rows(readable(adapter.raw_snapshots(spark, sf_dir)))


@named_query(
    "message_round_trip",
    f"""WITH {sql.RAW} SELECT datasource AS topic, datasource || timestamp_ms AS key, timestamp_ms, count(*) AS messages
    FROM raw WHERE timestamp_ms IS NOT NULL GROUP BY ALL""",
)
def message_round_trip(spark, sf_dir):
    """Messages as a topic holds them, in bytes and with columns of its own, read and dated again."""
    sent = message_rows(readable(adapter.raw_snapshots(spark, sf_dir)))
    held = sent.select(
        "topic", F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"),
    )
    read = message_columns(held).withColumn("timestamp_ms", updatetime_millis(F.col("content")))
    return read.groupBy("topic", "key", "timestamp_ms").agg(F.count(F.lit(1)).alias("messages"))


@named_query(
    "random_keys",
    "SELECT event_type AS datasource, count(*) AS snapshots, count(*) AS keys FROM events GROUP BY event_type",
)
def random_keys(spark, sf_dir):
    """Snapshots tagged with a random key each: no two are alike, not even of one content."""
    contents = adapter.snapshot_contents(adapter.table(spark, sf_dir, "events"))
    tagged = tag_snapshots(contents, "any", "updatetime_random_key")
    return tagged.groupBy(F.col("feed").alias("datasource")).agg(
        F.count(F.lit(1)).alias("snapshots"), F.count_distinct("key").alias("keys")
    )


ARCHIVE_SQL = f"""WITH {sql.RAW} SELECT datasource, strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d') AS day,
  count(*) * {{times}} AS snapshots,
  min(strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d_%H.%M.%S_UTC')) AS first_name
FROM raw WHERE timestamp_ms IS NOT NULL GROUP BY ALL"""


def _archive_counts(rows):
    day = F.date_format("day", "yyyy-MM-dd") if dict(rows.dtypes)["day"] == "date" else F.col("day")
    return rows.groupBy("datasource", day.alias("day")).agg(
        F.count(F.lit(1)).alias("snapshots"), F.min("snapshot_name").alias("first_name")
    )


@named_query("archive_day_counts", ARCHIVE_SQL.format(times=1))
def archive_day_counts(spark, sf_dir):
    return _archive_counts(archive_rows(readable(adapter.raw_snapshots(spark, sf_dir))))


@named_query("archive_appended", ARCHIVE_SQL.format(times=2))
def archive_appended(spark, sf_dir):
    """The archive written twice: the second time appends."""
    path = scratch_dir(spark, "archive")
    raw = readable(adapter.raw_snapshots(spark, sf_dir))
    append_archive(raw, path)
    append_archive(raw, path)
    return _archive_counts(spark.read.parquet(path))


# Noon to noon, so that two days are read in part.
ARCHIVE_FROM, ARCHIVE_TO = datetime(2024, 1, 9, 12), datetime(2024, 1, 20, 12)


@named_query(
    "archive_round_trip",
    f"""WITH {sql.RAW} SELECT event_type AS datasource, strftime(make_timestamp(updatetime * 1000000), '%Y-%m-%d') AS day,
      count(*) AS snapshots, CAST(count(*) + count(*) FILTER (WHERE event_type <> 'view') AS BIGINT) AS stations,
      CAST(sum(whole) AS BIGINT) AS bikes, min(make_timestamp(updatetime * 1000000)) AS first_time,
      min(strftime(make_timestamp(updatetime * 1000000), '%Y-%m-%d_%H.%M.%S_UTC')) AS first_name
    FROM ({WHOLE}) WHERE make_timestamp(updatetime * 1000000) >= TIMESTAMP '{ARCHIVE_FROM}'
      AND make_timestamp(updatetime * 1000000) < TIMESTAMP '{ARCHIVE_TO}' GROUP BY ALL""",
)
def archive_round_trip(spark, sf_dir):
    """Snapshots archived by day; those between two times are listed by folder, dated by their names and parsed."""
    path = scratch_dir(spark, "archive")
    append_archive(readable(adapter.raw_snapshots(spark, sf_dir)), path)
    schema = "timestamp_ms bigint, key string, arrival bigint, content string, snapshot_name string, datasource string, day string"
    between = archived_between(spark, path, ARCHIVE_FROM, ARCHIVE_TO, schema=schema)
    carried = ("datasource", "day", "arrival", "snapshot_time", "snapshot_name")
    stations = xml.observations(between, *carried)
    return stations.groupBy("datasource", "day").agg(
        F.count_distinct("arrival").alias("snapshots"), F.count(F.lit(1)).alias("stations"), F.sum("bikes").alias("bikes"),
        F.min("snapshot_time").alias("first_time"), F.min("snapshot_name").alias("first_name"),
    )


@named_query(
    "dedup_recent",
    """SELECT datasource, timestamp_ms, min(arrival) AS arrival FROM (
      SELECT o_orderpriority AS datasource, CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS timestamp_ms,
             o_orderkey AS arrival FROM orders) GROUP BY ALL""",
)
def dedup_recent(spark, sf_dir):
    return feed.deduplicated(adapter.order_snapshots(spark, sf_dir))


# Two levels: neither a slice nor the slices of a block are more than 10,000 rows of a datasource.
ARRIVAL_BUCKETS = [span_bucket("arrival", 10_000), span_bucket("slice", 10_000, "block")]


@named_query(
    "monotone_filter",
    """SELECT datasource, timestamp_ms, arrival FROM (
      SELECT o_orderpriority AS datasource, CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS timestamp_ms,
             o_orderkey AS arrival FROM orders)
    QUALIFY timestamp_ms > coalesce(max(timestamp_ms) OVER (
      PARTITION BY datasource ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1)""",
)
def monotone_filter(spark, sf_dir):
    raw = adapter.order_snapshots(spark, sf_dir)
    return feed.monotone(raw, ARRIVAL_BUCKETS)


@named_query("monotone_scan", QUERIES["monotone_filter"].sql)
def monotone_scan(spark, sf_dir):
    """The same by a prefix scan over ranges of arrival that the data decides on."""
    cut = in_ranges(adapter.order_snapshots(spark, sf_dir), ["datasource"], "arrival", scratch_dir(spark, "ranges"))
    return feed.monotone(cut, [RANGE]).drop(RANGE.name)


@named_query(
    "refresh_interval",
    """WITH times AS (SELECT DISTINCT event_type AS datasource, CAST(floor(epoch(ts)) AS BIGINT) AS updatetime FROM events),
    gaps AS (SELECT *, updatetime - lag(updatetime) OVER (PARTITION BY datasource ORDER BY updatetime) AS gap FROM times)
    SELECT datasource, min_by(gap, updatetime) AS first_gap, min(gap) AS min_gap, max(gap) AS max_gap,
           avg(gap) AS avg_gap, count(*) AS gaps FROM gaps WHERE gap IS NOT NULL GROUP BY datasource""",
)
def refresh_interval(spark, sf_dir):
    events = adapter.table(spark, sf_dir, "events")
    times = events.select(
        F.col("event_type").alias("datasource"), adapter.epoch_seconds(F.col("ts")).alias("updatetime")
    )
    return feed.refresh_interval(times)


NEWEST = f"""{sql.OBS},
newest AS (
  SELECT station, timetag, latitude, longitude, status, bikes FROM obs
  QUALIFY row_number() OVER (PARTITION BY station ORDER BY timetag DESC, event_id DESC) = 1
)"""


@named_query("newest_per_station", f"WITH {NEWEST} SELECT * FROM newest")
def newest_per_station(spark, sf_dir):
    return current_state.newest_per_station(adapter.observations(spark, sf_dir), adapter.TIE).drop("event_id")


@named_query(
    "point_text",
    f"WITH {NEWEST} SELECT station, 'POINT(' || longitude || ' ' || latitude || ')' AS the_geom FROM newest",
)
def points(spark, sf_dir):
    newest = current_state.newest_per_station(adapter.observations(spark, sf_dir), adapter.TIE)
    return newest.select("station", point_text(F.col("longitude"), F.col("latitude")).alias("the_geom"))


STATE = (
    "longitude, latitude, 'POINT(' || longitude || ' ' || latitude || ')' AS the_geom, "
    "status, bikes AS num_available_bikes"
)


def _states(spark, sf_dir):
    """The state left by closed observations of the supplier stations, and by all open ones."""
    obs = adapter.observations(spark, sf_dir)
    known = adapter.supplier_stations(spark, sf_dir).select(F.col("id").alias("station"))
    closed = keyed.exists_in(obs.where("status = 'CLS'"), known, ["station"])
    old = current_state.newest_per_station(closed, adapter.TIE)
    new = current_state.newest_per_station(obs.where("status = 'OPN'"), adapter.TIE)
    return current_state.state_rows(old), current_state.state_rows(new)


MERGE = f"""{sql.OBS},
latest AS (
  SELECT * FROM obs WHERE status = 'OPN' OR station IN (SELECT s_suppkey FROM supplier)
  QUALIFY row_number() OVER (PARTITION BY station, status ORDER BY timetag DESC, event_id DESC) = 1
),
old AS (SELECT * FROM latest WHERE status = 'CLS'),
new AS (SELECT * FROM latest WHERE status = 'OPN')"""


@named_query(
    "current_state_merge",
    f"""WITH {MERGE} SELECT {STATE} FROM new
    UNION ALL SELECT {STATE} FROM old WHERE station NOT IN (SELECT station FROM new)""",
)
def current_state_merge(spark, sf_dir):
    return current_state.merged_state(*_states(spark, sf_dir))


@named_query(
    "current_state_updates",
    f"WITH {MERGE} SELECT {STATE} FROM new WHERE station IN (SELECT station FROM old)",
)
def current_state_updates(spark, sf_dir):
    return current_state.updated_rows(*_states(spark, sf_dir))


@named_query(
    "current_state_inserts",
    f"WITH {MERGE} SELECT {STATE} FROM new WHERE station NOT IN (SELECT station FROM old)",
)
def current_state_inserts(spark, sf_dir):
    return current_state.inserted_rows(*_states(spark, sf_dir))


@named_query("current_state_rewritten", f"WITH {MERGE} SELECT {STATE} FROM new")
def current_state_rewritten(spark, sf_dir):
    """A stored state emptied and filled again."""
    path = scratch_dir(spark, "state")
    old, new = _states(spark, sf_dir)
    append(old, path)
    truncate(spark, path)
    append(new, path)
    return spark.read.parquet(path)


def window_sql(length: int, slide: int) -> str:
    """Windows start on multiples of the slide since 1970."""
    return f"""{sql.OBS},
    windowed AS (
      SELECT obs.*, make_timestamp(
        CAST((e // {slide} - i) * {slide} + {max(slide - length, 0)} AS BIGINT) * 1000000) AS window_start
      FROM (SELECT *, CAST(epoch(timetag) AS BIGINT) AS e FROM obs) AS obs, range(0, {max(length // slide, 1)}) AS r(i)
    ),
    inside AS (
      SELECT *, window_start + INTERVAL {length} SECOND AS window_end FROM windowed
      WHERE timetag >= window_start AND timetag < window_start + INTERVAL {length} SECOND
    ),
    windows AS (
      SELECT window_start, window_end, station, timetag, latitude, longitude, status, bikes FROM inside
      QUALIFY row_number() OVER (PARTITION BY window_start, station ORDER BY timetag DESC, event_id DESC) = 1
    )"""


@named_query("window_60_90", f"WITH {window_sql(60, 90)} SELECT * FROM windows")
def window_60_90(spark, sf_dir):
    return current_state.newest_per_window(adapter.observations(spark, sf_dir), 60, 90, adapter.TIE)


@named_query("window_60_30", f"WITH {window_sql(60, 30)} SELECT * FROM windows")
def window_60_30(spark, sf_dir):
    return current_state.newest_per_window(adapter.observations(spark, sf_dir), 60, 30, adapter.TIE)
