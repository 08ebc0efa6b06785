"""The streaming jobs driven over the whole event table, in time order, with restarts in between."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from docklake.catalog import adapter, sql
from docklake.catalog.feeds import ARRIVAL_BUCKETS, NEWEST, STATE, window_sql
from docklake.catalog.registry import named_query
from docklake.plans.star import star_join
from docklake.schemas import BIG_TABLE_COLUMNS, FACT_COLUMNS
from docklake.session import scratch_dir
from docklake.sources import xml
from docklake.sources.feeds import readable
from docklake.streaming import jobs, late, stateful

PARTS = 3


def _time_slices(rows: DataFrame, order: str) -> Iterator[DataFrame]:
    """``rows`` in ``PARTS`` successive equal stretches of ``order``."""
    bounds = rows.agg(F.min(order).alias("low"), F.max(order).alias("high")).first()
    step = (bounds["high"] - bounds["low"]) / PARTS
    edges = [bounds["low"] + step * i for i in range(1, PARTS)]
    for i in range(PARTS):
        low = F.lit(True) if i == 0 else F.col(order) >= F.lit(edges[i - 1])
        high = F.lit(True) if i == PARTS - 1 else F.col(order) < F.lit(edges[i])
        yield rows.where(low & high)


def run_in_slices(
    spark: SparkSession, rows: DataFrame, order: str, job: Callable[[DataFrame, str], DataStreamWriter]
) -> str:
    """Feed ``rows`` to a job slice by slice, one micro-batch and one restart each. ``job`` gets
    the stream and a folder for its output and state."""
    folder = scratch_dir(spark, "stream")
    for piece in _time_slices(rows, order):
        piece.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        jobs.start(job(stream, folder), f"{folder}/checkpoint").awaitTermination()
    return folder


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.table(spark, sf_dir, "events")


def _parquet(rows: DataFrame, folder: str) -> DataStreamWriter:
    return rows.writeStream.format("parquet").option("path", f"{folder}/out").outputMode("append")


@named_query("stream_delta", f"WITH {sql.FACT} SELECT * FROM fact")
def stream_delta(spark, sf_dir):
    def job(events, folder):
        obs = adapter.observations_of(events)
        sink = jobs.batch_directory(f"{folder}/out")
        return jobs.fact_batches(obs, [sink], f"{folder}/counts", adapter.TIE)

    folder = run_in_slices(spark, _events(spark, sf_dir), "event_id", job)
    return spark.read.parquet(f"{folder}/out").select(*FACT_COLUMNS)


@named_query("stream_delta_empty_slice", f"WITH {sql.FACT} SELECT * FROM fact")
def stream_delta_empty_slice(spark, sf_dir):
    """The middle slice has no rows; the counts move on over it."""
    events = _events(spark, sf_dir)
    count = events.agg(F.max("event_id")).first()[0] or 0
    apart = events.withColumn("place", F.col("event_id") + F.when(F.col("event_id") * 2 >= count, 2 * count).otherwise(0))

    def job(stream, folder):
        sink = jobs.batch_directory(f"{folder}/out")
        return jobs.fact_batches(adapter.observations_of(stream), [sink], f"{folder}/counts", adapter.TIE)

    folder = run_in_slices(spark, apart, "place", job)
    return spark.read.parquet(f"{folder}/out").select(*FACT_COLUMNS)


@named_query("stream_big_table", f"WITH {sql.BIG} SELECT * FROM big")
def stream_big_table(spark, sf_dir):
    stations = adapter.customer_stations(spark, sf_dir)

    def job(events, folder):
        sink = jobs.big_table_sink(f"{folder}/big", f"{folder}/staging", stations)
        return jobs.fact_batches(adapter.observations_of(events), [sink], f"{folder}/counts", adapter.TIE)

    folder = run_in_slices(spark, _events(spark, sf_dir), "event_id", job)
    return spark.read.parquet(f"{folder}/big").select(*BIG_TABLE_COLUMNS)


@named_query(
    "stream_star",
    f"""WITH {sql.FACT}, {sql.CUSTOMER_DIM} SELECT fact.*, {sql.DIM_FIELDS}, {sql.calendar('timetag')}
    FROM fact JOIN dim ON station = id""",
)
def stream_star(spark, sf_dir):
    def job(events, folder):
        sinks = [
            jobs.fact_table(f"{folder}/fact", f"{folder}/fact-staging"),
            jobs.time_table(f"{folder}/time", f"{folder}/time-staging"),
        ]
        return jobs.fact_batches(adapter.observations_of(events), sinks, f"{folder}/counts", adapter.TIE)

    folder = run_in_slices(spark, _events(spark, sf_dir), "event_id", job)
    facts, times = (spark.read.parquet(f"{folder}/{name}") for name in ("fact", "time"))
    return star_join(facts, adapter.customer_stations(spark, sf_dir), times)


@named_query(
    "stream_parse",
    f"""WITH {sql.RAW} SELECT datasource, count(*) AS stations, count(DISTINCT arrival) AS documents,
      CAST(sum(bikes) AS BIGINT) AS bikes FROM (
        SELECT event_type AS datasource, event_id AS arrival, whole AS bikes FROM pieces WHERE value <= 100 UNION ALL
        SELECT event_type, event_id, 0 FROM pieces WHERE value <= 100 AND event_type <> 'view') GROUP BY datasource""",
)
def stream_parse(spark, sf_dir):
    """Raw documents parsed inside the stream."""

    def job(raw, folder):
        return _parquet(xml.observations(raw, "datasource", "arrival"), folder)

    folder = run_in_slices(spark, adapter.raw_snapshots(spark, sf_dir), "arrival", job)
    return spark.read.parquet(f"{folder}/out").groupBy("datasource").agg(
        F.count(F.lit(1)).alias("stations"),
        F.count_distinct("arrival").alias("documents"),
        F.sum("bikes").alias("bikes"),
    )


def _zoned(obs: DataFrame) -> DataFrame:
    """Event times for a watermark carry a zone."""
    return obs.withColumn("timetag", F.col("timetag").cast("timestamp"))


def _newest_windows(spark, sf_dir, length, slide):
    def job(events, folder):
        obs = _zoned(adapter.observations_of(events))
        return _parquet(jobs.newest_in_windows(obs, "0 seconds", length, slide, tie=adapter.TIE), folder)

    folder = run_in_slices(spark, _events(spark, sf_dir), "event_id", job)
    times = ("window_start", "window_end", "timetag")
    return spark.read.parquet(f"{folder}/out").withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


@named_query("stream_newest_late", f"WITH {window_sql(60, 90)} SELECT * FROM windows")
def stream_newest_late(spark, sf_dir):
    """Events arrive in the order of their stations, so nearly all of them after later ones; none is lost."""

    def job(events, folder):
        obs = adapter.observations_of(events)
        return jobs.window_batches(obs, f"{folder}/windows", f"{folder}/staging", 60, 90, adapter.TIE)

    folder = run_in_slices(spark, _events(spark, sf_dir), "user_id", job)
    return spark.read.parquet(f"{folder}/windows").drop("day")


@named_query(
    "stream_windows_to_state",
    f"""WITH {window_sql(60, 90)}, newest AS (
      SELECT * FROM windows QUALIFY row_number() OVER (PARTITION BY station ORDER BY timetag DESC) = 1)
    SELECT {STATE} FROM newest""",
)
def stream_windows_to_state(spark, sf_dir):
    """The newest row of every window kept in a table, and the newest of all windows of a station on the map."""

    def job(events, folder):
        obs = adapter.observations_of(events)
        state = (f"{folder}/state", f"{folder}/state-staging")
        return jobs.window_batches(obs, f"{folder}/windows", f"{folder}/staging", 60, 90, adapter.TIE, state)

    folder = run_in_slices(spark, _events(spark, sf_dir), "event_id", job)
    return spark.read.parquet(f"{folder}/state").drop("timetag")


def _closed_sql(length, slide):
    return f"WITH {window_sql(length, slide)} SELECT * FROM windows WHERE window_end <= (SELECT max(timetag) FROM obs)"


@named_query("stream_newest", _closed_sql(60, 90))
def stream_newest(spark, sf_dir):
    """Windows that have closed by the last event."""
    return _newest_windows(spark, sf_dir, 60, 90)


@named_query("stream_newest_sliding", _closed_sql(60, 30))
def stream_newest_sliding(spark, sf_dir):
    return _newest_windows(spark, sf_dir, 60, 30)


DISTINCT_TIMES = """SELECT DISTINCT event_type AS datasource, CAST(epoch(date_trunc('second', ts)) AS BIGINT) * 1000 AS timestamp_ms
    FROM events"""


def _twice(spark, sf_dir, lag=None):
    """Every snapshot arrives twice, 45 seconds apart; ``processed`` is when it is seen, ``arrival`` its stamp, both in
    seconds. ``lag`` is how much later than stamped a row is processed."""
    seconds = adapter.epoch_seconds(F.col("ts"))
    snapshots = _events(spark, sf_dir).select(
        F.col("event_type").alias("datasource"), (seconds * 1000).alias("timestamp_ms"), seconds.alias("arrival")
    )
    both = snapshots.withColumn("delay", F.explode(F.array(F.lit(0), F.lit(45))))
    arriving = both.select("datasource", "timestamp_ms", (F.col("arrival") + F.col("delay")).alias("arrival"))
    return arriving.withColumn("processed", F.col("arrival") + (F.lit(0) if lag is None else lag))


def _deduplicated(spark, rows):
    def job(raw, folder):
        return jobs.recent_duplicate_batches(raw, [jobs.batch_directory(f"{folder}/out")], f"{folder}/seen", 180)

    folder = run_in_slices(spark, rows, "processed", job)
    return spark.read.parquet(f"{folder}/out").select("datasource", "timestamp_ms")


@named_query("stream_dedup", DISTINCT_TIMES)
def stream_dedup(spark, sf_dir):
    return _deduplicated(spark, _twice(spark, sf_dir))


@named_query("stream_dedup_out_of_step", DISTINCT_TIMES)
def stream_dedup_out_of_step(spark, sf_dir):
    """One feed is processed three days behind its stamps, so most of its first snapshots come after later ones of others."""
    lag = F.when(F.col("datasource") == "error", 3 * 86_400).otherwise(0)
    return _deduplicated(spark, _twice(spark, sf_dir, lag))


NEWER = """SELECT datasource, timestamp_ms, arrival FROM (
      SELECT o_orderpriority AS datasource, CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS timestamp_ms,
             o_orderkey AS arrival FROM orders)
    QUALIFY timestamp_ms > coalesce(max(timestamp_ms) OVER (
      PARTITION BY datasource ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1)"""


@named_query("stream_monotone", NEWER)
def stream_monotone(spark, sf_dir):
    def job(raw, folder):
        sink = jobs.batch_directory(f"{folder}/out")
        return jobs.monotone_batches(raw, [sink], f"{folder}/newest", buckets=ARRIVAL_BUCKETS)

    folder = run_in_slices(spark, adapter.order_snapshots(spark, sf_dir), "arrival", job)
    return spark.read.parquet(f"{folder}/out").select("datasource", "timestamp_ms", "arrival")


@named_query("stream_merge", f"WITH {NEWEST} SELECT {STATE} FROM newest")
def stream_merge(spark, sf_dir):
    def job(events, folder):
        obs = adapter.observations_of(events)
        return jobs.current_state_batches(obs, f"{folder}/state", f"{folder}/staging", adapter.TIE)

    folder = run_in_slices(spark, _events(spark, sf_dir), "event_id", job)
    return spark.read.parquet(f"{folder}/state")


@named_query(
    "stream_raw_store",
    f"""WITH {sql.RAW} SELECT datasource, timestamp_ms, count(DISTINCT content) AS documents
    FROM raw WHERE timestamp_ms IS NOT NULL GROUP BY ALL""",
)
def stream_raw_store(spark, sf_dir):
    """Raw snapshots kept by (datasource, time, key); every slice is stored twice to the same effect."""

    def job(raw, folder):
        store = jobs.raw_store_sink(f"{folder}/raw", f"{folder}/staging")

        def twice(batch, batch_id):
            store(batch, batch_id)
            store(batch, batch_id)

        return raw.writeStream.foreachBatch(twice)

    folder = run_in_slices(spark, adapter.raw_snapshots(spark, sf_dir), "arrival", job)
    stored = spark.read.parquet(f"{folder}/raw").groupBy("datasource", "timestamp_ms")
    return stored.agg(F.count(F.lit(1)).alias("documents"))


@named_query(
    "stream_documents_to_wide",
    f"""WITH {sql.RAW}, {sql.CUSTOMER_DIM}, first_seen AS (
      SELECT * FROM pieces WHERE value <= 100 QUALIFY row_number() OVER (PARTITION BY event_type, updatetime ORDER BY event_id) = 1),
    uniq AS (
      SELECT user_id AS station, updatetime, event_type = 'error' AS closed, whole AS bikes
      FROM first_seen QUALIFY row_number() OVER (PARTITION BY user_id, updatetime ORDER BY event_id DESC) = 1),
    moved AS (SELECT *, lag(bikes) OVER (PARTITION BY station ORDER BY updatetime) AS previous FROM uniq)
    SELECT station, updatetime, CAST(CASE WHEN closed THEN 0 ELSE bikes END AS BIGINT) AS available,
      CAST(coalesce(greatest(previous - bikes, 0), 0) AS BIGINT) AS lent,
      CAST(coalesce(greatest(bikes - previous, 0), 0) AS BIGINT) AS returned, district, neighborhood
    FROM moved JOIN dim ON station = id""",
)
def stream_documents_to_wide(spark, sf_dir):
    """From documents to the wide table in two chained streams: readable ones without repeats are archived; the archive
    is parsed into facts, which are joined and stored. The horizon takes in the whole input."""
    stations = adapter.customer_stations(spark, sf_dir)
    raw = adapter.raw_snapshots(spark, sf_dir)

    def archive(documents, folder):
        sink = jobs.batch_directory(f"{folder}/raw")
        return jobs.recent_duplicate_batches(readable(documents), [sink], f"{folder}/seen", 10**12)

    folder = run_in_slices(spark, raw, "arrival", archive)
    stored = spark.readStream.schema(raw.schema).parquet(f"{folder}/raw")
    obs = xml.observations(stored, "arrival").where("station >= 0").withColumn("station", F.col("station").cast("bigint"))
    sink = jobs.big_table_sink(f"{folder}/big", f"{folder}/staging", stations)
    jobs.start(jobs.fact_batches(obs, [sink], f"{folder}/counts", ("arrival",)), f"{folder}/facts").awaitTermination()
    return spark.read.parquet(f"{folder}/big").select(
        "station", F.unix_timestamp("timetag").alias("updatetime"), "available", "lent", "returned", "district", "neighborhood"
    )


@named_query("stream_late_facts", f"WITH {sql.FACT} SELECT * FROM fact")
def stream_late_facts(spark, sf_dir):
    """Events arrive in a random order, so two thirds of them later than others of their station; the facts they follow
    and the ones that follow them are put right."""
    events = _events(spark, sf_dir).withColumn("place", F.pmod(F.xxhash64("event_id"), F.lit(10_000)))

    def job(stream, folder):
        obs = adapter.observations_of(stream)
        return late.late_fact_batches(obs, f"{folder}/facts", f"{folder}/ends", f"{folder}/staging", adapter.TIE)

    folder = run_in_slices(spark, events, "place", job)
    return spark.read.parquet(f"{folder}/facts").select(*FACT_COLUMNS)


def _arrival_sql(length, slide):
    """Windows of arrival, which runs against the time of the events."""
    arrived = f"""arrived AS (
      SELECT * EXCLUDE (timetag), timetag AS seen, TIMESTAMP '2030-01-01' + (TIMESTAMP '2030-01-01' - timetag) AS timetag FROM obs)"""
    inner = window_sql(length, slide).replace(sql.OBS, "").replace("FROM obs)", "FROM arrived)")
    inner = inner.replace("SELECT obs.*", "SELECT a.*").replace("AS obs, range", "AS a, range")
    inner = inner.replace("station, timetag, latitude", "station, seen AS timetag, latitude")
    inner = inner.replace("ORDER BY timetag DESC, event_id DESC", "ORDER BY seen DESC, timetag DESC, latitude DESC, longitude DESC, status DESC, bikes DESC")
    return f"WITH {sql.OBS}, {arrived}{inner} SELECT * FROM windows WHERE window_end <= (SELECT max(timetag) FROM arrived)"


@named_query("stream_window_arrival", _arrival_sql(60, 90))
def stream_window_arrival(spark, sf_dir):
    """Windows of 60 s every 90 s by arrival; the events arrive backwards, the last one first."""
    far = F.lit("2030-01-01").cast("timestamp_ntz")
    obs = adapter.observations(spark, sf_dir).withColumn("arrival", far + (far - F.col("timetag")))

    def job(stream, folder):
        return jobs.arrival_window_batches(stream, [jobs.batch_directory(f"{folder}/out")], f"{folder}/open", 60, 90)

    folder = run_in_slices(spark, obs, "arrival", job)
    return spark.read.parquet(f"{folder}/out").drop("batch_id")


@named_query("stream_stateful_facts", f"WITH {sql.FACT} SELECT * FROM fact")
def stream_stateful_facts(spark, sf_dir):
    """Facts by state per station."""
    def job(events, folder):
        return _parquet(stateful.stateful_facts(adapter.observations_of(events), adapter.TIE), folder)

    with stateful.state_on_disk(spark):
        folder = run_in_slices(spark, _events(spark, sf_dir), "event_id", job)
    return spark.read.parquet(f"{folder}/out").select(*FACT_COLUMNS)


@named_query("stream_stateful_monotone", NEWER)
def stream_stateful_monotone(spark, sf_dir):
    """Newer snapshots by state per datasource."""
    def job(raw, folder):
        return _parquet(stateful.stateful_monotone(raw), folder)

    with stateful.state_on_disk(spark):
        folder = run_in_slices(spark, adapter.order_snapshots(spark, sf_dir), "arrival", job)
    return spark.read.parquet(f"{folder}/out").select("datasource", "timestamp_ms", "arrival")
