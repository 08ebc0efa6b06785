"""Streaming jobs. Those that need order inside a key run the batch operators per micro-batch and
carry a keyed table between them; the rest are native streaming plans.

Every source must bound its micro-batches (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from docklake.functions.calendar import day_string, utc_from_millis
from docklake.functions.text import point_text
from docklake.operators.current_state import (
    POINT, STATE_FIELDS, in_windows, newest_per_station, newest_per_window, state_rows,
)
from docklake.operators.facts import facts, last_counts
from docklake.operators.feed import monotone
from docklake.operators.keyed import latest_per_key
from docklake.operators.ordered import Bucket, span_bucket, with_previous
from docklake.plans.star import big_table, time_dimension
from docklake.session import delete_path, scratch_dir
from docklake.sinks.files import insert_new, merge_newest, upsert
from docklake.sources.feeds import readable
from docklake.streaming.carried import CarriedTable

BatchSink = Callable[[DataFrame, int], None]
StateUpdate = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def start(writer: DataStreamWriter, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Start with recoverable progress: every ``interval``, or once over all there is."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def console(rows: DataFrame) -> DataStreamWriter:
    return rows.writeStream.format("console").outputMode("append")


# sinks of one micro-batch; repeating a batch leaves the same rows, and only the days it has are rewritten


def batch_directory(path: str) -> BatchSink:
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def fact_table(path: str, staging: str) -> BatchSink:
    def write(rows: DataFrame, batch_id: int) -> None:
        upsert(rows, path, ["station", "timetag"], staging, partition_by=["day"], merge_id=batch_id)

    return write


def time_table(path: str, staging: str) -> BatchSink:
    def write(rows: DataFrame, batch_id: int) -> None:
        times = time_dimension(rows).withColumn("day", F.to_date("timetag"))
        upsert(times, path, ["timetag"], staging, partition_by=["day"], merge_id=batch_id)

    return write


def big_table_sink(path: str, staging: str, stations: DataFrame) -> BatchSink:
    def write(rows: DataFrame, batch_id: int) -> None:
        wide = big_table(rows, stations).withColumn("day", F.to_date("timetag"))
        upsert(wide, path, ["station", "timetag"], staging, partition_by=["day"], merge_id=batch_id)

    return write


RAW_KEY = ("datasource", "timestamp_ms", "key")


def raw_store_sink(path: str, staging: str) -> BatchSink:
    """Raw snapshots kept once by (datasource, time, key), below datasource and UTC day. Stored ones are not moved."""

    def write(rows: DataFrame, batch_id: int) -> None:
        dated = readable(rows).select(*RAW_KEY, "content", day_string(utc_from_millis(F.col("timestamp_ms"))).alias("day"))
        insert_new(dated, path, RAW_KEY, staging, partition_by=["datasource", "day"], merge_id=batch_id)

    return write


# jobs


def stateful_batches(
    stream: DataFrame, update: StateUpdate, state_path: str, state_schema: str, sinks: Sequence[BatchSink]
) -> DataStreamWriter:
    """Run ``update(rows, before) -> (output, after)`` on every micro-batch. Both states are keyed
    frames of ``state_schema``, kept below ``state_path``; ``after`` is complete, so a key stays
    until the update leaves it out. All of it is DataFrame work, spread over the cluster. What a
    micro-batch holds is stored for its own time, not cached: a cached partition is as large as a whole file of well
    compressed documents unpacked, and a stored table is read by columns and in bounded pieces."""
    carried = CarriedTable(state_path, state_schema)

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark, held = batch.sparkSession, scratch_dir(batch.sparkSession, "micro-batch")
        try:
            batch.write.parquet(held)
            output, after = update(spark.read.schema(batch.schema).parquet(held), carried.before(spark, batch_id))
            for sink in sinks:
                sink(output, batch_id)
            carried.store(after, batch_id)
        finally:
            delete_path(spark, held)

    return stream.writeStream.foreachBatch(process)


def fact_batches(
    obs: DataFrame, sinks: Sequence[BatchSink], state_path: str, tie: Sequence[str] = (), late: str = "keep"
) -> DataStreamWriter:
    """Facts of a stream of observations.

    Inside a micro-batch rows are ordered by time; the first row of a station compares with the
    last count of the batch before. ``late="keep"`` treats a row older than that count like any
    other, ``late="drop"`` leaves it out.
    """
    if late not in ("keep", "drop"):
        raise ValueError(f"unknown late rule {late!r}")
    kinds = {field.name: field.dataType.simpleString() for field in obs.schema.fields}
    schema = f"station {kinds['station']}, bikes int, timetag {kinds['timetag']}"

    def update(rows: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
        if late == "drop":
            known = before.select("station", F.col("timetag").alias("_known"))
            fresh = F.col("_known").isNull() | (F.col("timetag") > F.col("_known"))
            rows = rows.join(known, "station", "left").where(fresh).drop("_known")
        output = facts(rows, tie, initial=before.select("station", "bikes"))
        joined = last_counts(rows, tie).alias("new").join(before.alias("old"), "station", "full")
        seen = F.col("new.timetag").isNotNull()
        after = joined.select(
            "station",
            *(F.when(seen, F.col(f"new.{n}")).otherwise(F.col(f"old.{n}")).alias(n) for n in ("bikes", "timetag")),
        )
        return output, after

    return stateful_batches(obs, update, state_path, schema, sinks)


def monotone_batches(
    raw: DataFrame, sinks: Sequence[BatchSink], state_path: str, buckets: Sequence[Bucket], order: str = "arrival"
) -> DataStreamWriter:
    """Snapshots strictly newer than all earlier ones of their datasource."""

    def update(rows: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
        seen = rows.select("datasource", "timestamp_ms").unionByName(before)
        after = seen.groupBy("datasource").agg(F.max("timestamp_ms").alias("timestamp_ms"))
        return monotone(rows, buckets, order, before), after

    return stateful_batches(raw, update, state_path, "datasource string, timestamp_ms bigint", sinks)


def current_state_batches(
    obs: DataFrame, path: str, staging: str, tie: tuple[str, ...] = ()
) -> DataStreamWriter:
    """Keep the current-state table at ``path`` up to date with the newest row per station."""

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rows = state_rows(newest_per_station(batch, tie))
        upsert(rows, path, POINT, staging, merge_id=batch_id)

    return obs.writeStream.foreachBatch(process)


def recent_duplicate_batches(
    raw: DataFrame, sinks: Sequence[BatchSink], state_path: str, horizon: int, arrival: str = "arrival"
) -> DataStreamWriter:
    """Drop snapshots whose (datasource, time) arrived up to ``horizon`` before, in units of the whole number ``arrival``.

    Only repeats are dropped: a first snapshot passes however late it is, and a feed that lags behind the others is
    measured by its own clock. Kept between micro-batches is the last arrival of each snapshot that can still repeat.
    """
    keys = ["datasource", "timestamp_ms"]

    def update(rows: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
        first = rows.dropDuplicates([*keys, arrival])
        ordered = first.withColumn("_at", F.col(arrival))
        cut = [span_bucket(arrival, max(horizon, 1))]
        known = before.select(*keys, F.col(arrival).alias("_at"))
        passed = with_previous(ordered, keys, arrival, "_at", "_last", cut, known)
        fresh = passed.where(F.col("_last").isNull() | (F.col(arrival) - F.col("_last") > horizon))
        seen = rows.select(*keys, arrival).unionByName(before).groupBy(*keys).agg(F.max(arrival).alias(arrival))
        newest = seen.groupBy("datasource").agg(F.max(arrival).alias("_newest"))
        after = seen.join(newest, "datasource").where(F.col("_newest") - F.col(arrival) <= horizon).drop("_newest")
        return fresh.select(*rows.columns), after

    return stateful_batches(raw, update, state_path, f"datasource string, timestamp_ms bigint, {arrival} bigint", sinks)


def newest_in_windows(
    obs: DataFrame, delay: str, length: int = 60, slide: int = 90, tie: tuple[str, ...] = ()
) -> DataFrame:
    """The newest row per station and event-time window; a window is emitted once it has closed, ``delay`` after its
    end. Rows later than that are in no window: choose ``delay`` by how late rows can be, or keep a table that late rows
    still correct with ``window_batches``."""
    return newest_per_window(obs.withWatermark("timetag", delay), length, slide, tie)


WINDOW_KEY = ("window_start", "window_end", "station")


def window_batches(
    obs: DataFrame, path: str, staging: str, length: int = 60, slide: int = 90, tie: tuple[str, ...] = (),
    state: tuple[str, str] | None = None,
) -> DataStreamWriter:
    """Keep a table of the newest row per station and window below ``path``, by day of the window.

    No row is too late: it corrects its window. With ``state`` (path, staging) the newest row per station of a
    micro-batch's windows also goes to a current-state table, unless that table has a newer one.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        newest = newest_per_window(batch, length, slide, tie).withColumn("day", F.to_date("window_start"))
        merge_newest(newest, path, WINDOW_KEY, staging, ["timetag"], ["day"], batch_id)
        if state is not None:
            rows = newest_per_station(newest.select("timetag", *STATE_FIELDS))
            placed = latest_per_key(rows, POINT, ["timetag", "station"]).select(
                *POINT, point_text(F.col("longitude"), F.col("latitude")).alias("the_geom"), "status",
                F.col("bikes").alias("num_available_bikes"), "timetag",
            )
            merge_newest(placed, state[0], POINT, state[1], ["timetag"], (), batch_id)

    return obs.writeStream.foreachBatch(process)


def arrival_window_batches(
    obs: DataFrame, sinks: Sequence[BatchSink], state_path: str, length: int = 60, slide: int = 90, arrival: str = "arrival"
) -> DataStreamWriter:
    """The newest row per station and window of arrival, whatever times the rows carry.

    ``arrival`` is when the source saw a row; it doesn't fall from one micro-batch to the next. A micro-batch closes
    the windows that end by its last arrival, and only those are given out, once. Windows that are still open wait in
    the carried table with the newest row of each station, so nothing depends on a watermark. Of rows of one time the
    last to arrive is the newest.
    """
    kinds = {field.name: field.dataType.simpleString() for field in obs.schema.fields}
    fields = ("timetag", arrival, "latitude", "longitude", "status", "bikes")
    rows_schema = ", ".join(f"{name} {kinds[name]}" for name in ("station", *fields))
    schema = f"window_start {kinds[arrival]}, window_end {kinds[arrival]}, {rows_schema}"

    def update(rows: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
        windowed = in_windows(rows, length, slide, arrival).select(
            (F.col("window.end") - F.expr(f"interval {length} seconds")).alias("window_start"),
            F.col("window.end").alias("window_end"), "station", *fields,
        )
        newest = latest_per_key(before.unionByName(windowed), WINDOW_KEY, ["timetag", arrival])
        last = rows.agg(F.max(arrival).alias("last")).first()["last"]
        closed = F.col("window_end") <= F.lit(last)
        return newest.where(closed).drop(arrival), newest.where(~closed)

    return stateful_batches(obs, update, state_path, schema, sinks)
