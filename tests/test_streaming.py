from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from docklake.operators.facts import facts
from docklake.sources import feeds, xml
from docklake.streaming import jobs, stateful
from docklake.streaming.carried import CarriedTable
from test_sources import BROKEN, FIRST, SPARSE, document, station

OBS = "station int, timetag timestamp_ntz, status string, slots int, bikes int"
START = datetime(2014, 5, 24)


def at(seconds):
    return START + timedelta(seconds=seconds)


def observed(*counts):
    return [(s, at(t), "OPN", 5, b) for s, t, b in counts]


def feed_batches(spark, folder, schema, batches, job):
    """One micro-batch and one restart per list of rows."""
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        jobs.start(job(stream), f"{folder}/checkpoint").awaitTermination()


IN_ORDER = [
    observed((1, 0, 9), (1, 60, 4), (2, 0, 7)),
    observed((1, 180, 7), (1, 120, 4), (3, 0, 1)),
    [],
    observed((2, 90_000, 1), (1, 240, 1)),
]


def moves(frame):
    return rows(frame.select("station", "timetag", "available", "lent", "returned"))


@pytest.mark.parametrize("kind", ["carried", "stateful"])
def test_stream_equals_batch(spark, folder, kind):
    def job(stream):
        if kind == "carried":
            return jobs.fact_batches(stream, [jobs.batch_directory(f"{folder}/out")], f"{folder}/state")
        return stateful.stateful_facts(stream).writeStream.format("parquet").option("path", f"{folder}/out")

    with stateful.state_on_disk(spark):
        feed_batches(spark, folder, OBS, IN_ORDER, job)
    whole = spark.createDataFrame([o for batch in IN_ORDER for o in batch], OBS)
    assert moves(spark.read.parquet(f"{folder}/out")) == moves(facts(whole))


LATE = [observed((1, 100, 5), (2, 100, 5)), observed((1, 50, 2), (2, 200, 6)), observed((1, 300, 4))]


@pytest.mark.parametrize(
    "late, expected",
    [
        # The late row compares with the count before it and replaces it.
        ("keep", [(1, 50, 3, 0), (1, 100, 0, 0), (1, 300, 0, 2), (2, 100, 0, 0), (2, 200, 0, 1)]),
        ("drop", [(1, 100, 0, 0), (1, 300, 1, 0), (2, 100, 0, 0), (2, 200, 0, 1)]),
    ],
)
def test_late_observations(spark, folder, late, expected):
    def job(stream):
        return jobs.fact_batches(stream, [jobs.batch_directory(f"{folder}/out")], f"{folder}/state", late=late)

    feed_batches(spark, folder, OBS, LATE, job)
    got = spark.read.parquet(f"{folder}/out").select("station", "timetag", "lent", "returned")
    assert rows(got) == [(s, at(t), lent, back) for s, t, lent, back in expected]


def test_stateful_keeps_late_observations(spark, folder):
    def job(stream):
        return stateful.stateful_facts(stream).writeStream.format("parquet").option("path", f"{folder}/out")

    feed_batches(spark, folder, OBS, LATE, job)
    got = spark.read.parquet(f"{folder}/out").where("station = 1").select("timetag", "lent", "returned")
    assert rows(got) == [(at(50), 3, 0), (at(100), 0, 0), (at(300), 0, 2)]


def test_unknown_late_rule(spark):
    with pytest.raises(ValueError):
        jobs.fact_batches(spark.createDataFrame([], OBS), [], "x", late="sometimes")


SNAPSHOT = "datasource string, timestamp_ms bigint, arrival int"
ARRIVALS = [
    [("a", 5, 0), ("a", 5, 1), ("b", 1, 2)],
    [("a", 3, 3), ("b", 1, 4), ("a", 9, 5)],
    [("b", 2, 6), ("a", 8, 7), ("a", 10, 8)],
]


@pytest.mark.parametrize("kind", ["carried", "stateful"])
def test_stream_of_newer_snapshots(spark, folder, kind):
    def job(stream):
        if kind == "carried":
            return jobs.monotone_batches(stream, [jobs.batch_directory(f"{folder}/out")], f"{folder}/state", [])
        return stateful.stateful_monotone(stream).writeStream.format("parquet").option("path", f"{folder}/out")

    with stateful.state_on_disk(spark):
        feed_batches(spark, folder, SNAPSHOT, ARRIVALS, job)
    got = spark.read.parquet(f"{folder}/out").select("datasource", "timestamp_ms", "arrival")
    assert rows(got.orderBy("arrival"), "in order") == [("a", 5, 0), ("b", 1, 2), ("a", 9, 5), ("b", 2, 6), ("a", 10, 8)]


def test_recent_duplicates_and_late_first_arrivals(spark, folder):
    schema = "datasource string, timestamp_ms bigint, arrival bigint"
    batches = [
        [("a", 1, 0), ("a", 1, 20), ("b", 1, 20), ("a", 1, 0)], [("a", 1, 60), ("a", 2, 1000)],
        [("b", 7, 30), ("b", 1, 190)],  # b lags behind a: 7 is new, 1 repeats
        [("a", 2, 1181), ("b", 1, 371)],  # both beyond the horizon of what came before
    ]

    def job(stream):
        return jobs.recent_duplicate_batches(stream, [jobs.batch_directory(f"{folder}/out")], f"{folder}/seen", 180)

    feed_batches(spark, folder, schema, batches, job)
    got = spark.read.parquet(f"{folder}/out").select("datasource", "timestamp_ms", "arrival")
    assert rows(got) == [("a", 1, 0), ("a", 2, 1000), ("a", 2, 1181), ("b", 1, 20), ("b", 1, 371), ("b", 7, 30)]


def test_late_rows_correct_their_window(spark, folder):
    batches = [[(1, at(10), "OPN", 1, 5), (1, at(100), "OPN", 1, 6)], [(3, at(50), "OPN", 1, 7), (1, at(5), "OPN", 1, 9), (1, at(20), "OPN", 1, 8)]]

    def job(stream):
        obs = stream.withColumns({"latitude": F.lit(1.0), "longitude": F.col("station") + F.lit(0.5)})
        return jobs.window_batches(obs, f"{folder}/w", f"{folder}/s", 60, 60, state=(f"{folder}/state", f"{folder}/s2"))

    feed_batches(spark, folder, OBS, batches, job)
    got = spark.read.parquet(f"{folder}/w").select("station", "timetag", "bikes")
    assert rows(got) == [(1, at(20), 8), (1, at(100), 6), (3, at(50), 7)]
    assert rows(spark.read.parquet(f"{folder}/state").select("longitude", "num_available_bikes")) == [(1.5, 6), (3.5, 7)]


def test_a_batch_leaves_other_days_as_they_are(spark, folder):
    def files(name):
        return {p: p.stat().st_mtime_ns for p in Path(folder, name).rglob("*.parquet")}

    stations = spark.createDataFrame([(1, "d", "n", "p", "a", 1.0, 1, 1.0)], "id int, district string, neighborhood string, postal_code string, address string, pop_density double, population bigint, size double")
    sinks = {"fact": jobs.fact_table(f"{folder}/fact", f"{folder}/s1"), "time": jobs.time_table(f"{folder}/time", f"{folder}/s2"),
             "big": jobs.big_table_sink(f"{folder}/big", f"{folder}/s3", stations)}
    before = {}
    for number, second in enumerate((100, 90_000)):
        made = facts(spark.createDataFrame([(1, at(second), "OPN", 1, 2)], OBS))
        for name, sink in sinks.items():
            before.setdefault(name, files(name))
            sink(made, number)
    raw = jobs.raw_store_sink(f"{folder}/raw", f"{folder}/s4")
    for number, millis in enumerate((1, 86_400_001)):
        before["raw"] = files("raw")
        raw(spark.createDataFrame([("x", millis, "k", "text")], "datasource string, timestamp_ms bigint, key string, content string"), number)
    assert before["raw"].items() <= files("raw").items() and len(files("raw")) == 2
    for name in sinks:
        assert spark.read.parquet(f"{folder}/{name}").count() == 2


def test_documents_to_the_wide_star_in_a_stream(spark, folder, tmp_path):
    """Files are parsed, newer snapshots kept, facts and calendar stored."""
    again = document(1401551647, station(1, "41.3979520", "2.18004200", "x", 21, 760, "2", "OPN", 20, 4))
    (tmp_path / "in").mkdir()
    staging = f"{folder}/staging"

    def keep(raw, batch_id):
        # Each micro-batch of newer snapshots is archived; facts read the archive.
        raw.write.mode("overwrite").parquet(f"{folder}/raw/batch_id={batch_id}")

    for number, content in enumerate([FIRST, BROKEN, FIRST, again]):
        (tmp_path / "in" / f"{number}.xml").write_text(content)
        files = feeds.snapshot_file_stream(spark, f"{folder}/in", 1)
        raw = feeds.readable(feeds.tag_snapshots(files, "bikes"))
        ordered = raw.withColumn("position", F.struct("arrival", "path"))
        jobs.start(jobs.monotone_batches(ordered, [keep], f"{folder}/newest", [], "position"), f"{folder}/c1").awaitTermination()
        if not (tmp_path / "raw").exists():
            continue
        stored = spark.readStream.schema("content string").parquet(f"{folder}/raw")
        obs = xml.observations(stored)
        sinks = [jobs.fact_table(f"{folder}/fact", f"{staging}/f"), jobs.time_table(f"{folder}/time", f"{staging}/t")]
        jobs.start(jobs.fact_batches(obs, sinks, f"{folder}/counts"), f"{folder}/c2").awaitTermination()
    got = spark.read.parquet(f"{folder}/fact").select("station", "available", "lent", "returned", F.col("timetag").cast("bigint"))
    assert rows(got) == [
        (1, 4, 2, 0, 1401551647), (1, 6, 0, 0, 1401551587), (2, 4, 0, 0, 1401551587), (3, 11, 0, 0, 1401551587),
    ]
    assert spark.read.parquet(f"{folder}/time").count() == 2
    assert SPARSE not in rows(spark.read.parquet(f"{folder}/raw").select("content"))


def test_a_state_update_of_ones_own(spark, folder):
    """A running count per datasource, written as a function of two frames."""

    def update(rows_in, before):
        counted = rows_in.groupBy("datasource").agg(F.count(F.lit(1)).alias("n")).unionByName(before)
        after = counted.groupBy("datasource").agg(F.sum("n").alias("n"))
        return after.join(rows_in, "datasource", "left_semi"), after

    def job(stream):
        sink = jobs.batch_directory(f"{folder}/out")
        return jobs.stateful_batches(stream, update, f"{folder}/state", "datasource string, n bigint", [sink])

    feed_batches(spark, folder, SNAPSHOT, [*ARRIVALS, [("b", 3, 9)]], job)
    got = spark.read.parquet(f"{folder}/out").select("batch_id", "datasource", "n")
    assert rows(got) == [(0, "a", 2), (0, "b", 1), (1, "a", 4), (1, "b", 2), (2, "a", 6), (2, "b", 3), (3, "b", 4)]


def test_carried_table_starts_a_repeated_batch_from_the_same_version(spark, folder):
    table = CarriedTable(f"{folder}/state", "k int, v int")
    assert table.before(spark, 0).count() == 0
    for batch_id in range(4):
        table.store(spark.createDataFrame([(1, batch_id)], table.schema), batch_id)
    assert rows(table.before(spark, 4)) == [(1, 3)]
    assert rows(table.before(spark, 3)) == [(1, 2)]
    table.store(spark.createDataFrame([(1, 33)], table.schema), 3)
    assert rows(table.before(spark, 4)) == [(1, 33)]


def test_a_repeated_batch_leaves_the_same_rows(spark, folder):
    sink = jobs.batch_directory(f"{folder}/out")
    for _ in range(2):
        sink(spark.createDataFrame([(1,)], "k int"), 0)
    assert rows(spark.read.parquet(f"{folder}/out").select("k")) == [(1,)]


def test_a_micro_batch_is_stored_for_its_own_time_and_not_cached(spark, folder, monkeypatch):
    held, seen = f"{folder}/held", []
    monkeypatch.setattr(jobs, "scratch_dir", lambda _spark, _label: held)

    def update(rows_in, before):
        seen.append((rows_in.storageLevel.useMemory, all(held in file for file in rows_in.inputFiles())))
        return rows_in, before

    def job(stream):
        return jobs.stateful_batches(stream, update, f"{folder}/state", "datasource string", [jobs.batch_directory(f"{folder}/out")])

    feed_batches(spark, folder, SNAPSHOT, ARRIVALS, job)
    assert seen and set(seen) == {(False, True)} and not Path(held).exists()
    assert spark.read.parquet(f"{folder}/out").count() == sum(map(len, ARRIVALS))
