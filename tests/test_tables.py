from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from docklake.operators import current_state, keyed, stations
from docklake.sinks import files

STATE = "station int, timetag timestamp_ntz, latitude double, longitude double, status string, bikes int"


def frame(spark, data):
    return spark.createDataFrame(data, "k int, part string, v int")


def test_upsert_inserts_updates_and_repeats(spark, folder):
    path, staging = f"{folder}/t", f"{folder}/s"

    def put(data, **how):
        files.upsert(frame(spark, data), path, ["k"], staging, partition_by=["part"], **how)
        return rows(spark.read.parquet(path).select("k", "part", "v"))

    assert put([(1, "a", 1), (2, "b", 1)]) == [(1, "a", 1), (2, "b", 1)]
    assert put([(2, "b", 2), (3, "b", 2)]) == [(1, "a", 1), (2, "b", 2), (3, "b", 2)]
    for _ in range(2):
        assert put([(4, "c", 3)], merge_id=7) == [(1, "a", 1), (2, "b", 2), (3, "b", 2), (4, "c", 3)]


def test_upsert_takes_the_last_of_repeated_new_rows(spark, folder):
    new = spark.createDataFrame([(1, 5, 50), (1, 9, 90), (1, 7, 70)], "k int, seq int, v int")
    files.upsert(new, f"{folder}/t", ["k"], f"{folder}/s", order=["seq"])
    assert rows(spark.read.parquet(f"{folder}/t")) == [(1, 9, 90)]


def test_upsert_resumes_after_a_loss(spark, folder, monkeypatch):
    """The table is half overwritten when the job dies; the next attempt finishes from staging."""
    path, staging = f"{folder}/t", f"{folder}/s"
    files.upsert(frame(spark, [(1, "a", 1), (2, "a", 1)]), path, ["k"], staging, partition_by=["part"])
    new = frame(spark, [(2, "a", 2)])

    def die(_spark, _path):
        raise RuntimeError("lost")

    monkeypatch.setattr(files, "_mark", die)
    with pytest.raises(RuntimeError):
        files.upsert(new, path, ["k"], staging, partition_by=["part"], merge_id=3)
    monkeypatch.undo()
    spark.createDataFrame([], "k int, v int, part string").write.mode("overwrite").partitionBy("part").parquet(path)
    files.upsert(new, path, ["k"], staging, partition_by=["part"], merge_id=3)
    assert rows(spark.read.parquet(path).select("k", "part", "v")) == [(1, "a", 1), (2, "a", 2)]


def test_upsert_goes_on_deleting_after_a_loss_in_the_clean_up(spark, folder, tmp_path, monkeypatch):
    """Half of the staged rows are gone when the job is run again; the table keeps all of them."""
    path, staging = f"{folder}/t", f"{folder}/s"
    new = frame(spark, [(k, "a", k) for k in range(20)]).repartition(4)

    def die(_spark, _path):
        for part in sorted((tmp_path / "s" / "3" / "merged").glob("part-*"))[1:]:
            part.unlink()
        raise RuntimeError("lost")

    monkeypatch.setattr(files, "delete_path", die)
    with pytest.raises(RuntimeError):
        files.upsert(new, path, ["k"], staging, partition_by=["part"], merge_id=3)
    monkeypatch.undo()
    files.upsert(new, path, ["k"], staging, partition_by=["part"], merge_id=3)
    assert rows(spark.read.parquet(path).select("k", "part", "v")) == rows(new)
    assert not list((tmp_path / "s").iterdir())


def test_upsert_keeps_rows_of_the_null_partition(spark, folder):
    path = f"{folder}/t"

    def put(data):
        files.upsert(frame(spark, data), path, ["k"], f"{folder}/s", partition_by=["part"])
        return rows(spark.read.schema("k int, part string, v int").parquet(path).select("k", "part", "v"))

    assert put([(1, None, 1), (2, "a", 1)]) == [(1, None, 1), (2, "a", 1)]
    assert put([(3, None, 1)]) == [(1, None, 1), (2, "a", 1), (3, None, 1)]
    assert put([(4, "", 1)]) == [(1, None, 1), (2, "a", 1), (3, None, 1), (4, None, 1)]
    assert put([(5, "b", 1), (1, None, 2)]) == [(1, None, 2), (2, "a", 1), (3, None, 1), (4, None, 1), (5, "b", 1)]


def test_the_later_row_wins_on_either_side(spark, folder):
    for data in ([(1, "a", 5), (2, "a", 1)], [(1, "a", 3), (2, "a", 9)]):
        files.merge_newest(frame(spark, data), f"{folder}/t", ["k"], f"{folder}/s", ["v"], ["part"])
    assert rows(spark.read.parquet(f"{folder}/t").select("k", "v")) == [(1, 5), (2, 9)]


def test_upsert_leaves_other_partitions_alone(spark, folder, tmp_path):
    path = f"{folder}/t"
    files.upsert(frame(spark, [(1, "a", 1), (2, "b", 1)]), path, ["k"], f"{folder}/s", partition_by=["part"])
    kept = {p.name for p in (tmp_path / "t" / "part=a").iterdir()}
    files.upsert(frame(spark, [(2, "b", 2)]), path, ["k"], f"{folder}/s", partition_by=["part"])
    assert {p.name for p in (tmp_path / "t" / "part=a").iterdir()} == kept


def test_archive_days_and_appending(spark, folder):
    raw = spark.createDataFrame(
        [("a", 1403452626000 + i, "k", f"content {i}") for i in range(10)],
        "datasource string, timestamp_ms bigint, key string, content string",
    )
    path = f"{folder}/archive"
    files.append_archive(raw, path)
    assert spark.read.parquet(path).count() == 10
    files.append_archive(raw, path)
    stored = spark.read.parquet(path)
    assert rows(stored.groupBy("datasource", F.col("day").cast("string")).count()) == [("a", "2014-06-22", 20)]
    assert rows(stored.select("snapshot_name").distinct()) == [("2014-06-22_15.57.06_UTC",)]


def test_message_rows(spark):
    raw = spark.createDataFrame([("feed", 1404244632, "k", "text")], "datasource string, timestamp_ms bigint, key string, content string")
    assert rows(files.message_rows(raw)) == [("feed", "feed1404244632", "text")]


def test_truncate_keeps_the_schema(spark, folder):
    frame(spark, [(1, "a", 1)]).write.parquet(f"{folder}/t")
    files.truncate(spark, f"{folder}/t")
    left = spark.read.parquet(f"{folder}/t")
    assert left.count() == 0 and left.columns == ["k", "part", "v"]


def test_latest_and_earliest_per_key(spark):
    df = frame(spark, [(1, "a", 1), (1, "b", 2), (1, "c", 2), (2, None, 0)])
    assert rows(keyed.latest_per_key(df, ["k"], ["v"])) == [(1, "c", 2), (2, None, 0)]
    assert rows(keyed.earliest_per_key(df, ["k"], ["v"])) == [(1, "a", 1), (2, None, 0)]


def test_current_state_is_keyed_by_point(spark):
    at = datetime(2014, 5, 31)
    seen = spark.createDataFrame(
        [(1, at, 41.397952, 2.180042, "OPN", 3), (1, at, 41.394272, 2.175169, "CLS", 2)], STATE
    )
    state = current_state.state_rows(seen)
    assert rows(state) == [
        (2.175169, 41.394272, "POINT(2.175169 41.394272)", "CLS", 2),
        (2.180042, 41.397952, "POINT(2.180042 41.397952)", "OPN", 3),
    ]
    assert rows(current_state.merged_state(state, state)) == rows(state)
    closed = state.where("status = 'OPN'").withColumn("status", F.lit("CLS"))
    other = state.where("status = 'CLS'").withColumn("longitude", F.lit(9.0))
    merged = current_state.merged_state(state, closed.unionByName(other))
    assert rows(merged.select("longitude", "status")) == [(2.175169, "CLS"), (2.180042, "CLS"), (9.0, "CLS")]
    assert rows(current_state.updated_rows(state, closed)) == rows(closed)
    assert rows(current_state.inserted_rows(state, other)) == rows(other)
    assert current_state.kept_rows(state, closed).count() == 1


def test_newest_takes_the_latest_time(spark):
    at = [datetime(2014, 5, 31, 0, 0, s) for s in (5, 30, 59)]
    seen = spark.createDataFrame([(1, t, 1.0, 2.0, "OPN", i) for i, t in enumerate(at)], STATE)
    assert current_state.newest_per_station(seen).first().bikes == 2
    windows = current_state.newest_per_window(seen, 60, 90).collect()
    # The 90 s window from 00:00:00 counts only its last 60 s.
    assert [(w.window_start, w.window_end, w.bikes) for w in windows] == [
        (datetime(2014, 5, 31, 0, 0, 30), datetime(2014, 5, 31, 0, 1, 30), 2)
    ]
    sliding = current_state.newest_per_window(seen, 60, 30)
    assert sorted(w.bikes for w in sliding.collect()) == [0, 2, 2]


def test_shipped_districts_invert(spark):
    districts = stations.default_districts(spark)
    mapping = {r.neighborhood: r.district for r in stations.neighborhood_districts(districts).collect()}
    assert districts.count() == 10
    assert mapping["Pedralbes"] == "Les Corts" and mapping["El Coll"] == "Gràcia"


def test_geography_falls_back_to_places(spark):
    known = [(1, "Eixample", "Dreta"), (2, None, None), (3, None, None), (4, "Gràcia", None), (5, None, None)]
    sites = spark.createDataFrame(known, "id int, district string, neighborhood string")
    places = [(2, 0, "Gràcia"), (2, 1, "Pedralbes"), (2, 2, "El Coll"), (3, 0, "Nowhere"), (3, 1, "Eixample"), (4, 0, "Pedralbes")]
    candidates = spark.createDataFrame(places, "id int, rank int, place string")
    got = stations.resolve_geography(sites, candidates, stations.default_districts(spark))
    assert rows(got) == [
        (1, "Eixample", "Dreta"), (2, "Les Corts", "Pedralbes"), (3, "Eixample", None),
        (4, "Les Corts", "Pedralbes"), (5, None, None),
    ]


def test_district_figures_are_complete_or_missing(spark):
    cells = [
        ("Eixample", 0, "7,48 km²", "none"),
        ("Eixample", 1, " 7,48 km²", "266,874 hab (35.678,34 hab/km²)"),
        ("Gràcia", 0, "wide", "1,000 (2,5)"),
    ]
    pages = spark.createDataFrame(cells, "district string, rank int, size_text string, population_text string")
    figures = stations.district_statistics(stations.page_statistics(pages))
    assert rows(figures) == [("Eixample", 7.48, 266874, 35678.34)]
    site = [(1, 2.18, 41.39, 21, "Eixample", "L'Antiga", "08013", "Ali Bei", 44), (2, 2.0, 41.0, 1, "Gràcia", None, None, None, 3)]
    sites = spark.createDataFrame(
        site, "id int, longitude double, latitude double, height int, district string, neighborhood string, "
        "postal_code string, street string, street_number int",
    )
    assert rows(stations.station_dimension(sites, figures)) == [
        (1, 2.18, 41.39, 21, "Eixample", 'L"Antiga', "08013", "Ali Bei 44", 35678.34, 266874, 7.48),
        (2, 2.0, 41.0, 1, "Gràcia", None, None, "", None, None, None),
    ]


def test_geocoder_answers(spark):
    answers = [
        (1, 0, None, "Fort", "x, 08013 Barcelona, Spain"),
        (1, 1, "Eixample", "Dreta", "y, 08010 Barcelona, Spain"),
        (2, 0, None, None, "z, Spain"),
    ]
    results = spark.createDataFrame(answers, "id int, rank int, sublocality string, neighborhood string, formatted string")
    got = stations.geocoded(spark.createDataFrame([(1,), (2,), (3,)], "id int"), results)
    assert rows(got) == [(1, "Eixample", "Fort", "08013"), (2, None, None, None), (3, None, None, None)]


def test_synonyms(spark):
    sites = spark.createDataFrame([(1, "Sants - Montjuïc"), (2, "Gràcia"), (3, None)], "id int, district string")
    names = spark.createDataFrame([("Sants - Montjuïc", "Sants-Montjuïc")], "spelling string, name string")
    assert rows(stations.apply_synonyms(sites, names, "district")) == [(1, "Sants-Montjuïc"), (2, "Gràcia"), (3, None)]


def test_insert_new_gives_what_upsert_gives(spark, folder):
    def stored(put, name, **how):
        found = []
        for data in ([(1, "a", 1), (2, "b", 1), (5, None, 1)], [(2, "b", 2), (3, "b", 2), (3, "b", 1), (5, None, 1)], [(2, "b", 2), (4, None, 3), (5, "c", 1)]):
            for _ in range(2):
                put(frame(spark, data), f"{folder}/{name}", ["k", "part"], f"{folder}/s-{name}", partition_by=["part"], merge_id=len(found))
                found.append(rows(spark.read.schema("k int, part string, v int").parquet(f"{folder}/{name}")))
        return found

    assert stored(files.insert_new, "new") == stored(files.upsert, "old")


def test_insert_new_moves_no_stored_row(spark, folder, tmp_path):
    """Rows that are stored stay in their files; the new ones of their partition come beside them."""
    path = f"{folder}/t"

    def put(data, **how):
        files.insert_new(frame(spark, data), path, ["k"], f"{folder}/s", partition_by=["part"], **how)
        return {p.name for p in (tmp_path / "t").rglob("*.parquet")}

    first = put([(1, "a", 1), (2, "b", 1)])
    assert put([(1, "a", 1), (2, "b", 1)]) == first
    assert first < put([(1, "a", 1), (3, "a", 1)])
    assert rows(spark.read.parquet(path).select("k", "v")) == [(1, 1), (2, 1), (3, 1)]
    assert not list((tmp_path / "s").iterdir())


def test_insert_new_finishes_a_lost_merge(spark, folder, monkeypatch):
    path, staging = f"{folder}/t", f"{folder}/s"
    files.insert_new(frame(spark, [(1, "a", 1), (2, "a", 1)]), path, ["k"], staging, partition_by=["part"])
    new = frame(spark, [(2, "a", 2), (3, "b", 1)])

    def die(_spark, _path):
        raise RuntimeError("lost")

    monkeypatch.setattr(files, "_mark", die)
    with pytest.raises(RuntimeError):
        files.insert_new(new, path, ["k"], staging, partition_by=["part"], merge_id=3)
    monkeypatch.undo()
    spark.createDataFrame([], "k int, v int, part string").write.mode("overwrite").partitionBy("part").parquet(path)
    files.insert_new(new, path, ["k"], staging, partition_by=["part"], merge_id=3)
    assert rows(spark.read.parquet(path).select("k", "part", "v")) == [(1, "a", 1), (2, "a", 2), (3, "b", 1)]
