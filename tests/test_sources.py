from datetime import datetime, timezone
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from docklake.functions.text import snapshot_file_time
from docklake.schemas import RAW_SNAPSHOT
from docklake.sinks.files import append_archive
from docklake.sources import feeds, tables, xml
from docklake.sources.archive import archived_between

STATION = """ <station><id>{id}</id><lat>{lat}</lat><long>{long}</long><street><![CDATA[{street}]]></street>
  <height>{height}</height><streetNumber>{number}</streetNumber><nearbyStationList>{near}</nearbyStationList>
  <status>{status}</status><slots>{slots}</slots><bikes>{bikes}</bikes></station>"""


def station(id, lat, long, street, height, number, near, status, slots, bikes):
    return STATION.format(**locals())


def document(updatetime, *stations):
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<feed>\n'
    return f"{head} <updatetime><![CDATA[{updatetime}]]></updatetime>\n" + "\n".join(stations) + "\n</feed>"


FIRST = document(
    1401551587,
    station(1, "41.3979520", "2.18004200", "Gran Via Corts Catalanes", 21, 760, "24,369,387,426", "OPN", 18, 6),
    station(2, "41.3942720", "2.17516900", "Plaza Tetu&aacute;n", 21, 8, "360,368,387,414", "OPN", 23, 4),
    station(3, "41.3936990", "2.18113700", "Ali Bei", 21, 44, "4,6,119,419", "OPN", 14, 11),
)
SPARSE = document(1401644107, station(511, "41.4", "2.1", "Lepant", "", "", "1,2,3", "CLS", "", 0))
BROKEN = "<feed><updatetime>soon</updatetime><station>"


def contents(spark, *documents):
    return spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "doc int, content string")


def test_observations_of_a_document(spark):
    got = xml.observations(contents(spark, FIRST), "doc").drop("timetag").orderBy("station").collect()
    assert [tuple(r) for r in got] == [
        (0, 1401551587, 1, 41.397952, 2.180042, "Gran Via Corts Catalanes", 21, 760, [24, 369, 387, 426], "OPN", 18, 6),
        (0, 1401551587, 2, 41.394272, 2.175169, "Plaza Tetu&aacute;n", 21, 8, [360, 368, 387, 414], "OPN", 23, 4),
        (0, 1401551587, 3, 41.393699, 2.181137, "Ali Bei", 21, 44, [4, 6, 119, 419], "OPN", 14, 11),
    ]


def test_observation_time(spark):
    got = xml.observations(contents(spark, FIRST)).select(F.date_format("timetag", "yyyy-MM-dd HH:mm:ss")).distinct()
    assert rows(got) == [("2014-05-31 15:53:07",)]


def test_defaults_of_a_sparse_station(spark):
    got = xml.observations(contents(spark, SPARSE)).first()
    assert (got.height, got.street_number, got.nearby, got.slots, got.bikes) == (0, -1, [1, 2, 3], 0, 0)


def test_broken_documents_are_set_aside(spark):
    parsed = xml.with_document(contents(spark, FIRST, BROKEN, "", SPARSE))
    assert rows(xml.rejected(parsed).select("doc")) == [(1,), (2,)]
    assert rows(xml.accepted(parsed).select("doc")) == [(0,), (3,)]
    assert rows(xml.snapshot_times(contents(spark, FIRST, BROKEN))) == [(1401551587,)]


def test_one_bad_station_does_not_reject_its_document(spark):
    bad = station("x", "41.4", "2.1", "Nowhere", 1, 1, "1", "OPN", 1, 1)
    no_place = station(9, "", "2.1", "Nowhere", 1, 1, "1", "OPN", 1, 1)
    good = station(8, "41.4", "2.1", "Here", 1, 1, "1", "OPN", 1, 1)
    raw = contents(spark, document(5, bad, good, no_place))
    assert rows(xml.observations(raw).select("station")) == [(8,)]
    assert rows(xml.rejected_stations(raw).select("street")) == [("Nowhere",), ("Nowhere",)]


def test_a_document_is_parsed_once(spark):
    plan = xml.observations(contents(spark, FIRST))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1


def test_unknown_column_fails_before_execution(spark):
    with pytest.raises(Exception, match="UNRESOLVED"):
        xml.observations(contents(spark, FIRST)).select("colour")


@pytest.fixture
def archive(tmp_path):
    names = ["feed_2014-05-31_15.53.07_UTC.xml", "feed_2014-06-01_17.35.07_UTC.xml", "feed_2014-06-01_17.36.07_UTC.xml"]
    for name, content in zip(names, (FIRST, SPARSE, BROKEN)):
        (tmp_path / name).write_text(content)
    return str(tmp_path)


def test_snapshot_files(spark, archive):
    first = feeds.snapshot_files(spark, archive, limit=2)
    got = first.select(F.date_format(snapshot_file_time(F.col("path")), "yyyy-MM-dd HH:mm:ss"), "content")
    assert rows(got) == [("2014-05-31 15:53:07", FIRST), ("2014-06-01 17:35:07", SPARSE)]
    assert feeds.snapshot_files(spark, f"{archive}/feed_2014-06*").count() == 2


def test_feeds_side_by_side(spark, archive):
    both = [feeds.Feed("east", archive), feeds.Feed("west", f"{archive}/feed_2014-05*", "updatetime_random_key")]
    raw = feeds.read_feeds(spark, both)
    got = rows(feeds.readable(raw).select("datasource", "timestamp_ms"))
    assert got == [("east", 1401551587000), ("east", 1401644107000), ("west", 1401551587000)]
    assert rows(feeds.unreadable(raw).select("datasource", "content")) == [("east", BROKEN)]
    assert raw.select("key").where("key is null").count() == 0


def test_repeated_datasource_and_unknown_parser():
    with pytest.raises(ValueError, match="more than once: a"):
        feeds.check_feeds([feeds.Feed("a", "x"), feeds.Feed("a", "y")])
    with pytest.raises(ValueError, match="unknown snapshot parser: other"):
        feeds.check_feeds([feeds.Feed("a", "x", "other")])


def test_a_parser_of_ones_own(spark):
    feeds.register_parser("seconds", lambda content: (content.try_cast("bigint") * 1000, content))
    raw = feeds.tag_snapshots(spark.createDataFrame([("7",), ("x",)], "content string"), "f", "seconds")
    assert rows(feeds.readable(raw)) == [("f", 7000, "7", "7")]
    feeds.PARSERS.pop("seconds")


def test_station_csv_keeps_the_last_row_and_reads_null_text(spark, tmp_path):
    path = tmp_path / "stations.csv"
    path.write_text(
        "seq,id,longitude,latitude,heigh,district,neighborhood,postal_code,address,pop_density,population,size\n"
        "1,300,2.1,41.3,20,Eixample,NULL,08013,Gran Via 1,35678.34,266874,7.48\n"
        "2,27,2.164415,41.396881,49,NULL,NULL,08037,Provença 322,,,\n"
        "3,300,2.2,41.4,21,Gràcia,El Coll,08014,Gran Via 2,1.5,2,3\n"
    )
    got = tables.station_dim_csv(spark, str(path))
    assert rows(got) == [
        (27, 2.164415, 41.396881, 49, None, None, "08037", "Provença 322", None, None, None),
        (300, 2.2, 41.4, 21, "Gràcia", "El Coll", "08014", "Gran Via 2", 1.5, 2, 3.0),
    ]


def test_only_the_days_between_are_opened(spark, folder):
    def snapshot(day, hour, source="bikes"):
        at = datetime(2014, 5, day, hour, tzinfo=timezone.utc)
        return source, int(at.timestamp() * 1000), f"{source}{day}{hour}", "<x/>"

    raw = spark.createDataFrame([snapshot(d, h, s) for d in (1, 2, 3, 4) for h in (1, 13) for s in ("bikes", "a/b")], RAW_SNAPSHOT)
    append_archive(raw, f"{folder}/archive")
    for day in ("2014-05-01", "2014-05-04"):  # whoever lists or reads these days fails
        Path(folder, "archive", "datasource=bikes", f"day={day}", "broken.parquet").write_text("no table")
    start, end = datetime(2014, 5, 2, 12), datetime(2014, 5, 4)
    found = archived_between(spark, f"{folder}/archive", start, end)
    assert rows(found.select("datasource", F.date_format("snapshot_time", "dd HH"))) == sorted(
        [(s, t) for s in ("a/b", "bikes") for t in ("02 13", "03 01", "03 13")], key=repr
    )
    assert [r.key for r in archived_between(spark, f"{folder}/archive", start, datetime(2014, 5, 3), ["bikes"]).collect()] == ["bikes213"]
    assert archived_between(spark, f"{folder}/nowhere", start, end).collect() == []


def test_outcomes_of_one_parse(spark):
    unplaced = STATION.format(id="x", lat="41.4", long="2.1", street="", height="", number="", near="", status="OPN", slots=1, bikes=1)
    placed = station(9, "41.4", "2.1", "Lepant", 1, 2, "3", "OPN", 5, 6)
    raw = contents(spark, document(7, placed, unplaced), BROKEN, document(8))
    counts = Observation()
    found = xml.counted_outcomes(xml.outcomes(raw, "doc"), counts)
    assert rows(found.select("doc", "updatetime", "station", "outcome")) == sorted(
        [(0, 7, 9, xml.STATION), (0, 7, None, xml.NO_PLACE), (1, None, None, xml.NO_TIME)], key=repr
    )
    assert counts.get == {"stations": 1, "no_place": 1, "no_time": 1}
