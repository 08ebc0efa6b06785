import random
from pathlib import Path

from conftest import rows
from pyspark.sql import functions as F
from test_streaming import OBS, at, feed_batches, observed

from docklake.operators.facts import facts
from docklake.schemas import FACT_COLUMNS
from docklake.streaming import jobs, late

DAY = 86_400


def _job(folder):
    return lambda stream: late.late_fact_batches(stream, f"{folder}/facts", f"{folder}/ends", f"{folder}/staging")


def _both(spark, folder, batches):
    whole = spark.createDataFrame([o for batch in batches for o in batch], OBS)
    return rows(spark.read.parquet(f"{folder}/facts").select(*FACT_COLUMNS)), rows(facts(whole).select(*FACT_COLUMNS))


def test_late_rows_in_any_order_give_the_batch_facts(spark, folder):
    random.seed(3)
    made = [(random.randint(1, 4), at(random.randint(0, 9) * DAY + random.randint(0, 5) * 7), random.choice(["OPN", "CLS"]), 5, random.randint(0, 9)) for _ in range(160)]
    batches = [made[:50], [], made[50:60], made[60:]]
    feed_batches(spark, folder, OBS, batches, _job(folder))
    found, want = _both(spark, folder, batches)
    assert found == want


def test_only_days_that_change_are_rewritten(spark, folder):
    first = observed((1, 0, 9), (1, DAY, 4), (1, 2 * DAY, 7), (1, 5 * DAY, 7), (1, 5 * DAY + 9, 3), (2, 3 * DAY, 1))
    later = observed((1, 2 * DAY + 60, 1))
    files = lambda: {p: p.stat().st_mtime_ns for p in Path(folder, "facts").rglob("*.parquet")}
    feed_batches(spark, folder, OBS, [first], _job(folder))
    before = files()
    feed_batches(spark, folder, OBS, [later], _job(folder))
    kept = {p.parent.name for p in set(before) & set(files())}
    # The late row's own day, and the station's next one, whose first fact now compares with it.
    assert kept == {"day=2014-05-24", "day=2014-05-25", "day=2014-05-27"}
    found, want = _both(spark, folder, [first, later])
    assert found == want


def test_a_merge_that_is_repeated_or_was_lost_changes_nothing(spark, folder):
    paths = (f"{folder}/facts", f"{folder}/ends", f"{folder}/staging", [])
    batches = [observed((1, 100, 5), (1, 900, 2)), observed((1, 500, 9), (1, 300, 1))]
    for number, batch in enumerate(batches):
        obs = spark.createDataFrame(batch, OBS)
        late.staged(late.unique_rows(obs, []), f"{folder}/staging/rows-{number}/fresh")  # an earlier try came this far
        for _ in range(2):
            late.merge_late(obs, *paths, number)
    found, want = _both(spark, folder, batches)
    assert found == want and not list(Path(folder, "staging").rglob("*.parquet"))


ARRIVING = OBS + ", latitude double, longitude double, arrival timestamp_ntz"


def test_windows_by_arrival_close_by_the_trigger(spark, folder):
    def seen(second, station, time, bikes):
        return station, at(time), "OPN", 1, bikes, 1.0, 2.0, at(second)

    batches = [[seen(35, 1, 900, 1), seen(80, 1, 500, 2)], [], [seen(85, 1, 100, 3), seen(130, 2, 50, 4)], [seen(300, 2, 40, 5)]]

    def job(stream):
        return jobs.arrival_window_batches(stream, [jobs.batch_directory(f"{folder}/out")], f"{folder}/open")

    feed_batches(spark, folder, ARRIVING, batches, job)
    out = spark.read.parquet(f"{folder}/out")
    found = rows(out.select("batch_id", F.date_format("window_start", "mm:ss"), "station", F.date_format("timetag", "mm:ss"), "bikes"))
    # Windows are 60 s long, one every 90 s; 00:30 to 01:30 closes with the arrival at 02:10, the newest by time is the first.
    assert [f[1:] for f in found] == [("00:30", 1, "15:00", 1), ("02:00", 2, "00:50", 4)]
