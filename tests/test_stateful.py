import random
from datetime import datetime, timedelta

import pandas as pd
from conftest import rows

from docklake.operators.facts import facts
from docklake.streaming import jobs, stateful

OBS = "station int, timetag timestamp_ntz, status string, slots int, bikes int"
START = datetime(2014, 5, 24)


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Map(dict):
    def updateValue(self, key, value):
        self[key] = value

    def getValue(self, key):
        return self[key]

    def removeKey(self, key):
        del self[key]


class Handle:
    def getValueState(self, name, schema):
        return Value()

    def getMapState(self, name, key_schema, value_schema):
        return Map()


def test_pieces_are_taken_stretch_by_stretch():
    """5,000 rows of a key in mixed order and pieces of 100; no step sees more than a stretch of 250."""
    sizes = []

    def step(part, held):
        sizes.append(len(part))
        before = part["n"].shift(fill_value=held)
        return part.assign(before=before), int(part["n"].iloc[-1])

    numbers = list(range(5_000))
    random.Random(1).shuffle(numbers)
    job = stateful.InOrder(["n"], 250, step)
    job.init(Handle())
    pieces = [pd.DataFrame({"n": numbers[i : i + 100]}) for i in range(0, 5_000, 100)]
    found = pd.concat(job.handleInputRows((1,), iter([pieces[0].iloc[:0], *pieces]), None))
    assert found["n"].tolist() == list(range(5_000)) and found["before"].tolist() == list(range(-1, 4_999))
    assert max(sizes) == 250 and not job.waiting and job.held.get() == (4_999,)
    again = pd.concat(job.handleInputRows((1,), iter([pd.DataFrame({"n": [5_001, 5_000]})]), None))
    assert again["before"].tolist() == [4_999, 5_000] and job.held.get() == (5_001,)
    assert list(job.handleInputRows((1,), iter([]), None)) == [] and job.held.get() == (5_001,)


def test_busy_station_in_small_pieces(spark, folder):
    """One station has nine tenths of the rows, its batches come in mixed order and in pieces of 16 rows; each batch is a restart."""
    mixed = random.Random(2)
    seconds = mixed.sample(range(40_000), 600)
    whole = [(7 if i % 10 else i, START + timedelta(seconds=t), "OPN", 9, mixed.randrange(20)) for i, t in enumerate(seconds)]
    parts = [[r for r in whole if low <= (r[1] - START).seconds < low + 15_000] for low in (0, 15_000, 30_000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        with stateful.state_on_disk(spark):
            for part in parts:
                spark.createDataFrame(part, OBS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
                moved = stateful.stateful_facts(spark.readStream.schema(OBS).parquet(f"{folder}/in"), seconds=1_800)
                out = moved.writeStream.format("parquet").option("path", f"{folder}/out")
                jobs.start(out, f"{folder}/checkpoint").awaitTermination()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    columns = ["station", "timetag", "available", "lent", "returned"]
    expected = facts(spark.createDataFrame(whole, OBS))
    assert rows(spark.read.parquet(f"{folder}/out").select(columns)) == rows(expected.select(columns))


def test_the_last_of_repeated_rows_counts():
    repeated = pd.DataFrame({"station": 1, "timetag": [1, 1, 2], "status": "OPN", "slots": 1, "bikes": [3, 5, 4]})
    out, held = stateful._previous_counts(repeated, -1)
    assert out["bikes"].tolist() == [5, 4] and out["previous"].tolist() == [-1, 5] and held == 4
