"""The same jobs with state per key, for very many keys: a state store on disk holds one value a key, and only keys that
occur in a micro-batch are touched. A key's rows come in any order and in pieces; what doesn't fit one piece waits in the
store by stretches of the order and is taken stretch by stretch, so no task holds all rows of a key.

Start the streams inside ``state_on_disk``, or in a session with the settings of ``ROCKSDB``; workers need this package and that for protocol buffers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import chain, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from docklake.functions.measures import fact_measures

# The state store that can keep several states a key.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in files."""
    before = {name: spark.conf.get(name, None) for name in ROCKSDB}
    for name, value in ROCKSDB.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _packed(rows: pd.DataFrame) -> bytes:
    batch, sink = pa.RecordBatch.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(value).read_all().to_pandas()


class InOrder(StatefulProcessor):
    """Gives the rows of a key to ``step`` in ``order``, with a whole number that it hands on (at first -1).

    ``step(rows, held)`` gets sorted rows, all of one piece or of one stretch of ``width`` of the first column of ``order``, and
    returns what to emit and the number to hold. Rows of one value of that column always come in one call.
    """

    def __init__(self, order: list[str], width: int, step: Callable[[pd.DataFrame, int], tuple[pd.DataFrame, int]]) -> None:
        self.order, self.width, self.step = order, width, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "value bigint")
        self.waiting = handle.getMapState("waiting", "stretch bigint, piece int", "rows binary")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pieces = (piece for piece in rows if len(piece))
        first, second = next(pieces, None), next(pieces, None)
        if first is None:
            return
        held = self.held.get()[0] if self.held.exists() else -1
        for part in [first] if second is None else self._stretches(chain([first, second], pieces)):
            out, held = self.step(part.sort_values(self.order, kind="stable", ignore_index=True), held)
            yield out
        self.held.update((int(held),))

    def _stretches(self, pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, piece in enumerate(pieces):
            at = piece[self.order[0]]
            seconds = at.to_numpy().astype("datetime64[s]").astype(np.int64) if at.dtype.kind == "M" else at.to_numpy()
            for stretch, own in piece.groupby(seconds // self.width):
                self.waiting.updateValue((int(stretch), number), (_packed(own),))
        places = sorted(tuple(place) for place in self.waiting.keys())
        for _, same in groupby(places, key=lambda place: place[0]):
            same = list(same)
            yield pd.concat([_unpacked(self.waiting.getValue(place)[0]) for place in same])
            for place in same:
                self.waiting.removeKey(place)

    def close(self) -> None:
        pass


def _previous_counts(rows: pd.DataFrame, held: int) -> tuple[pd.DataFrame, int]:
    rows = rows.drop_duplicates("timetag", keep="last")
    previous = rows["bikes"].shift(fill_value=held).astype("int32")
    return rows.assign(previous=previous)[["station", "timetag", "status", "slots", "bikes", "previous"]], int(rows["bikes"].iloc[-1])


def stateful_facts(obs: DataFrame, tie: tuple[str, ...] = (), seconds: int = 3600) -> DataFrame:
    """Facts of a stream of observations. Of those of one (station, timetag) in a micro-batch the last by ``tie`` counts. At most
    ``seconds`` of a station, or one piece, are sorted at a time."""
    kinds = {f.name: f.dataType.simpleString() for f in obs.schema.fields}
    names = ["station", "timetag", "status", "slots", "bikes"]
    schema = ", ".join(f"{n} {kinds[n]}" for n in names) + ", previous int"
    moved = obs.select(*dict.fromkeys([*names, *tie])).groupBy("station").transformWithStateInPandas(
        InOrder(["timetag", *tie], seconds, _previous_counts), schema, "append", "None"
    )
    measures = fact_measures(F.col("status"), F.col("slots"), F.col("bikes"), F.col("previous"))
    return moved.select("station", "timetag", "status", *(c.alias(n) for n, c in measures.items()))


def _newer_snapshots(rows: pd.DataFrame, held: int) -> tuple[pd.DataFrame, int]:
    times = rows["timestamp_ms"].to_numpy()
    seen = np.maximum.accumulate(np.concatenate(([held], times)))
    return rows[times > seen[:-1]], int(seen[-1])


def stateful_monotone(raw: DataFrame, arrivals: int = 10_000) -> DataFrame:
    """Snapshots strictly newer than all earlier ones of their datasource, by ``arrival``, a number; a stretch has ``arrivals`` of them."""
    return raw.groupBy("datasource").transformWithStateInPandas(
        InOrder(["arrival"], arrivals, _newer_snapshots), raw.schema, "append", "None"
    )
