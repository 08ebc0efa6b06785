"""Helpers the operators share: folds, free column names, stored intermediates."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docklake.session import scratch_dir

UPPER = bytes(range(ord("A"), ord("Z") + 1))
LOWERED = bytes.maketrans(UPPER, UPPER.lower())


def fold(id_column: str | Column, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds``; null for a null id."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(column.cast("string")) % folds


def free_name(frame: DataFrame, wish: str) -> str:
    """``wish``, made longer until no column of ``frame`` has that name."""
    taken = {name.lower() for name in frame.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` as a table in the shared scratch folder, which lost executors don't take along."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def utf8(texts: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string array; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return [value or b"" for value in texts.cast(kind).to_pylist()]
