"""One row per key. All of these combine map-side, so a hot key costs no more than another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``; remaining ties are settled by the other columns."""
    return _pick(df, keys, order, F.max)


def earliest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, keys, order, F.min)


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*order, *(c for c in rest if c not in order))
    return df.groupBy(*keys).agg(pick(ranked).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def insert_missing(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``."""
    return new.join(existing.select(*keys), list(keys), "left_anti")


def update_matching(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` that replace a row of ``existing``."""
    return new.join(existing.select(*keys), list(keys), "left_semi")


def exists_in(df: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(keys_of.select(*keys), list(keys), "left_semi")


def merge_by_key(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``existing`` with the rows of ``new`` put in by key: new rows win, the last by ``order``
    among several new ones."""
    columns = existing.columns
    both = existing.withColumn("_new", F.lit(0)).unionByName(
        new.select(*columns).withColumn("_new", F.lit(1))
    )
    return latest_per_key(both, keys, ["_new", *order]).select(*columns)
