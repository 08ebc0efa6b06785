"""Tables in buckets by key: joined without moving their rows, and read by key from the buckets that hold it.

A key with many rows is spread over several slots, as many as its rows need, and slots are what the buckets go by. The
number of slots of each key is a table of its own, with one row a key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOT = "slot"
SLOTS = "slots_of_key"
MOST_SLOTS = 1 << 16  # of one key; the slot is a bigint that holds the key above them


@dataclass(frozen=True)
class Buckets:
    """Where rows of an integer ``key`` lie: ``path`` has the slots of each key, tables are named in the session's catalog."""

    key: str
    count: int
    path: str

    def slots(self, spark: SparkSession) -> DataFrame:
        """``(key, slots_of_key)`` of the keys that are spread at all."""
        return spark.read.parquet(f"{self.path}/slots")

    def write(self, rows: DataFrame, name: str, order: str) -> DataFrame:
        """``rows`` as a table with the column ``slot``, sorted by ``order`` in each; a row's slot depends on its ``order`` value."""
        own = F.pmod(F.xxhash64(order), F.coalesce(SLOTS, F.lit(1)))
        return self._stored(self._with_slots(rows, own), name, order)

    def write_lookup(self, rows: DataFrame, name: str) -> DataFrame:
        """One row a key and slot, so that each bucket has what its keys look up."""
        return self._stored(self._with_slots(rows, F.explode(F.sequence(F.lit(0), F.coalesce(SLOTS, F.lit(1)) - 1))), name)

    def rows_of(self, table: DataFrame, key: int) -> DataFrame:
        """The rows of one key; only the buckets of its slots are read."""
        found = self.slots(table.sparkSession).where(F.col(self.key) == key).first()
        return table.where(F.col(SLOT).isin([key * MOST_SLOTS + i for i in range(found[SLOTS] if found else 1)]))

    def _with_slots(self, rows: DataFrame, number: Column) -> DataFrame:
        spread = rows.join(self.slots(rows.sparkSession), self.key, "left").withColumn(SLOT, number)
        slot = F.col(self.key).cast("bigint") * MOST_SLOTS + F.col(SLOT)
        return spread.withColumn(SLOT, slot).select(*rows.columns, SLOT)

    def _stored(self, rows: DataFrame, name: str, *order: str) -> DataFrame:
        placed = rows.repartition(self.count, SLOT)  # the hash of the buckets, so a task writes one file
        placed.write.bucketBy(self.count, SLOT).sortBy(SLOT, *order).option("path", f"{self.path}/{name}").saveAsTable(name)
        return rows.sparkSession.table(name)


def planned(rows: DataFrame, key: str, path: str, rows_in_bucket: int, most_buckets: int = 4096) -> Buckets:
    """Buckets for ``rows``: one for each ``rows_in_bucket``, and slots of at most about half as many rows.

    Null keys are kept in a slot of their own, null. A key has ``MOST_SLOTS`` slots at most; beyond that they grow.
    """
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    slots = F.least(F.ceil(2 * F.col("n") / rows_in_bucket), F.lit(MOST_SLOTS)).cast("int")
    sizes.where(2 * F.col("n") > rows_in_bucket).select(key, slots.alias(SLOTS)).write.parquet(f"{path}/slots")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    return Buckets(key, max(1, min(-(-total // rows_in_bucket), most_buckets)), path)
