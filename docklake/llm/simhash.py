"""Near-duplicate documents by SimHash fingerprints at a Hamming distance of at most two.

Search is a generalised pigeonhole: correlated bits share a partition, and each partition gets its own threshold, chosen by
dynamic programming on estimated costs. Two fingerprints within distance ``d`` then agree up to its threshold in at
least one partition, whenever the thresholds of ``m`` partitions sum to ``d - m + 1``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from docklake.llm.common import LOWERED, free_name, stored, utf8
from docklake.llm.components import components

BITS = 64
DISTANCE = 2
SEED = 42


def fingerprint(text: bytes, words_in_shingle: int = 3) -> int:
    """The unsigned SimHash of one text; zero for a text without words."""
    words = text.translate(LOWERED).split()
    if not words:
        return 0
    if len(words) < words_in_shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_in_shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(shingle, SEED) for shingle in shingles], dtype="<u8")
    set_bits = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 4096):
        part = hashes[start : start + 4096]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


@F.arrow_udf(LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    values = np.fromiter((fingerprint(text) for text in utf8(texts)), dtype="<u8", count=len(texts))
    return pa.array(values.view(np.int64))


def with_fingerprint(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a signed long; a null text counts as empty."""
    return docs.withColumn(name, _fingerprints("text"))


@dataclass(frozen=True)
class Partition:
    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        """The bits as a signed long."""
        value = sum(1 << bit for bit in self.bits)
        return value - (1 << BITS) if value >> (BITS - 1) else value

    @property
    def flips(self) -> list[int]:
        """What to flip in a value to get all values within the threshold, as signed longs."""
        masks = [
            sum(1 << bit for bit in chosen) for n in range(self.threshold + 1) for chosen in combinations(self.bits, n)
        ]
        return [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in masks]


def _joint_counts(batches):
    """Per task: how many fingerprints have bits i and j set, the count of all at (64, 64)."""
    total, joint = 0, np.zeros((BITS, BITS), dtype=np.int64)
    for batch in batches:
        values = batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8)
        for start in range(0, len(values), 65536):
            bits = np.unpackbits(values[start : start + 65536], axis=1, bitorder="little").astype(np.float32)
            joint += (bits.T @ bits).astype(np.int64)
        total += len(values)
    i, j = np.divmod(np.arange(BITS * BITS), BITS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(i, BITS)), pa.array(np.append(j, BITS)), pa.array(np.append(joint.ravel(), total))],
        names=["i", "j", "n"],
    )


def bit_correlations(prints: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and the absolute correlation of every pair of bits, over all of them."""
    sums = prints.select("print").mapInArrow(_joint_counts, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    found = {(row.i, row.j): row.n for row in sums.collect()}  # at most 64 * 64 + 1 rows
    total = found.pop((BITS, BITS), 0)
    joint = np.zeros((BITS, BITS))
    for (i, j), n in found.items():
        joint[i, j] = n / max(total, 1)
    share = np.diag(joint)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    return total, np.abs((joint - np.outer(share, share)) / np.outer(spread, spread))


def grouped_bits(correlation: np.ndarray, groups: int) -> list[tuple[int, ...]]:
    """Near equal groups of bits: each starts with the bit least tied to the others and takes the most correlated ones."""
    free, found = set(range(BITS)), []
    for k in range(groups):
        size = len(free) // (groups - k)
        tie = {bit: correlation[bit, [b for f in found for b in f]].sum() for bit in free}
        group = [min(free, key=lambda bit: (tie[bit], bit))]
        free -= set(group)
        while len(group) < size:
            bit = max(free, key=lambda bit: (correlation[bit, group].sum(), -bit))
            group.append(bit)
            free.remove(bit)
        found.append(tuple(sorted(group)))
    return found


def _neighbours(width: int, threshold: int) -> int:
    return sum(len(list(combinations(range(width), n))) for n in range(threshold + 1))


def planned_partitions(total: int, correlation: np.ndarray, sample: np.ndarray) -> list[Partition]:
    """The cheapest partitions and thresholds for ``total`` distinct fingerprints.

    The share of pairs that agree within a threshold comes from a bounded sample, at least what independent fair bits
    would give. It only steers cost; any plan finds all links.
    """
    best: tuple[float, list[Partition]] | None = None
    for groups in range(1, DISTANCE + 3):
        parts = grouped_bits(correlation, groups)
        cost: list[dict[int, float]] = []
        for bits in parts:
            mask = np.uint64(sum(1 << bit for bit in bits))
            own = sample & mask
            apart = np.bitwise_count(own[:, None] ^ own[None, :])[np.triu_indices(len(own), 1)]
            cost.append({-1: 0.0})
            for threshold in range(DISTANCE + 1):
                near = _neighbours(len(bits), threshold)
                share = max(float((apart <= threshold).mean()) if len(apart) else 0.0, near / 2.0 ** len(bits))
                cost[-1][threshold] = total * near * (1 if threshold == 0 else 2) + share * total * total / 2
        plans: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for choices in cost:
            longer: dict[int, tuple[float, tuple[int, ...]]] = {}
            for spent, (sum_, chosen) in plans.items():
                for threshold, price in choices.items():
                    candidate = (sum_ + price, (*chosen, threshold))
                    if spent + threshold not in longer or candidate < longer[spent + threshold]:
                        longer[spent + threshold] = candidate
            plans = longer
        price, thresholds = plans[DISTANCE - groups + 1]
        if best is None or price < best[0]:
            best = price, [Partition(bits, t) for bits, t in zip(parts, thresholds, strict=True) if t >= 0]
    return best[1]


def _signatures(prints: DataFrame, partitions: list[Partition]) -> DataFrame:
    """``(part, value, print, entry, probe)``: where each fingerprint is stored and where it looks."""
    found = []
    for part, partition in enumerate(partitions):
        own = F.col("print").bitwiseAND(F.lit(partition.mask))
        flips = F.array(*(F.lit(flip).cast("long") for flip in partition.flips))
        exploded = prints.select("print", F.explode(flips).alias("flip"))
        found.append(exploded.select(
            F.lit(part).alias("part"), own.bitwiseXOR(F.col("flip")).alias("value"), "print", (F.col("flip") == 0).alias("entry"),
        ))
    return reduce(DataFrame.unionByName, found)


def links(prints: DataFrame, bucket_limit: int = 64, sample_size: int = 2048) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints ``prints(print)`` that connect all within distance two.

    Small buckets are verified pair by pair. Fingerprints of a bucket above ``bucket_limit`` go to an exact search
    without pairs: each is listed under itself and its 64 one-bit neighbours. Two of them are within two bits exactly
    if they share a listing, and all under one listing (65 at most, as they are distinct) are within two bits of
    each other, so linking them to their smallest keeps every component whole at a linear cost.
    """
    total, correlation = bit_correlations(prints)
    rows = prints.orderBy(F.xxhash64("print"), "print").limit(sample_size).collect()
    sample = np.array([row["print"] for row in rows], dtype=np.int64).view(np.uint64)
    signatures = stored(_signatures(prints, planned_partitions(total, correlation, sample)), "signatures")
    sizes = signatures.groupBy("part", "value").agg(F.count("*").alias("size"), F.max("entry").alias("held"))
    placed = signatures.join(sizes.where("size > 1 and held"), ["part", "value"])
    small = placed.where(F.col("size") <= bucket_limit)
    looking = small.select("part", "value", F.col("print").alias("x"))
    held = small.where("entry").select("part", "value", F.col("print").alias("y"))
    verified = (
        looking.join(held, ["part", "value"])
        .where((F.col("x") != F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= DISTANCE))
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    )
    crowded = placed.where(F.col("size") > bucket_limit).select("print").distinct()
    around = Partition(tuple(range(BITS)), 1).flips
    listed = crowded.select(
        "print", F.explode(F.array(*(F.lit(flip).cast("long") for flip in around))).alias("flip")
    ).select("print", F.col("print").bitwiseXOR(F.col("flip")).alias("listing"))
    groups = listed.groupBy("listing").agg(F.collect_set("print").alias("near")).where(F.size("near") > 1)  # 65 at most
    starred = groups.select(F.array_min("near").alias("a"), F.explode("near").alias("b")).where("a != b")
    return verified.unionByName(starred).distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with ``fingerprint`` (signed long) and ``component_id``, the smallest id reachable by links.

    Columns of those names in ``docs`` are replaced. Each row of ``docs`` stays, repeated rows too. Null texts count
    as empty, texts without words have fingerprint zero and are linked like any other. Null ids are ignored when
    the smallest is taken; a component with null ids only has a null ``component_id``. An empty table gives none.

    Rows with one fingerprint meet only in map-side combined aggregates and in a join that adaptive execution can
    split, links are sought between distinct fingerprints.
    """
    docs = docs.drop("component_id")
    marked = stored(with_fingerprint(docs, "fingerprint"), "fingerprints")
    classes = stored(
        marked.groupBy(F.col("fingerprint").alias("print")).agg(F.min(id_column).alias("smallest")), "classes"
    )
    roots = components(links(classes.select("print")))
    linked = roots.join(classes, roots["node"] == classes["print"])
    shared = linked.groupBy("root").agg(F.min("smallest").alias("reached"))
    reached = roots.join(shared, "root").select("node", "reached")
    named = classes.join(reached, classes["print"] == reached["node"], "left").select(
        F.col("print").alias("fingerprint"), F.when(F.col("node").isNull(), F.col("smallest")).otherwise(F.col("reached")).alias("component_id")
    )
    return marked.join(named, "fingerprint").select(*docs.drop("fingerprint").columns, "fingerprint", "component_id")


def one_of_each(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row of each component of near duplicates: the smallest id, of equal ids any one; columns as in ``docs``.

    Texts cross the network once, in the last join; rows are told apart by a number stored with them.
    """
    row = free_name(docs, "row_number")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    own = numbered.select(F.col(id_column).alias("doc_id"), "text", F.col(row).alias("row"))
    found = near_duplicates(own, "row").groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")).alias("first")
    )
    return numbered.join(found.select(F.col("first.row").alias(row)), row, "left_semi").drop(row)
