"""Near copies at a given Jaccard similarity, found by wide SimHash fingerprints.

A similarity of 0.8 leaves 64-bit fingerprints some ten bits apart, too many for a search that flips bits. Here the
fingerprint of the distinct shingles has many blocks of 64 bits. In each block the bits are ranked by how decided they
are: those whose counts lie furthest from a half hardly ever change between near copies. Blocks are the partitions of a
generalised pigeonhole: per block a threshold says how many of the most decided bits two texts must share there, chosen by
dynamic programming on estimated candidate counts so that a pair at the least similarity is met in some block
almost surely. Candidates are verified: by the whole fingerprint where that leaves no doubt, else by their shingles.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from math import comb, cos, log, pi, sqrt
from struct import unpack

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from docklake.llm.common import LOWERED, free_name, stored
from docklake.llm.components import components

BITS = 64
BLOCKS = 64
DECIDED = 6  # the most decided bits of a block that are kept
WORDS = 32  # blocks whose bits are kept whole, to measure how far two texts are apart
SEED = 42
STRETCH = 1 << 16  # bytes of a text that are cut into words at once
SPACE = re.compile(rb"[ \t-\r]")
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _stretches(text: bytes):
    """The lower-case words of a text, stretch by stretch, so that a very long one is never held as words."""
    start = 0
    while start < len(text):
        space = SPACE.search(text, start + STRETCH)
        end = space.start() if space else len(text)
        yield text[start:end].translate(LOWERED).split()
        start = end


def shingles(text: bytes, width: int) -> np.ndarray:
    """The distinct hashes of all ``width``-word shingles, sorted; of fewer words that of all, none without words."""
    digest, found, words = xxhash.xxh64_intdigest, [], []
    for stretch in _stretches(text):
        words = words[len(words) - width + 1 :] + stretch if len(words) >= width else words + stretch
        if len(words) >= width:
            joined = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
            found.append(np.unique(np.fromiter((digest(shingle, SEED) for shingle in joined), np.uint64)))
    if not found:
        return np.array([digest(b" ".join(words), SEED)] if words else [], np.uint64)
    return np.unique(np.concatenate(found))


def content(text: bytes) -> bytes:
    """128 bits that tell texts of other words apart."""
    whole = xxhash.xxh128()
    for stretch in _stretches(text):
        for start in range(0, len(stretch), 1024):
            whole.update(b" ".join(stretch[start : start + 1024]) + b" ")
    return whole.digest()


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """``(hashes, BLOCKS)``: an own hash for every block."""
    x = hashes[:, None] + np.arange(1, BLOCKS + 1, dtype=np.uint64) * STEP
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def decided_bits(hashes: np.ndarray) -> tuple[bytes, bytes]:
    """The fingerprint of ``WORDS`` words, and of each block the most decided bits, as ``2 * bit + value``."""
    ones = np.zeros(BLOCKS * BITS, np.int64)
    for start in range(0, len(hashes), 255):  # sums of bytes hold 255 rows
        rows = _mixed(hashes[start : start + 255]).view(np.uint8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    lean = (2 * ones - len(hashes)).reshape(BLOCKS, BITS)
    print_ = np.packbits((lean[:WORDS] > 0).reshape(-1), bitorder="little").tobytes()
    first = np.argsort(-np.abs(lean), axis=1, kind="stable")[:, :DECIDED]
    return print_, (2 * first + (np.take_along_axis(lean, first, 1) > 0)).astype(np.uint8).tobytes()


# What reads whole texts is a plain function of a row, so rows come a hundred at a time; an Arrow batch would hold all texts of
# a task outside the heap of the JVM, which keeps much of that memory, and again in Python.
def _sketched(width: int):
    kind = StructType([
        StructField("content_a", LongType()), StructField("content_b", LongType()),
        StructField("print", BinaryType()), StructField("decided", BinaryType()),
    ])

    @F.udf(kind, useArrow=False)
    def sketch(text: bytes | None) -> tuple:
        own = bytes(text or b"")
        return (*unpack("<qq", content(own)), *decided_bits(shingles(own, width)))

    return lambda text: sketch(F.col(text).cast("binary"))


def _angle(similarity: float) -> float:
    """The share of bits in which two sets of one size and this Jaccard similarity differ."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / pi)


@lru_cache
def agreement(similarity: float) -> tuple[float, ...]:
    """How likely two such sets agree in the 1, 2, ... most decided bits of a block, from simulated counts."""
    rho = cos(pi * _angle(similarity))
    rng = np.random.default_rng(SEED)
    a = rng.standard_normal((20_000, BITS))
    b = rho * a + sqrt(1 - rho * rho) * rng.standard_normal(a.shape)
    marks = []
    for lean in (a, b):
        first = np.concatenate([np.argsort(-np.abs(part), axis=1)[:, :DECIDED] for part in np.split(lean, 20)])
        marks.append(2 * first + (np.take_along_axis(lean, first, 1) > 0))
    return tuple(
        float((np.sort(marks[0][:, :k], 1) == np.sort(marks[1][:, :k], 1)).all(axis=1).mean()) for k in range(1, DECIDED + 1)
    )


def _keys(decided: np.ndarray, block: int, k: int) -> np.ndarray:
    """Of ``decided (rows, BLOCKS, DECIDED)`` one number for the block and its ``k`` most decided bits."""
    keys = np.full(len(decided), block, np.int64)
    for mark in np.sort(decided[:, block, :k], axis=1).T:
        keys = keys * 128 + mark
    return keys * 8 + k


def planned(total: int, sample: np.ndarray, apart: np.ndarray, similarity: float, missed: float) -> list[tuple[int, int]]:
    """``(block, decided bits to share)`` at the least cost for ``total`` texts; pairs at ``similarity`` are missed with
    a chance of ``missed`` at most, or as low as all blocks allow. Costs come from a bounded sample: rows
    to place and pairs that meet in vain, at least those that meet by chance. ``apart`` marks the pairs of the sample that
    are no candidates; near pairs are what is sought and cost nothing, or the plan would avoid the blocks where they
    meet. Costs only steer the plan.
    """
    unit = 0.01
    need = int(np.ceil(-log(missed) / unit))
    gains = [int(-log(1 - p) / unit) for p in agreement(similarity)]
    best: dict[int, tuple[float, tuple[tuple[int, int], ...]]] = {0: (0.0, ())}
    for block in range(BLOCKS):
        costs = []
        for k in range(1, DECIDED + 1):
            keys = _keys(sample, block, k)
            meeting = np.count_nonzero((keys[:, None] == keys[None, :]) & apart) / max(np.count_nonzero(apart), 1)
            share = max(meeting, 1.0 / (comb(BITS, k) * 2.0**k))
            costs.append(4.0 * total + share * total * total / 2)
        longer = dict(best)
        for gained, (cost, chosen) in best.items():
            for k, price in enumerate(costs, 1):
                now, wanted = (cost + price, (*chosen, (block, k))), min(gained + gains[k - 1], need)
                if wanted not in longer or now[0] < longer[wanted][0]:
                    longer[wanted] = now
        best = longer
    return list(best[max(best)][1])


def _spots(plan: list[tuple[int, int]]):
    @F.arrow_udf(ArrayType(LongType()))
    def spots(decided: pa.Array) -> pa.Array:
        marks = np.frombuffer(b"".join(decided.to_pylist()), np.uint8).reshape(-1, BLOCKS, DECIDED).astype(np.int64)
        keys = np.stack([_keys(marks, block, k) for block, k in plan], axis=1)
        offsets = np.arange(0, keys.size + 1, len(plan), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)))

    return spots


@F.arrow_udf(IntegerType())
def _apart(a: pa.Array, b: pa.Array) -> pa.Array:
    """In how many bits two fingerprints differ."""
    x, y = (np.frombuffer(b"".join(side.to_pylist()), np.uint64).reshape(-1, WORDS) for side in (a, b))
    return pa.array(np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int32))


def _measured(pairs: DataFrame, prints: DataFrame, most: int) -> DataFrame:
    """``(a, b, apart)`` of the pairs whose fingerprints differ in ``most`` bits at most."""
    for side in "ab":
        pairs = pairs.join(prints.select(F.col("row").alias(side), F.col("print").alias(f"print_{side}")), side)
    # A filter moves below a deterministic column and then counts on its own, in a second worker beside the first.
    apart = _apart.asNondeterministic()("print_a", "print_b")
    return pairs.select("a", "b", apart.alias("apart")).where(F.col("apart") <= most)


def _jaccard(width: int):
    @F.udf(DoubleType(), useArrow=False)
    def jaccard(a: bytes | None, b: bytes | None) -> float:
        own, other = (shingles(bytes(text or b""), width) for text in (a, b))
        both = len(np.intersect1d(own, other, assume_unique=True))
        return both / max(len(own) + len(other) - both, 1)

    return lambda a, b: jaccard(F.col(a).cast("binary"), F.col(b).cast("binary"))


@dataclass(frozen=True)
class Bounds:
    """Numbers of differing bits: of the two words that travel along, and of whole fingerprints."""

    words: int
    sure: int  # so few leave no doubt
    most: int  # more are out of the question

    @classmethod
    def of(cls, similarity: float) -> Bounds:
        share = _angle(similarity)

        def at(bits: int, spread: float) -> int:
            return round(bits * share + spread * sqrt(bits * share * (1 - share)))

        return cls(at(2 * BITS, 3.6), at(WORDS * BITS, -4.5), at(WORDS * BITS, 4.0))


def _near(x0: Column, x1: Column, y0: Column, y1: Column, bound: int) -> Column:
    return F.bit_count(x0.bitwiseXOR(y0)) + F.bit_count(x1.bitwiseXOR(y1)) <= bound


BUCKET_LIMIT = 64  # rows of a spot that are compared pair by pair at once
CHUNK = 2048  # rows of a crowded spot that are compared with as many others in one task


def candidates(signs: DataFrame, bound: int, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Pairs ``(a, b)`` of ``signs(row, w0, w1, spot)`` that share a spot and whose words differ in ``bound`` bits at most.

    All pairs of a spot of up to ``bucket_limit`` rows are looked at. In a larger spot all rows meet its first one, which
    connects most of a group of near copies at a pair a row; ``crowded_pairs`` compares the others.
    """
    sizes = signs.groupBy("spot").agg(F.count("*").alias("n"), F.min(F.struct("row", "w0", "w1")).alias("first")).where("n > 1")
    small = signs.join(sizes.where(F.col("n") <= bucket_limit).select("spot"), "spot", "left_semi")
    small = small.groupBy("spot").agg(F.collect_list(F.struct("row", "w0", "w1")).alias("members"))
    partners = F.transform("members", lambda x: F.transform(
        F.filter("members", lambda y: (y["row"] > x["row"]) & _near(x["w0"], x["w1"], y["w0"], y["w1"], bound)),
        lambda y: F.struct(x["row"].alias("a"), y["row"].alias("b")),
    ))
    pairs = small.select(F.explode(F.flatten(partners)).alias("pair")).select("pair.a", "pair.b")
    met = signs.join(sizes.where(F.col("n") > bucket_limit).select("spot", "first"), "spot").where(F.col("row") != F.col("first.row"))
    met = met.where(_near(F.col("w0"), F.col("w1"), F.col("first.w0"), F.col("first.w1"), bound))
    return pairs.unionByName(met.select(F.col("first.row").alias("a"), F.col("row").alias("b"))).distinct()


def _compared(bounds: Bounds):
    """Of two chunks of a spot the pairs of rows of different groups that may be similar: one of many that surely connect
    the same groups, all doubtful ones that those leave apart."""

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        own, other = key[1].as_py(), key[2].as_py()
        number, chunk = rows.column("row").to_numpy(), rows.column("chunk").to_numpy()
        prints = np.frombuffer(b"".join(rows.column("print").to_pylist()), np.uint64).reshape(-1, WORDS)
        group = rows.column("group").to_numpy().copy()
        here, there = np.nonzero(chunk == own)[0], np.nonzero(chunk == other)[0]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for place, x in enumerate(here):
            y = there[place + 1 :] if own == other else there
            y = y[np.bitwise_count(prints[y, :2] ^ prints[x, :2]).sum(axis=1, dtype=np.int32) <= bounds.words]
            y = y[group[y] != group[x]]
            apart = np.bitwise_count(prints[y] ^ prints[x]).sum(axis=1, dtype=np.int32)
            y, apart = y[apart <= bounds.most], apart[apart <= bounds.most]
            if not len(y):
                continue
            joined, first = np.unique(group[y[apart <= bounds.sure]], return_index=True)
            sure = np.nonzero(apart <= bounds.sure)[0][first]
            group[np.isin(group, joined)] = group[x]
            kept = np.concatenate([sure, np.nonzero(apart > bounds.sure)[0]])
            found.append((np.full(len(kept), x), y[kept], apart[kept]))
        a, b, apart = (np.concatenate(x) if found else np.empty(0, np.int64) for x in (zip(*found, strict=True) if found else ((),) * 3))
        kept = (apart <= bounds.sure) | (group[a] != group[b])
        a, b, apart = number[a[kept]], number[b[kept]], apart[kept]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "apart": apart.astype(np.int32)})

    return compare


def crowded_pairs(signs: DataFrame, prints: DataFrame, groups: DataFrame, bounds: Bounds, bucket_limit: int = BUCKET_LIMIT, chunk_size: int = CHUNK) -> DataFrame:
    """Pairs ``(a, b, apart)`` that connect what is near in spots of more than ``bucket_limit`` rows and not yet in one of
    ``groups(node, root)``.

    Every pair of a spot is compared unless its rows are connected. A spot is dealt into chunks, and each two of them meet in a
    group of their own, so tasks stay small; the work grows with the square of a spot that holds many groups.
    """
    grouped = signs.select("row", "spot").join(groups.select(F.col("node").alias("row"), "root"), "row", "left")
    grouped = grouped.select("row", "spot", F.coalesce("root", "row").alias("group"))
    sizes = grouped.groupBy("spot").agg(F.count("*").alias("n"), F.min("group").alias("low"), F.max("group").alias("high"))
    open_ = sizes.where((F.col("n") > bucket_limit) & (F.col("low") != F.col("high")))
    parts = open_.select("spot", F.ceil(F.col("n") / chunk_size).cast("int").alias("parts"))
    dealt = grouped.join(parts, "spot").withColumn("chunk", F.pmod(F.xxhash64("row"), "parts").cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.join(prints.select("row", "print"), "row").select(
        "spot", F.least("chunk", "with").alias("own"), F.greatest("chunk", "with").alias("other"), "row", "chunk", "group", "print"
    )
    return dealt.groupBy("spot", "own", "other").applyInArrow(_compared(bounds), "a long, b long, apart int").distinct()


def links(texts: DataFrame, prints: DataFrame, width: int, similarity: float, missed: float, sample_size: int = 1024, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Edges ``(a, b)`` between rows of ``prints(row, print, decided)`` that connect what is similar; ``texts(row, text)``.

    Pairs that fingerprints alone decide come first; a doubtful pair is compared by its texts only if those have not
    connected it already. Then the pairs of crowded spots that are still apart are compared in the same way.
    """
    bounds = Bounds.of(similarity)
    chosen = prints.orderBy(F.xxhash64("row"), "row").limit(sample_size).select("decided", "print").collect()
    sample = np.frombuffer(b"".join(row["decided"] for row in chosen), np.uint8).reshape(-1, BLOCKS, DECIDED).astype(np.int64)
    own = np.frombuffer(b"".join(row["print"][:16] for row in chosen), np.uint64).reshape(-1, 2)
    apart = sum(np.bitwise_count(word[:, None] ^ word[None, :]) for word in own.T) > bounds.words
    plan = planned(prints.count(), sample, apart, similarity, missed)
    words = [F.conv(F.hex(F.substring("print", start, 8)), 16, -10).cast("long").alias(name) for start, name in ((1, "w0"), (9, "w1"))]
    signs = stored(prints.select("row", *words, F.explode(_spots(plan)("decided")).alias("spot")), "spots")
    pairs = candidates(signs, bounds.words, bucket_limit)
    measured = stored(_measured(pairs, prints, bounds.most), "similar-pairs")
    sure = measured.where(F.col("apart") <= bounds.sure).select("a", "b")
    doubtful = measured.where(F.col("apart") > bounds.sure)
    first = stored(sure.unionByName(_proven(texts, doubtful, stored(components(sure), "sure-groups"), width, similarity)), "first-links")
    groups = stored(components(first), "first-groups")
    later = stored(crowded_pairs(signs, prints, groups, bounds, bucket_limit), "crowded-pairs")
    if later.isEmpty():
        return first
    sure = later.where(F.col("apart") <= bounds.sure).select("a", "b")
    doubtful = later.where(F.col("apart") > bounds.sure)
    proven = _proven(texts, doubtful, stored(components(first.unionByName(sure)), "sure-groups"), width, similarity)
    return first.unionByName(sure).unionByName(proven)


def _proven(texts: DataFrame, doubtful: DataFrame, groups: DataFrame, width: int, similarity: float) -> DataFrame:
    """Those of the pairs ``doubtful(a, b)`` between different ``groups(node, root)`` whose texts are similar."""
    for side in "ab":
        doubtful = doubtful.join(groups.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    doubtful = stored(doubtful.where(apart).select("a", "b"), "doubtful-pairs")
    for side in "ab":
        doubtful = doubtful.join(texts.select(F.col("row").alias(side), F.col("text").alias(f"text_{side}")), side)
    return doubtful.where(_jaccard(width)("text_a", "text_b") >= similarity).select("a", "b")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", width: int = 5, similarity: float = 0.8, missed: float = 0.01) -> DataFrame:
    """One row of each group that links of ``similarity`` connect: the smallest id, of equal ids any one; columns as in ``docs``.

    Similar are texts whose sets of ``width``-word shingles (lower-case A-Z; fewer words: all of them) have a Jaccard
    similarity of that much. A pair just there is found with a chance of ``1 - missed`` or more, nearer ones more surely,
    equal words always. Null and empty texts and those without words are copies of each other and of nothing else. Null ids
    come last, repeated rows are copies, an empty table gives none. Texts cross the network in the last join,
    and where a doubtful pair is compared.
    """
    row = free_name(docs, "row_number")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    texts = numbered.select(F.col(row).alias("row"), F.col(id_column).alias("doc_id"), "text")
    marked = stored(texts.select("row", "doc_id", _sketched(width)("text").alias("s")).select("row", "doc_id", "s.*"), "sketches")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    classes = stored(marked.groupBy("content_a", "content_b").agg(F.min("row").alias("row"), F.min(order).alias("first")), "contents")
    prints = stored(marked.join(classes.select("row"), "row", "left_semi").select("row", "print", "decided"), "prints")
    roots = components(links(texts.select("row", "text"), prints, width, similarity, missed))
    named = classes.join(roots, classes["row"] == roots["node"], "left")
    kept = named.groupBy(F.coalesce("root", "row").alias("group")).agg(F.min("first").alias("first"))
    return numbered.join(kept.select(F.col("first.row").alias(row)), row, "left_semi").drop(row)
