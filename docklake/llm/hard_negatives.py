"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Rows of one label are written along a Hilbert curve in small blocks, each a row of a Parquet table with the smallest and
the largest value of every component. From those, interval arithmetic bounds the products of a vector with all rows of a
block: a block is read for an anchor only if the bounds meet a window of scores the anchor still has rows to find in. All
scores are whole numbers, and all results are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docklake.llm.common import stored

SCALE = 256.0
CURVE_COMPONENTS, CURVE_BITS = 16, 3
POSITIONS = 12  # bits of a row's place in its block
LEAST, MOST = -(1 << 62), 1 << 62
EXACT = float(1 << 53)  # whole numbers below it are exact as doubles


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of cell numbers below ``2 ** bits``; after Skilling's transposition."""
    x = cells.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for own in x:
            inverted = (own >> level & 1).astype(bool)
            swapped = np.where(inverted, 0, (x[0] ^ own) & low)
            x[0] ^= np.where(inverted, low, swapped)
            own ^= swapped
    x = np.bitwise_xor.accumulate(x, axis=0)
    flips = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        flips ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    place = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for own in x ^ flips:
            place = place << 1 | (own >> level & 1)
    return place


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows; by doubles where no sum can leave the whole numbers they hold."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the most that products of ``a`` with vectors between ``low`` and ``high`` can be."""
    a, low, high = a.astype(np.float64), low.astype(np.float64), high.astype(np.float64)
    up, down = np.maximum(a, 0.0), np.minimum(a, 0.0)
    peak = a.shape[1] * np.abs(a).max(initial=0.0) * max(np.abs(low).max(initial=0.0), np.abs(high).max(initial=0.0))
    slack = 0.0 if peak < EXACT else peak * 2.0**-40
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def quantised(vectors: DataFrame, anchors: Column) -> DataFrame:
    """Usable rows with whole components ``floor(256 * x)``, their number, and whether they are anchors."""
    value = lambda x: x.cast("double")
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(value(x)) & (F.abs(value(x)) < float("inf")), F.lit(False)))
    scaled = F.transform("vector", lambda x: F.floor(F.lit(SCALE) * value(x)))
    length = F.aggregate("whole", F.lit(0.0), lambda total, x: total + value(x) * value(x))
    usable = vectors.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)))
    return (
        usable.select("vec_id", "label", scaled.alias("whole"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
        .where(length < float(1 << 60)).withColumn("width", F.size("whole"))
    )


def _spread(rows: DataFrame) -> tuple[int, list[tuple[int, float, float]]]:
    """The commonest width, and of its components that vary most: number, mean and standard deviation."""
    widest = rows.groupBy("width").count().orderBy(F.desc("count"), "width").first()
    width = widest["width"] if widest else 0
    sums = (
        rows.where(F.col("width") == width).select(F.posexplode("whole").alias("component", "x"))
        .groupBy("component").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("deviation"))
    )
    most = sums.orderBy(F.desc("deviation"), "component").limit(CURVE_COMPONENTS).collect()
    return width, [(row["component"], row["mean"], row["deviation"]) for row in most]


def _place(width: int, components: list[tuple[int, float, float]]):
    """A row's place on the curve, 0 for another width; a component's cells lie within two standard deviations, the outer ones are open."""
    numbers, mean, deviation = (np.array(x) for x in zip(*components, strict=True))
    cells = 1 << CURVE_BITS

    @F.arrow_udf("long")
    def place(rows: pa.Array) -> pa.Array:
        found, usual = np.zeros(len(rows), np.int64), pc.equal(pc.list_value_length(rows), width)
        x = rows.filter(usual).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)[:, numbers]
        scaled = (x - mean) / np.maximum(deviation, 1e-9) * (cells / 4.0) + cells / 2.0
        found[usual.to_numpy(zero_copy_only=False)] = hilbert(np.clip(scaled, 0, cells - 1).astype(np.int64), CURVE_BITS)
        return pa.array(found)

    return place


BLOCK = "block long NOT NULL, width int, label long, n long, anchors long, low binary, high binary, rows binary, ids array<long>, is_anchor array<boolean>"


def _blocks(block_rows: int):
    """Sorted rows in blocks of one width and label, within a block by id."""

    def pack(batches):
        number, held = TaskContext.get().partitionId() << 24, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            kind = np.stack([table.column(name).to_numpy() for name in ("width", "label")])
            edges = [0, *(np.nonzero((np.diff(kind, axis=1) != 0).any(axis=0))[0] + 1).tolist(), len(table)]
            held = None
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                for start in range(low, high, block_rows):
                    part = table.slice(start, min(block_rows, high - start))
                    if start + block_rows >= high == len(table):
                        held = part.combine_chunks()  # more rows of this block may follow
                    else:
                        yield block(number, part)
                        number += 1
        if held is not None and len(held):
            yield block(number, held)

    def block(number: int, rows: pa.Table):
        rows = rows.sort_by([("vec_id", "ascending")])  # nulls last
        width = rows.column("width")[0].as_py()
        matrix = pa.chunked_array(rows.column("whole")).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(len(rows), width)
        anchor = rows.column("anchor").to_pylist()
        one = [
            number, width, rows.column("label")[0].as_py(), len(rows), sum(anchor), matrix.min(axis=0).tobytes(), matrix.max(axis=0).tobytes(),
            matrix.tobytes(), rows.column("vec_id").to_pylist(), anchor,
        ]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 3, pa.list_(pa.int64()), pa.list_(pa.bool_())]
        names = [field.split()[0] for field in BLOCK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(one, kinds, strict=True)], names=names)

    return pack


def blocks_of(rows: DataFrame, block_rows: int) -> DataFrame:
    """The stored blocks of quantised rows, along the curve of the components that vary most."""
    if block_rows > 1 << POSITIONS:
        raise ValueError(f"a block holds {1 << POSITIONS} rows at most")
    width, components = _spread(rows)
    place = _place(width, components)("whole") if components else F.lit(0).cast("long")
    order = ["width", "label", "place", "vec_id"]
    placed = rows.withColumn("label", F.col("label").cast("long")).withColumn("place", place)
    along = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(along.select("width", "label", "vec_id", "anchor", "whole").mapInArrow(_blocks(block_rows), BLOCK), "blocks")


def _matrix(values: bytes, rows: int, width: int) -> np.ndarray:
    return np.frombuffer(values, "<i4").reshape(rows, width)


def _anchors(k: int):
    """Every anchor, with the ``k``-th best score of its own label in its own block: the positives are no worse."""

    def find(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rows = _matrix(row["rows"], row["n"], row["width"])
                at = np.nonzero(row["is_anchor"])[0]
                scores = products(rows[at], rows)
                scores[np.arange(len(at)), at] = LEAST
                least = np.sort(scores, axis=1)[:, -k] if row["n"] > k else np.full(len(at), LEAST)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((row["block"] << POSITIONS) + at), pa.array([row["ids"][i] for i in at], pa.int64()),
                        pa.array([row["width"]] * len(at), pa.int32()), pa.array([row["label"]] * len(at), pa.int64()),
                        pa.array([rows[i].tobytes() for i in at], pa.binary()), pa.array([[x, MOST] for x in least.tolist()], pa.list_(pa.int64())),
                    ],
                    names=["anchor", "anchor_id", "width", "label", "vector", "windows"],
                )

    return find


def _needed(same_label: bool):
    """For each block of a chunk the anchors of a pack whose windows its bounds meet."""

    def choose(batches):
        for batch in batches:
            for row in batch.to_pylist():
                zones: dict[tuple, list] = {}
                for zone in row["zones"]:
                    zones.setdefault((zone["width"], zone["label"]), []).append(zone)
                packs: dict[tuple, list] = {}
                for item in row["items"]:
                    packs.setdefault((item["width"], item["label"]), []).append(item)
                for (width, label), items in packs.items():
                    for (other_width, other_label), found in zones.items():
                        if width == other_width and (label == other_label) == same_label:
                            for start in range(0, len(items), 512):
                                yield from reads(items[start : start + 512], found, width)

    def reads(items: list[dict], zones: list[dict], width: int):
        vectors = np.stack([np.frombuffer(item["vector"], "<i4") for item in items])
        wide = max(len(item["windows"]) for item in items)
        windows = np.array([item["windows"] + [1, 0] * ((wide - len(item["windows"])) // 2) for item in items], "<i8").reshape(len(items), -1, 2)
        low, high = (np.stack([np.frombuffer(zone[side], "<i4") for zone in zones]).reshape(len(zones), width) for side in ("low", "high"))
        least, most = bounds(vectors, low, high)
        meets = np.zeros(least.shape, bool)
        for j in range(windows.shape[1]):
            meets |= (most >= windows[:, j, :1]) & (least <= windows[:, j, 1:])
        anchors = np.array([item["anchor"] for item in items], "<i8")
        for column in np.nonzero(meets.any(axis=0))[0]:
            at = np.nonzero(meets[:, column])[0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([zones[column]["block"]], pa.int64()), pa.array([anchors[at].tobytes()], pa.binary()),
                    pa.array([vectors[at].tobytes()], pa.binary()), pa.array([windows[at].tobytes()], pa.binary()),
                ],
                names=["block", "asking", "vectors", "asked"],
            )

    return choose


def _found(k: int):
    """The first ``k`` rows of a block in each window of each anchor that reads it."""

    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                anchors = np.frombuffer(row["asking"], "<i8")
                windows = np.frombuffer(row["asked"], "<i8").reshape(len(anchors), -1, 2)
                scores = products(_matrix(row["vectors"], len(anchors), row["width"]), _matrix(row["rows"], row["n"], row["width"]))
                own = anchors - (row["block"] << POSITIONS)
                inside = np.nonzero((own >= 0) & (own < row["n"]))[0]
                scores[inside, own[inside]] = LEAST
                ids = np.array(row["ids"], dtype=object)
                for j in range(windows.shape[1]):
                    low, high = windows[:, j, :1], windows[:, j, 1:]
                    met = (scores >= low) & (scores <= high) & (scores > LEAST)
                    some = np.nonzero(met.any(axis=1))[0]
                    if not len(some):
                        continue
                    falling = np.where(met[some], -scores[some], MOST)
                    first = np.argsort(falling, axis=1, kind="stable")[:, :k]  # rows lie by id, so ties go to the smaller
                    at, rank = np.nonzero(np.take_along_axis(met[some], first, axis=1))
                    place = first[at, rank]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(anchors[some][at]), pa.array(windows[some][at, j, 1]), pa.array(scores[some][at, place]),
                            pa.array(ids[place].tolist(), pa.int64()),
                        ],
                        names=["anchor", "window", "score", "vec_id"],
                    )

    return search


def _first_in_windows(items: DataFrame, blocks: DataFrame, k: int, same_label: bool, pack_rows: int) -> DataFrame:
    """``anchor, window, score, vec_id, rank``: the first ``k`` rows in each window of scores of ``items``."""
    packs, chunks = (max(1, -(-frame.count() // pack_rows)) for frame in (items, blocks))
    packed = items.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(packs)).alias("pack")).agg(
        F.collect_list(F.struct("anchor", "width", "label", "vector", "windows")).alias("items")
    )
    zones = blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(chunks)).alias("chunk")).agg(
        F.collect_list(F.struct("block", "width", "label", "low", "high")).alias("zones")
    )
    met = packed.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))).join(zones, "chunk")
    reads = met.select("items", "zones").mapInArrow(_needed(same_label), "block long NOT NULL, asking binary, vectors binary, asked binary")
    read = reads.join(blocks.select("block", "width", "n", "rows", "ids"), "block")
    found = read.mapInArrow(_found(k), "anchor long, window long, score long, vec_id long")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mined(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, least_percent: int = 80, block_rows: int = 256,
    pack_rows: int = 2048,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors of ``vectors(vec_id, vector, label)``.

    A score is the inner product with the anchor of components ``floor(256 * x)``; higher scores come first, ties by smaller
    id, null ids last. An anchor's positives are its first ``positives`` other rows of its label. Its hard negatives for a
    positive are the first ``negatives`` rows of other labels with a score from ``least_percent`` of 100 of the positive's
    up to all of it. Rows with a null label, a null vector, or a null or non-finite component take no part, nor do rows
    whose squared length is 2 ** 60 or more, as scores would not fit. Vectors with another number of components than the
    anchor's have no product with it. Repeated rows are rows of their own; a null id is no anchor. An empty table gives none.

    Anchors meet zone maps in packs and chunks of about ``pack_rows``, and blocks in joins, so no task holds more than a
    pack, a chunk or a block; all windows of an anchor are found in one pass over the blocks its bounds choose.
    """
    blocks = blocks_of(quantised(vectors, anchors), block_rows)
    with_anchors = blocks.where("anchors > 0").select("block", "width", "label", "n", "rows", "ids", "is_anchor")
    items = stored(with_anchors.mapInArrow(_anchors(positives), "anchor long, anchor_id long, width int, label long, vector binary, windows array<long>"), "anchors")
    best = stored(_first_in_windows(items, blocks, positives, True, pack_rows), "positives").select(
        "anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("positive_rank")
    )
    lowest = F.expr(f"(positive_score * {least_percent} + 99) div 100")
    ranges = best.where("positive_score >= 0").groupBy("anchor").agg(
        F.flatten(F.collect_set(F.array(lowest, F.col("positive_score")))).alias("windows")
    )
    asking = items.drop("windows").join(ranges, "anchor")
    hard = _first_in_windows(asking, blocks, negatives, False, pack_rows).select(
        "anchor", F.col("window").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return best.join(hard, ["anchor", "positive_score"]).join(items.select("anchor", "anchor_id"), "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


ORACLE = """
WITH usable AS (
    SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS whole
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.row AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same_label, b.row, b.vec_id,
        CAST(list_inner_product(a.whole, b.whole) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.row <> b.row AND len(a.whole) = len(b.whole)
    WHERE a.vec_id % 100 = 0),
positive AS (
    SELECT * FROM scored WHERE same_label
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
    n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor = p.anchor AND NOT n.same_label AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""
