"""Approximate nearest neighbours by learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts. A small network learns which part a vector's neighbours
lie in; it puts every vector into its most probable part and sends a query to several probable ones, where exact inner
products decide.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from docklake.llm.common import stored


def neighbour_graph(vectors: np.ndarray, degree: int) -> np.ndarray:
    """The ``degree`` rows of largest inner product with each row, itself left out."""
    found = np.empty((len(vectors), degree), dtype=np.int64)
    for start in range(0, len(vectors), 512):
        near = vectors[start : start + 512] @ vectors.T
        near[np.arange(len(near)), np.arange(start, start + len(near))] = -np.inf
        found[start : start + 512] = np.argpartition(-near, degree - 1, axis=1)[:, :degree]
    return found


def _halves(nodes: np.ndarray, graph: np.ndarray, seed: int) -> np.ndarray:
    """Which of ``nodes`` go to the second half: near equal halves with few graph edges between them."""
    place = np.full(len(graph), -1)
    place[nodes] = np.arange(len(nodes))
    a = np.repeat(np.arange(len(nodes)), graph.shape[1])
    b = place[graph[nodes].ravel()]
    a, b = a[b >= 0], b[b >= 0]
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    n = len(nodes)
    root = 1.0 / np.sqrt(np.bincount(a, minlength=n) + 1.0)
    weight = root[a] * root[b]
    first = 1.0 / root / np.linalg.norm(1.0 / root)
    x = np.random.default_rng(seed).normal(size=n)
    for _ in range(60):  # second eigenvector of the normalised graph
        x = x + root * root * x + np.bincount(a, weight * x[b], n)
        x -= first * (first @ x)
        x /= np.linalg.norm(x) + 1e-30
    side = np.zeros(n, dtype=np.int64)
    side[np.argsort(x * root, kind="stable")[n // 2 :]] = 1
    for _ in range(10):  # swap pairs while that removes cut edges
        other = np.bincount(a, (side[a] != side[b]).astype(float), n)
        gain = 2 * other - np.bincount(a, minlength=n)
        low, high = (np.nonzero(side == s)[0] for s in (0, 1))
        low, high = low[np.argsort(-gain[low], kind="stable")], high[np.argsort(-gain[high], kind="stable")]
        pairs = min(len(low), len(high))
        good = np.nonzero(gain[low[:pairs]] + gain[high[:pairs]] <= 0)[0]
        swaps = min(good[0] if len(good) else pairs, max(n // 50, 1))
        if not swaps:
            break
        trial = side.copy()
        trial[low[:swaps]], trial[high[:swaps]] = 1, 0
        if (trial[a] != trial[b]).sum() >= (side[a] != side[b]).sum():
            break
        side = trial
    return side


def balanced_parts(graph: np.ndarray, levels: int) -> np.ndarray:
    """The part of each node: ``2 ** levels`` parts of near equal size, by repeated halving."""
    part = np.zeros(len(graph), dtype=np.int64)
    for level in range(levels):
        halved = part * 2
        for p in range(2**level):
            nodes = np.nonzero(part == p)[0]
            if len(nodes) > 1:
                halved[nodes] += _halves(nodes, graph, p)
        part = halved
    return part


@dataclass(frozen=True)
class Router:
    """A network with one hidden layer: how probable each part is for a vector."""

    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    scale: float

    @property
    def parts(self) -> int:
        return len(self.out_bias)

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        raw = np.maximum(vectors * self.scale @ self.hidden + self.hidden_bias, 0.0) @ self.out + self.out_bias
        raw = np.exp(raw - raw.max(axis=1, keepdims=True))
        return raw / raw.sum(axis=1, keepdims=True)


def trained_router(vectors: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 40, rate: float = 3e-3) -> Router:
    """Fitted by Adam to ``target``, the share of each part among a vector and its neighbours."""
    rng = np.random.default_rng(7)
    scale = 1.0 / (np.sqrt((vectors**2).mean()) + 1e-30) if vectors.size else 1.0
    x = vectors * scale
    width, parts = vectors.shape[1], target.shape[1]
    values = [rng.normal(size=(width, hidden)) * np.sqrt(2 / width), np.zeros(hidden), rng.normal(size=(hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts)]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    step = 0
    for epoch in range(epochs if parts > 1 else 0):
        order = rng.permutation(len(x))
        for start in range(0, len(x), 256):
            rows = order[start : start + 256]
            before = x[rows] @ values[0] + values[1]
            active = np.maximum(before, 0.0)
            raw = active @ values[2] + values[3]
            p = np.exp(raw - raw.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            slope = (p - target[rows]) / len(rows)
            back = (slope @ values[2].T) * (before > 0)
            gradients = [x[rows].T @ back, back.sum(0), active.T @ slope, slope.sum(0)]
            step += 1
            now = rate * (1.0 - epoch / epochs)
            for v, g, (m, s) in zip(values, gradients, moments, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= now * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Router(*values, scale)


def fitted(sample: np.ndarray, levels: int, degree: int = 10) -> Router:
    """The router of ``2 ** levels`` parts learned from a sample."""
    parts = 2**levels
    if parts == 1:
        return trained_router(sample, np.ones((len(sample), 1)))
    graph = neighbour_graph(sample, min(degree, len(sample) - 1))
    part = balanced_parts(graph, levels)
    target = np.zeros((len(sample), parts))
    for column in (np.arange(len(sample)), *graph.T):
        target[np.arange(len(sample)), part[column]] += 1.0
    return trained_router(sample, target / target.sum(axis=1, keepdims=True))


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    return pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _routed(router: Router, width: int, chosen: Callable[[np.ndarray], list]):
    @F.arrow_udf(ArrayType(IntegerType()))
    def routed(vectors: pa.Array) -> pa.Array:
        return pa.array(chosen(router.probabilities(_matrix(vectors, width))), pa.list_(pa.int32()))

    return routed


def _probes(sizes: dict[int, int], enough: int, confidence: float, fewest: int):
    """Parts in descending probability: to a joint ``confidence``, ``fewest`` of them, and ``enough`` vectors in them."""

    def chosen(probabilities: np.ndarray) -> list:
        held = np.array([sizes.get(p, 0) for p in range(probabilities.shape[1])])
        order = np.argsort(-probabilities, axis=1, kind="stable")
        sure = np.take_along_axis(probabilities, order, axis=1).cumsum(axis=1)
        seen = held[order].cumsum(axis=1)
        done = (sure >= confidence) & (seen >= enough) & (np.arange(order.shape[1]) >= fewest - 1)
        last = np.where(done.any(axis=1), done.argmax(axis=1), order.shape[1] - 1)
        return [row[: n + 1].astype(np.int32) for row, n in zip(order, last, strict=True)]

    return chosen


def _best_of(k: int):
    """Per group the ``k`` best candidates of each query, by products summed in the order of the components."""

    def best(_key, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(queries) and len(candidates):
            candidates = candidates.sort_values(["vec_id", "row"], kind="stable")
            ids, rows = candidates["vec_id"].to_numpy(), candidates["row"].to_numpy()
            c = np.stack(candidates["vector"].to_numpy()).astype(np.float64).T.copy()
            for start in range(0, len(queries), 128):
                part = queries.iloc[start : start + 128]
                own, own_rows = part["vec_id"].to_numpy(), part["row"].to_numpy()
                q = np.stack(part["vector"].to_numpy()).astype(np.float64)
                score = q[:, :1] * c[0]
                for d in range(1, len(c)):
                    score += q[:, d : d + 1] * c[d]
                score[own_rows[:, None] == rows[None, :]] = -np.inf
                n = min(k, len(ids))
                bound = np.partition(score, len(ids) - n, axis=1)[:, len(ids) - n]
                for row, (query, query_row) in enumerate(zip(own, own_rows, strict=True)):
                    at = np.nonzero((score[row] >= bound[row]) & (score[row] > -np.inf))[0]
                    at = at[np.argsort(-score[row][at], kind="stable")[:n]]
                    parts.append(pd.DataFrame({"query_row": query_row, "query_id": query, "vec_id": ids[at], "score": score[row][at]}))
        return pd.concat(parts) if parts else pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})

    return best


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, part_rows: int = 2048, most_levels: int = 6, sample_rows: int = 8192,
    confidence: float = 0.99, fewest_probes: int = 2, block_rows: int = 4096,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row of ``vectors(vec_id, vector)`` that ``queries`` holds for.

    Every row is indexed; the router is fitted on the ``sample_rows`` rows of smallest id hash. There are as many parts
    as make ``part_rows`` rows each, ``2 ** most_levels`` at most. Ties go to the smaller id. A query gets all
    candidates if there are ``k`` or fewer. Every row is a candidate of every other one, also rows of one id: only the
    query's own row is left out. Rows with an unusable vector, another number of components than most, or a null id take
    no part. An empty table gives none.

    A part is searched in blocks of ``block_rows`` candidates by as many queries, so that no task holds a whole part; a part
    with a third of all rows only has more blocks.
    """
    given = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).select("vec_id", "vector")
    widths = given.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = widths["width"] if widths else 1
    rows = stored(given.where(F.size("vector") == width).withColumn("row", F.monotonically_increasing_id()), "vectors")
    total = rows.count()
    levels = int(np.clip(np.floor(np.log2(max(total, 1) / part_rows)), 0, most_levels))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vector").collect()
    router = fitted(np.array([row["vector"] for row in sample], dtype=np.float64).reshape(-1, width), levels)

    first = _routed(router, width, lambda p: p.argmax(axis=1)[:, None].astype(np.int32).tolist())
    placed = stored(rows.select("row", "vec_id", "vector", first("vector")[0].alias("part")), "placed")
    sizes = {row["part"]: row["count"] for row in placed.groupBy("part").count().collect()}  # a row per part
    probes = _routed(router, width, _probes(sizes, k + 1, confidence, fewest_probes))
    asked = stored(rows.where(queries).select("row", "vec_id", "vector", F.explode(probes("vector")).alias("part")), "asked")
    asking = {row["part"]: row["count"] for row in asked.groupBy("part").count().collect()}

    def blocks(counts: dict[int, int]) -> Column:
        table = [x for part, n in counts.items() for x in (F.lit(part), F.lit(-(-n // block_rows)))]
        return F.coalesce(F.create_map(*table)[F.col("part")], F.lit(0)) if table else F.lit(0)

    def spread(frame: DataFrame, own: str, own_counts: dict, other: str, other_counts: dict) -> DataFrame:
        """Each row in one block of its side, once for each block of the other side."""
        return frame.withColumn(own, F.pmod(F.xxhash64("row"), blocks(own_counts)).cast("int")).withColumn(
            other, F.explode(F.filter(F.sequence(F.lit(0), blocks(other_counts)), lambda x: x < blocks(other_counts)))
        )

    keys = ("part", "block", "chunk")
    left = spread(asked, "chunk", asking, "block", sizes).groupBy(*keys)
    right = spread(placed, "block", sizes, "chunk", asking).groupBy(*keys)
    found = left.cogroup(right).applyInPandas(_best_of(k), "query_row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
