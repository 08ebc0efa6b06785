import numpy as np
import pytest

from docklake.llm import neighbours
from pyspark.sql import functions as F

SCHEMA = "vec_id long, vector array<float>, rank int"


def _exact(rows, k):
    usable = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    want = set()
    for at, (q, own) in enumerate(usable):
        if q % 20 == 0:
            scored = sorted((-float((own * v).sum()), i) for other, (i, v) in enumerate(usable) if other != at)[:k]
            want |= {(q, rank, i) for rank, (_, i) in enumerate(scored, 1)}
    return want


def _found(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return {(r.query_id, r.rank, r.vec_id) for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0, **options).collect()}


def test_odd_vectors_ties_and_few_rows(spark):
    rows = [(20, [1.0, 0.0]), (1, [0.5, 0.5]), (3, [0.5, 0.5]), (2, [0.5, 0.5]), (40, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]),
            (7, [float("inf"), 1.0]), (8, [None, 1.0]), (9, []), (None, [1.0, 1.0]), (10, [1.0, 2.0, 3.0]), (3, [0.5, 0.5]), (60, [-1.0, -1.0])]
    assert _found(spark, rows, k=20) == _exact([r for r in rows if r[0] != 10], 20)
    assert _found(spark, []) == set()


def test_rows_of_one_id_are_all_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [9.0, 0.0]), (2, [0.2, 0.0]), (0, [2.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0).collect())
    want = [(0, rank, i, x * y) for y, others in ((1.0, [(1, 9.0), (0, 2.0), (1, 0.5), (2, 0.2)]), (2.0, [(1, 9.0), (0, 1.0), (1, 0.5), (2, 0.2)]))
            for rank, (i, x) in enumerate(others, 1)]
    assert [f[:3] for f in found] == sorted(w[:3] for w in want)
    assert np.allclose(sorted(f[3] for f in found), sorted(w[3] for w in want))


def test_blocks_and_parts_give_what_one_search_gives(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(700)] + [(1000 + i, [1.0] * 6) for i in range(300)]
    want = _exact(rows, 7)
    assert _found(spark, rows, k=7, block_rows=40) == want
    assert _found(spark, rows, k=7, part_rows=200, block_rows=60, confidence=2.0) == want  # all parts are probed


def test_parts_are_balanced_and_recall_holds(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 4000)] + 0.4 * rng.normal(size=(4000, 16))).astype(np.float32)
    part = neighbours.balanced_parts(neighbours.neighbour_graph(x.astype(float), 10), 3)
    assert np.ptp(np.bincount(part, minlength=8)) <= 8
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found, want = _found(spark, rows, k=10, part_rows=500), _exact(rows, 10)
    near = lambda triples: {(q, i) for q, _, i in triples}
    assert len(found) == len(want) and len(near(found) & near(want)) / len(want) >= 0.9


@pytest.mark.parametrize("levels", [0, 2])
def test_probabilities_sum_to_one(levels):
    x = np.random.default_rng(1).normal(size=(200, 4))
    assert np.allclose(neighbours.fitted(x, levels).probabilities(x).sum(axis=1), 1.0)
