import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docklake.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, vector array<float>, score double, rank int, block string"


def _brute(rows, positives=5, negatives=5):
    usable = [
        (i, label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, label, v in rows
        if label is not None and v is not None and None not in v and np.isfinite(v).all()
    ]
    usable = [row for row in usable if sum(x * x for x in row[2]) < 1 << 60]
    order = lambda pair: (-pair[1], pair[0][0] is None, pair[0][0] or 0)
    out = Counter()
    for own in usable:
        if own[0] is None or own[0] % 100:
            continue
        scored = sorted(((r, sum(map(int.__mul__, own[2], r[2]))) for r in usable if r is not own and len(r[2]) == len(own[2])), key=order)
        for row, p in [pair for pair in scored if pair[0][1] == own[1]][:positives]:
            hits = [(r, s) for r, s in scored if r[1] != own[1] and 80 * p <= 100 * s <= 100 * p][:negatives]
            out.update((own[0], row[0], rank, r[0], p, s) for rank, (r, s) in enumerate(hits, 1))
    return out


def _mined(spark, rows, **options):
    frame = spark.createDataFrame([(i, label, v, 0.0, 0, "") for i, label, v in rows], SCHEMA)
    return Counter(map(tuple, hn.mined(frame, F.col("vec_id") % 100 == 0, **options).collect()))


@pytest.mark.parametrize("components, bits", [(2, 3), (3, 2), (4, 2), (2, 5)])
def test_the_curve_visits_every_cell_in_steps_of_one(components, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * components, indexing="ij"), -1).reshape(-1, components)
    places = hn.hilbert(cells, bits)
    assert sorted(places) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_product():
    rng = np.random.default_rng(3)
    a, rows = rng.integers(-50, 50, (20, 6)), rng.integers(-50, 50, (30, 6))
    least, most = hn.bounds(a, rows.min(axis=0)[None], rows.max(axis=0)[None])
    exact = a @ rows.T
    assert (least[:, 0] <= exact.min(axis=1)).all() and (most[:, 0] >= exact.max(axis=1)).all()


def test_products_beyond_doubles_stay_exact():
    a = np.array([[(1 << 29) - 1, 3], [-(1 << 29), 1]])
    assert hn.products(a, a).tolist() == [[sum(x * y for x, y in zip(r, s)) for s in a.tolist()] for r in a.tolist()]


@pytest.mark.parametrize("options", [{}, {"block_rows": 7, "pack_rows": 3}])
def test_mined_rows_equal_brute_force(spark, options):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 5))
    rows = [(i * 25, int(rng.integers(0, 3)), (0.1 * (centres[i % 8] + 0.4 * rng.normal(size=5))).astype(np.float32).tolist()) for i in range(240)]
    rows += [(5000 + i, 1, rows[0][2]) for i in range(60)]  # many copies of one vector
    want = _brute(rows)
    assert len(want) > 50
    assert _mined(spark, rows, **options) == want


def test_odd_rows(spark):
    v = [0.5, -0.25]
    rows = [(100, 1, v), (100, 1, v), (200, 2, v), (300, None, v), (400, 1, None), (500, 1, [None, 1.0]), (600, 1, [float("nan"), 1.0]),
            (700, 1, [float("inf"), 0.0]), (800, 1, [1e30, 0.0]), (900, 3, []), (1000, 3, []), (1100, 4, []), (None, 2, v), (1, 1, [0.4, -0.2]), (2, 2, [0.45, -0.2]),
            (3, 2, [0.4, -0.2]), (1200, 5, [0.0, 0.0]), (4, 5, [1.0, 1.0]), (1300, 6, [1.0, 2.0, 3.0]), (1400, 6, [-1.0, -2.0, -3.0]), (5, 7, [900.0, 2.0])]
    want = _brute(rows)
    assert want[(100, 100, 1, 200, _score(v, v), _score(v, v))] == 2  # repeated rows are rows of their own
    assert _mined(spark, rows) == want
    assert _mined(spark, rows[2:3]) == Counter() == _mined(spark, [])


def _score(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=True))


def test_far_blocks_are_not_read(spark):
    rng = np.random.default_rng(5)
    rows = [(i, 0 if i % 2 else 1, [(1.0 if i < 300 else -1.0) + 0.01 * float(x) for x in rng.normal(size=2)]) for i in range(600)]
    frame = spark.createDataFrame([(i, label, v, 0.0, 0, "") for i, label, v in rows], SCHEMA)
    blocks = hn.blocks_of(hn.quantised(frame, F.col("vec_id") == 0), 32)
    items = blocks.where("anchors > 0").select("block", "width", "label", "n", "rows", "ids", "is_anchor").mapInArrow(
        hn._anchors(5), "anchor long, anchor_id long, width int, label long, vector binary, windows array<long>"
    ).withColumn("windows", F.expr("array(1L, 1000000L)"))
    zones = blocks.groupBy().agg(F.collect_list(F.struct("block", "width", "label", "low", "high")).alias("zones"))
    met = items.groupBy().agg(F.collect_list(F.struct("anchor", "width", "label", "vector", "windows")).alias("items")).join(zones)
    reads = met.select("items", "zones").mapInArrow(hn._needed(False), "block long, asking binary, vectors binary, asked binary").count()
    assert 0 < reads <= 6 < blocks.where("label = 0").count()
