import os

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, labels

from docklake.llm import boosting, common, quality, queries
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def _slow_score(trees, row):
    total = trees.base
    for root in trees.roots:
        node = root
        while trees.left[node] != node:
            node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
        total += trees.value[node]
    return 1 / (1 + np.exp(-total))


def test_trees_learn_an_interaction_and_flat_arrays_agree_with_walking_them():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    trees = boosting.trained(x, y, rounds=40, depth=3)
    fresh = rng.normal(size=(500, 3))
    scores = trees.scores(fresh)
    assert ((scores >= 0.5) == ((fresh[:, 0] > 0) ^ (fresh[:, 1] > 0))).mean() > 0.95
    assert np.allclose(scores[:50], [_slow_score(trees, row) for row in fresh[:50]])


def test_nothing_to_learn_from():
    none = boosting.trained(np.zeros((0, 2)), np.zeros(0))
    assert np.allclose(none.scores(np.zeros((3, 2))), 0.5)
    constant = boosting.trained(np.ones((50, 2)), np.r_[np.ones(40), np.zeros(10)])
    assert np.allclose(constant.scores(np.ones((1, 2))), 0.8, atol=0.03)


def test_statistics_of_texts_without_words():
    assert quality.statistics(b"") == quality.statistics(b" \n\t") == [0.0] * len(quality.STATISTICS)


def test_odd_rows_get_scores(spark):
    docs = documents(spark)
    model = quality.trained_on(docs, labels(spark, [(1, 1, 0), (7, 0, 0), (None, 1, 0), (3, None, 0), (99, 1, 1)]), "quality", F.lit(True))
    rows = docs.select("doc_id", quality.score(model).alias("s")).collect()
    assert len(rows) == docs.count() and all(0 <= row.s <= 1 for row in rows)
    untaught = quality.trained_on(docs.limit(0), labels(spark), "quality", F.lit(True))
    assert {row.s for row in docs.select(quality.score(untaught).alias("s")).collect()} == {0.5}
    assert docs.limit(0).select(quality.score(model)).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver tables are not here")
def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/labels.parquet")
    rows = queries.op1_quality(spark, SF).join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([row.predicted == row.quality for row in rows]) > 0.97


def test_statistics_hold_few_texts_twice(monkeypatch):
    texts, sizes = pa.array(["a b", None, ""] * 300), []
    monkeypatch.setattr(quality, "utf8", lambda part: sizes.append(len(part)) or common.utf8(part))
    assert quality._features(texts).tolist() == [quality.statistics(text) for text in common.utf8(texts)]
    assert max(sizes) <= 256 and quality._features(texts.slice(0, 0)).shape == (0, len(quality.STATISTICS))


def test_a_score_holds_no_arrow_batch_of_texts(spark, capsys):
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 9, 40 if i % 2 else 5)) for i in range(80)] + ["é!", "", None]
    features = np.array([quality.statistics((text or "").encode()) for text in texts])
    model = boosting.trained(features, np.arange(len(texts)) % 2.0, smallest_leaf=2)
    scored = spark.createDataFrame(list(enumerate(texts)), "n int, text string").select("n", quality.score(model).alias("s"))
    scored.explain()
    assert "ArrowEvalPython" not in capsys.readouterr().out
    assert np.allclose([row.s for row in scored.orderBy("n").collect()], model.scores(features), atol=1e-12)
