import os

import numpy as np
import pytest
from helpers import documents, labels

from docklake.llm import queries, toxicity
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"


def _corpus(spark):
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    docs, marks = [], []
    for i in range(600):
        own = rng.choice(words, 40).tolist()
        if i % 5 == 0:
            own[3:3], own[20:20] = ["nasty"], ["vile"]
        docs.append((i, " ".join(own)))
        marks.append((i, 1, int(i % 5 == 0)))
    return spark.createDataFrame(docs, "doc_id long, text string"), labels(spark, marks)


def test_toxic_texts_are_told_apart_on_unseen_ids(spark):
    docs, marks = _corpus(spark)
    model = toxicity.trained_on(docs, marks, "toxic", F.col("doc_id") < 400)
    rows = docs.where("doc_id >= 400").select("doc_id", toxicity.score(model).alias("s")).collect()
    assert np.mean([(row.s >= 0.7) == (row.doc_id % 5 == 0) for row in rows]) > 0.97
    assert model.evidence("NASTY, vile!")[0] > model.evidence("waa wba")[0]
    assert np.isclose(model.stem.sum(axis=1), 1.0).all()


def test_odd_rows_get_scores(spark):
    docs = documents(spark)
    model = toxicity.trained_on(docs, labels(spark, [(1, 1, 1), (7, 0, 0), (None, 1, 0), (3, 0, None)]), "toxic", F.lit(True))
    rows = docs.select(toxicity.score(model).alias("s")).collect()
    assert len(rows) == docs.count() and all(0 <= row.s <= 1 for row in rows)
    untaught = toxicity.trained_on(docs.limit(0), labels(spark), "toxic", F.lit(True))
    assert {row.s for row in docs.select(toxicity.score(untaught).alias("s")).collect()} == {0.5}


def test_a_score_holds_no_arrow_batch_of_texts(spark, capsys):
    docs, marks = _corpus(spark)
    model = toxicity.trained_on(docs, marks, "toxic", F.col("doc_id") < 400)
    scored = docs.select("text", toxicity.score(model).alias("s"))
    scored.explain()
    assert "ArrowEvalPython" not in capsys.readouterr().out
    assert all(np.isclose(row.s, model.probabilities(np.array([model.evidence(row.text)]))[0]) for row in scored.collect())


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver tables are not here")
def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/labels.parquet")
    rows = queries.op9_toxicity(spark, SF).join(truth, "doc_id").where("held_out").collect()
    assert np.mean([row.predicted == row.toxic for row in rows]) > 0.97
    assert np.mean([row.predicted for row in rows if not row.toxic]) < 0.02
