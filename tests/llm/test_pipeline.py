import os
import sys

import pytest
from helpers import documents, labels

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as pipeline  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver tables are not here")
def test_every_decision_takes_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = [docs]
    for _, stage in pipeline.STAGES[:-1]:
        found = stage(spark, kept[-1], SF)
        kept.append(pipeline.stored(found, "test-stage"))
        assert kept[-1].schema.names == docs.schema.names
    ids = [{r.doc_id for r in frame.select("doc_id").collect()} for frame in kept]
    assert ids[0] > ids[1] > ids[2] > ids[3] and ids[3] == ids[4]
    wrong = [i for i in ids[0] & truth.keys() if (i in ids[1]) != bool(truth[i].quality)]
    assert len(wrong) <= 0.03 * len(truth)
    texts = [r.text for r in kept[3].select("text").collect()]
    assert len(set(texts)) == len(texts)
    packed = {r.doc_id for r in pipeline.STAGES[-1][1](spark, kept[4], SF).select("doc_id").distinct().collect()}
    assert packed == ids[4]


def test_odd_rows(spark, tmp_path):
    labels(spark, [(1, 1, 0), (4, 1, 0), (7, 0, 1)]).write.parquet(f"{tmp_path}/labels.parquet")
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    rows = pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} <= {1, 2, 3, 4, 5, 6, 7, None}
    documents(spark).limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    labels(spark).write.parquet(f"{tmp_path}/none/labels.parquet")
    assert pipeline.run(spark, f"{tmp_path}/none").collect() == []
