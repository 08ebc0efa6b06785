import pickle
import zlib
from collections import Counter
from dataclasses import fields

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents

from docklake.llm import language_model as lm
from docklake.llm.common import fold


def _slow_base(rows):
    words = [lm.words_of((text or "").encode()) + [lm.END] for _, text in rows]
    count = Counter(w for (i, _), own in zip(rows, words, strict=True) if i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for w in own)
    n, v = sum(count.values()), len(count)
    return n, [(len(own), sum(count[w] > 0 for w in own), sum(np.log10((count[w] + 1) / (n + v + 1)) for w in own)) for own in words]


@pytest.mark.parametrize("known", [1 << 17, 30])
def test_base_scores_by_counting(spark, known):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 40) % 500)) for i in range(80)]
    rows += [(r.doc_id, r.text) for r in documents(spark).collect()]
    found = lm.scored(spark.createDataFrame([(*r, "x", 0.0) for r in rows], "doc_id long, text string, word string, n double"), fold("doc_id", 7) != 2, known_words=known).collect()
    n, want = _slow_base(rows)
    key = lambda x: (str(x[0]), x[1], round(x[3], 6))
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in found), key=key)
    expected = sorted(((i, *w) for (i, _), w in zip(rows, want, strict=True)), key=key)
    assert [g[:3] for g in got] == [e[:3] for e in expected] and np.allclose([g[3] for g in got], [e[3] for e in expected])
    assert {r.train_tokens for r in found} == {n} and all(np.isfinite(r.score) and r.score < 0 for r in found)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in found)


def test_probabilities_sum_to_one_after_training(spark):
    rng = np.random.default_rng(3)
    docs = spark.createDataFrame([(i, " ".join(f"w{int(x)}" for x in rng.integers(0, 4000, 200))) for i in range(200)], "doc_id long, text string")
    model = lm.trained_on(docs, lm.word_counts(docs), known_words=3000, share=2, rounds=2)
    codes = np.arange(lm.BEFORE_FIRST)
    for before, skipped in ((lm.BEFORE_FIRST, lm.BEFORE_FIRST), (5, 2049), (2060, 17)):
        p = 10 ** model.log_probabilities(codes, np.full(len(codes), before), np.full(len(codes), skipped))
        assert abs(p.sum() - 1.0) < 1e-4
    assert np.any(model.by_class[1:])


def test_context_is_learned(spark):
    docs = spark.createDataFrame([(i, " ".join(["a b c d"] * 20) if i % 2 else " ".join(["c a d b"] * 20)) for i in range(400)], "doc_id long, text string")
    rows = lm.scored(docs, fold("doc_id", 7) != 2, share=4, rounds=4, batch_tokens=64).where("held_out").collect()
    assert sum(r.score for r in rows) > 0.8 * sum(r.base_score for r in rows)


def test_nothing_to_learn_from(spark):
    rows = lm.scored(documents(spark), fold("doc_id", 7) > 9).collect()
    assert {r.n_known for r in rows} == {0} and {r.train_tokens for r in rows} == {0} and len(rows) == documents(spark).count()
    assert lm.scored(documents(spark).limit(0), fold("doc_id", 7) != 2).collect() == []


def test_every_document_shapes_the_weights(spark):
    """Each text repeats a pair of its own words, which then must have raised the weights of their context."""
    docs = spark.createDataFrame([(i, f"a{i} b{i} " * 30) for i in range(60)], "doc_id long, text string")
    model = lm.trained_on(docs, lm.word_counts(docs))
    for i in range(60):
        code = {name: model.number[name.encode()] for name in (f"a{i}", f"b{i}")}
        for word, before in (code.values(), reversed(code.values())):
            log_p = model.log_probabilities(np.array([word]), np.array([before]), np.array([word]))[0]
            assert log_p > -1.8  # 1 of 121 words without a context, -2.08


def test_fewer_rounds_than_parts_are_refused(spark):
    docs = documents(spark)
    with pytest.raises(ValueError, match="leave out 26 of 32"):
        lm.trained_on(docs, lm.word_counts(docs), rounds=6, share=32)


def test_runs_are_summed():
    rng = np.random.default_rng(7)
    p, times = rng.normal(size=(50, 3)), np.array([1, 2, 8, 9, 30, 1, 5])
    at, starts = rng.integers(0, 50, times.sum()), np.concatenate([[0], times.cumsum()[:-1]])
    assert np.allclose(lm._summed(p, at, starts, times), np.add.reduceat(p[at], starts, axis=0))


def test_broadcast_values_need_no_package():
    """What tasks are sent is made of plain arrays, dicts and numbers."""
    model = lm.Model({b"": 0}, *(np.zeros(1) for _ in range(5)))
    sent = tuple(getattr(model, field.name) for field in fields(model))
    assert b"docklake" not in pickle.dumps(sent) and lm.Model(*pickle.loads(pickle.dumps(sent))).number == {b"": 0}


def _trained(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 60) % 3000)) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return rows, lm.trained_on(docs, lm.word_counts(docs), known_words=2500, rounds=1)


def test_scores_by_a_plain_softmax(spark):
    """Every probability anew from the weights, one token at a time; remembered normalisers don't change it."""
    rows, model = _trained(spark)
    seen = np.full(lm.CODES * lm.CODES, np.nan, np.float32)
    for _, text in rows[:10]:
        _, codes = model.encoded(lm.words_of(text.encode()))
        before, skipped = lm._context(codes)
        plain = []
        for code, b, s in zip(codes, before, skipped, strict=True):
            cls = int(lm.classes_of(np.array([code]))[0])
            logits = sum(model.by_class[row[0]].astype(float) for row in lm.class_rows(np.array([b]), np.array([s])))
            p = np.exp(logits[cls]) / np.exp(logits).sum()
            if code < lm.VOCABULARY:
                own = sum(model.by_word[row[0]].astype(float) for row in lm.word_rows(np.array([cls]), np.array([b]), np.array([s])))
                p *= np.exp(own[code % lm.CLASS_WORDS]) / np.exp(own).sum()
            plain.append(np.log10(p))
        assert np.allclose(model.log_probabilities(codes, before, skipped), plain, atol=1e-5)
        for _ in range(2):
            assert np.allclose(model.log_probabilities(codes, before, skipped, seen), plain, atol=1e-5)


def test_contexts_are_counted_whole(spark):
    """Triples of all texts against a plain count, and every one of them in a step, once."""
    rows, model = _trained(spark)
    want = Counter()
    for _, text in rows:
        codes = model.encoded(lm.words_of(text.encode()))[1]
        want.update(zip((int(x) for x in lm._context(codes)[0]), (int(x) for x in lm._context(codes)[1]), codes.tolist(), strict=True))

    class Held:
        value = tuple(getattr(model, field.name) for field in fields(model))

    texts = pa.RecordBatch.from_arrays([pa.array([text for _, text in rows])], names=["text"])
    batches = list(lm._triples(Held)([texts]))
    found = Counter()
    for context, code, n in lm._chunks(batches):
        for part, first, owner in lm._steps(context, 64):
            assert np.array_equal(context[first][owner], context[part]) and len(first) <= 64
            for c, word, times in zip(context[part].tolist(), code[part].tolist(), n[part].tolist(), strict=True):
                found[(*divmod(c, lm.CODES), word)] += times
    assert found == want


def test_a_step_follows_the_gradient():
    """One context, followed 6 times by 0 and 2 times by 2, against the formula."""
    table = lm.Table(np.zeros((4, 3), np.float32), np.zeros((4, 3), np.float32), np.zeros(4, np.float32))
    lm._descend(table, [np.array([1]), np.array([3])], np.array([0, 0]), np.array([0, 2]), np.array([6, 2]), 0.5, 1.0)
    expected, seen = np.full(3, 8 / 3), np.array([6.0, 0.0, 2.0])
    step = -0.5 * (expected - seen) / (np.maximum(expected, seen) + 1.0)
    assert np.allclose(table.weights[[1, 3]], step, atol=1e-6) and not table.weights[[0, 2]].any()
    assert table.touched.tolist() == [0, 8, 0, 8]
