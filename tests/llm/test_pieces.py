import itertools
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import documents

from docklake.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(PATH)


def _paths(model, text):
    """All segmentations of a text of known pieces, with their probabilities."""
    if not text:
        return {(): 1.0}
    found = {}
    for end in range(1, len(text) + 1):
        if text[:end] in model.known:
            number, log_p = model.known[text[:end]]
            found |= {(number, *rest): math.exp(log_p) * p for rest, p in _paths(model, text[end:]).items()}
    return found


def test_samples_follow_the_law_of_drawing_without_replacement(model):
    weight = _paths(model, "▁then")
    total = sum(weight.values())
    p = {path: w / total for path, w in weight.items()}
    n = 12_000
    seeds = np.random.default_rng(1).integers(0, 2**63, n).astype(np.uint64)
    drawn = [[(tuple(ids.tolist()), lp, li) for ids, lp, li in own] for s in range(0, n, 500) for own in pieces.sampled(model, ["then"] * 500, seeds[s : s + 500], 2)]
    first, both = Counter(own[0][0] for own in drawn), Counter((own[0][0], own[1][0]) for own in drawn)
    assert all(abs(first[a] / n - q) < 0.015 for a, q in p.items())
    assert all(abs(both[a, b] / n - p[a] * p[b] / (1 - p[a])) < 0.015 for a, b in itertools.permutations(p, 2))
    assert all(len({ids for ids, _, _ in own}) == 2 and abs(lp - math.log(p[ids])) < 1e-9 for own in drawn for ids, lp, _ in own)
    estimate = np.mean([sum(math.exp(lp - li) * len(ids) for ids, lp, li in own) for own in drawn])
    assert abs(estimate - sum(q * len(a) for a, q in p.items())) < 0.02


def test_all_segmentations_of_a_short_text(model):
    weight = _paths(model, "▁in")
    own = pieces.sampled(model, ["in"], np.array([3], np.uint64), 50)[0]
    assert {tuple(ids.tolist()) for ids, _, _ in own} == set(weight) and all(li == 0.0 for _, _, li in own)
    assert math.isclose(sum(math.exp(lp) for _, lp, _ in own), 1.0)


@pytest.mark.parametrize("text", ["Hello wörld  ﬁ 日本 x\n\n  y²., ", "", " ", "😀é\x00", "x" * 3000, "a\tb " * 200])
def test_every_sample_decodes_to_the_text(model, text):
    for ids, _, _ in pieces.sampled(model, [text], np.array([9], np.uint64), 3)[0]:
        assert model.decoded(ids.tolist()) == text


def test_words_forgotten_change_nothing(model, monkeypatch):
    texts = ["some words here", "and other words there", "some words here"]
    seeds = np.array([4, 5, 4], np.uint64)
    want = pieces.sampled(model, texts, seeds, 2)
    monkeypatch.setattr(pieces, "KEPT_NODES", 20)
    small = pieces.Pieces(PATH)
    for _ in range(2):
        for a, b in zip(pieces.sampled(small, texts, seeds, 2), want, strict=True):
            assert [(x[0].tolist(), x[1]) for x in a] == [(x[0].tolist(), x[1]) for x in b]


def test_odd_rows(spark):
    docs = documents(spark)
    found = pieces.segmentations(docs, PATH, k=2)
    rows = found.withColumn("back", pieces.decoded(found["ids"], PATH)).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert all(r.back == texts[r.doc_id] and r.n_pieces == len(r.ids) for r in rows)
    assert Counter(r.doc_id for r in rows) == {1: 4, 2: 1, 3: 1, None: 2, 4: 2, 5: 2, 6: 2, 7: 2}
    assert pieces.segmentations(docs.limit(0), PATH).collect() == []


def test_the_query_gives_the_ids_and_decodes_them(spark, model, tmp_path):
    docs = documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op5_pieces(spark, str(tmp_path)).collect()
    texts = {(r.doc_id, r.text or "") for r in docs.collect()}
    assert len(found) == 16 and all(r.decoded_equal and len(r.ids) == r.n_pieces for r in found)
    assert {(r.doc_id, model.decoded(r.ids)) for r in found} == texts
    assert len({(r.doc_id, r.sample, tuple(r.ids)) for r in found if r.doc_id in (4, 5, 6, 7)}) == 8


def test_edges_by_node_and_probability():
    rng = np.random.default_rng(5)
    start, log_p = rng.integers(0, 300, 5000), -rng.random(5000).round(2) + 1e-12 * rng.integers(0, 3, 5000)
    assert pieces._by_node(start, log_p).tolist() == np.lexsort((-log_p, start)).tolist()


def test_a_wrong_segmentation_does_not_give_the_text(model):
    texts = ["Hello wörld  ﬁ 日本 x\n\n  y²., ", "", "😀é\x00", "Hello wörld", "a \u2581 b"]
    own = [pieces.sampled(model, [text], np.array([9], np.uint64), 1)[0][0][0].astype(np.int32) for text in texts]
    own[3] = own[3][:-1]
    last = np.cumsum([len(ids) for ids in own])
    want = [model.decoded(ids.tolist()) == text for ids, text in zip(own, texts, strict=True)]
    assert model.give(np.concatenate(own), last, texts) == want == [True, True, True, False, False]


def test_chunks_by_listed_characters():
    texts = ["", " ", "a  b1_c²  ½x. ,é日本 \n\t y ", "a😀b 𝒜c 1 ", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))]
    assert [pieces._chunks(text) for text in texts] == [pieces.CHUNK.findall(" " + text) if text else [] for text in texts]
    assert pieces._chunks(texts[4]) == pieces.NEAR_CHUNK.findall(" " + texts[4])
