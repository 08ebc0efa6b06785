import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import documents

from docklake.llm import fill_middle as fm
from docklake.llm.wavelet import WaveletMatrix

TOKENS = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
LINES = re.compile("[^\n]*\n|[^\n]+")


def test_ranks_and_selections_by_counting():
    rng = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 500):
        symbols = rng.integers(0, 8, size).astype(np.uint8)
        matrix, at = WaveletMatrix(symbols, 3), np.arange(size + 1)
        for symbol in range(8):
            assert matrix.rank(symbol, at).tolist() == [int((symbols[:i] == symbol).sum()) for i in at]
        joint = np.array([int(np.isin(symbols[:i], (1, 6)).sum()) for i in at])
        assert matrix.joint_rank((1, 6), at).tolist() == joint.tolist()
        wished = np.arange(joint[-1] + 1)
        found = matrix.joint_select((1, 6), wished, np.zeros_like(wished), np.full_like(wished, size))
        assert found.tolist() == [int(np.nonzero(joint >= k)[0][0]) for k in wished]


@pytest.mark.parametrize("boundary, units", [("token", TOKENS), ("line", LINES)])
def test_cuts_by_splitting(boundary, units):
    random.seed(2)
    texts = ["", " ", "a", "a ", " a\n", "\n\n", "日本 é\x0b😀\x85x　y z", "a b " * 3000]
    texts += ["".join(random.choices("ab \n\t\x1c😀", k=random.randint(0, 40))) for _ in range(300)]
    draws = np.random.default_rng(3).integers(0, 1 << 32, (len(texts), 2))
    cuts = fm.cut(texts, draws, boundary)
    for row, text in enumerate(texts):
        parts = units.findall(text)
        first, second = sorted(int(d) % (len(parts) + 1) for d in draws[row])
        assert cuts.units[row] == len(parts)
        assert (cuts.first[row], cuts.second[row]) == (len("".join(parts[:first])), len("".join(parts[:second])))


def test_restored_texts_equal_the_given(spark):
    docs = documents(spark).unionByName(documents(spark, [(100 + i, f"< P{i}> <S <\nM> " * (i % 9), None, None) for i in range(200)]))
    docs = docs.unionByName(documents(spark, [(7, "has <S> in it", None, None), (9, "ends in <", None, 1.0)])).withColumnRenamed("component_id", "form")
    done = fm.transformed(docs, rate=100)
    assert done.count() == docs.count() and {"form", "form_"} <= set(done.columns)
    found = done.select("doc_id", "text", "form", "output", "restored", "units", "prefix_chars", "middle_chars").collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter((r.doc_id, r.text) for r in docs.collect())
    for row in found:
        text = row.text or ""
        assert row.restored == text and row.units == len(TOKENS.findall(text))
        if not text or "<S>" in text:
            assert row.form == "plain" and row.output == text and row.prefix_chars is None
        else:
            assert row.form in ("spm", "psm") and len(row.output) == len(text) + 9
            assert row.output.endswith(fm.MIDDLE + text[row.prefix_chars : row.prefix_chars + row.middle_chars])
    assert fm.transformed(docs.limit(0)).collect() == []
    assert {r.form for r in fm.transformed(docs, rate=0).collect()} == {"plain"}


def test_markers_that_a_cut_could_make():
    for text in ("<P", "<<", "S><M", "<M", "P><"):
        for first in range(len(text) + 1):
            for second in range(first, len(text) + 1):
                for form in ("psm", "spm", "plain"):
                    assert fm.restored(fm.rendered(text, form, first, second), form) == text
