import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import DOCUMENTS, documents
from tokenizers import Tokenizer

from docklake.llm import chunked_bpe as bpe
from pyspark.sql import functions as F

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "the ", "'s", "'re", "'", "r", " ", "  ", "\n\n", "\t", "é", "日本", "　", "\xa0", "😀", "12", "!!", "<|endoftext|>", "<|endof", "text|>", "word "]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH)


def test_joined_chunks_are_exact(encoder):
    random.seed(5)
    for _ in range(600):
        text = "".join(random.choices(random.sample(PARTS, random.randint(1, len(PARTS))), k=random.choice([0, 1, 9, 60, 400])))
        encoder.known.clear()
        found = bpe.texts_coded(encoder, [text.encode()], random.choice([16, 128, 512]))[0]
        assert found.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_chunks_move_with_their_passage():
    random.seed(6)
    passage = " ".join(str(random.random()) for _ in range(400)).encode()
    gears = bpe._gears()
    alone, moved = ({k for k in bpe._chunked([text], 256, gears)[0][1]} for text in (passage, b"something before, " * 7 + passage + b" after"))
    assert len(alone & moved) >= len(alone) - 4
    together = bpe._chunked([b"x" * 100, passage], 256, gears)[1]
    assert set(together[1]) == alone and b"".join(together[2]) == passage


@pytest.mark.parametrize("text", [b"", b"a" * 5000, "日".encode() * 2000, b"\n" * 3000])
def test_cuts_cover_the_text(text):
    (ends,) = bpe.cuts([text], 128, bpe._gears())
    assert sorted(ends) == ends and (ends[-1] if ends else 0) == len(text)
    assert all(low < high <= low + 1024 for low, high in zip([0, *ends], ends, strict=False))
    assert b"".join(text[a:b].decode().encode() for a, b in zip([0, *ends], ends, strict=False)) == text


def test_documents_as_the_tokenizer_has_them(spark):
    random.seed(7)
    passages = [" ".join(random.choices(["alpha", "beta's", "日本", "12", "<|endoftext|>", "\n\n", "x"], k=300)) for _ in range(4)]
    rows = DOCUMENTS + [(50 + i, "".join(random.sample(passages, 3)) + str(i), "s", None) for i in range(30)] + [(99, "z" * 100_000, None, None)]
    docs = documents(spark, rows).repartition(3)
    coded = bpe.encoded(docs, PATH, average=128, block_bytes=8000, decode=True)
    found = coded.select("doc_id", "ids", "decoded", bpe.decoded(PATH, F.col("ids")).alias("back")).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter((r.doc_id, r.text or "", tuple(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    assert Counter((r.doc_id, r.decoded, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in found) == want
    assert all(r.back == r.decoded for r in found)
    assert bpe.encoded(docs.limit(0), PATH).collect() == []


def test_shared_chunks_are_handed_over(spark):
    """A block whose chunks all come from elsewhere has them encoded for it."""
    text = " ".join(str(i * 7919) for i in range(3000))
    docs = documents(spark, [(i, text, None, None) for i in range(6)]).repartition(6)
    coded = bpe.encoded(docs, PATH, block_bytes=1000)
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert coded.select("ids").distinct().count() == 1 and plan.count("collect_list") == 2


def test_decoding_of_broken_ids(spark):
    tokenizer = Tokenizer.from_file(PATH)
    ids = tokenizer.encode("日😀", add_special_tokens=False).ids
    given = [ids[:1], ids[1:], [50256, 0], [], None]
    frame = spark.createDataFrame([(None if i is None else np.array(i, "<u4").tobytes(),) for i in given], "ids binary")
    found = [r.text for r in frame.select(bpe.decoded(PATH, F.col("ids")).alias("text")).collect()]
    assert found == [None if i is None else tokenizer.decode(i, skip_special_tokens=False) for i in given]
