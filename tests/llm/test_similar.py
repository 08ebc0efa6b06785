import numpy as np
import pytest
from helpers import LONG, documents
from pyspark.sql import functions as F

from docklake.llm import similar
from docklake.llm.components import components


def _shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def _similarity(a, b):
    return len(a & b) / max(len(a | b), 1)


def _families(seed, families, copies, words=300):
    """Texts of families: each copy has some words of the first one changed."""
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(families):
        base = [f"w{n}" for n in rng.integers(0, 20_000, words)]
        for copy in range(copies):
            own = list(base)
            for at in rng.choice(words, rng.integers(0, 12) if copy else 0, replace=False):
                own[at] = f"w{rng.integers(0, 20_000)}"
            texts.append(" ".join(own))
    return texts


def _groups(texts):
    """Brute force: all pairs of at least 0.8, and the group of each text."""
    sets = [_shingles(text) for text in texts]
    pairs = {(i, j) for i in range(len(sets)) for j in range(i) if _similarity(sets[i], sets[j]) >= 0.8}
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        x, y = sorted((find(i), find(j)))
        root[y] = x
    return sets, pairs, [find(i) for i in range(len(texts))]


def _prints(frame):
    return frame.select("row", similar._sketched(5)("text").alias("s")).select("row", "s.print", "s.decided")


def test_pairs_of_the_similarity_are_found_and_no_others(spark):
    texts = _families(2, 100, 2)
    sets, pairs, _ = _groups(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    found = {(max(r), min(r)) for r in similar.links(frame, _prints(frame), 5, 0.8, 0.01).collect()}
    assert all(_similarity(sets[i], sets[j]) >= 0.8 for i, j in found)
    assert 50 < len(pairs) < 100 and len(found & pairs) >= 0.95 * len(pairs)


@pytest.mark.parametrize("limit", [4, 64])
def test_crowded_spots_connect_what_pairs_connect(spark, limit):
    texts = _families(3, 3, 60)
    _, _, want = _groups(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(4)
    prints = _prints(frame)
    words = [F.conv(F.hex(F.substring("print", s, 8)), 16, -10).cast("long").alias(n) for s, n in ((1, "w0"), (9, "w1"))]
    plan = [(block, 2) for block in range(24)]
    signs = prints.select("row", *words, F.explode(similar._spots(plan)("decided")).alias("spot"))
    pairs = similar.candidates(signs, similar.Bounds.of(0.8).words, bucket_limit=limit).collect()
    assert all(r.a // 60 == r.b // 60 for r in pairs)  # only members of a family are near
    root = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    joined = sum(root.get(i, i) == root.get(w, w) for i, w in enumerate(want))
    assert joined >= 0.98 * len(texts)


def test_one_text_of_each_group_stays(spark):
    texts = _families(4, 20, 12) + _families(5, 60, 1)
    _, _, want = _groups(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    kept = {r.doc_id for r in similar.one_of_each(frame).collect()}
    firsts = set(want)
    assert firsts <= kept  # nothing goes that is similar to no text before it
    assert len(kept - firsts) <= 0.1 * (len(texts) - len(firsts))


def test_a_changed_passage_of_many_leaves_texts_alone(spark):
    rng = np.random.default_rng(6)
    passage = [f"p{n}" for n in range(150)]
    texts = [" ".join(passage + [f"w{n}" for n in rng.integers(0, 20_000, 150)]) for _ in range(150)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert similar.one_of_each(frame).count() == len(texts)


def test_plans_keep_the_chance_and_cost_less_for_fewer(spark):
    rng = np.random.default_rng(7)
    marks = [similar.decided_bits(rng.integers(0, 2**63, 50).astype(np.uint64))[1] for _ in range(100)]
    sample = np.frombuffer(b"".join(marks), np.uint8).reshape(-1, similar.BLOCKS, similar.DECIDED).astype(np.int64)
    p = similar.agreement(0.8)
    for total in (10, 10**5, 10**7):
        plan = similar.planned(total, sample, ~np.eye(100, dtype=bool), 0.8, 0.04)
        assert len({block for block, _ in plan}) == len(plan)
        assert np.prod([1 - p[k - 1] for _, k in plan]) <= 0.042
    few, many = (similar.planned(total, sample, ~np.eye(100, dtype=bool), 0.8, 0.04) for total in (10, 10**7))
    assert np.mean([k for _, k in many]) > np.mean([k for _, k in few])


def test_fingerprint_by_counting_bits():
    hashes = similar.shingles(b"Some words of a TEXT and some words of a text again", 5)
    mask, want = 2**64 - 1, bytearray()
    for block in range(similar.WORDS):
        value = 0
        mixed = []
        for h in hashes.tolist():
            x = (h + (block + 1) * 0x9E3779B97F4A7C15) & mask
            x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & mask
            x = ((x ^ x >> 27) * 0x94D049BB133111EB) & mask
            mixed.append(x ^ x >> 31)
        for bit in range(64):
            value |= (2 * sum(x >> bit & 1 for x in mixed) > len(mixed)) << bit
        want += value.to_bytes(8, "little")
    assert similar.decided_bits(hashes)[0] == bytes(want)
    assert len(hashes) == 7


@pytest.mark.parametrize("size", [1, 7, 50])
def test_stretches_change_nothing(monkeypatch, size):
    texts = [b"", b" ", b"one", b"a  b\tc\nd E", b" A b c d e f \x0b g h ", b"word " * 30, " ".join(f"w{i}é" for i in range(99)).encode()]
    want = [(similar.shingles(t, 5).tolist(), similar.content(t)) for t in texts]
    monkeypatch.setattr(similar, "STRETCH", size)
    assert [(similar.shingles(t, 5).tolist()) for t in texts] == [w[0] for w in want]
    for text, (hashes, _) in zip(texts, want, strict=True):
        words = text.lower().split()
        grams = {b" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
        assert len(hashes) == len(grams)
        assert similar.content(text) == similar.content(b" ".join(words))


def test_odd_rows(spark):
    docs = documents(spark)
    kept = similar.one_of_each(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 4, 6, 7, None]
    assert similar.one_of_each(docs.limit(0)).collect() == []
    longer = spark.createDataFrame([(9, LONG + " end"), (8, LONG), (3, "x")], "doc_id long, text string")
    assert sorted(r.doc_id for r in similar.one_of_each(longer).collect()) == [3, 8]


def test_a_task_holds_no_arrow_batch_of_texts(spark, capsys):
    texts = [*_families(10, 3, 2), "Some é words", None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    sketches = frame.select("row", "text", similar._sketched(5)("text").alias("s"))
    pairs = frame.join(frame.select(F.col("row").alias("other"), F.col("text").alias("other_text")), F.col("other") > F.col("row"))
    alike = pairs.select("row", "other", similar._jaccard(5)("text", "other_text").alias("j"))
    sketches.explain()
    alike.explain()
    assert "ArrowEvalPython" not in capsys.readouterr().out
    for r in sketches.collect():
        own = (r.text or "").encode()
        assert (r.s.print, r.s.decided) == similar.decided_bits(similar.shingles(own, 5))
        assert r.s.content_a.to_bytes(8, "little", signed=True) + r.s.content_b.to_bytes(8, "little", signed=True) == similar.content(own)
    sets = [_shingles(text or "") for text in texts]
    assert all(np.isclose(r.j, _similarity(sets[r.row], sets[r.other])) for r in alike.collect())


def test_invalid_utf8_is_read_by_its_bytes(spark):
    frame = spark.sql("select * from values (1L, x'61FF'), (2L, x'61FE'), (3L, x'61FF') as t(doc_id, text)")
    frame = frame.select("doc_id", F.col("text").cast("string"))
    assert sorted(r.doc_id for r in similar.one_of_each(frame).select("doc_id").collect()) == [1, 2]


def test_pairs_are_measured_by_one_worker_of_a_task(spark, capsys):
    frame = spark.createDataFrame(list(enumerate(_families(11, 4, 3))), "row long, text string")
    prints = _prints(frame).localCheckpoint()
    pairs = prints.select(F.col("row").alias("a")).crossJoin(prints.select(F.col("row").alias("b"))).where("a < b")
    measured = similar._measured(pairs, prints, similar.Bounds.of(0.8).most)
    measured.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
    bits = {r.row: np.frombuffer(r.print, np.uint64) for r in prints.collect()}
    apart = {(a, b): int(np.bitwise_count(bits[a] ^ bits[b]).sum()) for a in bits for b in bits if a < b}
    assert {(r.a, r.b, r.apart) for r in measured.collect()} == {(*p, n) for p, n in apart.items() if n <= similar.Bounds.of(0.8).most}


def test_crowded_spots_lose_no_pair_beside_their_first_row(spark, monkeypatch):
    """All texts meet in one spot; what is near its first row without being similar to it, or similar only to such, is joined."""
    rng = np.random.default_rng(8)
    base = [f"w{n}" for n in rng.integers(0, 20_000, 300)]
    chain, texts = list(base), [" ".join(base)]
    for step in range(90):  # each one is similar to the one before, few to the first
        chain[(step * 7) % 300] = f"x{step}"
        texts.append(" ".join(chain))
    _, _, want = _groups(texts)
    assert set(want) == {0}
    monkeypatch.setattr(similar, "planned", lambda *_: [(0, 1)])
    monkeypatch.setattr(similar, "_spots", lambda _plan: lambda _decided: F.array(F.lit(1).cast("long")))
    frame = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    root = {r.node: r.root for r in components(similar.links(frame, _prints(frame), 5, 0.8, 0.01, bucket_limit=4)).collect()}
    assert [root.get(i, i) for i in range(len(texts))] == want


@pytest.mark.parametrize("size", [7, 2048])
def test_crowded_pairs_by_brute_force(spark, size):
    texts = _families(9, 4, 30)
    frame = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    prints = _prints(frame)
    signs = prints.select("row", F.lit(1).cast("long").alias("spot"))
    bounds = similar.Bounds.of(0.8)
    groups = spark.createDataFrame([(i, 0) for i in range(0, 120, 3)], "node long, root long")
    pairs = similar.crowded_pairs(signs, prints, groups, bounds, 4, size).collect()
    bits = [np.frombuffer(r.print, np.uint64) for r in prints.orderBy("row").collect()]
    apart = {(i, j): int(np.bitwise_count(bits[i] ^ bits[j]).sum()) for j in range(120) for i in range(j)}
    near = {p for p, n in apart.items() if n <= bounds.most and np.bitwise_count(bits[p[0]][:2] ^ bits[p[1]][:2]).sum() <= bounds.words}
    assert {(r.a, r.b) for r in pairs} <= near and all(apart[r.a, r.b] == r.apart and not (r.a % 3 == r.b % 3 == 0) for r in pairs)
    known = [(0, i) for i in range(3, 120, 3)]
    got = spark.createDataFrame(known + [(r.a, r.b) for r in pairs], "a long, b long")
    all_ = spark.createDataFrame(known + sorted(near), "a long, b long")
    assert sorted(components(got).collect()) == sorted(components(all_).collect())
