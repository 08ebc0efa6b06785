import numpy as np
import pytest
import xxhash
from helpers import documents

from docklake.llm import simhash
from docklake.llm.components import components


def _slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def _slow_components(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in root:
        for b in root:
            if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in root}


def _signed(value):
    return value - 2**64 if value >= 2**63 else value


@pytest.mark.parametrize("text", ["", "one", "two WORDS", "a b c", "a b c a b c", "Ä ö\x0bx\x1cy z q w", "x " * 9000])
def test_fingerprint_by_counting_bits(text):
    assert simhash.fingerprint(text.encode()) == _slow_fingerprint(text)


@pytest.mark.parametrize("limit", [2, 64])
def test_links_connect_exactly_what_lies_within_two_bits(spark, limit):
    rng = np.random.default_rng(5)
    prints = {0, 1, 3, 7, 15, 31}  # a chain: the ends are far apart
    for _ in range(12):
        centre = int(rng.integers(0, 2**63))
        prints.add(centre)
        for _ in range(25):
            bits = rng.choice(64, rng.integers(1, 5), replace=False)
            prints.add(centre ^ sum(1 << int(b) for b in bits))
    prints = sorted(_signed(p) for p in prints)
    frame = spark.createDataFrame([(p,) for p in prints], "print long")
    edges = simhash.links(frame, bucket_limit=limit)
    assert all(bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 2 for r in edges.collect())
    found = {r.node: r.root for r in components(edges).collect()}
    want = _slow_components(prints)
    groups = lambda roots: {p: {q for q in roots if roots[q] == roots[p]} for p in roots}
    assert groups({p: found.get(p, p) for p in prints}) == groups(want)


def test_plans_keep_the_pigeonhole_sum():
    rng = np.random.default_rng(6)
    sample = rng.integers(0, 2**63, 500).astype(np.uint64)
    correlation = np.abs(rng.normal(size=(64, 64)))
    correlation += correlation.T
    for total in (10, 10**6, 10**8, 10**10, 10**12):
        parts = simhash.planned_partitions(total, correlation, sample)
        skipped = 64 - sum(len(p.bits) for p in parts)
        assert len({bit for p in parts for bit in p.bits}) == 64 - skipped
        if not skipped:
            assert sum(p.threshold for p in parts) == simhash.DISTANCE - len(parts) + 1
    assert sorted(b for g in simhash.grouped_bits(correlation, 3) for b in g) == list(range(64))


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3)] + [(300, 301), (301, 302), (302, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300, 302: 300}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_odd_rows(spark):
    docs = documents(spark)
    found = simhash.near_duplicates(docs)
    assert found.count() == docs.count() and set(found.columns) == set(docs.columns)
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[2].fingerprint == by_id[3].fingerprint == by_id[5].fingerprint == 0
    assert by_id[2].component_id == by_id[3].component_id == by_id[5].component_id == 2
    assert by_id[1].component_id == 1 and by_id[None].component_id is None
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 4, 6, 7, None]
    assert simhash.one_of_each(docs.limit(0)).collect() == [] and simhash.near_duplicates(docs.limit(0)).collect() == []
