import random
import re

from helpers import documents

from docklake.llm import rules


def _slow(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + o for i, w in enumerate(windows) if windows.count(w) > 1 for o in range(8)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines)


def test_measurements_by_counting():
    random.seed(2)
    texts = ["", " ", "a", "a b\nc\n\nc\n c", "é 日本 # x* y\x1cz\x0bq", "w " * 7, "w " * 8, "w " * 9]
    texts += [" ".join(random.choices("ab", k=random.randint(1, 60))) for _ in range(50)]
    texts += [("x y z u v w p q r s\n" * 3) + "other words " * n for n in range(6)]
    for text in texts:
        assert rules.measured(text.encode()) == _slow(text), text


def test_policies_and_ablations_follow_from_the_bits(spark):
    docs = documents(spark).unionByName(documents(spark, [(20 + i, f"word{i} " * 30 + "| " * i, None, None) for i in range(6)]))
    entries = rules.ledger(docs)
    kept = {v: entries.where(rules.passes(v)).count() for v in rules.POLICIES}
    assert entries.count() == docs.count() and kept[2] <= kept[1]
    rows = [r.failures for r in entries.collect()]
    for version, names in rules.POLICIES.items():
        for row in rules.ablations(entries, version).collect():
            bit, mask = 1 << rules.BIT[row.rule], rules.mask(version)
            assert row.kept == kept[version] == sum(not f & mask for f in rows)
            assert row.failing == sum(bool(f & bit) for f in rows)
            assert row.failing_alone == sum(f & mask == bit for f in rows)
            assert row.kept_without == sum(not f & mask & ~bit for f in rows)
        assert rules.ablations(entries, version).count() == len(names)
    assert rules.ablations(entries.limit(0)).collect() == []


def test_texts_without_words_fail_the_first_rule(spark):
    found = {r.doc_id: r for r in rules.ledger(documents(spark)).collect()}
    assert all(found[i].n_words == 0 and found[i].failures & 1 for i in (2, 3, 5))
    assert found[4].n_words == 100_000 and found[4].n_repeat_words == 100_000
