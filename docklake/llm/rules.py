"""Quality rules as a ledger: every rule is evaluated once, its failure is a bit beside the measurements.

Policies are versioned masks over the bits. What a policy keeps, and what it would keep without one of its rules, follow
from the bits alone, without reading a text again.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docklake.llm.common import utf8

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

# Bit, name and failing condition of each rule. Bits are never given to another rule.
RULES = (
    (0, "few_words", "n_words < 20"),
    (1, "repeated_words", "100 * n_repeat_words > 30 * n_words"),
    (2, "symbols", "10 * n_symbols > n_words"),
    (3, "duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    (4, "short_words", "word_chars < 2 * n_words"),
    (5, "long_words", "word_chars > 15 * n_words"),
)
BIT = {name: bit for bit, name, _ in RULES}
# The rules of each version of the policy.
POLICIES = {
    1: ("few_words", "repeated_words"),
    2: ("few_words", "repeated_words", "symbols", "duplicate_lines", "short_words", "long_words"),
}
CURRENT = 2


def repeated_words(ids: np.ndarray) -> int:
    """How many words lie in a window of eight that occurs twice or more, its first occurrence included."""
    rank, span = ids, 1
    while span < WINDOW:  # equal ranks mean equal windows, of twice the words in each step
        if len(rank) <= span:
            return 0
        pairs = rank[:-span] * (int(rank.max()) + 1) + rank[span:]
        rank, span = np.unique(pairs, return_inverse=True)[1], 2 * span
    again = np.bincount(rank)[rank] >= 2
    if not again.any():
        return 0
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    starts = np.nonzero(again)[0]
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int(np.count_nonzero(edges.cumsum()[:-1]))


def measured(text: bytes) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    words = text.split()
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(word, len(number)) for word in words], dtype=np.int64)
    lines = [line for line in text.split(b"\n") if line.strip()]
    chars = sum(len(word.decode()) for word in words) if not text.isascii() else sum(map(len, words))
    return (
        len(words), chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(ids),
        len(lines),
    )


@F.arrow_udf(StructType([StructField(name, LongType()) for name in MEASURES]))
def _measures(texts: pa.Array) -> pa.Array:
    rows = np.array([measured(text) for text in utf8(texts)], dtype=np.int64).reshape(-1, len(MEASURES))
    return pa.StructArray.from_arrays([pa.array(column) for column in rows.T], names=list(MEASURES))


def mask(policy: int) -> int:
    return sum(1 << BIT[name] for name in POLICIES[policy])


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row with ``MEASURES`` and ``failures``, a bit for each rule that it fails.

    Whole texts are read once; a null text has no words. Rows stay apart, repeated ones too; nothing is shuffled.
    """
    counted = docs.select(*keep, _measures(text).alias("measures")).select(*keep, *(F.col(f"measures.{name}").alias(name) for name in MEASURES))
    bits = (F.when(F.expr(condition), F.lit(1 << bit)).otherwise(0).cast("long") for bit, _, condition in RULES)
    return counted.withColumn("failures", reduce(Column.bitwiseOR, bits))


def passes(policy: int = CURRENT) -> Column:
    """Whether a row of the ledger fails none of the policy's rules."""
    return F.col("failures").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(entries: DataFrame, policy: int = CURRENT) -> DataFrame:
    """``rule, failing, failing_alone, kept, kept_without`` of each rule of a policy.

    Rows are first counted by their bits, of which there are ``2 ** rules`` combinations at most; the rest works on the counts.
    A ledger without rows gives no rows.
    """
    whole = mask(policy)
    counts = entries.groupBy(F.col("failures").bitwiseAND(F.lit(whole).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(1 << BIT[name]).cast("long").alias("own")) for name in POLICIES[policy]))
    each = counts.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.rule", "r.own")
    count = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    others = F.col("bits").bitwiseAND(F.bitwise_not("own"))
    return each.groupBy("rule").agg(
        count(F.col("bits").bitwiseAND(F.col("own")) != 0).alias("failing"),
        count(F.col("bits") == F.col("own")).alias("failing_alone"),
        count(F.col("bits") == 0).alias("kept"), count(others == 0).alias("kept_without"),
    )


ORACLE = r"""
WITH numbered AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT rid, doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
    FROM numbered
), windows AS (
    SELECT rid, i, array_to_string(words[i : i + 7], ' ') AS eight
    FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM split)
), again AS (
    SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, eight) >= 2
), covered AS (
    SELECT rid, count(DISTINCT i + o) AS n FROM again, (SELECT unnest(range(0, 8)) AS o) GROUP BY rid
), measured AS (
    SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
    FROM split LEFT JOIN covered USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines
        OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM measured
"""
