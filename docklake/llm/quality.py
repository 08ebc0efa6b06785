"""Document quality: histogram gradient-boosted trees over statistics of whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from docklake.llm.boosting import Trees, trained
from docklake.llm.common import UPPER, utf8

ACCEPTED = 0.3  # documents that score less are rejected
SYMBOLS = b"#*$%&|<>"
DIGITS = b"0123456789"
PUNCTUATION = b".,;:!?"
STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "distinct_words", "most_common_word", "repeated_words", "distinct_triples",
    "lines_per_word", "distinct_lines", "symbols", "upper", "digits", "punctuation", "marks", "bars", "foreign", "quotes",
    "long_words",
)


def statistics(text: bytes) -> list[float]:
    """The statistics of one text, in the order of ``STATISTICS``; all zero for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    size, n = len(text), len(words)
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(word, len(number)) for word in words], dtype=np.int64)
    triples = n - 2
    if triples > 0:
        codes = np.sort((ids[:-2] * len(number) + ids[1:-1]) * len(number) + ids[2:])
        distinct_triples = (1 + np.count_nonzero(codes[1:] != codes[:-1])) / triples
    else:
        distinct_triples = 1.0
    lines = [line for line in text.split(b"\n") if line.strip()]
    count = lambda characters: size - len(text.translate(None, characters))
    return [
        float(np.log1p(size)), float(np.log1p(n)), sum(map(len, words)) / n, len(number) / n,
        float(np.bincount(ids).max()) / n, float(np.count_nonzero(ids[1:] == ids[:-1])) / n, distinct_triples,
        len(lines) / n, len(set(lines)) / len(lines), count(SYMBOLS) / n, count(UPPER) / size, count(DIGITS) / size,
        count(PUNCTUATION) / n, text.count(b"!") / n, text.count(b"|") / n, count(FOREIGN) / size,
        count(b"\"'()[]{}") / n, sum(len(word) > 20 for word in words) / n,
    ]


FOREIGN = bytes(range(128, 256))


def _features(texts: pa.Array) -> np.ndarray:
    parts = (texts.slice(start, 256) for start in range(0, len(texts), 256))  # few are held twice
    return np.array([statistics(text) for part in parts for text in utf8(part)], dtype=float).reshape(-1, len(STATISTICS))


@F.arrow_udf(ArrayType(DoubleType()))
def _statistics(texts: pa.Array) -> pa.Array:
    return pa.array(list(_features(texts)), pa.list_(pa.float64()))


def trained_on(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, most_rows: int = 20_000) -> Trees:
    """Trees fitted to ``label`` (0 or 1) of ``labels``, by ``doc_id``.

    Fitted on a sample of at most ``most_rows`` labelled ids that ``allowed`` (a condition on ``doc_id``) admits, chosen by a
    hash of the id; so what is broadcast and collected stays below ``most_rows`` short rows. Null ids, null labels
    and labels without a document teach nothing; of several labels of one id the largest counts.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & allowed).groupBy("doc_id").agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    )
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .select("label", "doc_id", _statistics("text").alias("statistics")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows).collect()
    )
    features = np.array([row["statistics"] for row in rows], dtype=float).reshape(-1, len(STATISTICS))
    return trained(features, np.array([row["label"] for row in rows], dtype=float))


def score(model: Trees, text: str = "text") -> Column:
    """The probability of label 1 of every text; a null text counts as empty."""

    # Rows come a hundred at a time; an Arrow batch would hold all texts of a task in the JVM and again in Python.
    @F.udf(DoubleType(), useArrow=False)
    def scored(own: bytes | None) -> float:
        return float(model.scores(np.array([statistics(bytes(own or b""))], dtype=float))[0])

    return scored(F.col(text).cast("binary"))
