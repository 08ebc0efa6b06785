"""Toxicity: class-conditional Kneser-Ney models of words and word pairs, compared per word of the text.

Rare words rest on their beginnings, and those on backoff counts that both classes share.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

REJECTED = 0.7  # documents that score at least this are rejected
WORD = re.compile(r"\w+")
STEM = 4  # letters of a word's beginning that words share
WINDOW = 16
CLEAR = 5.0  # a word can speak no more than this for either class
START = ""
EVIDENCE = ("mean", "worst_window", "worst_word", "second_word", "third_word", "log_words")
STEMS, WORDS, PAIRS = 0, 1, 2


def _words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _slices(batch: pa.RecordBatch, rows: int):
    return (batch.slice(start, rows) for start in range(0, batch.num_rows, rows))


def _expressions(batches):
    """Per 64 texts: in how many toxic and ordinary texts each beginning, word and pair of words occurs."""
    for batch in (part for whole in batches for part in _slices(whole, 64)):
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            words = _words(text)
            own = set(words)
            seen[label].update((STEMS, "", stem) for stem in {word[:STEM] for word in own})
            seen[label].update((WORDS, "", word) for word in own)
            seen[label].update((PAIRS, *pair) for pair in set(zip([START, *words], words, strict=False)))
        keys = list(seen[0] | seen[1])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([key[0] for key in keys], pa.int32()), pa.array([key[1] for key in keys], pa.string()),
                pa.array([key[2] for key in keys], pa.string()), pa.array([seen[1][key] for key in keys], pa.int64()),
                pa.array([seen[0][key] for key in keys], pa.int64()),
            ],
            names=["kind", "prev", "word", "toxic", "ordinary"],
        )


@dataclass(frozen=True)
class Model:
    """Probabilities by class, toxic first. Stem 0 and word 0 stand for all unknown ones.

    A word after another has what is left of their pair's count after discounting, and a share of what the pairs leave:
    the probability of its beginning, times that of the word among words that begin so. Both rest on backoff counts
    (numbers of different words before it) that the classes share.
    """

    stem_number: dict[str, int]
    stem: np.ndarray  # (2, stems)
    rest: np.ndarray  # (2, stems): of all unknown words that begin so
    number: dict[str, int]
    word: np.ndarray  # (2, words): among the words that begin so
    backoff: np.ndarray  # (2, words): what a word's pairs leave
    pair_key: np.ndarray  # word before * words + word, sorted
    pair: np.ndarray  # (2, pairs)
    weights: np.ndarray  # of EVIDENCE and a constant

    def ratios(self, words: list[str]) -> np.ndarray:
        """Per word the log of its toxic over its ordinary probability after the word before."""
        get, stem = self.number.get, self.stem_number.get
        ids = np.array([get(word, 0) for word in words], dtype=np.int64)
        stems = np.array([stem(word[:STEM], 0) for word in words], dtype=np.int64)
        before = np.concatenate([[get(START, 0)], ids[:-1]])
        p = self.backoff[:, before] * self.stem[:, stems] * np.where(ids > 0, self.word[:, ids], self.rest[:, stems])
        if len(self.pair_key):
            key = before * self.word.shape[1] + ids
            at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            p = p + np.where(self.pair_key[at] == key, self.pair[:, at], 0.0)
        return np.clip(np.log(p[0]) - np.log(p[1]), -CLEAR, CLEAR)

    def evidence(self, text: str | None) -> list[float]:
        """The ratio per word of the whole text, of its most toxic window and of its three most toxic words, each
        taken twice at most, and the log of its length; zeros for a text without words."""
        words = _words(text)
        n = len(words)
        if not n:
            return [0.0] * len(EVIDENCE)
        ratios = self.ratios(words)
        width = min(WINDOW, n)
        sums = np.concatenate([[0.0], ratios.cumsum()])
        worst, times = [], Counter()
        for at in np.argsort(-ratios, kind="stable"):
            times[words[at]] += 1
            if times[words[at]] <= 2:
                worst.append(float(ratios[at]))
            if len(worst) == 3:
                break
        three = (worst + [0.0] * 3)[:3]
        return [float(ratios.mean()), float((sums[width:] - sums[:-width]).max() / width), *three, float(np.log1p(n))]

    def probabilities(self, evidence: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(evidence @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _discounted(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Absolute discounting with the discount that counts of one and two give."""
    once, twice = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
    discount = once / (once + 2 * twice) if once and twice else 0.5
    return np.maximum(counts - discount, 0.0) / np.maximum(whole, 1.0)


def _model(expressions: DataFrame, fewest_texts: int, most_expressions: int) -> Model:
    """The two models from the counts of ``_expressions``, summed."""
    both = F.col("toxic") + F.col("ordinary")
    pairs = expressions.where(F.col("kind") == PAIRS)
    following = pairs.groupBy("word").agg(F.count("*").alias("contexts"))
    leaving = pairs.groupBy(F.col("prev").alias("word")).agg(F.sum("toxic").alias("left_toxic"), F.sum("ordinary").alias("left_ordinary"))
    begun = following.groupBy(F.substring("word", 1, STEM).alias("word")).agg(F.sum("contexts").alias("contexts"))
    inside = expressions.where(F.col("kind") == WORDS).groupBy(F.substring("word", 1, STEM).alias("word")).agg(
        F.sum("toxic").alias("in_toxic"), F.sum("ordinary").alias("in_ordinary")
    )

    def kept(kind: int) -> DataFrame:
        frequent = expressions.where((F.col("kind") == kind) & (both >= fewest_texts))
        return frequent.orderBy(both.desc(), "prev", "word").limit(most_expressions)

    stems = kept(STEMS).join(begun, "word").join(inside, "word").collect()
    words = kept(WORDS).join(following, "word").join(leaving, "word", "left").fillna(0).collect()
    start = leaving.where(F.col("word") == START).first()
    sums = expressions.where(F.col("kind") == STEMS).agg(F.sum("toxic"), F.sum("ordinary")).first()
    all_contexts = pairs.count()

    stem_number = {row["word"]: i + 1 for i, row in enumerate(stems)}
    counts, within, contexts = np.zeros((2, len(stems) + 1)), np.zeros((2, len(stems) + 1)), np.zeros(len(stems) + 1)
    for i, row in enumerate(stems, 1):
        counts[:, i] = row["toxic"], row["ordinary"]
        within[:, i] = row["in_toxic"], row["in_ordinary"]
        contexts[i] = row["contexts"]
    contexts[0] = max(all_contexts - contexts.sum(), 1.0)
    own = _discounted(counts, np.array([[float(total or 0)] for total in sums]))
    stem = own + (1.0 - own.sum(axis=1, keepdims=True)) * contexts / contexts.sum()

    number = {START: 1} | {row["word"]: i + 2 for i, row in enumerate(words)}
    size = len(number) + 1
    stem_of, word_counts, leaves, shared = np.zeros(size, np.int64), np.zeros((2, size)), np.zeros((2, size)), np.zeros(size)
    for i, row in enumerate(words, 2):
        stem_of[i] = stem_number.get(row["word"][:STEM], 0)
        word_counts[:, i] = row["toxic"], row["ordinary"]
        leaves[:, i] = row["left_toxic"], row["left_ordinary"]
        shared[i] = row["contexts"] / contexts[stem_of[i]]
    if start is not None:
        leaves[:, 1] = start["left_toxic"], start["left_ordinary"]
    own = _discounted(word_counts, within[:, stem_of])
    left = np.stack([1.0 - np.minimum(np.bincount(stem_of, own[c], len(stems) + 1), 1.0) for c in range(2)]) + 1e-3
    word = own + left[:, stem_of] * shared
    rest = left * np.maximum(1.0 - np.bincount(stem_of, shared, len(stems) + 1), 1e-3)

    found = [
        (number[row["prev"]], number[row["word"]], row["toxic"], row["ordinary"])
        for row in kept(PAIRS).collect() if row["prev"] in number and row["word"] in number
    ]
    table = np.array(found, dtype=np.int64).reshape(-1, 4)
    table = table[np.argsort(table[:, 0] * size + table[:, 1])]
    pair = _discounted(table[:, 2:].T.astype(float), leaves[:, table[:, 0]])
    taken = np.stack([np.bincount(table[:, 0], pair[c], size) for c in range(2)])
    return Model(
        stem_number, stem, rest, number, word, np.maximum(1.0 - taken, 1e-3), table[:, 0] * size + table[:, 1], pair,
        np.zeros(len(EVIDENCE) + 1),
    )


def _logistic(evidence: np.ndarray, labels: np.ndarray, weights: np.ndarray, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton's method with a small ridge."""
    x = np.column_stack([evidence, np.ones(len(evidence))])
    found = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ found, -30, 30)))
        slope = x.T @ (weights * (p - labels)) + 1e-2 * found
        curve = (x * (weights * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + 1e-2 * np.eye(len(found))
        step = np.linalg.solve(curve, slope)
        found -= step * min(1.0, 10.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return found


def trained_on(
    docs: DataFrame, labels: DataFrame, label: str, allowed: Column, most_rows: int = 6_000, fewest_texts: int = 6,
    most_expressions: int = 200_000,
) -> Model:
    """Both models and the weights of their comparison, from labelled texts.

    Fitted on a sample of at most ``most_rows`` labelled ids of each class that ``allowed`` (a condition on ``doc_id``)
    admits, chosen by a hash of the id. Two thirds of the distinct texts give the counts, the rest the weights, in
    proportion to the classes. Expressions in fewer than ``fewest_texts`` texts, and those beyond the
    ``most_expressions`` most frequent words and pairs, rest on the backoff; this bounds what is broadcast. Null ids,
    null labels and labels without a text teach nothing; of several labels of one id the largest counts. Without
    labelled texts every score is one half.
    """
    allowed_labels = labels.where(F.col(label).isin(0, 1) & allowed).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    sizes = {row["label"]: row["count"] for row in allowed_labels.groupBy("label").count().collect()}
    chosen = None
    for value in (0, 1):
        part = allowed_labels.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label").distinct()
    part = F.pmod(F.xxhash64("text"), F.lit(3))
    expressions = (
        texts.where(part != 0).mapInArrow(_expressions, "kind int, prev string, word string, toxic long, ordinary long")
        .groupBy("kind", "prev", "word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")).cache()
    )
    model = _model(expressions, fewest_texts, most_expressions)
    expressions.unpersist()
    rows = texts.where(part == 0).select("label", _evidence(model)("text").alias("evidence")).limit(2 * most_rows).collect()
    if not rows:
        return model
    value = np.array([row["label"] for row in rows])
    evidence = np.array([row["evidence"] for row in rows], dtype=float)
    weight = np.array([sizes.get(v, 0) / max(np.count_nonzero(value == v), 1) for v in (0, 1)])[value]
    weights = _logistic(evidence, value.astype(float), weight * len(value) / weight.sum())
    return replace(model, weights=weights)


def _evidence(model: Model):
    @F.arrow_udf(ArrayType(DoubleType()))
    def evidence(texts: pa.Array) -> pa.Array:
        return pa.array([model.evidence(text) for text in texts.to_pylist()], pa.list_(pa.float64()))

    return evidence


def score(model: Model, text: str = "text") -> Column:
    """The probability of label 1 of every text; a null text counts as empty."""

    # Rows come a hundred at a time; an Arrow batch would hold all texts of a task in the JVM and again in Python.
    @F.udf(DoubleType(), useArrow=False)
    def scored(own: str | None) -> float:
        return float(model.probabilities(np.array(model.evidence(own))))

    return scored(F.col(text))
