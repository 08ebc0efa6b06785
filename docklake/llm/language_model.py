"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

A word's probability is that of its class after the words before, times its own within the class. The frequent words
form classes by frequency, all others classes by their ending, in which smoothed counts decide. Features are the word
before, the one before that (a skip), both together and a constant; each has a hashed row of weights. The weights are
trained by distributed gradient updates: all tokens are counted by context once, every task of a round descends on its own
contexts, each weighted by how often it occurs, and what it changed is averaged row by row.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, fields, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docklake.llm.common import LOWERED, stored, utf8
from docklake.session import delete_path, scratch_dir

END = b""  # no word is empty
CLASS_WORDS, HEAD_CLASSES, TAIL_CLASSES = 64, 32, 64
CLASSES = HEAD_CLASSES + TAIL_CLASSES
VOCABULARY = CLASS_WORDS * HEAD_CLASSES
BEFORE_FIRST = VOCABULARY + TAIL_CLASSES
CODES = BEFORE_FIRST + 1
CLASS_ROWS, WORD_ROWS = 1 << 15, 1 << 14
BLOCK = 64  # rows of weights that travel together


def tail_class(word: bytes) -> int:
    """The class of a rare word, by its last two characters."""
    return zlib.crc32(word.decode()[-2:].encode()) % TAIL_CLASSES


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWERED).split()


def _counted(batches):
    """Words and ends of this partition, counted in a memory that is emptied when it grows."""
    held: Counter = Counter()

    def rows():
        words = pa.array(list(held), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in utf8(batch.column(0)):
            held.update(words_of(text))
            held[END] += 1
            if len(held) > 250_000:
                yield rows()
                held.clear()
    if held:
        yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over all whole texts; the end of a text counts as the empty word."""
    return docs.select("text").mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    """What every task holds; its size is bounded by ``known_words`` and the constants above."""

    number: dict[bytes, int]  # the most frequent words, by descending count; the end is number 0
    log_count: np.ndarray  # log10(count + 1) of each
    tail: np.ndarray  # tail class of each, -1 for the vocabulary
    class_total: np.ndarray  # of each tail class, log10 of its tokens, words and one
    by_class: np.ndarray  # (CLASS_ROWS, CLASSES)
    by_word: np.ndarray  # (WORD_ROWS, CLASS_WORDS)

    def encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words and the end (-1 if not held), and codes: the vocabulary's numbers, then tail classes."""
        get = self.number.get
        numbers = np.array([get(word, -1) for word in words] + [0], dtype=np.int64)
        codes = np.where(self.tail[numbers] < 0, numbers, VOCABULARY + self.tail[numbers])
        for at in np.nonzero(numbers < 0)[0]:
            codes[at] = VOCABULARY + tail_class(words[at])
        return numbers, codes

    def log_probabilities(self, codes: np.ndarray, before: np.ndarray, skipped: np.ndarray, seen: np.ndarray | None = None) -> np.ndarray:
        """log10 of each code after the codes before it: of words of the vocabulary, or of tail classes.

        ``seen`` (``CODES * CODES`` floats, at first NaN) remembers the class normalisers of contexts from call to call.
        """
        out = np.empty(len(codes))
        for start in range(0, len(codes), 4096):
            part = slice(start, start + 4096)
            code, rows = codes[part], class_rows(before[part], skipped[part])
            cls = classes_of(code)
            if seen is None:
                out[part] = _log_softmax(self.by_class, rows, cls)
            else:
                context = before[part] * CODES + skipped[part]
                new, first = np.unique(context[np.isnan(seen[context])], return_index=True)
                if len(new):
                    at = np.nonzero(np.isnan(seen[context]))[0][first]
                    seen[new] = _log_normaliser(_logits(self.by_class, [own[at] for own in rows]))
                out[part] = sum(self.by_class[own, cls].astype(np.float64) for own in rows) - seen[context]
            head = np.nonzero(code < VOCABULARY)[0]
            rows = word_rows(cls[head], before[part][head], skipped[part][head])
            out[start + head] += _log_softmax(self.by_word, rows, code[head] % CLASS_WORDS)
        return out / np.log(10.0)


def classes_of(codes: np.ndarray) -> np.ndarray:
    return np.where(codes < VOCABULARY, codes // CLASS_WORDS, HEAD_CLASSES + codes - VOCABULARY)


def _hashed(kind: int, a: np.ndarray, b: np.ndarray | int, first: int, rows: int) -> np.ndarray:
    """Hashed row numbers from ``first`` to ``rows - 1``."""
    value = (a.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    value ^= (np.asarray(b, dtype=np.uint64).reshape(-1) + np.uint64(kind)) * np.uint64(0xC2B2AE3D27D4EB4F)
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
    return (first + (value >> np.uint64(33)) % np.uint64(rows - first)).astype(np.int64)


def class_rows(before: np.ndarray, skipped: np.ndarray) -> list[np.ndarray]:
    """Rows of the constant, the word before, the skipped one and both."""
    return [
        np.zeros(len(before), np.int64), _hashed(1_000_000, before, 0, 1, CLASS_ROWS), _hashed(2_000_000, skipped, 0, 1, CLASS_ROWS),
        _hashed(3_000_000, before, skipped, 1, CLASS_ROWS),
    ]


def word_rows(cls: np.ndarray, before: np.ndarray, skipped: np.ndarray) -> list[np.ndarray]:
    """Rows of the class, and of the class with the word before and with the skipped one."""
    return [cls, _hashed(4_000_000, before, cls, HEAD_CLASSES, WORD_ROWS), _hashed(5_000_000, skipped, cls, HEAD_CLASSES, WORD_ROWS)]


def _logits(weights: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    total = weights.take(rows[0], axis=0)
    for own in rows[1:]:
        total += weights.take(own, axis=0)
    return total


def _log_normaliser(logits: np.ndarray) -> np.ndarray:
    most = logits.max(axis=1)
    logits -= most[:, None]
    return most + np.log(np.exp(logits, out=logits).sum(axis=1, dtype=np.float64))


def _log_softmax(weights: np.ndarray, rows: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    logits = _logits(weights, rows)
    chosen = logits[np.arange(len(target)), target].astype(np.float64)
    return chosen - _log_normaliser(logits)


def _summed(p: np.ndarray, at: np.ndarray, starts: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The sum of the rows ``p[at]`` in each run of ``times`` entries from ``starts``; most runs have one entry."""
    total = p.take(at[starts], axis=0)
    for k in range(1, 8):
        more = np.nonzero((times > k) & (times <= 8))[0]
        if not len(more):
            break
        total[more] += p.take(at[starts[more] + k], axis=0)
    for run in np.nonzero(times > 8)[0]:
        total[run] = p.take(at[starts[run] : starts[run] + times[run]], axis=0).sum(axis=0)
    return total


def _descend(table: Table, rows: list[np.ndarray], owner: np.ndarray, target: np.ndarray, n: np.ndarray, rate: float, prior: float) -> None:
    """One step on a batch of contexts: context ``owner`` was followed ``n`` times by ``target``.

    The gradient of each weight is divided by the tokens that it has answered for so far in this round, so that frequent and
    rare contexts take steps of one size; ``prior`` tokens more keep rare ones near where they were.
    """
    size, width = len(rows[0]), table.weights.shape[1]
    logits = _logits(table.weights, rows)
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits, out=logits)
    times = np.bincount(owner, n, size).astype(np.float32)
    p *= (times / p.sum(axis=1))[:, None]
    found = np.bincount(owner * width + target, n, size * width).astype(np.float32).reshape(size, width)
    both = np.concatenate([p - found, np.maximum(p, found)], axis=1)
    flat = np.concatenate(rows)
    order = np.argsort(flat.astype(np.uint16) if len(table.weights) <= 1 << 16 else flat, kind="stable")  # 16 bits sort by radix
    flat = flat[order]
    starts = np.nonzero(np.diff(flat, prepend=-1))[0]
    own, lengths = flat[starts], np.diff(np.append(starts, len(flat)))
    total = _summed(both, order % size, starts, lengths)
    table.answered[own] += total[:, width:]
    table.weights[own] -= np.float32(rate) * total[:, :width] / (table.answered[own] + np.float32(prior))
    table.touched[own] += np.add.reduceat(times[order % size], starts)


@dataclass
class Table:
    """Weights in training."""

    weights: np.ndarray
    answered: np.ndarray  # tokens each weight expected or got in this round, the more of both batch by batch
    touched: np.ndarray  # tokens of each row


def _context(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.array([BEFORE_FIRST])
    return np.concatenate([edge, codes[:-1]]), np.concatenate([edge, edge, codes[:-2]])[: len(codes)]


def _triples(held: Broadcast):
    """How often each code follows each context in this partition, 4 M tokens at a time."""

    def rows(keys: list[np.ndarray]):
        own, times = np.unique(np.concatenate(keys), return_counts=True)
        for start in range(0, len(own), 1 << 16):
            context, code = np.divmod(own[start : start + (1 << 16)], CODES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(context.astype(np.int32)), pa.array(code.astype(np.int32)), pa.array(times[start : start + (1 << 16)])],
                names=["context", "code", "n"],
            )

    def count(batches):
        model, keys, size = Model(*held.value), [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                coded = [model.encoded(words_of(text))[1] for text in utf8(batch.column(0).slice(first, 64))]
                contexts = [_context(codes) for codes in coded]
                before, skipped = (np.concatenate(x) for x in zip(*contexts, strict=True))
                keys.append((before * CODES + skipped) * CODES + np.concatenate(coded))
                size += len(keys[-1])
                if size > 1 << 22:
                    yield from rows(keys)
                    keys, size = [], 0
        if keys:
            yield from rows(keys)

    return count


def _chunks(batches, size: int = 1 << 20):
    """Mixed and grouped ``context, code, n``: contexts in an order unlike that of their numbers, codes ascending in each."""

    def grouped(held):
        context, code, n = (np.concatenate([part[k] for part in held]) for k in range(3))
        order = np.argsort((context * 0x9E3779B1 % (1 << 23)) * CODES + code)  # an odd factor keeps numbers below 2 ** 23 apart
        return context[order], code[order], n[order]

    held, rows = [], 0
    for batch in batches:
        held.append([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
        rows += batch.num_rows
        if rows >= size:
            yield grouped(held)
            held, rows = [], 0
    if rows:
        yield grouped(held)


def _steps(group: np.ndarray, batch: int):
    """Batches of ``batch`` runs of equal values: the entries, the first one of each run, and each entry's run in the batch."""
    starts = np.nonzero(np.diff(group, prepend=-1))[0]
    ends = np.append(starts, len(group))
    run = np.repeat(np.arange(len(starts)), np.diff(ends))
    for first in range(0, len(starts), batch):
        own = starts[first : first + batch]
        part = slice(own[0], ends[min(first + batch, len(starts))])
        yield part, own, run[part] - first


def _updates(held: Broadcast, rate: float, prior: float, batch_tokens: int):
    """Changes of the weights after a descent on this task's contexts, in blocks of rows."""

    def descend(batches):
        model = Model(*held.value)
        tables = [Table(w.copy(), np.zeros_like(w), np.zeros(len(w), np.float32)) for w in (model.by_class, model.by_word)]
        for context, code, n in _chunks(batches):
            classes = classes_of(code)
            for part, first, owner in _steps(context, batch_tokens):
                _descend(tables[0], class_rows(*np.divmod(context[first], CODES)), owner, classes[part], n[part], rate, prior)
            head = code < VOCABULARY
            context, code, classes, n = context[head], code[head], classes[head], n[head]
            for part, first, owner in _steps(context * CLASSES + classes, batch_tokens):
                rows = word_rows(classes[first], *np.divmod(context[first], CODES))
                _descend(tables[1], rows, owner, code[part] % CLASS_WORDS, n[part], rate, prior)
        for number, (table, old) in enumerate(zip(tables, (model.by_class, model.by_word), strict=True)):
            touched = table.touched.reshape(-1, BLOCK)
            used = np.nonzero(touched.any(axis=1))[0]
            change = (table.weights - old).astype(np.float16).reshape(-1, BLOCK, old.shape[1])
            for start in range(0, len(used), 16):
                blocks = used[start : start + 16]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(blocks), number, np.int32)), pa.array(blocks.astype(np.int32)),
                        pa.array([change[b].tobytes() for b in blocks], pa.binary()),
                        pa.array([touched[b].tobytes() for b in blocks], pa.binary()),
                    ],
                    names=["table", "block", "change", "touched"],
                )

    return descend


def _averaged(rows: pd.DataFrame) -> pd.DataFrame:
    """The mean change of a block's rows, each partition weighted by how often it touched the row."""
    width = len(rows["change"].iloc[0]) // (2 * BLOCK)
    change, touched = np.zeros((BLOCK, width), np.float64), np.zeros(BLOCK, np.float64)
    for own, n in zip(rows["change"], rows["touched"], strict=True):
        times = np.frombuffer(n, np.float32)
        change += np.frombuffer(own, np.float16).reshape(BLOCK, width) * times[:, None].astype(np.float64)
        touched += times
    mean = (change / np.maximum(touched, 1.0)[:, None]).astype(np.float32)
    return pd.DataFrame({"table": rows["table"].iloc[:1], "block": rows["block"].iloc[:1], "change": [mean.tobytes()]})


def _least_count(counts: DataFrame, known_words: int) -> int:
    """The smallest count such that at most ``known_words`` words have it or more.

    From a histogram of the counts, exact below 1024 and by eighths of a power of two above, so of some 1,500 rows at most.
    """
    rank = F.floor(F.log2("n") * 8)
    step = F.when(F.col("n") < 1024, F.col("n")).otherwise(F.ceil(F.pow(F.lit(2.0), rank / 8)))
    sizes = counts.where("word != ''").groupBy(step.cast("long").alias("least")).count().collect()
    least, held = 1 << 62, 0
    for row in sorted(sizes, key=lambda row: -row["least"]):
        held += row["count"]
        if held > known_words:
            break
        least = row["least"]
    return least


def _started(counts: DataFrame, least: int) -> Model:
    """The model before training: smoothed counts without context. Held are the words of count ``least`` or more."""
    known = counts.where((F.col("word") != "") & (F.col("n") >= least)).toArrow()
    frequent = sorted(zip(known["n"].to_pylist(), known["word"].to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
    ends = counts.where(F.col("word") == "").first()
    words = [END] + [word.encode() for _, word in frequent]
    n = np.array([ends["n"] if ends else 0] + [n for n, _ in frequent], dtype=np.float64)
    tail = np.array([-1 if i < VOCABULARY else tail_class(word) for i, word in enumerate(words)], dtype=np.int64)
    in_tail = F.col("n") < least
    if len(words) >= VOCABULARY:
        last_n, last_word = frequent[VOCABULARY - 2]
        in_tail = (F.col("n") < last_n) | ((F.col("n") == last_n) & (F.col("word") > last_word))
    rare = counts.where((F.col("word") != "") & in_tail).groupBy(
        (F.crc32(F.encode(F.right("word", F.lit(2)), "utf-8")) % TAIL_CLASSES).alias("class")
    ).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    tokens, distinct = np.zeros(TAIL_CLASSES), np.zeros(TAIL_CLASSES)
    for row in rare:
        tokens[row["class"]], distinct[row["class"]] = row["n"], row["words"]
    head = np.zeros(VOCABULARY)
    head[: len(n[:VOCABULARY])] = n[:VOCABULARY] + 1
    by_class = np.zeros((CLASS_ROWS, CLASSES), np.float32)
    by_word = np.zeros((WORD_ROWS, CLASS_WORDS), np.float32)
    in_class = head.reshape(HEAD_CLASSES, CLASS_WORDS)
    by_class[0] = np.log(np.concatenate([in_class.sum(axis=1), tokens + distinct]) + 0.1)
    by_word[:HEAD_CLASSES] = np.log(in_class + 1e-3)
    return Model(
        {word: i for i, word in enumerate(words)}, np.log10(n + 1.0), tail, np.log10(tokens + distinct + 1.0), by_class, by_word
    )


def trained_on(
    docs: DataFrame, counts: DataFrame, known_words: int = 1 << 17, rounds: int = 4, share: int = 1, rate: float = 0.5, prior: float = 1.0,
    batch_tokens: int = 512,
) -> Model:
    """The model of ``docs(doc_id, text)``, whose ``counts`` cover all of them.

    The tokens of all documents are counted by (context, code) in one pass and one shuffle of combined counts. Each of
    ``rounds`` gradient rounds then descends on 1 of ``share`` parts of the contexts, by a hash, in turn; with the default, on
    all of them. There are as many rounds as parts at least, so every document is learned from. A step takes the tokens of
    ``batch_tokens`` distinct contexts. A round has as many tasks as the cluster has cores; what they send, and the one copy
    of the weights that the driver gets, don't grow with the documents.
    """
    if rounds < share:
        raise ValueError(f"{rounds} rounds leave out {share - rounds} of {share} parts of the documents")
    spark = docs.sparkSession
    context, path = spark.sparkContext, scratch_dir(spark, "triples")
    model = _started(counts, _least_count(counts, known_words))
    part = F.pmod(F.xxhash64("context"), F.lit(share))
    for number in range(-1, rounds):
        held = context.broadcast(tuple(getattr(model, field.name) for field in fields(model)))  # plain values need no package
        if number < 0:
            triples = docs.select("text").mapInArrow(_triples(held), "context int, code int, n long")
            triples.repartition("context").groupBy("context", "code").agg(F.sum("n").alias("n")).write.parquet(path)
        else:
            own = spark.read.schema("context int, code int, n long").parquet(path).where(part == number % share)
            updates = own.coalesce(context.defaultParallelism).mapInArrow(
                _updates(held, rate, prior, batch_tokens), "table int, block int, change binary, touched binary"
            )
            averaged = updates.groupBy("table", "block").applyInPandas(_averaged, "table int, block int, change binary").collect()
            tables = model.by_class.copy(), model.by_word.copy()
            for row in averaged:
                width = tables[row["table"]].shape[1]
                at = slice(row["block"] * BLOCK, (row["block"] + 1) * BLOCK)
                tables[row["table"]][at] += np.frombuffer(row["change"], np.float32).reshape(BLOCK, width)
            model = replace(model, by_class=tables[0], by_word=tables[1])
        held.destroy()  # else each round leaves a copy of the weights on the disk of every executor
    delete_path(spark, path)
    return model


ROW = ("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "word", "n")
ROW_SCHEMA = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, word string, n long"


def _scored(model: Model, total: float):
    """A row for each text, and one for each word of it that the model doesn't hold; both carry the text's number."""

    def score(batches):
        number = TaskContext.get().partitionId() << 33
        seen = np.full(CODES * CODES, np.nan, np.float32)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts = [words_of(text) for text in utf8(part.column("text"))]
                rows = np.arange(number, number + len(texts))
                number += len(texts)
                yield from _scored_texts(model, total, rows, part, texts, seen)

    return score


def _scored_texts(model: Model, total: float, rows: np.ndarray, part: pa.RecordBatch, texts: list[list[bytes]], seen: np.ndarray):
    encoded = [model.encoded(words) for words in texts]
    contexts = [_context(codes) for _, codes in encoded]
    sizes = np.array([len(codes) for _, codes in encoded])
    numbers, codes = (np.concatenate(x) for x in zip(*encoded, strict=True))
    before, skipped = (np.concatenate(x) for x in zip(*contexts, strict=True))
    owner = np.repeat(np.arange(len(texts)), sizes)
    held = numbers >= 0
    count = np.where(held, model.log_count[numbers], 0.0)
    log_p = model.log_probabilities(codes, before, skipped, seen)
    rare = codes >= VOCABULARY
    log_p[rare] += count[rare] - model.class_total[codes[rare] - VOCABULARY]
    sums = lambda values: np.bincount(owner, values, len(texts))
    n, none = len(texts), lambda size, kind: pa.nulls(size, kind)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(rows), part.column("doc_id"), part.column("held_out"), pa.array(sizes), pa.array(sums(count > 0).astype(np.int64)),
            pa.array(sums(count) - sizes * total), pa.array(sums(log_p)), pa.array([f" {row}" for row in rows]), pa.array(np.zeros(n, np.int64)),
        ],
        names=list(ROW),
    )
    at, words, times = [], [], []
    starts = np.concatenate([[0], sizes.cumsum()])
    for row, own, start in zip(rows, texts, starts, strict=False):
        rest = Counter(own[i] for i in np.nonzero(~held[start : start + len(own)])[0])
        at += [row] * len(rest)
        words += rest.keys()
        times += rest.values()
    if at:
        size = len(at)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(at, np.int64)), none(size, pa.int64()), none(size, pa.bool_()), none(size, pa.int64()), none(size, pa.int64()),
                none(size, pa.float64()), none(size, pa.float64()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(times, pa.int64()),
            ],
            names=list(ROW),
        )


def scored(docs: DataFrame, learn: Column, known_words: int = 1 << 17, **training) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row of ``docs(doc_id, text)``.

    The counts and the model come from the rows that ``learn`` (a condition on ``doc_id``) admits; null ids don't teach.
    Null texts count as empty and have one token, the end. Each row is scored by itself, repeated ones too; an empty
    table gives none, and without rows to learn from all words are unknown.

    Tasks hold the most frequent words, ``known_words`` at most. Counts of other words are joined: by then no word is frequent,
    so no key is hot, and a text sends a row for each of its rare words only.
    """
    docs = docs.select("doc_id", "text")
    taught = docs.where(F.coalesce(learn, F.lit(False)))
    counts = stored(word_counts(taught), "counts")
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("words")).first()
    tokens, distinct = sums["n"] or 0, sums["words"]
    model = trained_on(taught, counts, known_words, **training)
    held_out = F.coalesce(~learn, F.lit(False)).alias("held_out")
    rows = docs.select("doc_id", "text", held_out).mapInArrow(_scored(model, float(np.log10(tokens + distinct + 1))), ROW_SCHEMA)
    others = counts.where((F.col("word") != "") & (F.col("n") < _least_count(counts, known_words)))
    joined = rows.join(others.select("word", F.col("n").alias("found")), "word", "left")
    more = F.coalesce(F.col("n") * F.log10(F.col("found") + 1.0), F.lit(0.0))
    return joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("n_known", F.when(F.col("found").isNotNull(), F.col("n")), F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), F.sum(F.coalesce("base", F.lit(0.0)) + more).alias("base_score"),
        F.sum(F.coalesce("score", F.lit(0.0)) + more).alias("score"),
    ).drop("row")
