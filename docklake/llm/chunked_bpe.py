"""BPE encoding with reuse of content-defined chunks, and decoding.

Texts are cut where a rolling hash of the last bytes says so, thus at the same places of a passage wherever it stands.
A chunk that several blocks of documents hold is encoded once, by one of them, and its ids are handed to the others. The
ids of a text are those of its chunks, but for the joins: around each cut a window is encoded anew, and made longer until
it agrees with the chunk's own ids at a word that both begin at the same byte.

Why that is exact: the tokenizer cuts a text into words from left to right, and merges bytes within a word only. How a
word ends depends on less than ``MARGIN`` bytes after it. So from a common beginning on, two encodings have the same words
up to the margin before the end of the shorter one.
"""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_left
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docklake.llm.common import utf8

MARGIN = 16  # bytes; no less than the longest special token and than the two characters that decide how a word ends
HASHED = 32  # bytes the rolling hash sees
KEY_BYTES = 16
REMEMBERED_WORDS, REMEMBERED_CHUNKS = 100_000, 2_000
LEVEL = 6  # of compression

# What the tokenizer's pattern finds in texts without ``ODD`` characters, whose letters and numbers are these.
ODD = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"
)

PLAIN = re.compile(rf" [{LETTERS}]+")


def _gears() -> np.ndarray:
    """A fixed random number for each byte."""
    return np.frombuffer(b"".join(hashlib.sha256(bytes([b])).digest()[:4] for b in range(256)), "<u4")


def cuts(texts: list[bytes], average: int, gears: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each text, about ``average`` bytes each, from a quarter of it to eight times.

    All texts are hashed in one pass: a chunk is no shorter than what the hash sees, so no cut depends on another text.
    """
    whole = np.frombuffer(b"".join(texts), np.uint8)
    rolled, width = gears[whole], 1
    while width < HASHED:  # the hash of twice the width from two of the width
        rolled[width:] += rolled[:-width] << np.uint32(width)
        width *= 2
    begins = np.ones(len(whole) + 1, bool)  # a character or a text begins
    begins[:-1] = (whole & 0xC0) != 0x80
    wished = (np.nonzero((rolled < np.uint32(2**32 // average)) & begins[1:])[0] + 1).tolist()
    smallest, largest = max(average // 4, HASHED), 8 * average
    found, start = [], 0
    for text in texts:
        own, at, last = [], start, start + len(text)
        while at < last:
            near = bisect_left(wished, at + smallest)
            end = min(wished[near] if near < len(wished) else last, at + largest, last)
            while not begins[end]:
                end -= 1
            own.append(end - start)
            at = end
        found.append(own)
        start = last
    return found


@dataclass(frozen=True)
class Coded:
    """Ids of some bytes; the byte at which each begins, and the end; which of these places begin a word."""

    ids: np.ndarray
    at: np.ndarray
    word: np.ndarray

    def first_at(self, byte: int) -> int:
        """The number of the id that begins at ``byte`` or after it."""
        return int(self.at.searchsorted(byte))

    def words(self, low: int, high: int) -> np.ndarray:
        """Bytes from ``low`` to ``high`` at which words begin."""
        part = slice(self.first_at(low), self.first_at(high + 1))
        return self.at[part][self.word[part]]


class Encoder:
    """The tokenizer of a file, with the byte length of each id and a bounded memory of words and chunks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        if any(len(token.encode()) > MARGIN for token in self.special):
            raise ValueError(f"a special token is longer than {MARGIN} bytes")
        self.pieces = id_bytes(self.tokenizer)
        self.lengths = np.array([len(piece) for piece in self.pieces], dtype=np.int64)
        self.words: dict[str, bytes] = {}
        self.recurring: set[str] = set()
        self.known: dict[bytes, Coded] = {}
        self.gears = _gears()

    def coded(self, parts: list[bytes]) -> list[Coded]:
        """Each distinct word goes to the tokenizer once while it is remembered; parts with odd characters go whole."""
        texts = [part.decode() for part in parts]
        cut = [None if self._goes_whole(text) else WORDS.findall(text) for text in texts]
        seen = set().union(*filter(None, cut))
        missing = list(seen.difference(self.words))
        self.recurring |= seen.difference(missing)
        self._remember(missing)
        each = list(map(self.words.__getitem__, chain.from_iterable(words or () for words in cut)))
        ids = np.frombuffer(b"".join(each), np.uint32)
        ends = np.zeros(len(each) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, each), np.int64, len(each)) >> 2, out=ends[1:])
        begins = np.zeros(len(ids) + 1, bool)
        begins[ends] = True
        at = self._places(ids)
        last = ends[np.cumsum([0, *(len(words or ()) for words in cut)])].tolist()
        return [
            self._coded_whole(text) if words is None else Coded(ids[low:high], at[low : high + 1] - at[low], begins[low : high + 1])
            for text, words, low, high in zip(texts, cut, last, last[1:], strict=False)
        ]

    def _remember(self, words: list[str]) -> None:
        """Words of a space and letters are cut apart again in a text of many of them; others are texts of their own."""
        plain = [word for word in words if PLAIN.fullmatch(word)]
        for start in range(0, len(plain), 1000):
            part = plain[start : start + 1000]
            one = self.tokenizer.encode("".join(part), add_special_tokens=False)
            ids = np.array(one.ids, dtype=np.uint32).tobytes()
            bounds = (4 * np.nonzero(np.diff(np.array([*one.word_ids, -1], dtype=np.int64), prepend=-1))[0]).tolist()
            self.words.update(zip(part, (ids[low:high] for low, high in zip(bounds, bounds[1:], strict=False)), strict=True))
        rest = [word for word in words if word not in self.words]
        for word, one in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.words[word] = np.array(one.ids, dtype=np.uint32).tobytes()

    def _coded_whole(self, text: str) -> Coded:
        one = self.tokenizer.encode(text, add_special_tokens=False)
        begins = np.diff(np.array([*one.word_ids, -1], dtype=np.int64), prepend=-1) != 0
        return self.from_ids(np.array(one.ids, dtype=np.uint32), begins)

    def _places(self, ids: np.ndarray) -> np.ndarray:
        at = np.zeros(len(ids) + 1, np.int64)
        self.lengths.take(ids).cumsum(out=at[1:])
        return at

    def _goes_whole(self, text: str) -> bool:
        return ODD.search(text) is not None or any(token in text for token in self.special)

    def from_ids(self, ids: np.ndarray, begins: np.ndarray) -> Coded:
        return Coded(ids, self._places(ids), begins)

    def chunks(self, keys: list[bytes], parts: list[bytes]) -> list[Coded]:
        """Of each chunk, encoded unless it is known."""
        missing = {key: part for key, part in zip(keys, parts, strict=True) if key not in self.known}
        self.known.update(zip(missing, self.coded(list(missing.values())), strict=True))
        return [self.known[key] for key in keys]

    def forget(self) -> None:
        """Called between blocks, whose chunks the memory has to hold. Words that were met again stay longer."""
        if len(self.known) > REMEMBERED_CHUNKS:
            self.known.clear()
        if len(self.words) > REMEMBERED_WORDS:
            again = self.recurring if len(self.recurring) < REMEMBERED_WORDS // 2 else ()
            self.words, self.recurring = {word: self.words[word] for word in again}, set()

    def joined(self, text: bytes, ends: list[int], chunks: list[Coded], windows: list[Coded]) -> np.ndarray:
        """The ids of a text from those of its chunks; ``windows`` are the first tries around its inner cuts."""
        starts = [0, *ends]
        found, at, number = [], 0, 0  # all ids before byte ``at`` are found, a word begins there in chunk ``number``
        while number < len(chunks):
            chunk, start = chunks[number], starts[number]
            if number == len(chunks) - 1:
                found.append(chunk.ids[chunk.first_at(at - start) :])
                break
            leave = last_sure_word(chunk, start, ends[number])
            if leave < at:  # the words found so far reach beyond what is sure in this chunk
                leave, window = at, None
            else:
                window = windows[number]
            found.append(chunk.ids[chunk.first_at(at - start) : chunk.first_at(leave - start)])
            reach = window_end(text, ends[number])
            while True:
                window = window or self.coded([text[leave:reach]])[0]
                sure = len(text) if reach == len(text) else reach - MARGIN
                at, number = self._agreement(window, leave, sure, starts, ends, chunks, number + 1)
                if at >= 0:
                    break
                number -= 1
                if reach == len(text):
                    at, number = len(text), len(chunks)
                    break
                reach, window = whole_character(text, min(len(text), reach + 2 * (reach - leave))), None
            found.append(window.ids[: window.first_at(at - leave)])
        return np.concatenate(found) if found else np.zeros(0, np.uint32)

    def _agreement(self, window: Coded, leave: int, sure: int, starts: list[int], ends: list[int], chunks: list[Coded], number: int) -> tuple[int, int]:
        """The first byte from chunk ``number`` on where a word of the window and of a chunk begin, or -1; and the chunk."""
        for other in range(number, len(chunks)):
            start = starts[other]
            if start > sure:
                break
            theirs = set((chunks[other].words(0, sure - start) + start).tolist())
            for at in (window.words(start - leave, min(sure, ends[other] - 1) - leave) + leave).tolist():
                if at in theirs:
                    return at, other
        return -1, number


def last_sure_word(chunk: Coded, start: int, end: int) -> int:
    """The last byte at which a word begins in the chunk, whatever follows the chunk."""
    words = chunk.words(0, end - start - MARGIN)
    return start + (int(words[-1]) if len(words) else 0)


def whole_character(text: bytes, end: int) -> int:
    while end < len(text) and text[end] & 0xC0 == 0x80:
        end += 1
    return end


def window_end(text: bytes, cut: int) -> int:
    return whole_character(text, min(len(text), cut + 3 * MARGIN))


def id_bytes(tokenizer) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary, whose printable stand-ins follow from the byte values."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    pieces = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
        pieces[number] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    for number, token in tokenizer.get_added_tokens_decoder().items():
        pieces[number] = token.content.encode()
    return pieces


def _vocabulary(path: str) -> list[bytes]:
    from tokenizers import Tokenizer

    return id_bytes(Tokenizer.from_file(path))


def in_this_process(path: str, make=Encoder):
    """One encoder or vocabulary per worker process; it is kept with the tokenizers module, as this one travels with each task."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_chunk_encoders", {})
    name = (path, make.__name__)
    if name not in kept:
        kept[name] = make(path)
    return kept[name]


def _key(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=KEY_BYTES).digest()


def _chunked(texts: list[bytes], average: int, gears: np.ndarray) -> list[tuple[list[int], list[bytes], list[bytes]]]:
    """Ends, keys and bytes of the chunks of each text."""
    found = []
    for text, ends in zip(texts, cuts(texts, average, gears), strict=True):
        parts = [text[low:high] for low, high in zip([0, *ends], ends, strict=False)]
        found.append((ends, list(map(_key, parts)), parts))
    return found


def _blocks(block_bytes: int):
    """Documents of a partition in compressed blocks of about ``block_bytes``; a longer text is a block of its own."""

    def pack(batches):
        number, held, size = TaskContext.get().partitionId() << 33, [], 0

        def block():
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(held)
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))) as writer:
                writer.write_table(table)
            payload = pa.array([sink.getvalue().to_pybytes()], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), payload], names=["block", "payload"])

        for batch in batches:
            lengths = np.array([len(text) for text in utf8(batch.column("text"))], dtype=np.int64)
            start = 0
            while start < len(lengths):
                rows = max(1, int(np.searchsorted(lengths[start:].cumsum(), block_bytes - size, side="right")))
                if size and size + int(lengths[start]) > block_bytes:
                    yield block()
                    number, held, size = number + 1, [], 0
                    continue
                held.append(batch.slice(start, rows))
                size += int(lengths[start : start + rows].sum())
                start += rows
        if held:
            yield block()

    return pack


def _documents(payload) -> pa.Table:
    with pa.ipc.open_stream(payload.as_buffer()) as reader:
        return reader.read_all()


def _texts(payload) -> list[bytes]:
    return [text for chunk in _documents(payload).column("text").chunks for text in utf8(chunk)]


def _keys(average: int):
    """The distinct chunks of each block."""

    def keys(batches):
        gears = _gears()
        for batch in batches:
            for block, payload in zip(batch.column("block"), batch.column("payload"), strict=True):
                found = pa.array(list({key for _, keys, _ in _chunked(_texts(payload), average, gears) for key in keys}), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()] * len(found), pa.int64()), found], names=["block", "key"])

    return keys


def _owned(path: str, average: int):
    """Ids of the chunks that a block encodes for others, with a bit for each that begins a word, and one for the end."""

    def encode(batches):
        encoder = in_this_process(path)
        for batch in batches:
            for payload, wanted in zip(batch.column("payload"), batch.column("owned"), strict=True):
                if not wanted.is_valid:
                    continue
                wanted, parts = set(wanted.as_py()), {}
                for _, keys, own in _chunked(_texts(payload), average, encoder.gears):
                    parts.update((key, part) for key, part in zip(keys, own, strict=True) if key in wanted)
                coded = encoder.chunks(list(parts), list(parts.values()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(parts), pa.binary()), pa.array([one.ids.tobytes() for one in coded], pa.binary()),
                        pa.array([np.packbits(one.word).tobytes() for one in coded], pa.binary()),
                    ],
                    names=["key", "ids", "words"],
                )
                encoder.forget()

    return encode


def _encoded(path: str, average: int, decode: bool):
    """Ids of the documents of a block, with the ids of the chunks that come from elsewhere."""

    def encode(batches):
        encoder = in_this_process(path)
        for batch in batches:
            for payload, shared in zip(batch.column("payload"), batch.column("shared"), strict=True):
                for one in shared.as_py() or ():
                    ids = np.frombuffer(one["ids"], "<u4")
                    encoder.known[one["key"]] = encoder.from_ids(ids, np.unpackbits(np.frombuffer(one["words"], np.uint8), count=len(ids) + 1).view(bool))
                for part in _documents(payload).to_batches():
                    for start in range(0, part.num_rows, 64):
                        rows = part.slice(start, 64)
                        ids = texts_coded(encoder, utf8(rows.column("text")), average)
                        columns = {"doc_id": rows.column("doc_id"), "ids": pa.array([one.astype("<u4").tobytes() for one in ids], pa.binary())}
                        if decode:
                            columns["decoded"] = pa.array([text_of(one, encoder.pieces) for one in ids], pa.string())
                        yield pa.RecordBatch.from_pydict(columns)
                encoder.forget()

    return encode


def texts_coded(encoder: Encoder, texts: list[bytes], average: int) -> list[np.ndarray]:
    """Ids of whole texts. All cuts are joined together; texts of which a first window doesn't do are joined one by one."""
    chunked = _chunked(texts, average, encoder.gears)
    chunks = encoder.chunks([k for _, keys, _ in chunked for k in keys], [p for _, _, parts in chunked for p in parts])
    sizes = [len(ends) for ends, _, _ in chunked]
    if not chunks:
        return [np.zeros(0, np.uint32) for _ in texts]
    whole = b"".join(texts)
    text_end = np.repeat(np.cumsum([len(text) for text in texts]), sizes)
    starts = np.concatenate([[0], np.cumsum([chunk.at[-1] for chunk in chunks])])
    inner = np.nonzero(starts[1:] < text_end)[0]  # chunks that a cut follows
    cut, after, text_end = starts[inner + 1], starts[inner + 2], text_end[inner]
    tokens = np.concatenate([[0], np.cumsum([len(chunk.ids) for chunk in chunks])])
    ids, at, word = _laid_out(chunks, starts[:-1])
    words = at[word]
    leave = words[np.searchsorted(words, cut - MARGIN, side="right") - 1]
    reach = np.minimum(cut + 3 * MARGIN, text_end)
    letters = np.append(np.frombuffer(whole, np.uint8), 0)
    for _ in range(3):  # to the end of a character
        reach += (reach < text_end) & (letters[reach] & 0xC0 == 0x80)
    windows = encoder.coded([whole[low:high] for low, high in zip(leave.tolist(), reach.tolist(), strict=True)])
    first = np.concatenate([[0], np.cumsum([len(window.ids) for window in windows])]).astype(np.int64)
    own_ids, own_at, own_word = _laid_out(windows, leave)
    own = np.repeat(np.arange(len(windows)), np.diff(first))
    sure = np.where(reach == text_end, text_end, reach - MARGIN)
    may = np.nonzero(own_word & (own_at >= cut[own]) & (own_at <= sure[own]) & (own_at < after[own]))[0]
    may = may[words[np.minimum(np.searchsorted(words, own_at[may]), len(words) - 1)] == own_at[may]]
    agreed, nearest = np.unique(own[may], return_index=True)
    meet, until = np.full(len(inner), -1), np.zeros(len(inner), np.int64)
    meet[agreed], until[agreed] = own_at[may[nearest]], may[nearest]
    next_leave = np.append(leave[1:], len(whole))
    done = (meet >= 0) & ((after == text_end) | (meet <= next_leave))
    gone, back = np.searchsorted(at, leave).tolist(), np.searchsorted(at, meet).tolist()
    first, until, found, number, join = first.tolist(), until.tolist(), [], 0, 0
    for text, (ends, _, _), size in zip(texts, chunked, sizes, strict=True):
        joins = range(join, join + max(size - 1, 0))
        if not done[joins.start : joins.stop].all():
            found.append(encoder.joined(text, ends, chunks[number : number + size], windows[joins.start : joins.stop]))
        else:
            parts, now = [], tokens[number]
            for j in joins:
                parts += [ids[now : gone[j]], own_ids[first[j] : until[j]]]
                now = back[j]
            found.append(np.concatenate([*parts, ids[now : tokens[number + size]]]))
        number, join = number + size, joins.stop
    return found


def _laid_out(coded: list[Coded], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids in a row, where they begin if their parts begin at ``starts``, and which of them begin a word."""
    if not coded:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, bool)
    at = np.concatenate([one.at[:-1] for one in coded]) + np.repeat(starts, [len(one.ids) for one in coded])
    return np.concatenate([one.ids for one in coded]), at, np.concatenate([one.word[:-1] for one in coded])


def text_of(ids: np.ndarray, pieces: list[bytes]) -> str:
    return b"".join(map(pieces.__getitem__, ids.tolist())).decode(errors="replace")


def encoded(docs: DataFrame, path: str, average: int = 1024, block_bytes: int = 1 << 22, decode: bool = False) -> DataFrame:
    """``doc_id, ids`` of ``docs(doc_id, text)``: little-endian unsigned 32-bit ids of every whole text by the tokenizer of ``path``.

    The ids are those the tokenizer gives the whole text without adding special tokens; a special token that stands in the
    text is one id. Null texts count as empty and have none; repeated rows and null ids stay; an empty table gives none.
    Other columns of ``docs`` are left out. With ``decode`` the ids are turned back in the same pass, as ``decoded``.

    Documents travel in compressed blocks of ``block_bytes`` of text, or one text. First only keys of chunks are
    counted, each once a block, so a chunk in a third of all documents has a row a block. The first block that holds a
    shared chunk encodes it. All steps read one shuffle of the blocks. A block gets the ids of its own distinct chunks, so no task holds more than a block and
    its ids. Keys depend on content alone: a block that is read again after a lost executor has the same chunks, and
    whatever it isn't handed it encodes itself.
    """
    parts = max(docs.rdd.getNumPartitions(), docs.sparkSession.sparkContext.defaultParallelism)
    packed = docs.select("doc_id", "text").mapInArrow(_blocks(block_bytes), "block long NOT NULL, payload binary").repartition(parts, "block")
    occurring = packed.mapInArrow(_keys(average), "block long NOT NULL, key binary NOT NULL").repartition(parts, "key")
    owners = occurring.groupBy("key").agg(F.min("block").alias("owner"), F.count("*").alias("blocks")).where("blocks > 1")
    owned = owners.withColumnRenamed("owner", "block").repartition(parts, "block").groupBy("block").agg(F.collect_list("key").alias("owned"))
    once = packed.join(owned, "block", "left").select("payload", "owned").mapInArrow(_owned(path, average), "key binary NOT NULL, ids binary, words binary")
    found = occurring.join(once, "key").repartition(parts, "block")
    handed = found.groupBy("block").agg(F.collect_list(F.struct("key", "ids", "words")).alias("shared"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary" + ", decoded string" * decode
    return packed.join(handed, "block", "left").select("payload", "shared").mapInArrow(_encoded(path, average, decode), schema)


def decoded(path: str, ids: Column) -> Column:
    """The text of ids as ``encoded`` gives them, special tokens included; bytes that are no text become U+FFFD."""

    @F.arrow_udf(StringType())
    def decode(values: pa.Array) -> pa.Array:
        pieces = in_this_process(path, _vocabulary)
        return pa.array(
            [None if v is None else text_of(np.frombuffer(v, "<u4"), pieces) for v in values.to_pylist()], pa.string()
        )

    return decode(ids)
