"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

Every partition packs its own pieces best-fit. Nearly full sequences are final. Underfull ones become items of the next
round, in which fewer partitions pack what is left over of several, as few at last as can hold it.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docklake.llm.common import stored
from docklake.llm.tokens import in_this_process

MEMBERS = ("doc_id", "piece", "start", "length", "ids_crc32")
KINDS = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
SCHEMA = "sequence_id long, fill int, final boolean, " + ", ".join(
    f"{name} array<{'int' if name == 'piece' else 'bigint'}>" for name in (*MEMBERS, "offset")
)
END = np.array([1], dtype="<u4").tobytes()


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """The bin of each item and the number of bins, by best-fit of the items in descending size.

    An item goes to the fullest bin that holds it. Bins are kept by what they have left; a bit for each amount that
    occurs makes the smallest sufficient one a matter of a shift.
    """
    bins = np.zeros(len(sizes), dtype=np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    amounts, count = 0, 0
    order = np.argsort(-sizes, kind="stable")
    for item, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        enough = amounts >> size
        if enough:
            left = size + (enough & -enough).bit_length() - 1
            chosen = waiting[left].pop()
            if not waiting[left]:
                amounts ^= 1 << left
        else:
            left, chosen, count = capacity, count, count + 1
        bins[item] = chosen
        left -= size
        if left:
            if not waiting[left]:
                amounts |= 1 << left
            waiting[left].append(chosen)
    return bins, count


def _packed(columns: dict[str, pa.Array], owner: np.ndarray, sizes: np.ndarray, capacity: int, slack: int, last: bool, first: int):
    """Batches of sequences: ``columns`` hold the members, ``owner`` the item of each, ``sizes`` the tokens of each item."""
    bins, count = best_fit(sizes, capacity)
    fill = np.bincount(bins, sizes, count).astype(np.int64)
    open_ = fill < capacity - slack
    if last:
        open_[:] = False
    member_bin = bins[owner]
    order = np.argsort(member_bin, kind="stable")
    lengths = columns["length"].to_numpy()[order]
    before = np.concatenate([[0], lengths.cumsum()])
    ends = np.searchsorted(member_bin[order], np.arange(count + 1))
    offset = before[:-1] - np.repeat(before[ends[:-1]], np.diff(ends))
    taken = {name: column.take(pa.array(order)) for name, column in columns.items()} | {"offset": pa.array(offset.astype(np.int64))}
    step = 512
    for start in range(0, count, step):
        stop = min(start + step, count)
        low, high = int(ends[start]), int(ends[stop])
        at = pa.array((ends[start : stop + 1] - low).astype(np.int32))
        lists = [pa.ListArray.from_arrays(at, taken[name].slice(low, high - low)) for name in (*MEMBERS, "offset")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(first + np.arange(start, stop)), pa.array(fill[start:stop].astype(np.int32)), pa.array(~open_[start:stop]), *lists],
            names=["sequence_id", "fill", "final", *MEMBERS, "offset"],
        )


def _first_number(level: int) -> int:
    """Numbers of this task's sequences start here; rounds and partitions have ranges of their own."""
    return (level << 56) | (TaskContext.get().partitionId() << 32)


def _pieces_of(batches, tokenizer: str, capacity: int):
    """The pieces of this partition's documents as numpy columns."""
    words = in_this_process(tokenizer)
    ids, numbers, starts, lengths, sums = [], [], [], [], []
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            texts = [text or "" for text in part.column("text").to_pylist()]
            for doc_id, tokens in zip(part.column("doc_id").to_pylist(), words.ids(texts), strict=True):
                tokens += END
                n = len(tokens) // 4
                for piece, at in enumerate(range(0, n, capacity)):
                    length = min(capacity, n - at)
                    ids.append(doc_id)
                    numbers.append(piece)
                    starts.append(at)
                    lengths.append(length)
                    sums.append(zlib.crc32(tokens[4 * at : 4 * (at + length)]))
    return {name: pa.array(values, kind) for name, values, kind in zip(MEMBERS, (ids, numbers, starts, lengths, sums), KINDS, strict=True)}


def _first_round(tokenizer: str, capacity: int, slack: int):
    def pack(batches):
        columns = _pieces_of(batches, tokenizer, capacity)
        sizes = columns["length"].to_numpy()
        if len(sizes):
            yield from _packed(columns, np.arange(len(sizes)), sizes, capacity, slack, False, _first_number(0))

    return pack


def _next_round(level: int, capacity: int, slack: int, last: bool):
    def pack(batches):
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        lists = {name: table.column(name).combine_chunks() for name in MEMBERS}
        counts = pc.list_value_length(lists["length"]).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(table.num_rows), counts)
        columns = {name: pc.list_flatten(values) for name, values in lists.items()}
        sizes = table.column("fill").to_numpy().astype(np.int64)
        yield from _packed(columns, owner, sizes, capacity, slack, last, _first_number(level))

    return pack


def packed(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, slack: int = 8, fan_in: int = 8, task_items: int = 100_000,
) -> DataFrame:
    """One row per piece of a document: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``docs(doc_id, text)`` are tokenised by the file ``tokenizer`` and ended by id 1; only documents of more than
    ``capacity`` tokens are cut. Null texts count as empty (one token, the end); null and repeated ids stay as they are,
    each row is packed. An empty table gives none.

    Texts do not leave their partition: only lengths and check sums do. A sequence within ``slack`` tokens of
    ``capacity`` is final; every other one goes on as an item. A round has a task for ``fan_in`` of the round before, or as
    many as hold ``task_items`` items each, dealt at random, if that is more. The last round is the one after which
    fewer tasks would not do: of one task, or of tasks that each have a fair sample of all sizes. Each round is a table
    in the shared scratch folder: a lost executor costs the tasks it ran.
    """
    rounds = [stored(docs.select("doc_id", "text").mapInArrow(_first_round(tokenizer, capacity, slack), SCHEMA), "packed")]
    width, last = len(rounds[0].inputFiles()), False
    while not last:
        rest = rounds[-1].where("not final")
        needed = max(-(-rest.count() // task_items), 1)
        last = width <= needed * fan_in
        width = needed if last else -(-width // fan_in)
        rounds.append(stored(rest.repartition(width).mapInArrow(_next_round(len(rounds), capacity, slack, last), SCHEMA), "packed"))
    final = [frame.where("final") for frame in rounds[:-1]] + [rounds[-1]]
    sequences = reduce(DataFrame.unionByName, final)
    members = F.explode(F.arrays_zip(*MEMBERS, "offset")).alias("member")
    return sequences.select("sequence_id", members).select(*(f"member.{name}" for name in MEMBERS), "sequence_id", "member.offset")
