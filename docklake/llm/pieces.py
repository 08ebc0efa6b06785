"""Sampled segmentations of texts into the pieces of a public SentencePiece file, without replacement, and back.

The segmentations of a text are the paths of a lattice. Gumbel top-k over all of them needs no enumeration: a search
keeps sets of paths (all that go on from one node, some edges left out) with the perturbed score of the best path in
them, which can be drawn before the path is known. The best set is followed to its end, which gives the next distinct
sample, and what branches off from that path are new sets. The exact mass of the paths behind each node is the bound
that makes this an A-star search without a wasted step.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SPACE = "▁"
# No piece crosses from letters to others, or from others to a space.
CHUNK = re.compile(r" *(?:[^\W\d_]+|(?:[^\w ]|[\d_])+)| +")
LETTER, FAR = re.compile(r"[^\W\d_]"), re.compile("[\U00010000-\U0010ffff]")
HASH_BASE = 0x9E3779B97F4A7C15
PLACE_BASE, DRAW_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
KEPT_NODES = 1_650_000  # of the lattices of words that are remembered


def _spelled_out(chunk: str = " *(?:[{}]+|[{}]+)| +") -> re.Pattern:
    """``CHUNK`` for texts without characters above U+FFFF: with all characters listed, which is looked up in a table."""
    spans: tuple[list, list] = ([], [])
    for char in filter(" ".__ne__, map(chr, range(1 << 16))):
        own = spans[LETTER.match(char) is None]
        if own and ord(own[-1][1]) == ord(char) - 1:
            own[-1][1] = char
        else:
            own.append([char, char])
    return re.compile(chunk.format(*("".join(f"\\u{ord(first):04x}-\\u{ord(last):04x}" for first, last in own) for own in spans)))


NEAR_CHUNK = _spelled_out()


def _chunks(text: str) -> list[str]:
    return (NEAR_CHUNK if text.isascii() or FAR.search(text) is None else CHUNK).findall(" " + text) if text else []


class Roots(dict):
    """First nodes by chunk. A chunk that is not there is noted in ``met`` and gets the negative of its number for now."""

    def __init__(self):
        self.met: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.met.append(chunk)
        self[chunk] = -len(self.met)
        return self[chunk]


class Pieces:
    """Pieces of a file with probabilities by Zipf's law from their rank, and lattices of the words seen so far.

    A lattice has a node for each character; its edges are the pieces that begin there, the most probable first.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.byte: dict[int, int] = {}
        self.text: list[bytes] = []
        known: dict[str, int] = {}
        for number in range(model.vocab_size()):
            piece = model.id_to_piece(number)
            if model.is_byte(number):
                self.byte[int(piece[3:5], 16)] = number
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(number) or model.is_unknown(number):
                self.text.append(b"")
            else:
                known[piece] = number
                self.text.append(piece.encode())
        weight = 1.0 / (np.arange(1, len(known) + 2) + 2.7)
        log_p = np.log(weight / weight.sum())
        self.log_byte = float(log_p[-1])  # of one byte of a character that is no piece
        self.known = {piece: (number, float(p)) for (piece, number), p in zip(known.items(), log_p, strict=False)}
        self.one_byte = np.array([self.byte.get(b, 0) for b in range(128)])
        self.spaced = pa.array([text.replace(SPACE.encode(), b" ") for text in self.text], pa.large_binary())
        self.beginnings = self._beginnings()
        self.root = Roots()
        self.nodes = self.edges = 0
        size = 1 << 16
        self.first = np.zeros(size, np.int32)
        self.upto, self.log_p = np.empty(size), np.empty(size)  # cumulated probability within the node; log of the own one
        self.following, self.piece, self.source = (np.empty(size, np.int32) for _ in range(3))

    def _beginnings(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By length the hashes of all beginnings of pieces, sorted, with the piece that ends there (or -1) and its log
        probability."""
        found: list[dict[int, tuple[int, float]]] = [{} for _ in range(max(map(len, self.known)))]
        for piece, own in self.known.items():
            value = 0
            for n, char in enumerate(piece):
                value = (value * HASH_BASE + ord(char) + 1) % (1 << 64)
                if n + 1 == len(piece):
                    found[n][value] = own
                else:
                    found[n].setdefault(value, (-1, 0.0))
        tables = []
        for own in found:
            order = sorted(own)
            tables.append((np.array(order, np.uint64), np.array([own[x][0] for x in order]), np.array([own[x][1] for x in order])))
        return tables

    def _add(self, chunks: list[str]) -> dict[str, int]:
        """Appends the lattices of ``chunks``, all at once; their first nodes."""
        code = np.frombuffer("".join(chunks).replace(" ", SPACE).encode("utf-32-le"), "<u4").astype(np.uint64)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        last = sizes.cumsum()
        end_of = np.repeat(last, sizes)
        at, value = np.arange(len(code)), np.zeros(len(code), np.uint64)
        start, stop, piece, log_p = [], [], [], []
        for n, (hashes, ids, p) in enumerate(self.beginnings, 1):
            inside = at + n <= end_of[at]
            at = at[inside]
            value = value[inside] * np.uint64(HASH_BASE) + code[at + n - 1] + np.uint64(1)
            where = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
            hit = hashes[where] == value
            own = at[hit & (ids[where] >= 0)]
            which = where[hit & (ids[where] >= 0)]
            if n == 1:  # characters that are no piece go on as bytes
                odd = np.setdiff1d(at, own)
                width = 1 + (code[odd] >= 0x80).astype(int) + (code[odd] >= 0x800) + (code[odd] >= 0x10000)
                start, stop, piece, log_p = [odd], [odd + 1], [np.where(width == 1, self.one_byte[np.minimum(code[odd], np.uint64(127)).astype(int)], -1 - code[odd].astype(np.int64))], [width * self.log_byte]
            start.append(own)
            stop.append(own + n)
            piece.append(ids[which])
            log_p.append(p[which])
            at, value = at[hit], value[hit]
        start, stop, piece, log_p = (np.concatenate(x) for x in (start, stop, piece, log_p))

        behind = np.zeros(len(code) + 1)  # log of the mass of all paths from a node to the end of its chunk
        left = end_of - np.arange(len(code))
        ends = stop == end_of[start]
        nodes = np.argsort(left * len(code) + np.arange(len(code)))
        rank = np.empty(len(code), np.int64)
        rank[nodes] = np.arange(len(code))
        order = np.argsort(rank[start] * len(start) + np.arange(len(start)))
        bounds = np.searchsorted(left[start[order]], np.arange(1, int(left.max(initial=0)) + 2))
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            own = order[low:high]
            x = log_p[own] + np.where(ends[own], 0.0, behind[stop[own]])
            nodes = start[own]
            first = np.nonzero(np.diff(nodes, prepend=-1))[0]
            nodes = nodes[first]
            top = np.maximum.reduceat(x, first)
            total = np.add.reduceat(np.exp(x - np.repeat(top, np.diff(np.append(first, len(x))))), first)
            behind[nodes] = top + np.log(total)
        log_p = log_p + np.where(ends, 0.0, behind[stop]) - behind[start]
        order = _by_node(start, log_p)
        start, stop, piece, log_p, ends = (x[order] for x in (start, stop, piece, log_p, ends))
        first = np.searchsorted(start, np.arange(len(code) + 1))
        upto = np.concatenate([[0.0], np.exp(log_p).cumsum()])
        upto = upto[1:] - np.repeat(upto[first[:-1]], np.diff(first))
        upto[first[1:] - 1] = 2.0
        node, edge = self.nodes, self.edges
        parts = (("first", first + edge, node), ("upto", upto, edge), ("log_p", log_p, edge), ("following", np.where(ends, -1, stop + node), edge), ("piece", piece, edge), ("source", start + node, edge))
        for name, values, where in parts:
            held = getattr(self, name)
            while where + len(values) > len(held):
                held = np.concatenate([held, np.empty_like(held)])
            held[where : where + len(values)] = values
            setattr(self, name, held)
        self.nodes, self.edges = node + len(code), edge + len(start)
        return dict(zip(chunks, (node + last - sizes).tolist(), strict=True))

    def roots_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The first nodes of the chunks of all texts, and how many chunks each text has.

        Lattices that don't fit in the memory stay until the next call.
        """
        if self.nodes > KEPT_NODES:
            self.nodes, self.edges = self.kept
        split = [_chunks(text) for text in texts]
        roots = self.root
        counts = np.array([len(chunks) for chunks in split], dtype=np.int64)
        found = np.fromiter(map(roots.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        if missing := roots.met:
            before = self.nodes, self.edges
            added = self._add(missing)
            nodes = np.fromiter(added.values(), np.int64, len(added))
            if self.nodes > KEPT_NODES:
                self.kept = before
                for chunk in missing:
                    del roots[chunk]
            else:
                roots.update(added)
            new = found < 0
            found[new] = nodes[-1 - found[new]]
            roots.met = []
        return found, counts

    def ids(self, edges: np.ndarray) -> np.ndarray:
        pieces = self.piece[edges]
        if (pieces >= 0).all():
            return pieces
        found: list[int] = []
        for piece in pieces.tolist():
            found += [piece] if piece >= 0 else [self.byte[b] for b in chr(-1 - piece).encode()]
        return np.array(found, dtype=np.int64)

    def decoded(self, ids: list[int]) -> str:
        """The text of the ids; bytes that form no character become replacement characters."""
        text = b"".join(map(self.text.__getitem__, ids)).decode(errors="replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text

    def give(self, ids: np.ndarray, last: np.ndarray, texts: list[str]) -> list[bool]:
        """Whether each stretch of ``ids`` decodes to its text; ``last`` holds where the stretches end.

        The bytes of all ids are put together at once. Equal ones need no more; others are decoded on their own.
        """
        joined = self.spaced.take(pa.array(ids))
        _, offsets, data = joined.buffers()
        ends = np.frombuffer(offsets, np.int64)[np.concatenate([[0], last])].tolist()
        result, known, coded = [], None, None
        for n, text in enumerate(texts):
            if text is not known:
                known, coded = text, pa.py_buffer(b" " + text.encode())
            size = ends[n + 1] - ends[n]
            same = size == coded.size and SPACE not in text and data.slice(ends[n], size).equals(coded)
            result.append(same or self.decoded(ids[last[n - 1] if n else 0 : last[n]].tolist()) == text)
        return result


def _by_node(start: np.ndarray, log_p: np.ndarray) -> np.ndarray:
    """``np.lexsort((-log_p, start))``, mostly by one whole number for both."""
    key = (start.astype(np.uint64) << np.uint64(32)) | np.maximum(-log_p, 0.0).astype(np.float32).view(np.uint32)
    order = np.argsort(key)
    tie = np.diff(key[order]) == 0
    if tie.any():
        place = np.nonzero(np.append(tie, False) | np.append(False, tie))[0]
        own = np.sort(order[place])
        order[place] = own[np.lexsort((-log_p[own], start[own]))]
    return order


def _uniform(seed: np.ndarray, draw: int | np.ndarray, place: np.ndarray | int) -> np.ndarray:
    """Numbers strictly between zero and one that depend on the three arguments only."""
    return _mixed(seed + np.asarray(place, dtype=np.uint64).reshape(-1) * PLACE_BASE + np.asarray(draw, dtype=np.uint64).reshape(-1) * DRAW_BASE)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The uniform numbers of whole ones, which are overwritten."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    x >>= np.uint64(12)
    uniform = x.astype(np.float64)
    uniform *= 2.0**-52
    uniform += 2.0**-53
    return uniform


def _below(mass: np.ndarray, bound: np.ndarray, uniform: np.ndarray) -> np.ndarray:
    """The greatest perturbed score of paths of log mass ``mass``, given that it is at most ``bound``."""
    return mass - np.log(np.exp(mass - bound) - np.log(uniform))


def _branching(ahead: np.ndarray, own: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Log mass of the paths that leave at each edge, and which edges can give one of the ``need`` greatest scores.

    ``ahead`` is the log probability of the path up to an edge, ``own`` that of the edge. A perturbation lies between -4 and
    37, as uniform numbers have 53 bits; so an edge whose mass is 45 below the ``need``-th greatest is out.
    """

    def masses(part: slice) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return ahead[part] + np.log1p(-np.minimum(np.exp(own[part]), 1.0))

    size = 64
    while True:
        mass = masses(slice(0, size))
        known = mass[mass > -np.inf]
        if len(known) >= need or size >= len(own):
            break
        size *= 4
    least = np.partition(known, len(known) - need)[len(known) - need] - 45.0 if len(known) >= need else -np.inf
    far = int(np.searchsorted(-ahead, -least, side="right")) if least > -np.inf else len(own)
    if far > size:
        mass = masses(slice(0, far))
    kept = np.nonzero((mass >= least) & (mass > -np.inf))[0]
    return mass[kept], kept


def sampled(pieces: Pieces, texts: list[str], seeds: np.ndarray, k: int) -> list[list[tuple[np.ndarray, float, float]]]:
    """Per text up to ``k`` distinct segmentations: ids, log probability and log inclusion probability.

    Samples come in descending perturbed score. The inclusion score is the probability of being among the samples given
    the score of the first one that is not. Texts with fewer segmentations give all of them, each with probability one.
    """
    roots, counts = pieces.roots_of(texts)
    starts = np.concatenate([[0], counts.cumsum()])
    owner = np.repeat(np.arange(len(texts)), counts)
    own_seed, own_place = seeds[owner], np.arange(len(owner)) - starts[owner]
    following, log_p = pieces.following, pieces.log_p
    score = -np.log(-np.log(_uniform(seeds, 0, 1)))
    heaps: list[list] = [[(-float(score[d]), 0, -1, 0, ())] for d in range(len(texts))]
    paths: list[list[tuple[np.ndarray, np.ndarray, float]]] = [[] for _ in texts]
    for number in range(k):
        # What is known of each text's next path: its perturbed score, and its edges up to where it branches off.
        live = np.array([d for d, heap in enumerate(heaps) if heap], dtype=np.int64)
        if not len(live):
            break
        bound, before = np.zeros(len(texts)), np.zeros(len(texts))
        begun: dict[int, tuple] = {}
        if number:
            chunks, states = [], []
            for d in live.tolist():
                taken, _, parent, at, without = heapq.heappop(heaps[d])
                edges, places, _ = paths[d][parent]
                node = pieces.source[edges[at]]
                left = np.arange(pieces.first[node], pieces.first[node + 1])
                for out in without:
                    left = left[left != out]
                share = np.exp(log_p[left]).cumsum()
                u = float(_uniform(seeds[d : d + 1], 3 * number + 1, at + 1)[0])
                chosen = min(int(np.searchsorted(share, u * share[-1], side="right")), len(left) - 1)
                edge, others = left[chosen], np.delete(left, chosen)
                bound[d], before[d] = -taken, float(log_p[edges[:at]].sum() + log_p[edge])
                begun[d] = np.append(edges[:at], edge), places[: at + 1], at, (*without, int(edge)), others
                rest = np.arange(places[at] + (following[edge] < 0), starts[d + 1])
                state = roots[rest].copy()
                if following[edge] >= 0:
                    state[0] = following[edge]
                chunks.append(rest)
                states.append(state)
            place, state = np.concatenate(chunks), np.concatenate(states)
        else:
            place, state = np.arange(len(roots)), roots
            for d, heap in enumerate(heaps):
                bound[d] = -heapq.heappop(heap)[0]
        place, edge = _walked(pieces, place, state, own_seed, own_place, 3 * number + 2)
        bounds = np.searchsorted(place, starts)

        own = log_p[edge]
        sums = np.concatenate([[0.0], own.cumsum()])
        need = k - number
        for d in live.tolist():
            low, high = int(bounds[d]), int(bounds[d + 1])
            total = float(sums[high] - sums[low] + before[d])
            edges, places, start = edge[low:high], place[low:high], 0
            if d in begun:
                old, old_places, at, without, others = begun[d]
                edges, places, start = np.concatenate([old, edges]), np.concatenate([old_places, places]), len(old)
                if len(others):
                    mass_left = np.array([float(log_p[old[:at]].sum()) + math.log(float(np.exp(log_p[others]).sum()))])
                    again = _below(mass_left, bound[d : d + 1], _uniform(seeds[d : d + 1], 3 * number + 3, 1))
                    heapq.heappush(heaps[d], (-float(again[0]), number, number, at, without))
            paths[d].append((edges, places, total))
            # The best path that leaves this one at each of its new edges, where it can be among those still needed.
            mass, kept = _branching(sums[low:high] - sums[low] + before[d], own[low:high], need)
            scores = _below(mass, bound[d : d + 1], _uniform(seeds[d : d + 1], 3 * number + 3, kept + start + 2))
            best = np.argpartition(-scores, need - 1)[:need] if len(scores) > need else np.arange(len(scores))
            for i, score in zip(kept[best].tolist(), scores[best].tolist(), strict=True):
                heapq.heappush(heaps[d], (-score, number, number, start + i, (int(edges[start + i]),)))
    result = []
    for heap, own in zip(heaps, paths, strict=True):
        threshold = -heap[0][0] if heap else -np.inf
        result.append([(pieces.ids(edges), p, _log_inclusion(p - threshold)) for edges, _, p in own])
    return result


def _walked(pieces: Pieces, place: np.ndarray, state: np.ndarray, seed: np.ndarray, number: np.ndarray, draw: int) -> tuple[np.ndarray, np.ndarray]:
    """A random path to the end of each chunk, from the node ``state``: chunks and edges in the order of the text."""
    at, found, steps = np.arange(len(place)), [], np.zeros(len(place), np.int64)
    # The number of a step is ``_uniform(seed[place], draw, number[place] * (1 << 20) + step)``.
    mixed = seed[place] + (number[place].astype(np.uint64) << np.uint64(20)) * PLACE_BASE + np.full(1, draw, np.uint64) * DRAW_BASE
    while len(at):
        u = _mixed(mixed.copy())
        edge = pieces.first[state]
        later = np.nonzero(u >= pieces.upto[edge])[0]
        while len(later):
            edge[later] += 1
            later = later[u[later] >= pieces.upto[edge[later]]]
        found.append((at, edge))
        steps[at] = len(found)
        state = pieces.following[edge]
        going = np.nonzero(state >= 0)[0]
        at, state, mixed = at[going], state[going], mixed[going]
        mixed += PLACE_BASE
    begin = steps.cumsum() - steps
    edges = np.empty(int(steps.sum()), np.int32)
    for step, (own, edge) in enumerate(found):
        edges[begin[own] + step] = edge
    return np.repeat(place, steps), edges


def _log_inclusion(x: float) -> float:
    """``log(1 - exp(-exp(x)))``."""
    if x > 3.0:
        return 0.0
    return float(np.log(-np.expm1(-np.exp(x)))) if x > -30.0 else float(x)


def in_this_process(path: str) -> Pieces:
    """The pieces of a file once per worker process, kept with the module that reads the file."""
    import sentencepiece

    kept = sentencepiece.__dict__.setdefault("_sampled_pieces", {})
    if path not in kept:
        kept[path] = Pieces(path)
    return kept[path]


def segmentations(docs: DataFrame, model: str, k: int = 2, seed: int = 0, with_ids: bool = True, check: bool = False) -> DataFrame:
    """Up to ``k`` rows per row of ``docs(doc_id, text)``: ``doc_id, sample, n_pieces, ids_crc32, log_probability,
    log_inclusion`` and, if asked for, ``ids``. With ``check`` every segmentation is decoded, and ``decoded_equal`` says
    whether that gives the text.

    Segmentations are distinct and drawn without replacement; draws depend on ``seed``, the id and the text
    only, so repeated rows get equal samples. A null text counts as empty and has one segmentation, the empty one. Null
    ids share a seed. The sum is over ids as little-endian unsigned 32-bit numbers. An empty table gives none. Whole texts
    are segmented; nothing is shuffled, and a task remembers lattices of a bounded number of words.
    """
    kinds = [("doc_id", pa.int64()), ("sample", pa.int32()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("log_probability", pa.float64()), ("log_inclusion", pa.float64())]
    kinds += [("ids", pa.list_(pa.int32()))] if with_ids else []
    kinds += [("decoded_equal", pa.bool_())] if check else []

    def draw(batches):
        pieces = in_this_process(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                seeds = part.column("seed").to_numpy().view(np.uint64)
                texts = [text or "" for text in part.column("text").to_pylist()]
                drawn = sampled(pieces, texts, seeds, k)
                rows = [(at, n, *own) for at, samples in enumerate(drawn) for n, own in enumerate(samples)]
                ids = [row[2].astype(np.int32, copy=False) for row in rows]
                flat, last = np.concatenate([np.empty(0, np.int32), *ids]), np.cumsum([len(own) for own in ids], dtype=np.int64)
                values = [
                    part.column("doc_id").take(pa.array([row[0] for row in rows], pa.int64())).cast(pa.int64()), [row[1] for row in rows], [len(own) for own in ids],
                    [zlib.crc32(own) for own in ids], [row[3] for row in rows], [row[4] for row in rows],
                ]
                values += [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], last]), pa.int32()), pa.array(flat))] if with_ids else []
                values += [pieces.give(flat, last, [texts[row[0]] for row in rows])] if check else []
                arrays = [value if isinstance(value, pa.Array) else pa.array(value, kind) for value, (_, kind) in zip(values, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in kinds])

    schema = "doc_id long, sample int, n_pieces long, ids_crc32 long, log_probability double, log_inclusion double"
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", F.lit(seed)).alias("seed"))
    return rows.mapInArrow(draw, schema + (", ids array<int>" if with_ids else "") + (", decoded_equal boolean" if check else ""))


def decoded(ids: Column, model: str) -> Column:
    """The text of an array of ids; null for null."""

    @F.arrow_udf(StringType())
    def decode(values: pa.Array) -> pa.Array:
        pieces = in_this_process(model)
        return pa.array([None if own is None else pieces.decoded(own) for own in values.to_pylist()], pa.string())

    return decode(ids)
