"""Fill-in-middle transformation: texts are cut in three at token boundaries found by ranks in a wavelet matrix.

Every character has a class: a line break, other white space, a character inside a word, or the last one of a word. The
classes of many texts together are one wavelet matrix. Ranks of classes at the ends of a text combine into its number of
tokens or lines, and a bisection on ranks finds the place of a boundary, for all texts at once.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docklake.llm.common import free_name
from docklake.llm.wavelet import WaveletMatrix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
LINE_BREAK, BLANK, IN_WORD, WORD_END = 0, 1, 2, 3
CLOSING = {"token": (WORD_END,), "line": (LINE_BREAK,)}  # the classes whose characters close a unit
BLOCK_CHARS = 1 << 21


@dataclass(frozen=True)
class Cuts:
    """Per text: its units, and the characters of prefix and of prefix and middle."""

    units: np.ndarray
    first: np.ndarray
    second: np.ndarray


def character_classes(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of every code point of texts that begin at ``starts``."""
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    word_after = np.zeros(len(codes) + 1, bool)
    word_after[:-1] = ~blank
    word_after[starts] = False  # a word ends with its text
    return np.where(blank, np.where(codes == 10, LINE_BREAK, BLANK), np.where(word_after[1:], IN_WORD, WORD_END)).astype(np.uint8)


def cut(texts: list[str], draws: np.ndarray, boundary: str = "token") -> Cuts:
    """Cuts after ``draws[:, 0] % (units + 1)`` and ``draws[:, 1] % (units + 1)`` units of each text, the smaller first."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(text) for text in texts], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    matrix = WaveletMatrix(character_classes(codes, starts), 2)
    closing = CLOSING[boundary]
    before = matrix.joint_rank(closing, starts)
    closed = matrix.joint_rank(closing, ends) - before
    # What follows the last closed unit is a unit of its own: white space, or a line without its break.
    last = matrix.joint_select(closing, before + closed, starts, ends)
    units = closed + (last < ends)
    wished = np.sort(draws.astype(np.int64) % (units + 1)[:, None], axis=1)
    places = [np.where(own > closed, ends, matrix.joint_select(closing, before + own, starts, ends)) - starts for own in wished.T]
    return Cuts(units, *places)


def draws_of(ids: list, seed: int) -> np.ndarray:
    """Four unsigned 32-bit numbers for each id, from the SHA-256 of seed and id; a null id counts as empty."""
    digests = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(digests, ">u4").reshape(-1, 4)


def rendered(text: str, form: str, first: int, second: int) -> str:
    if form == "psm":
        return f"{PREFIX}{text[:first]}{SUFFIX}{text[second:]}{MIDDLE}{text[first:second]}"
    if form == "spm":
        return f"{SUFFIX}{text[second:]}{PREFIX}{text[:first]}{MIDDLE}{text[first:second]}"
    return text


def restored(output: str, form: str) -> str:
    """The text that ``rendered`` made ``output`` from; texts that hold a marker are plain, so each marker is found once."""
    if form == "plain":
        return output
    leading, inner = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    one, _, rest = output.removeprefix(leading).partition(inner)
    other, _, middle = rest.partition(MIDDLE)
    return one + middle + other if form == "psm" else other + middle + one


def _forms(texts: list[str], draws: np.ndarray, rate: int, spm_share: int) -> list[str]:
    return [
        "plain" if not text or h3 % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE))
        else "spm" if h4 % 100 < spm_share else "psm"
        for text, h3, h4 in zip(texts, draws[:, 2].tolist(), draws[:, 3].tolist(), strict=True)
    ]


def _blocks(texts: list[str]):
    """Slices of ``BLOCK_CHARS`` characters or one text."""
    start, held = 0, 0
    for at, text in enumerate(texts):
        if held and held + len(text) > BLOCK_CHARS:
            yield slice(start, at)
            start, held = at, 0
        held += len(text)
    if texts:
        yield slice(start, len(texts))


def transformed(docs: DataFrame, seed: int = 42, rate: int = 50, spm_share: int = 80, boundary: str = "token") -> DataFrame:
    """``docs(doc_id, text, ...)`` with ``units, form, prefix_chars, middle_chars, output, restored`` of every whole text.

    Of 100 texts about ``rate`` are cut in three after whole tokens (``boundary="line"``: lines) and written with
    markers, ``spm_share`` of 100 of those with the suffix first; draws depend on ``seed`` and ``doc_id`` only, so
    repeated rows have equal results. Empty texts and texts that hold a marker stay plain, their character counts are
    null. A null text counts as empty, a null id as an empty one. Columns of these names move on under longer ones. No
    row leaves its partition; a task holds the classes of ``BLOCK_CHARS`` characters or one text.
    """
    names = ["units", "form", "prefix_chars", "middle_chars", "output", "restored"]
    for name in names:
        if name in docs.columns:
            docs = docs.withColumnRenamed(name, free_name(docs, name))
    kinds = ["long", "string", "long", "long", "string", "string"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{n} {k}" for n, k in zip(names, kinds, strict=True)])

    def transform(batches):
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            draws = draws_of(batch.column("doc_id").to_pylist(), seed)
            for part in _blocks(texts):
                yield _rows(batch.slice(part.start, part.stop - part.start), texts[part], draws[part])

    def _rows(batch, texts, draws):
        cuts = cut(texts, draws[:, :2], boundary)
        forms = _forms(texts, draws, rate, spm_share)
        outputs = [rendered(*one) for one in zip(texts, forms, cuts.first.tolist(), cuts.second.tolist(), strict=True)]
        plain = np.array([form == "plain" for form in forms])
        added = [
            pa.array(cuts.units), pa.array(forms, pa.string()), pa.array(cuts.first, mask=plain), pa.array(cuts.second - cuts.first, mask=plain),
            pa.array(outputs, pa.string()), pa.array([restored(*one) for one in zip(outputs, forms, strict=True)], pa.string()),
        ]
        return pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *names])

    return docs.mapInArrow(transform, schema)


ORACLE = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents),
drawn AS (
    SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
        CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (len(units) + 1) AS c1,
        CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (len(units) + 1) AS c2,
        CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 AS h4
    FROM cut),
formed AS (
    SELECT doc_id, text, n,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 50 THEN 'plain'
            WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(units[1:least(c1, c2)], '') AS prefix, array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
        array_to_string(units[greatest(c1, c2) + 1:], '') AS suffix
    FROM drawn)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM formed
"""
