"""Token ids of whole texts by a public tokenizer file, with the words of a text looked up in a bounded memory."""

from __future__ import annotations

import os
import re

import numpy as np

# Texts of these characters are cut by the pattern below exactly as the tokenizer cuts them: composing changes none of
# them, lower-casing works character by character, and both see the same white space among them.
ODD = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
CUT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+")
REMEMBERED = 400_000


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


class WordTokenizer:
    """Ids of texts as little-endian unsigned 32-bit numbers, for a tokenizer file that lower-cases, drops white space and
    treats words, single digits and runs of other characters apart.

    Each distinct word goes to the tokenizer once while it is remembered. Texts with other characters or with the
    string of a special token go to it whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        cut = [None if self._goes_whole(text) else CUT.findall(text.lower()) for text in texts]
        missing = list(set().union(*filter(None, cut)).difference(self.known))
        for start in range(0, len(missing), 1000):
            part = missing[start : start + 1000]
            self.known.update(zip(part, self._words(part), strict=True))
        look = self.known.__getitem__
        found = [
            _packed(self.tokenizer.encode(text, add_special_tokens=False).ids) if words is None else b"".join(map(look, words))
            for text, words in zip(texts, cut, strict=True)
        ]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return found

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, from one text of all of them where the tokenizer sees the same words in it."""
        joined = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        owner = np.array(joined.word_ids, dtype=np.int64)
        bounds = np.nonzero(np.diff(owner, prepend=-1))[0]
        if len(bounds) != len(words):
            return [_packed(one.ids) for one in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        packed = _packed(joined.ids)
        ends = [*(4 * bounds).tolist(), len(packed)]
        return [packed[low:high] for low, high in zip(ends[:-1], ends[1:], strict=True)]

    def _goes_whole(self, text: str) -> bool:
        return ODD.search(text) is not None or any(token in text for token in self.special)


def in_this_process(path: str) -> WordTokenizer:
    """One tokenizer per worker process; it is kept with the tokenizers module, as this one travels with each task."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_word_tokenizers", {})
    if path not in kept:
        kept[path] = WordTokenizer(path)
    return kept[path]
