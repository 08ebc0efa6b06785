"""A wavelet matrix in numpy: ranks and selections of symbols in a long sequence, for many queries at once."""

from __future__ import annotations

import numpy as np

WORD = 64


class Bits:
    """A bit vector with ranks in constant time: packed words and the ones before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // WORD) * WORD, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.zeros = len(bits) - int(ones.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        word, rest = at // WORD, (at % WORD).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low).astype(np.int64)


class WaveletMatrix:
    """Symbols from 0 to ``2 ** levels - 1``; the highest bit is on the first level, zeros go before ones on the next."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.size, self.levels, self.bits = len(symbols), levels, []
        for level in range(levels - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.bits.append(Bits(bit))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` is among the first ``at`` symbols."""
        low, high = np.zeros_like(at), at
        for level, bits in zip(range(self.levels - 1, -1, -1), self.bits, strict=True):
            if symbol >> level & 1:
                low, high = bits.zeros + bits.rank(low), bits.zeros + bits.rank(high)
            else:
                low, high = low - bits.rank(low), high - bits.rank(high)
        return high - low

    def joint_rank(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols are any of ``symbols``."""
        return sum((self.rank(symbol, at) for symbol in symbols), np.zeros_like(at))

    def joint_select(self, symbols: tuple[int, ...], count: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest position with a joint rank of ``count`` or more, by bisection between ``low`` and ``high``."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) // 2
            reached = self.joint_rank(symbols, middle) >= count
            high = np.where(open_ & reached, middle, high)
            low = np.where(open_ & ~reached, middle + 1, low)
        return low
