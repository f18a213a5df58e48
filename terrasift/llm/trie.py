"""Elias-Fano n-gram tries: monotone levels in memory-mapped buffers, searched by successor.

A level of m sorted values below u keeps the low bits of each value in whole bytes and the high bits as unary gaps in a bit
vector, packed, with one count for every 64 bits to find the run of equal high bits. Contexts form the first level, their bounds in the successor level (the pointers)
another, the distinct successor words a third, and the successors of all contexts the last: a successor is stored relative to its context, as context number
times the number of words plus its word's number, which makes the whole level monotone. Numbers are exact; two words are told apart by
``WORD_BITS`` bits of their hash. Each successor has a quantised probability of one byte.

The buffers are anonymous memory maps, or files of a folder that is given.
"""

from __future__ import annotations

import mmap
from pathlib import Path

import numpy as np

#: Bits of a word's hash that a successor is asked with.
WORD_BITS = 56
#: Steps of a quantised probability per power of ten; the last code stands for "not there".
STEPS = 25
ABSENT = 255

_BYTE = np.arange(256, dtype=np.uint8)
_ONES = np.unpackbits(_BYTE[:, None], axis=1, bitorder="little")
_COUNT = _ONES.sum(axis=1).astype(np.uint8)
#: Place of the k-th set bit of a byte.
_PLACE = np.argsort(1 - _ONES, axis=1, kind="stable").astype(np.uint8)


def quantise(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(p) * STEPS), 0, ABSENT - 1).astype(np.uint8)


def restore(codes: np.ndarray) -> np.ndarray:
    """Probabilities of codes; 0 for "not there"."""
    table = 10.0 ** (-np.arange(256) / STEPS)
    table[ABSENT] = 0
    return table[codes]


def _mapped(folder: Path | None, name: str, values: np.ndarray) -> np.ndarray:
    """The values in a memory map: a file of the folder, or an anonymous one."""
    if not values.size:
        return values
    if folder is not None:
        values.tofile(folder / name)
        return np.memmap(folder / name, values.dtype, "r", shape=values.shape)
    buffer = mmap.mmap(-1, values.nbytes)
    out = np.frombuffer(buffer, values.dtype).reshape(values.shape)
    out[...] = values
    return out


class EliasFano:
    """A sorted level: ``low`` bytes, ``high`` bits in 64-bit words, and the number of zeros before each word."""

    def __init__(self, values: np.ndarray, folder: Path | None = None, name: str = "level") -> None:
        self.n = n = len(values)
        self.low_bytes = min(7, -(-max(0, (int(values[-1]) // n).bit_length()) // 8)) if n else 0
        self.runs = int(values[-1] >> np.uint64(8 * self.low_bytes)) + 1 if n else 0
        self.low = _mapped(folder, f"{name}.low", np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : self.low_bytes]))
        bits = np.zeros(-(-(n + self.runs) // 64) * 64, np.uint8)
        bits[(values >> np.uint64(8 * self.low_bytes)).astype(np.int64) + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little")
        ones = np.concatenate([[0], np.cumsum(bits.reshape(-1, 64).sum(axis=1, dtype=np.int64))])[:-1] if n else np.zeros(0, np.int64)
        self.high = _mapped(folder, f"{name}.high", high)
        self.ones = _mapped(folder, f"{name}.ones", ones.astype(np.uint32 if n < 1 << 32 else np.uint64))

    def _select(self, index: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the one (or zero) with this number in the bit vector."""
        before = self.ones.astype(np.int64)
        if not ones:
            before = 64 * np.arange(len(before)) - before
        word = np.searchsorted(before, index, "right") - 1
        rest = index - before[word]
        data = self.high.reshape(-1, 8)[word]
        if not ones:
            data = ~data
        sums = np.cumsum(_COUNT[data], axis=1, dtype=np.uint8)
        byte = (sums <= rest[:, None]).sum(axis=1)
        rows = np.arange(len(index))
        rest = rest - np.where(byte > 0, sums[rows, byte - 1], 0)
        return 64 * word + 8 * byte + _PLACE[data[rows, byte], rest]

    def _start(self, run: np.ndarray) -> np.ndarray:
        """Number of values before a run of equal high bits."""
        out = np.full(len(run), self.n, np.int64)
        out[run <= 0] = 0
        inside = np.flatnonzero((run > 0) & (run < self.runs))
        if len(inside):
            out[inside] = self._select(run[inside] - 1, False) - (run[inside] - 1)
        return out

    def _low(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), 8), np.uint8)
        out[:, : self.low_bytes] = self.low[at]
        return out.view("<u8").reshape(-1)

    def at(self, index: np.ndarray) -> np.ndarray:
        """Values by position."""
        high = self._select(index, True) - index
        return (high.astype(np.uint64) << np.uint64(8 * self.low_bytes)) | self._low(index)

    def _search(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position of the first stored value that isn't smaller, the end of the run it was looked for in, and the low bits."""
        shift = np.uint64(8 * self.low_bytes)
        run = np.minimum(values >> shift, np.uint64(self.runs)).astype(np.int64)
        low = values & np.uint64((1 << int(shift)) - 1)
        a = self._start(run)
        end = self._start(run + 1)
        b = end.copy()
        open_ = np.flatnonzero(a < b)
        while len(open_):
            mid = (a[open_] + b[open_]) // 2
            less = self._low(mid) < low[open_]
            a[open_[less]] = mid[less] + 1
            b[open_[~less]] = mid[~less]
            open_ = open_[a[open_] < b[open_]]
        return a, end, low

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Position of the first stored value that isn't smaller: the run of equal high bits, then its low bits by halving."""
        return self._search(values)[0] if self.n else np.zeros(len(values), np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Positions of the values, -1 where they aren't stored."""
        if not self.n:
            return np.full(len(values), -1, np.int64)
        at, end, low = self._search(values)
        return np.where((at < end) & (self._low(np.minimum(at, self.n - 1)) == low), at, -1)


class Trie:
    """Two-level trie of contexts and successors with quantised probabilities."""

    def __init__(self, contexts: np.ndarray, words: np.ndarray, context_of: np.ndarray, word_of: np.ndarray, p: np.ndarray, folder: Path | None = None) -> None:
        """contexts and words: sorted keys; then one entry per n-gram with the numbers of its context and word, sorted by both."""
        if len(contexts) * max(1, len(words)) >> 63:
            raise ValueError("too many contexts for one shard; use more shards")
        self.n_words = np.uint64(max(1, len(words)))
        bounds = np.searchsorted(context_of, np.arange(len(contexts) + 1))
        keys = context_of.astype(np.uint64) * self.n_words + word_of.astype(np.uint64)
        parts = {"contexts": contexts, "pointers": bounds.astype(np.uint64), "words": words, "successors": keys}
        self.levels = {k: EliasFano(v, folder, k) for k, v in parts.items()}
        self.codes = _mapped(folder, "codes", quantise(p))

    def branching(self, contexts: np.ndarray) -> np.ndarray:
        """Number of successors of each context."""
        at = self.levels["contexts"].find(contexts)
        known = np.flatnonzero(at >= 0)
        out = np.zeros(len(contexts), np.int64)
        if len(known):
            pointers = self.levels["pointers"]
            out[known] = (pointers.at(at[known] + 1) - pointers.at(at[known])).astype(np.int64)
        return out

    def lookup(self, contexts: np.ndarray, counts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Codes of n-grams: contexts with the number of their successors asked for, and these words."""
        at = np.repeat(self.levels["contexts"].find(contexts), counts)
        word = self.levels["words"].find(words)
        out = np.full(len(words), ABSENT, np.uint8)
        known = np.flatnonzero((at >= 0) & (word >= 0))
        pos = self.levels["successors"].find(at[known].astype(np.uint64) * self.n_words + word[known].astype(np.uint64))
        out[known[pos >= 0]] = self.codes[pos[pos >= 0]]
        return out
