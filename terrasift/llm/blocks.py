"""Documents in bounded blocks, and exchanges of keys between blocks and shards.

A block holds the documents of one hash class and is sized by measured bytes. Its words become integers once and everything
else is array work. What a block must learn about the whole corpus it asks by key: each block sends its distinct keys,
sorted and packed, to the shards that own them; a shard answers in the order of the question. A key held by every document
thus meets its shard once per block, whatever its frequency, and no group of rows grows with the number of copies.

Both sides are recomputed from their inputs if an executor is lost.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let_go

#: Text bytes of a block.
BLOCK_BYTES = 18 << 20
MESSAGES = "shard int, block int, keys binary, extra binary"
REPLIES = "block int, shard int, reply binary"

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def block_count(docs: DataFrame, text_col: str) -> int:
    """Number of blocks of about ``BLOCK_BYTES`` that hold the texts, by their measured length."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")) + 16).alias("n")).first()[0] or 0
    return max(1, -(-int(size) // BLOCK_BYTES))


def _hash_of_int(values: np.ndarray) -> np.ndarray:
    """The engine's hash of 32-bit integers (Murmur3, seed 42), by which it deals rows to partitions."""
    rotate = lambda x, k: (x << np.uint32(k)) | (x >> np.uint32(32 - k))
    with np.errstate(over="ignore"):
        h = np.uint32(42) ^ (rotate(values.astype(np.uint32) * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593))
        h = (rotate(h, 13) * np.uint32(5) + np.uint32(0xE6546B64)) ^ np.uint32(4)
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        return (h ^ (h >> np.uint32(16))).view(np.int32)


#: Most blocks that get names of their own choice; beyond it blocks fall on partitions by chance, a few on each.
NAMED_BLOCKS = 10_000


def block_names(n: int) -> list[int]:
    """Names of n blocks that the engine deals to n different partitions, one each, so no task has several blocks."""
    if n > NAMED_BLOCKS:
        return list(range(n))
    out, found, start = np.full(n, -1, np.int64), 0, 0
    while found < n:
        tried = np.arange(start, start + 8 * n + 64)
        place, first_ = np.unique(_hash_of_int(tried) % n, return_index=True)
        free = out[place] < 0
        out[place[free]] = tried[first_[free]]
        found, start = int((out >= 0).sum()), start + len(tried)
    return out.tolist()


def blocked(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(block, doc_id, text as UTF-8) in n blocks, partitioned by block. Rows are dealt by id and text, so neither null nor repeated ids pile up."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")
    name = F.element_at(F.array(*map(F.lit, block_names(n))), number + 1) if 1 < n <= NAMED_BLOCKS else number
    return rows.select(name.cast("int").alias("block"), "doc_id", "text").repartition(n, "block")


def shard_bits(n: int) -> int:
    """log2 of the number of shards beside n blocks."""
    return max(2, (2 * n - 1).bit_length())


class Words:
    """The words of some texts: ids (flat), starts (of each text, and the end), and the distinct words with 64-bit hashes."""

    def __init__(self, texts: list[bytes | None], lower: bool, end: bytes | None = None) -> None:
        import xxhash

        let_go()
        ids, starts, known = array("i"), array("q", [0]), defaultdict(count().__next__)
        last = [end] if end is not None else []
        get = known.__getitem__
        for t in texts:
            ids.extend(map(get, ((t or b"").lower() if lower else t or b"").split() + last))
            starts.append(len(ids))
        self.ids = np.frombuffer(ids, np.int32) if len(ids) else np.zeros(0, np.int32)
        self.starts = np.frombuffer(starts, np.int64)
        self.words = list(known)
        digest = xxhash.xxh64_intdigest
        self.hashes = np.fromiter(map(digest, self.words), np.uint64, len(self.words))
        if end is not None and end in known:
            self.hashes[known[end]] = np.uint64(digest(b"\0end"))

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)

    def windows(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each position of the flat array, 0 where there are too few; windows may cross texts."""
        n = len(self.ids)
        out = np.zeros(n, np.uint64)
        if n >= size:
            with np.errstate(over="ignore"):
                powers = np.multiply.accumulate(np.full(n, _BASE, np.uint64))
                sums = np.zeros(n + 1, np.uint64)
                np.cumsum(self.hashes[self.ids] * powers, out=sums[1:])
                del powers
                back = np.multiply.accumulate(np.full(n - size + 1, _INVERSE, np.uint64))
                out[: n - size + 1] = mix((sums[size:] - sums[: n - size + 1]) * back + np.uint64(size))
        return out

    def fits(self, size: int) -> np.ndarray:
        """Positions from which ``size`` words lie in the same text."""
        ends = np.repeat(self.starts[1:], self.lengths)
        return np.arange(len(self.ids)) + size <= ends

    def offsets(self) -> np.ndarray:
        """Position of each word in its text."""
        return np.arange(len(self.ids)) - np.repeat(self.starts[:-1], self.lengths)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def squeeze(values: np.ndarray, width: int) -> bytes:
    """The ``width`` low bytes of each value."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def expand(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").reshape(-1)


def rest(keys: np.ndarray, bits: int, width: int) -> np.ndarray:
    """What is left of keys inside their shard, cut to ``width`` bytes."""
    return (keys << np.uint64(bits)) >> np.uint64(64 - 8 * width)


def parts(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(shard, start, end) of sorted keys, for shards that get any."""
    shards = (keys >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(shards)) + 1
    bounds = [0, *cuts.tolist(), len(keys)] if len(keys) else [0]
    for a, b in zip(bounds, bounds[1:], strict=False):
        yield int(shards[a]), a, b


def messages(block: int, rows: list[tuple[int, bytes, bytes | None]]) -> pa.Table:
    """(shard, keys, extra) of one block as message rows."""
    return pa.table({
        "shard": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([block] * len(rows), pa.int32()),
        "keys": pa.array([r[1] for r in rows], pa.binary()), "extra": pa.array([r[2] for r in rows], pa.binary()),
    })


def replies(shard: int, rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({
        "block": pa.array([r[0] for r in rows], pa.int32()), "shard": pa.array([shard] * len(rows), pa.int32()), "reply": pa.array([r[1] for r in rows], pa.binary()),
    })


def first(table: pa.Table, column: str) -> int:
    return table.column(column)[0].as_py()


def answered(table: pa.Table) -> dict[int, bytes]:
    """Replies to a block, by shard."""
    return dict(zip(table.column("shard").to_pylist(), table.column("reply").to_pylist(), strict=True))


def repeat_questions(block: int, keys: np.ndarray, bits: int, width: int) -> tuple[np.ndarray, pa.Table]:
    """Messages that ask whether keys occur twice in the corpus. Gives the sorted distinct keys too."""
    known, counts = np.unique(keys, return_counts=True)
    kept = rest(known, bits, width)
    return known, messages(block, [(s, squeeze(kept[a:b], width), np.packbits(counts[a:b] > 1).tobytes()) for s, a, b in parts(known, bits)])


def repeat_answers(table: pa.Table, width: int) -> pa.Table:
    """A shard's answer: one bit per key of each message, set where the key came twice."""
    asked = [expand(k, width) for k in table.column("keys").to_pylist()]
    sizes = [len(a) for a in asked]
    twice = [np.unpackbits(np.frombuffer(e, np.uint8), count=n).astype(bool) for e, n in zip(table.column("extra").to_pylist(), sizes, strict=True)]
    every, flag = np.concatenate(asked), np.concatenate(twice)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(every), bool)
    again[1:] |= same
    again[:-1] |= same
    flag[order] |= again
    at, out = 0, []
    for block, n in zip(table.column("block").to_pylist(), sizes, strict=True):
        out.append((block, np.packbits(flag[at : at + n]).tobytes()))
        at += n
    return replies(first(table, "shard"), out)


def repeated(known: np.ndarray, got: dict[int, bytes], bits: int) -> np.ndarray:
    """Of sorted distinct keys, those whose answer bit is set."""
    flags = np.zeros(len(known), bool)
    for shard, a, b in parts(known, bits):
        flags[a:b] = np.unpackbits(np.frombuffer(got[shard], np.uint8), count=b - a)
    return known[flags]


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Membership in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values
