"""Exact substring deduplication with difference-cover anchors.

A word is removed where it lies in a window of ``WINDOW`` words whose sequence starts somewhere else too. Windows are not hashed at all positions:
anchors of ``WINDOW - period + 1`` words are, at positions whose remainder lies in a difference cover of the period. For any two
positions some shift below the period brings both onto the cover, so two equal windows hold two equal anchors at the same
shift. Anchors that occur once in the corpus end the search there; around the others the match is extended to the whole windows, which are
compared by hash in a second exchange.

Results: null text has no words. Windows are judged on the input. Repeated rows count as other occurrences of each other, and
each yields a row. Extra columns are ignored. An anchor is asked by 40 bits beside those of its shard, a window by 56: a wrong
removal needs both to collide. Null and empty texts have no words and keep an empty text; an empty table gives no rows; extra columns may have any name.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import MESSAGES, REPLIES, Words, among, answered, block_count, blocked, first, repeat_answers, repeat_questions, repeated, shard_bits

WINDOW = 35
# Perfect difference sets by period.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
ANCHOR_BYTES, WINDOW_BYTES = 5, 7


def cover(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest known period that leaves anchors of at least two fifths of the window; each position is its own cover below that."""
    fits = [p for p in COVERS if (window - p + 1) * 5 >= window * 2]
    return (max(fits), COVERS[max(fits)]) if fits else (1, (0,))


def _anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the anchors and their positions."""
    period, residues = cover(window)
    size = window - period + 1
    at = np.flatnonzero(np.isin(words.offsets() % period, residues) & words.fits(size))
    return words.windows(size)[at], at


def _candidates(words: Words, window: int, anchors: np.ndarray, at: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Starts of windows that hold a repeated anchor at a shift below the period."""
    period, _ = cover(window)
    sums = np.zeros(len(words.ids) + period + 1, np.int32)
    hit = np.zeros(len(words.ids) + period, np.int32)
    hit[at[among(anchors, known)]] = 1
    np.cumsum(hit, out=sums[1:])
    n = len(words.ids)
    return np.flatnonzero((sums[period : period + n] > sums[:n]) & words.fits(window))


def _ask(table: pa.Table, window: int, bits: int) -> pa.Table:
    words = Words(table.column("text").to_pylist(), lower=False)
    return repeat_questions(first(table, "block"), _anchors(words, window)[0], bits, ANCHOR_BYTES)[1]


def _extend(table: pa.Table, got: dict[int, bytes], window: int, bits: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """The block's words, its candidate windows and their hashes, once the anchors are answered."""
    words = Words(table.column("text").to_pylist(), lower=False)
    anchors, at = _anchors(words, window)
    starts = _candidates(words, window, anchors, at, repeated(np.unique(anchors), got, bits))
    return words, starts, words.windows(window)[starts]


def mark(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the words that stay, joined by one space) of every row."""
    n = block_count(docs, text_col)
    bits = shard_bits(n)
    source = blocked(docs, id_col, text_col, n)
    blocks = source.groupBy("block")

    def windows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return repeat_questions(0, np.zeros(0, np.uint64), bits, WINDOW_BYTES)[1]
        return repeat_questions(first(left, "block"), _extend(left, answered(right), window, bits)[2], bits, WINDOW_BYTES)[1]

    def result(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = left.column("text").to_pylist()
        anchor, whole = (answered(right.filter(pc.equal(right.column("round"), i))) for i in (1, 2))
        n_words, n_removed, kept = [], [], []
        if texts:
            words, starts, hashes = _extend(left, anchor, window, bits)
            again = starts[among(hashes, repeated(np.unique(hashes), whole, bits))]
            edges = np.zeros(len(words.ids) + 1, np.int32)
            np.add.at(edges, again, 1)
            np.add.at(edges, again + window, -1)
            stays = np.cumsum(edges[:-1]) == 0
            n_words = words.lengths.tolist()
            bounds = words.starts.tolist()
            for t, a, b in zip(texts, bounds, bounds[1:], strict=False):
                mask = stays[a:b]
                own, n = (t or b"").split(), int(mask.sum())
                n_removed.append(b - a - n)
                kept.append(b" ".join(own if n == b - a else list(compress(own, mask.tolist()))))
        return pa.table({
            "doc_id": left.column("doc_id").cast(pa.int64()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), "kept": pa.array([k.decode("utf-8", "replace") for k in kept], pa.string()),
        })

    anchor_replies = blocks.applyInArrow(lambda t: _ask(t, window, bits), MESSAGES).groupBy("shard").applyInArrow(lambda t: repeat_answers(t, ANCHOR_BYTES), REPLIES)
    window_messages = blocks.cogroup(anchor_replies.groupBy("block")).applyInArrow(windows, MESSAGES)
    window_replies = window_messages.groupBy("shard").applyInArrow(lambda t: repeat_answers(t, WINDOW_BYTES), REPLIES)
    both = anchor_replies.withColumn("round", F.lit(1)).unionByName(window_replies.withColumn("round", F.lit(2)))
    return blocks.cogroup(both.groupBy("block")).applyInArrow(result, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
