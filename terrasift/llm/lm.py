"""Language-model scores of whole texts from Elias-Fano tries over the n-grams of all training texts.

Words are lower-cased in A-Z; each text ends in an end token, which also stands before its first word. The model interpolates bigrams with
the add-one unigrams by absolute discounting: P(w|v) = max(c(vw) - D, 0) / c(v) + D * successors(v) / c(v) * P(w), and P(w) where v is unknown.
The bigrams of all training texts are counted without pruning. Their counts meet in shards by context; a context of more than
``SPLIT`` tokens is spread over several shards by successor. Each shard builds one trie with its quantised probabilities and answers the blocks.

Results: null text is the empty text, one end token. Repeated rows count each. Without training texts all counts are 0. Probabilities of seen bigrams
are exact up to the quantisation (steps of a 25th of a power of ten, see ``trie``). Extra columns are ignored, whatever their names. Words are told apart by 56 bits of their hash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import MESSAGES, NAMED_BLOCKS, Words, answered, block_count, block_names, blocked, expand, first, messages, mix, parts, rest, shard_bits, squeeze
from .trie import WORD_BITS, Trie, restore

DISCOUNT = 0.75
#: Training tokens of a context per shard that shares it.
SPLIT = 1 << 18
END = b"\n"
KEY_BYTES = 7
SUCCESSOR_BYTES = WORD_BITS // 8
REPLY = "block int, shard int, reply binary, n long, v long, round int"


def held_out(doc_id: int | None, modulus: int = 7, remainder: int = 2) -> bool:
    return zlib.crc32(str(doc_id).encode()) % modulus == remainder


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<u4").tobytes(), 1)


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<u4")


class _Block:
    """Words of a block, which of its tokens are for training, and its distinct words by hash."""

    def __init__(self, table: pa.Table) -> None:
        self.ids = table.column("doc_id").to_pylist()
        self.words = w = Words(table.column("text").to_pylist(), lower=True, end=END)
        self.held = np.array([held_out(i) for i in self.ids], bool)
        self.train = np.repeat(~self.held, w.lengths)
        self.order = np.argsort(w.hashes)
        self.keys = w.hashes[self.order]
        self.end = w.words.index(END)

    def unigrams(self) -> np.ndarray:
        """Training counts in key order."""
        return np.bincount(self.words.ids[self.train], minlength=len(self.keys))[self.order]

    def totals(self, got: dict[int, bytes], bits: int) -> np.ndarray:
        """Corpus counts by word id out of the answers."""
        out = np.zeros(len(self.keys), np.int64)
        for shard, a, b in parts(self.keys, bits):
            out[self.order[a:b]] = _counts(got[shard])
        return out

    def bigrams(self, totals: np.ndarray, bits: int) -> dict[str, np.ndarray]:
        """Distinct bigrams whose first word occurs in training, by shard, context and successor; where each token's bigram went.

        A context that several shards share is put to all of them, so that its successors are counted whole.
        """
        w, h = self.words.ids, self.words.hashes
        v = np.concatenate([[self.end], w[:-1]])
        # Words by rank of their context key and of their hash, so that one sort of pairs gives the order of the messages.
        context = mix(h)
        by_context = np.argsort(context)
        ranks = np.empty((2, len(h)), np.int64)
        ranks[0, by_context] = ranks[1, self.order] = np.arange(len(h))
        code, inverse = np.unique(ranks[0][v] << 32 | ranks[1][w], return_inverse=True)
        count = np.append(np.bincount(inverse[self.train], minlength=len(code)), 0)
        asked = np.flatnonzero(totals[by_context[code >> 32]] > 0)
        shares = np.minimum(totals // SPLIT + 1, 1 << bits)
        successor = h[self.order[code[asked] & 0xFFFFFFFF]] >> np.uint64(64 - WORD_BITS)
        cv = by_context[code[asked] >> 32]
        share = mix(successor) % shares[cv].astype(np.uint64)
        shared = np.unique(cv[shares[cv] > 1])
        if len(shared):
            each = np.repeat(shared, shares[shared])
            order = np.argsort(np.concatenate([code[asked], ranks[0][each] << 32 | 0xFFFFFFFF]), kind="stable")
            asked = np.concatenate([asked, np.full(len(each), len(code))])[order]
            share = np.concatenate([share, *[np.arange(k, dtype=np.uint64) for k in shares[shared].tolist()]])[order]
            successor = np.concatenate([successor, np.full(len(each), (1 << WORD_BITS) - 1, np.uint64)])[order]
            cv = np.concatenate([cv, each])[order]
        shard = ((context[cv] >> np.uint64(64 - bits)) + share) & np.uint64((1 << bits) - 1)
        order = np.argsort(shard.astype(np.uint16) if bits <= 16 else shard, kind="stable")
        cv, asked = cv[order], asked[order]
        return {"asked": asked, "shard": shard[order].astype(np.int64), "context": context[cv], "successor": successor[order], "word": cv, "count": count[asked], "inverse": inverse, "size": len(code)}

    def runs(self, g: dict[str, np.ndarray]):
        """(shard, start, end, starts of its contexts) of the ordered bigrams."""
        cuts = np.flatnonzero(np.diff(g["shard"])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(g["shard"])], strict=True):
            if a < b:
                yield int(g["shard"][a]), a, b, a + np.concatenate([[0], np.flatnonzero(np.diff(g["context"][a:b])) + 1])


def _ask_unigrams(table: pa.Table, bits: int) -> pa.Table:
    block = _Block(table)
    counts, kept = block.unigrams(), rest(block.keys, bits, KEY_BYTES)
    return messages(first(table, "block"), [(s, squeeze(kept[a:b], KEY_BYTES), _packed(counts[a:b])) for s, a, b in parts(block.keys, bits)])


def _reply_table(shard: int, rows: list[tuple[int, bytes | None]], n: int, v: int, round_: int) -> pa.Table:
    k = len(rows)
    arrays = [pa.array([r[0] for r in rows], pa.int32()), pa.array([shard] * k, pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([n] * k, pa.int64()), pa.array([v] * k, pa.int64()), pa.array([round_] * k, pa.int32())]
    return pa.table(dict(zip(("block", "shard", "reply", "n", "v", "round"), arrays, strict=True)))


def _answer_unigrams(table: pa.Table) -> pa.Table:
    """Counts by key; and one row (block -1) with the shard's number of tokens and of words seen in training."""
    asked = [expand(k, KEY_BYTES) for k in table.column("keys").to_pylist()]
    counts = np.concatenate([_counts(e) for e in table.column("extra").to_pylist()])
    known, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.bincount(inverse, weights=counts, minlength=len(known)).astype(np.int64)
    at, rows = 0, [(-1, None)]
    for block, keys in zip(table.column("block").to_pylist(), asked, strict=True):
        rows.append((block, _packed(total[inverse[at : at + len(keys)]])))
        at += len(keys)
    return _reply_table(first(table, "shard"), rows, int(total.sum()), int((total > 0).sum()), 1)


def _ask_bigrams(left: pa.Table, right: pa.Table, bits: int) -> pa.Table:
    if not left.num_rows:
        return messages(0, [])
    block = _Block(left)
    totals = block.totals(answered(right), bits)
    g = block.bigrams(totals, bits)
    rows = []
    for shard, a, b, starts in block.runs(g):
        sizes = np.diff(np.append(starts, b))
        head = b"".join(len(x).to_bytes(4, "little") + x for x in (squeeze(g["context"][starts], 8), _packed(sizes), _packed(totals[g["word"][starts]]), _packed(g["count"][a:b])))
        rows.append((shard, squeeze(g["successor"][a:b], SUCCESSOR_BYTES), head))
    return messages(first(left, "block"), rows)


def _fields(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        out.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return out


def _answer_bigrams(table: pa.Table) -> pa.Table:
    """Builds the shard's trie from the counts of all blocks and answers with codes and branching numbers."""
    asked = []
    for keys, extra in zip(table.column("keys").to_pylist(), table.column("extra").to_pylist(), strict=True):
        context, sizes, total, count = _fields(extra)
        asked.append((expand(context, 8), _counts(sizes).astype(np.int64), _counts(total), expand(keys, SUCCESSOR_BYTES), _counts(count)))
    every = np.concatenate([a[0] for a in asked])
    contexts, at = np.unique(every, return_inverse=True)
    total = np.zeros(len(contexts), np.int64)
    total[at] = np.concatenate([a[2] for a in asked])
    count = np.concatenate([a[4] for a in asked])
    seen = np.flatnonzero(count)
    words, word = np.unique(np.concatenate([a[3] for a in asked])[seen], return_inverse=True)
    # Context and word numbers in one integer: both are below the number of entries of the shard.
    key = np.repeat(at, np.concatenate([a[1] for a in asked]))[seen] * max(1, len(words)) + word
    order = np.argsort(key)
    key, count = key[order], count[seen][order].astype(np.int64)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    summed = np.add.reduceat(count, starts) if len(starts) else np.zeros(0, np.int64)
    number, word = np.divmod(key[starts], max(1, len(words)))
    trie = Trie(contexts, words, number, word, (summed - DISCOUNT) / np.maximum(total[number], 1))
    del key, order, count, every
    rows = []
    for block, (c, s, _, w, _) in zip(table.column("block").to_pylist(), asked, strict=True):
        branching, codes = _packed(trie.branching(c)), zlib.compress(trie.lookup(c, s, w).tobytes(), 1)
        rows.append((block, len(branching).to_bytes(4, "little") + branching + codes))
    return _reply_table(first(table, "shard"), rows, 0, 0, 2)


def _score(left: pa.Table, right: pa.Table, bits: int) -> pa.Table:
    columns: dict[str, list] = {k: [] for k in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")}
    if left.num_rows:
        block = _Block(left)
        got = {i: right.filter(pc.equal(right.column("round"), i)) for i in (0, 1, 2)}
        n_train, n_words = (first(got[0], c) for c in ("n", "v"))
        totals = block.totals(answered(got[1]), bits)
        base = (totals + 1) / (n_train + n_words + 1)
        g, codes = block.bigrams(totals, bits), answered(got[2])
        branching = np.zeros(len(totals), np.int64)
        p = np.zeros(g["size"] + 1)
        for shard, a, b, starts in block.runs(g):
            head = codes[shard]
            k = 4 + int.from_bytes(head[:4], "little")
            np.add.at(branching, g["word"][starts], _counts(head[4:k]))
            p[g["asked"][a:b]] = restore(np.frombuffer(zlib.decompress(head[k:]), np.uint8))
        w = block.words.ids
        v = np.concatenate([[block.end], w[:-1]])
        seen = np.maximum(totals, 1)
        back = np.where(totals > 0, np.minimum(1.0, DISCOUNT * branching / seen), 1.0)
        log_p = np.log10(p[g["inverse"]] + back[v] * base[w])
        starts = block.words.starts[:-1]
        add = lambda x: np.add.reduceat(x, starts)
        columns = {
            "doc_id": block.ids, "held_out": block.held.tolist(), "n_tokens": block.words.lengths, "n_known": add((totals[w] > 0).astype(np.int64)),
            "train_tokens": [n_train] * left.num_rows, "base_score": add(np.log10(base)[w]), "score": add(log_p),
        }
    types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(columns.items(), types, strict=True)})


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    n_blocks = block_count(docs, text_col)
    bits = shard_bits(n_blocks)
    blocks = blocked(docs, id_col, text_col, n_blocks).groupBy("block")
    one = blocks.applyInArrow(lambda t: _ask_unigrams(t, bits), MESSAGES).groupBy("shard").applyInArrow(_answer_unigrams, REPLY)
    two = (
        blocks.cogroup(one.where("block >= 0").groupBy("block"))
        .applyInArrow(lambda a, b: _ask_bigrams(a, b, bits), MESSAGES)
        .groupBy("shard")
        .applyInArrow(_answer_bigrams, REPLY)
    )
    # The corpus totals: one row for each block.
    totals = one.where("block < 0").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).where("n IS NOT NULL")
    totals = totals.select(F.explode(F.array(*map(F.lit, block_names(n_blocks))) if n_blocks <= NAMED_BLOCKS else F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(0).alias("shard"), F.lit(None).cast("binary").alias("reply"), "n", "v", F.lit(0).alias("round"))
    replies = one.where("block >= 0").unionByName(two).unionByName(totals)
    return blocks.cogroup(replies.groupBy("block")).applyInArrow(lambda a, b: _score(a, b, bits), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
