"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

A document's row of the incidence matrix is its set of word shingles. Columns are ordered by rising document frequency, counted over all
documents. A pair of similarity t must share a column among the first ``n - ceil(t n) + 1`` of either row (the size-derived bound), so only those entries
say which cells of the product can reach t, and only columns that more than one row holds. Rows of equal sets are one row from the start, and columns with equal rows one
column. Inside a column, cells of rows that a link already joins are not formed: first every row meets one pivot at a time, then what is left meets in
all pairs that sizes allow, in blocks of rows. The cells that stand are multiplied: their overlap counts add up over blocks of columns of the whole rows, and a cell goes as soon as
its count can't reach the bound that the two sizes ask for. No count is estimated.

Results: words are split at ASCII white space and lower-cased in A-Z. A text of fewer words than a shingle has is one shingle; null or wordless
texts have none and are linked with nothing. Rows of equal text share a component, repeated rows too. ``component_id`` is the smallest id reached;
null ids are passed over and a component of null ids only has null. Rows that share an id but not a text are judged by their own text. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..session import checkpointed, release
from .blocks import REPLIES, Words, answered, block_count, blocked, expand, first, mix, parts, replies, rest, shard_bits, squeeze
from .common import bounded, tidied, tidy, unused

SHINGLE = 5
#: Similarity in percent.
PERCENT = 80
SKETCH_BYTES, SET_BYTES = 4, 6
PIVOT_ROUNDS = 2
#: log2 of the blocks of columns that overlaps are summed over.
COLUMN_BITS = 3
#: Entries of the rows of pairs that are multiplied at once, about.
ENTRIES_AT_ONCE = 2_000_000
#: Rows of a column that one task takes; longer columns are dealt over several.
COLUMN_ROWS = 512
#: log2 of the parts of the hash range in which core sizes are compared.
PROFILE_BITS = 6
MESSAGES = "shard int, block int, keys binary, sets binary, ids binary"
_NO_ID = np.iinfo(np.int64).max


class _Block:
    """Sorted shingle sets of a block's rows, and one key for each set (0: no set)."""

    def __init__(self, table: pa.Table, size: int) -> None:
        ids = table.column("doc_id").to_pylist()
        self.ids = ids
        self.id_or_max = np.array([_NO_ID if i is None else i for i in ids], np.int64)
        words = Words(table.column("text").to_pylist(), lower=True)
        whole = words.windows(size)
        self.sets: list[np.ndarray] = []
        for a, b in zip(words.starts.tolist(), words.starts[1:].tolist(), strict=False):
            if b - a >= size:
                self.sets.append(np.unique(whole[a : b - size + 1]))
            elif b > a:
                with np.errstate(over="ignore"):
                    h = np.uint64(b - a)
                    for w in words.hashes[words.ids[a:b]]:
                        h = mix(h + w * np.uint64(0x9E3779B97F4A7C15))
                self.sets.append(np.array([h], np.uint64))
            else:
                self.sets.append(np.zeros(0, np.uint64))
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        with np.errstate(over="ignore"):
            self.keys = np.array([mix(np.sum(mix(s + np.uint64(1))) + np.uint64(len(s))) | np.uint64(1) if len(s) else 0 for s in self.sets], np.uint64)
        #: Distinct sets in key order, and a row of each.
        self.known, self.row = np.unique(self.keys, return_index=True)
        if len(self.known) and self.known[0] == 0:
            self.known, self.row = self.known[1:], self.row[1:]

    def least_ids(self) -> np.ndarray:
        out = np.full(len(self.known), _NO_ID)
        at = np.searchsorted(self.known, self.keys)
        real = self.keys > 0
        np.minimum.at(out, at[real], self.id_or_max[real])
        return out

    def columns(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of the block and how many of its distinct sets hold each (at most 255)."""
        flat = np.concatenate([self.sets[r] for r in self.row]) if len(self.row) else np.zeros(0, np.uint64)
        known, counts = np.unique(flat, return_counts=True)
        return known, np.minimum(counts, 255).astype(np.uint8)


def _ask(table: pa.Table, size: int, bits: int) -> pa.Table:
    block = _Block(table, size)
    shingles, counts = block.columns()
    least, kept = block.least_ids(), rest(shingles, bits, SKETCH_BYTES)
    rows = {s: [squeeze(kept[a:b], SKETCH_BYTES) + counts[a:b].tobytes(), b"", b""] for s, a, b in parts(shingles, bits)}
    for s, a, b in parts(block.known, bits):
        rows.setdefault(s, [b"", b"", b""])[1:] = [block.known[a:b].tobytes(), least[a:b].tobytes()]
    number = first(table, "block")
    return pa.table({
        "shard": pa.array(list(rows), pa.int32()), "block": pa.array([number] * len(rows), pa.int32()),
        **{k: pa.array([r[i] for r in rows.values()], pa.binary()) for i, k in enumerate(("keys", "sets", "ids"))},
    })


def _answer(table: pa.Table) -> pa.Table:
    """Document frequencies (at most 255) of the shingles; for each set its smallest id and the block that stands for it."""
    blocks = table.column("block").to_pylist()
    asked, counts = [], []
    for data in table.column("keys").to_pylist():
        n = len(data) // (SKETCH_BYTES + 1)
        asked.append(expand(data[: n * SKETCH_BYTES], SKETCH_BYTES))
        counts.append(np.frombuffer(data[n * SKETCH_BYTES :], np.uint8))
    known, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    frequency = np.minimum(np.bincount(inverse, weights=np.concatenate(counts), minlength=len(known)), 255).astype(np.uint8)
    sets = [np.frombuffer(s, np.uint64) for s in table.column("sets").to_pylist()]
    ids = np.concatenate([np.frombuffer(i, np.int64) for i in table.column("ids").to_pylist()])
    keys, at_set = np.unique(np.concatenate(sets), return_inverse=True)
    least, owner = np.full(len(keys), _NO_ID), np.full(len(keys), _NO_ID)
    np.minimum.at(least, at_set, ids)
    np.minimum.at(owner, at_set, np.repeat(np.array(blocks, np.int64), [len(s) for s in sets]))
    a = b = 0
    out = []
    for block, k, s in zip(blocks, asked, sets, strict=True):
        mine = at_set[b : b + len(s)]
        out.append((block, len(s).to_bytes(4, "little") + least[mine].tobytes() + owner[mine].tobytes() + frequency[inverse[a : a + len(k)]].tobytes()))
        a, b = a + len(k), b + len(s)
    return replies(first(table, "shard"), out)


_ROWS = "doc_id long, n long, node long, least_id long, core long, profile array<int>, prefix array<long>, shingles binary"


def _rows(left: pa.Table, right: pa.Table, size: int, percent: int, bits: int) -> pa.Table:
    """One row per document; the row that stands for a set of the corpus carries its leading columns and its shingles."""
    columns: list[list] = [[] for _ in range(8)]
    if left.num_rows:
        block, number, got = _Block(left, size), first(left, "block"), answered(right)
        shingles, _ = block.columns()
        frequency = np.zeros(len(shingles), np.uint8)
        least, owner = np.zeros(len(block.known), np.int64), np.zeros(len(block.known), np.int64)
        set_parts = {s: (a, b) for s, a, b in parts(block.known, bits)}
        for s, (a, b) in set_parts.items():
            least[a:b] = np.frombuffer(got[s], np.int64, b - a, 4)
            owner[a:b] = np.frombuffer(got[s], np.int64, b - a, 4 + 8 * (b - a))
        for s, a, b in parts(shingles, bits):
            n = int.from_bytes(got[s][:4], "little")
            frequency[a:b] = np.frombuffer(got[s], np.uint8, b - a, 4 + 16 * n)
        stands = dict(zip(block.row[owner == number].tolist(), np.flatnonzero(owner == number).tolist(), strict=True))
        at = np.searchsorted(block.known, block.keys)
        for i, (doc_id, n, key) in enumerate(zip(block.ids, block.sizes.tolist(), block.keys.tolist(), strict=True)):
            core, profile, prefix, data = None, None, None, None
            if n and i in stands:
                own = block.sets[i]
                f = frequency[np.searchsorted(shingles, own)]
                lead = np.lexsort((own, f))[: n - -(-percent * n // 100) + 1]
                lead = lead[f[lead] > 1]
                core = int((f > 1).sum())
                profile = np.bincount((own[f > 1] >> np.uint64(64 - PROFILE_BITS)).astype(np.int64), minlength=1 << PROFILE_BITS).astype(np.int32)
                if len(lead):
                    prefix, data = own[lead].view(np.int64), squeeze(own >> np.uint64(64 - 8 * SET_BYTES), SET_BYTES)
            low = int(least[at[i]]) if n else None
            for c, v in zip(columns, (doc_id, n, int(np.uint64(key).view(np.int64)) if n else None, doc_id if not n else None if low == _NO_ID else low, core, profile if data else None, prefix, data), strict=True):
                c.append(v)
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary())
    return pa.table({name.split()[0]: pa.array(c, t) for name, c, t in zip(_ROWS.split(", "), columns, types, strict=True)})


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of nodes, those whose overlap reaches the similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))

    def count(batches):
        for batch in batches:
            columns = [batch.column(c) for c in ("a", "na", "sa", "b", "nb", "sb")]
            keep = np.zeros(batch.num_rows, bool)
            sizes = columns[1].to_numpy() + columns[4].to_numpy()
            # Cells of the product in groups of bounded size; the pair number has 15 bits beside a shingle's 48.
            ends = np.searchsorted(np.cumsum(sizes), np.arange(ENTRIES_AT_ONCE, int(sizes.sum()) + ENTRIES_AT_ONCE, ENTRIES_AT_ONCE), "right")
            cuts = np.unique(np.concatenate([[0], ends, np.arange(0, batch.num_rows, 1 << 15), [batch.num_rows]]))
            for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                keep[start:end] = _cells(*[c.slice(start, end - start) for c in columns], percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        tidy(cycles=False)

    return pairs.join(one, "a").join(two, "b").select("a", "na", "sa", "b", "nb", "sb").mapInArrow(count, "a long, b long")


def _side(names: pa.Array, data: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each pair's row, the shingles of all different rows in order, and where a row's shingles of each block of columns start."""
    names = names.to_numpy()
    known, first_, number = np.unique(names, return_index=True, return_inverse=True)
    rows = [expand(data[i].as_py(), SET_BYTES) for i in first_.tolist()]
    flat = np.concatenate(rows)
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    blocks = (flat >> np.uint64(8 * SET_BYTES - COLUMN_BITS)).astype(np.int64) + np.repeat(np.arange(len(rows)) << COLUMN_BITS, np.diff(starts))
    # Row-major order of (row, block), so one search finds all starts; the last entry ends the last block.
    return number, flat, np.searchsorted(blocks, np.arange((len(rows) << COLUMN_BITS) + 1))


def _taken(number: np.ndarray, alive: np.ndarray, flat: np.ndarray, starts: np.ndarray, block: int) -> np.ndarray:
    """(pair, shingle) entries of one block of columns for the pairs that are alive, in order."""
    at = (number[alive] << COLUMN_BITS) + block
    begin, size = starts[at], starts[at + 1] - starts[at]
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
    return (np.repeat(alive, size).astype(np.uint64) << np.uint64(8 * SET_BYTES)) | flat[place]


def _cells(a: pa.Array, na: pa.Array, sa: pa.Array, b: pa.Array, nb: pa.Array, sb: pa.Array, percent: int) -> np.ndarray:
    """Which cells (a, b) of the product reach the similarity.

    Overlaps are summed over blocks of columns (ranges of the shingle hash). After each block a cell goes whose sum, even if all that is left of the smaller
    row were shared, stays below the overlap that the two sizes ask for.
    """
    na, nb = na.to_numpy(), nb.to_numpy()
    need = -(-percent * (na + nb) // (100 + percent))
    left, right = _side(a, sa), _side(b, sb)
    overlap, alive = np.zeros(len(na), np.int64), np.flatnonzero(np.minimum(na, nb) >= need)
    for block in range(1 << COLUMN_BITS):
        if not len(alive):
            break
        both = np.concatenate([_taken(left[0], alive, left[1], left[2], block), _taken(right[0], alive, right[1], right[2], block)])
        both.sort(kind="stable")  # two ordered runs
        same = both[1:][both[1:] == both[:-1]]
        overlap += np.bincount((same >> np.uint64(8 * SET_BYTES)).astype(np.int64), minlength=len(na))
        rest_of = lambda side: side[2][(side[0][alive] + 1) << COLUMN_BITS] - side[2][(side[0][alive] << COLUMN_BITS) + block + 1]  # noqa: E731, B023
        alive = alive[overlap[alive] + np.minimum(rest_of(left), rest_of(right)) >= need[alive]]
    keep = np.zeros(len(na), bool)
    keep[alive] = overlap[alive] >= need[alive]
    return keep


def _near(n: str, m: str, core: Column, percent: int) -> Column:
    """Whether sizes n and m can be of a pair whose overlap is at most ``core``."""
    return percent * (F.col(n) + F.col(m)) <= (100 + percent) * core


def _overlap_bound(a: str, b: str) -> Column:
    """Most that two cores can share: the smaller count in each part of the hash range, summed."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)


def link(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    n = block_count(docs, text_col)
    # Everything below is smaller than the documents, so their number of blocks keeps its pieces small too.
    few = max(8, n)
    rows = checkpointed(_documents(docs, size, percent, id_col, text_col, n))
    release(docs.sparkSession)
    return _components(rows, percent, few)


def _documents(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str, n: int) -> DataFrame:
    bits = shard_bits(n)
    blocks = blocked(docs, id_col, text_col, n).groupBy("block")
    answers = blocks.applyInArrow(tidied(lambda t: _ask(t, size, bits)), MESSAGES).groupBy("shard").applyInArrow(tidied(_answer), REPLIES)
    return blocks.cogroup(answers.groupBy("block")).applyInArrow(tidied(lambda a, b: _rows(a, b, size, percent, bits)), _ROWS)


def _components(rows: DataFrame, percent: int, few: int) -> DataFrame:
    sets = rows.where("shingles IS NOT NULL").select("node", "n", "shingles")

    # Columns that several rows hold, one of each kind of columns with the same rows. A shingle that one row alone holds is in no overlap, so
    # the rest of the row (its core) bounds every overlap; entries of rows that even the smallest row of the column is too large for go.
    entries = rows.where("prefix IS NOT NULL").select("node", "n", "core", F.explode("prefix").alias("key"))
    kinds = entries.groupBy("key").agg(F.count("*").alias("rows"), F.min("n").alias("m"), F.expr("bit_xor(xxhash64(node))").alias("x"), F.expr("bit_xor(xxhash64(node, 1))").alias("y")).where("rows > 1")
    kinds = checkpointed(kinds.withColumn("parts", F.ceil(F.col("rows") / COLUMN_ROWS).cast("int")), few)
    kept = kinds.groupBy("rows", "x", "y").agg(F.min_by(F.struct("key", "m", "parts"), "key").alias("k")).select("k.*")
    # A long column is dealt over several tasks by its rows; there are fewer such columns than entries / COLUMN_ROWS.
    dealt = entries.join(bounded(kinds.where("parts > 1").select("key", "parts")), "key", "left").withColumn("part", F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    profiles = rows.where("shingles IS NOT NULL").select("node", "profile")
    entries = checkpointed(dealt.join(_each_part(kept), ["key", "part"]).where(_near("n", "m", F.col("core"), percent)).drop("m", "core").join(profiles, "node"), few)

    links = None
    core = F.aggregate("profile", F.lit(0), lambda x, y: x + y)
    for step in range(PIVOT_ROUNDS + 1):
        now = entries.withColumn("component", F.col("node")) if links is None else _labelled(entries, components(links, few))
        # First the row with the least of its own meets the others, then rows by chance.
        order = ((F.col("n") - core) / F.col("n")) if step == 0 else F.xxhash64("node", F.lit(step)).cast("double")
        pivot = F.min(F.struct(order.alias("o"), "node", "n", "profile", "component")).alias("p")
        spread = now.groupBy("key").agg(F.max("parts").alias("parts"), F.min("component").alias("low"), F.max("component").alias("high"), pivot).where("low <> high")
        if step < PIVOT_ROUNDS:
            met = now.drop("parts").join(_each_part(spread).select("key", "part", F.col("p.node").alias("pivot"), F.col("p.n").alias("m"), F.col("p.profile").alias("pivot_profile"), F.col("p.component").alias("other")), ["key", "part"])
            met = met.where((F.col("other") != F.col("component")) & _near("n", "m", _overlap_bound("profile", "pivot_profile"), percent)).groupBy("node", "pivot").agg(F.count("*").alias("shared"))
            pairs = met.groupBy("node").agg(F.max(F.struct("shared", "pivot")).alias("best")).select(F.col("node").alias("a"), F.col("best.pivot").alias("b"))
        else:
            # Of two rows of different components one at least isn't in the pivot's: those rows meet all rows of the column, in blocks of both.
            held = now.join(_each_part(spread).select("key", "part", F.col("p.component").alias("base")), ["key", "part"])
            odd = held.where("component <> base")
            many = odd.groupBy("key").agg(F.ceil(F.count("*") / COLUMN_ROWS).cast("int").alias("blocks"))
            left = _each_part(odd.drop("part")).join(bounded(many), "key").withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")).drop("blocks", "base")
            right = held.join(bounded(many), "key").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            right = right.select("key", "part", "block", F.col("node").alias("b"), F.col("n").alias("m"), F.col("profile").alias("other_profile"), F.col("component").alias("other"), "base")
            apart = F.when(F.col("other") == F.col("base"), F.lit(True)).otherwise(F.col("component") < F.col("other"))
            pairs = left.join(right, ["key", "part", "block"]).where(apart & _near("n", "m", _overlap_bound("profile", "other_profile"), percent)).select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
        found = _linked(pairs, sets, percent)
        links = checkpointed(found if links is None else links.unionByName(found), few)
        release(rows.sparkSession)

    names = checkpointed(components(links, few), few)
    known = rows.where("node IS NOT NULL").select("node", "least_id").distinct()
    least = names.join(known, "node").groupBy("component").agg(F.min("least_id").alias("component_id"))
    labels = names.join(least, "component").select("node", "component_id")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "node", "least_id").join(labels, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "least_id").alias("component_id"))


def _each_part(columns: DataFrame) -> DataFrame:
    """Rows of columns once for each part that the column is dealt over."""
    return columns.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))


def _labelled(entries: DataFrame, names: DataFrame) -> DataFrame:
    return entries.join(names, "node", "left").select("key", "part", "parts", "node", "n", "profile", F.coalesce("component", "node").alias("component"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one of each component: the row with its smallest id, once. Rows without words or id stay."""
    linked = link(docs, id_col=id_col, text_col=text_col).where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Ids with a row to drop, or with several rows of one component.
    name = unused("_id", docs)
    ids = linked.groupBy(F.col("doc_id").alias(name), "component_id").agg(F.count("*").alias("rows"))
    ids = checkpointed(ids.select(name, (F.col(name) != F.col("component_id")).alias("copy"), (F.col("rows") > 1).alias("again")).where("copy OR again"))
    copies, again = ids.where("copy").select(name).distinct(), ids.where("again").select(name).distinct()
    same = lambda rows: rows[id_col].cast("long") == F.col(name)
    kept = docs.join(bounded(copies), same(docs), "left_anti")
    if again.isEmpty():
        return kept
    once = kept.join(bounded(again), same(kept), "left_anti")
    return once.unionByName(kept.join(bounded(again), same(kept), "left_semi").dropDuplicates([id_col, text_col]))
