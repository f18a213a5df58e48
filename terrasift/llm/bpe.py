"""Byte-level BPE encoding and decoding by recursive queries that run inside each partition.

Every task keeps an in-memory DuckDB with the vocabulary and the merge table (two token ids and the id of
their concatenation). The distinct words of a batch become token-position rows; a recursive query joins
neighbouring rows with the merge table and contracts each word's leftmost minimum-rank pair until no pair
is left; ordered aggregation yields the ids and decodes them back to bytes. No rows are shuffled.

Words longer than ``LONG_WORD`` bytes go through a recursive query of their own. There a round contracts every place of the word's minimum-rank pair, from
the left. That gives the same tokens unless the new token is part of a merge that ranks before it; of such a pair only the leftmost place is contracted. The
query runs for so many rounds that its rows stay bounded, and goes on from its last round until nothing changes.

Results: null text is the empty text (no ids, empty bytes). Repeated rows yield repeated results. Extra columns
are ignored, whatever their names; an empty table gives no rows. Texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hold, map_rows

OWNER = "bpe"
LONG_WORD = 128
#: Most rows of all rounds of one recursive query, about.
ROWS_A_QUERY = 8_000_000
#: Entries of a generation of a worker's cache of chunks; beyond it the cache becomes the old generation, and the one before goes.
CACHE_ENTRIES = 500_000
#: Characters encoded at once.
SLICE_CHARS = 4_000_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
SCHEMA_IDS = "doc_id long, ids array<int>, decoded binary"

#: Patterns under which letters after at most one space are a word by themselves.
LETTER_PATTERNS = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",)
_RUNS_ON = re.compile(r"\s\x20|\s\Z")
_CUT = re.compile(r"(?<=\S)(?=\x20)")

# A row is one integer: word number, position and token, in this order from the top, so rows sort by word and position.
_POS_BITS, _LONG_POS_BITS = 9, 32
_LAST = """
last AS (SELECT x >> {top} AS word, max(step) AS step FROM rounds WHERE (x >> {t}) & {pos} = 0 GROUP BY 1),
done AS (SELECT last.word, last.step, x, id, chars FROM rounds JOIN last ON rounds.x >> {top} = last.word AND rounds.step = last.step JOIN vocab ON vocab.tok = rounds.x & {tok})
"""
_ROUNDS = (
    """
WITH RECURSIVE rounds(step, x) AS (
    SELECT 0::UTINYINT, x FROM start
    UNION ALL
    (WITH pair AS (SELECT step, x, lead(x) OVER (ORDER BY x) AS y FROM rounds),
    best AS (
        SELECT x >> {top} AS word, min((merged << 18) | (((x >> {t}) & {pos}) << 9) | ((y >> {t}) & {pos})) AS k
        FROM pair JOIN merges ON ab = (((x & {tok}) << {t}) | (y & {tok})) WHERE x >> {top} = y >> {top} GROUP BY 1)
    SELECT (step + 1)::UTINYINT, CASE WHEN (x >> {t}) & {pos} = (k >> 9) & {pos} THEN ((x >> {t}) << {t}) | (k >> 18) ELSE x END
    FROM pair JOIN best ON x >> {top} = word WHERE (x >> {t}) & {pos} <> k & {pos})
),"""
    + _LAST
    + """
SELECT word, array_to_string(list_transform(tokens, lambda e: e.id), ','), array_to_string(list_transform(tokens, lambda e: e.chars), '')
FROM (SELECT word, list_sort(list(struct_pack(x := x, id := id, chars := chars))) AS tokens FROM done GROUP BY word)"""
)
_LONG_ROUNDS = (
    """
WITH RECURSIVE rounds(step, x) AS (
    SELECT 0, x FROM start
    UNION ALL
    (WITH pair AS (SELECT step, x, lead(x) OVER (ORDER BY x) AS y, row_number() OVER (ORDER BY x) AS i FROM rounds WHERE step < {most}),
    ranked AS (SELECT x, y, i, merged, early FROM pair JOIN merges ON ab = (((x & {tok}) << {t}) | (y & {tok})) WHERE x >> {top} = y >> {top}),
    best AS (SELECT x >> {top} AS word, min(merged) AS k, arg_min(x, (merged, x)) AS leftmost FROM ranked GROUP BY 1),
    hits AS (SELECT x, y, k, i - row_number() OVER (ORDER BY i) AS run, i FROM ranked JOIN best ON x >> {top} = word AND merged = k WHERE NOT early OR x = leftmost),
    -- Places that overlap are taken from the left: the first of a run, the third, and so on.
    taken AS (SELECT x, y, k FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY i) AS place FROM hits) WHERE place % 2 = 1)
    SELECT step + 1, CASE WHEN a.k IS NOT NULL THEN ((pair.x >> {t}) << {t}) | a.k ELSE pair.x END
    FROM pair JOIN best ON pair.x >> {top} = word LEFT JOIN taken a ON a.x = pair.x LEFT JOIN taken b ON b.y = pair.x WHERE b.y IS NULL)
),"""
    + _LAST
)


class Coder:
    """Encodes words with one rank file; lives for a whole Python worker."""

    _known: dict[tuple[str, str], Coder] = {}

    def __init__(self, rank_file: str, pattern: str) -> None:
        import duckdb
        import pyarrow as pa
        import regex

        with open(rank_file, "rb") as lines:
            self.ranks = {base64.b64decode(word): int(rank) for word, rank in (x.split() for x in lines if x.strip())}
        self.words = regex.compile(pattern).findall
        self.letters_alone = pattern in LETTER_PATTERNS
        self.tokens = {rank: word for word, rank in self.ranks.items()}
        self.whole = {word: (str(rank), word.decode("latin-1")) for word, rank in self.ranks.items()}
        triples = [(self.ranks[w[:i]], self.ranks[w[i:]], r) for w, r in self.ranks.items() for i in range(1, len(w)) if w[:i] in self.ranks and w[i:] in self.ranks]
        # Tokens that are part of a merge ranked before them: contracting to one may show an earlier pair.
        early = {x for a, b, r in triples for x in (a, b) if r < x}
        self.bits = t = max(1, max(self.tokens).bit_length())
        self.rounds = _ROUNDS.format(t=t, top=t + _POS_BITS, pos=(1 << _POS_BITS) - 1, tok=(1 << t) - 1)
        merges = pa.table({"ab": pa.array([a << t | b for a, b, _ in triples], pa.int64()), "merged": pa.array([r for *_, r in triples], pa.int64()), "early": [r in early for *_, r in triples]})
        vocab = pa.table({"tok": pa.array(list(self.tokens), pa.int32()), "id": list(map(str, self.tokens)), "chars": [w.decode("latin-1") for w in self.tokens.values()]})
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.db.register("m", merges)
        self.db.register("v", vocab)
        self.db.execute("CREATE TABLE merges AS FROM m; CREATE TABLE vocab AS FROM v")
        self.db.unregister("m")
        self.db.unregister("v")
        #: Comma-joined ids and decoded bytes (as Latin-1 text) of the chunks seen: those after a space, without it, and by themselves.
        self.spaced: dict[str, tuple[str, str]] = {}
        self.old: dict[str, tuple[str, str]] = {}
        self.heads: dict[str, tuple[str, str]] = {}
        self.entries = CACHE_ENTRIES

    @classmethod
    def shared(cls, rank_file: str, pattern: str) -> Coder:
        if (rank_file, pattern) not in cls._known:
            cls._known[rank_file, pattern] = cls(rank_file, pattern)
            hold(OWNER, cls.forget)
        return cls._known[rank_file, pattern]

    @classmethod
    def forget(cls) -> None:
        for coder in cls._known.values():
            coder.db.close()
        cls._known.clear()

    def encode_words(self, words: list[bytes]) -> list[tuple[str, str]]:
        """(comma-joined ids, decoded bytes as Latin-1 text) of each of these distinct non-empty words."""
        out: list[tuple[str, str] | None] = list(map(self.whole.get, words))
        todo, long = [], []
        for i, (w, known) in enumerate(zip(words, out, strict=True)):
            if known is None:
                (long if len(w) > LONG_WORD else todo).append(i)
        # A word of n bytes leaves at most n * (n + 1) / 2 rows in all its rounds.
        start, rows = 0, 0
        for end, i in enumerate(todo, 1):
            rows += len(words[i]) * (len(words[i]) + 1) // 2
            if rows >= ROWS_A_QUERY or end == len(todo):
                self._contract([words[j] for j in todo[start:end]], todo[start:end], out)
                start, rows = end, 0
        start, rows = 0, 0
        for end, i in enumerate(long, 1):
            rows += len(words[i])
            if rows >= ROWS_A_QUERY // 16 or end == len(long):
                self._contract_long([words[j] for j in long[start:end]], long[start:end], out)
                start, rows = end, 0
        return out  # type: ignore[return-value]

    def _rows(self, words: list[bytes], pos_bits: int):
        """A row for each byte of the words."""
        import numpy as np

        lengths = np.fromiter(map(len, words), np.int64, len(words))
        byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        word = np.repeat(np.arange(len(words)), lengths) << (self.bits + pos_bits)
        pos = (np.arange(lengths.sum()) - np.repeat(lengths.cumsum() - lengths, lengths)) << self.bits
        return word | pos | byte_ids[np.frombuffer(b"".join(words), np.uint8)]

    def _contract(self, words: list[bytes], places: list[int], out: list) -> None:
        """Contracts words in one recursive query."""
        import pyarrow as pa

        self.db.register("start", pa.table({"x": self._rows(words, _POS_BITS)}))
        got = self.db.sql(self.rounds).to_arrow_table()
        self.db.unregister("start")
        numbers, *coded = [c.to_pylist() for c in got.columns]
        for n_word, pair in zip(numbers, zip(*coded, strict=True), strict=True):
            out[places[n_word]] = pair

    def _contract_long(self, words: list[bytes], places: list[int], out: list) -> None:
        """Contracts long words, a bounded number of rounds at a time; words with no pair left leave the rounds."""
        import pyarrow as pa

        names = {"t": self.bits, "top": self.bits + _LONG_POS_BITS, "pos": (1 << _LONG_POS_BITS) - 1, "tok": (1 << self.bits) - 1}
        rows = pa.table({"x": self._rows(words, _LONG_POS_BITS)})
        while rows.num_rows:
            most = max(1, ROWS_A_QUERY // rows.num_rows)
            self.db.register("start", rows)
            self.db.execute("CREATE OR REPLACE TEMP TABLE state AS " + _LONG_ROUNDS.format(most=most, **names) + "SELECT * FROM done")
            self.db.unregister("start")
            ended = self.db.sql(f"SELECT word, string_agg(id, ',' ORDER BY x), string_agg(chars, '' ORDER BY x) FROM state WHERE step < {most} GROUP BY word").fetchall()
            for n_word, ids, chars in ended:
                out[places[n_word]] = (ids, chars)
            rows = self.db.sql(f"SELECT x FROM state WHERE step = {most}").to_arrow_table()
        self.db.execute("DROP TABLE IF EXISTS state")

    def parts(self, text: str) -> tuple[str, list[str]]:
        """A text cut where a word must end under a pattern whose words hold white space at their start only or alone: what stands before
        the first cut, and the chunks after it without the space that each begins with."""
        if not _RUNS_ON.search(text):
            head, *rest = text.split(" ")
            return head, rest
        head, *rest = _CUT.split(text)
        if head[:1] == " " and head[:2] != "  " and len(head) > 1:
            return "", [head[1:], *[c[1:] for c in rest]]
        return head, [c[1:] for c in rest]

    def _learn(self, chunks: set[str], cache: dict[str, tuple[str, str]], space: str, old: dict[str, tuple[str, str]]) -> None:
        """Chunks go to the cache, from its old generation or encoded."""
        again = chunks & old.keys()
        cache.update(zip(again, map(old.__getitem__, again), strict=True))
        chunks -= again
        if not chunks:
            return
        alone = list(filter(str.isalpha, chunks)) if self.letters_alone else []
        words = set(map(space.__add__, alone))
        rest = list(chunks.difference(alone))
        cut = list(map(self.words, map(space.__add__, rest)))
        words.update(*cut)
        # Words of several chunks are often chunks by themselves.
        got: dict[str, tuple[str, str]] = {}
        for w in set().union(*cut):
            known = (self.spaced.get(w[1:]) or self.old.get(w[1:])) if w[0] == " " else self.heads.get(w)
            if known is not None:
                got[w] = known
        new = list(words.difference(got))
        got.update(zip(new, self.encode_words(list(map(str.encode, new))), strict=True))
        cache.update(zip(alone, map(got.__getitem__, map(space.__add__, alone)), strict=True))
        for c, ws in zip(rest, cut, strict=True):
            found = [got[w] for w in ws]
            cache[c] = found[0] if len(found) == 1 else (",".join([f[0] for f in found]), "".join([f[1] for f in found]))
        if self.letters_alone:
            # A word that is a chunk by itself, wherever it was met.
            for w in set().union(*cut).intersection(new):
                if w[0] != " ":
                    self.heads[w] = got[w]
                elif not w[1:2].isspace():
                    self.spaced[w[1:]] = got[w]

    def encode(self, texts: list[str]) -> Iterator[list[tuple[str, str]]]:
        """Encoded chunks of each text."""
        if len(self.spaced) > self.entries:
            self.old, self.spaced, self.heads = self.spaced, {}, {}
        # A pass over millions of small tuples for cycles would find none.
        gc.disable()
        try:
            cut = [self.parts(t) for t in texts]
            self._learn(set().union(*[rest for _, rest in cut]).difference(self.spaced), self.spaced, " ", self.old)
            self._learn({h for h, _ in cut if h}.difference(self.heads), self.heads, "", {})
        finally:
            gc.enable()
        take = self.spaced.__getitem__
        for head, rest in cut:
            yield [self.heads[head], *map(take, rest)] if head else list(map(take, rest))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def _slices(texts: list[str], chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def _run(docs: DataFrame, rank_file: str, pattern: str, id_col: str, text_col: str, schema: str, finish: Callable, cache_entries: int = CACHE_ENTRIES, slice_chars: int = SLICE_CHARS) -> DataFrame:
    def make() -> Callable:
        coder = Coder.shared(rank_file, pattern)
        coder.entries = cache_entries

        def fn(columns: list[list]) -> list[list]:
            done = [finish(x) for texts in _slices(columns[1], slice_chars) for x in coder.encode(texts)]
            return [columns[0], *([list(c) for c in zip(*done, strict=True)] if done else [[] for _ in schema.split(", ")[1:]])]

        return fn

    return map_rows(_texts(docs, id_col, text_col), schema, make, OWNER)


def encode_digest(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", cache_entries: int = CACHE_ENTRIES, slice_chars: int = SLICE_CHARS
) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the comma-joined ids and of the decoded bytes, one row for each input row.

    A smaller cache and smaller slices take less memory and more time; the results are the same.
    """
    nothing = hashlib.sha256(b"").hexdigest()

    def finish(parts: list[tuple[str, str]]) -> tuple:
        if not parts:
            return 0, nothing, nothing
        ids, decoded = zip(*parts, strict=True)
        joined = ",".join(ids)
        return joined.count(",") + 1, hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256("".join(decoded).encode("latin-1")).hexdigest()

    return _run(docs, rank_file, pattern, id_col, text_col, SCHEMA, finish, cache_entries, slice_chars)


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array) and the bytes decoded from them, one row for each input row."""

    def finish(parts: list[tuple[str, str]]) -> tuple:
        return [int(t) for p in parts for t in p[0].split(",")], "".join([p[1] for p in parts]).encode("latin-1")

    return _run(docs, rank_file, pattern, id_col, text_col, SCHEMA_IDS, finish)
