"""Benchmark decontamination by canonical templates, in DataFrame functions only.

Texts become lower-case words in which numbers, names (capitalised inside a sentence) and units (after a number) are typed
placeholders. Documents are cut into tiles of ``TILE`` words, once as templates and once as plain words; items are windowed at every word in
both ways. Any run of ``2 * TILE - 1`` words equal in one of the ways holds a whole tile, so a hash join of tiles with windows finds all places
where such a run can be. Those places are aligned word by word, first as templates, then with words equal in either way, so an exact passage needs no equal letter case. In each
run of ``MIN_RUN`` words or more the placeholders must be filled consistently (each value of the item stands for one value of the document,
and the other way round): it is cut at each refilled placeholder that conflicts with another one of the run, and the longest piece must reach ``MIN_RUN``
words. Literally equal words never conflict.

An item shorter than ``MIN_RUN`` words has a template too general to be evidence; it matches where all its words stand literally in a row, which a hash join of
windows of its length finds.

Results: null or empty texts and items match nothing; an empty table gives no rows. A pair has one row however often it matches, with its longest template run, or its longest run in either way
where no template run stands. Repeated rows count once; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .common import bounded, unused

TILE = 7
MIN_RUN = 2 * TILE - 1
# Units that are placeholders after a number.
UNITS = ("mm", "cm", "m", "km", "mi", "ft", "inch", "inches", "mg", "g", "kg", "lb", "oz", "ml", "l", "s", "sec", "min", "h", "hr", "hours", "minutes", "seconds", "days", "eur", "usd", "gbp", "percent", "mph", "kmh", "kw", "kwh", "hz")
NAME = "\x01"


def words(text: Column) -> Column:
    """Lower-case words; a name keeps a leading mark."""
    marked = F.regexp_replace(text, r"\p{Lu}(?<=[\p{Ll},;]\x20.)", NAME + "$0")
    return F.filter(F.split(F.lower(marked), r"[^\p{L}\p{N}\x01]+"), lambda w: w != "")


def template(ws: Column) -> Column:
    """Words with numbers, names and units replaced by their type."""
    number = lambda w: (w >= "0") & (w < ":")

    def one(w: Column, i: Column) -> Column:
        return F.when(number(w), F.lit("<num>")).when(w < "\x02", F.lit("<name>")).when((i > 0) & number(F.get(ws, i - 1)) & w.isin(*UNITS), F.lit("<unit>")).otherwise(w)

    return F.transform(ws, one)


def plain(ws: Column) -> Column:
    """Words without the mark of names."""
    return F.transform(ws, lambda w: F.ltrim(w, F.lit(NAME)))


def _tiles(t: Column) -> Column:
    """Numbers and hashes of the whole tiles of a template or of plain words."""
    n = F.floor(F.size(t) / TILE).cast("int")
    tile = lambda i: F.struct(i.alias("no"), F.xxhash64(F.slice(t, i * TILE + 1, TILE)).alias("tile"))
    return F.transform(F.slice(F.sequence(F.lit(0), n), F.lit(1), n), tile)


def _windows(t: Column) -> Column:
    n = F.size(t) - TILE + 1
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.struct((i - 1).alias("at"), F.xxhash64(F.slice(t, i, TILE)).alias("tile")))


def _longest(flags: Column) -> Column:
    """Length of the longest run of ones."""
    return F.array_max(F.transform(F.split(flags, "0+"), F.char_length))


def _flags(a: Column, test) -> Column:
    return F.array_join(F.transform(a, lambda x: F.when(test(x), F.lit("1")).otherwise(F.lit("0"))), "")


def _short(source: DataFrame, items: DataFrame) -> DataFrame | None:
    """Rows of ``matches`` for items of fewer than ``MIN_RUN`` words (item_id, item_ws); None where there are no such items."""
    lengths = sorted(r.n for r in items.select(F.size("item_ws").alias("n")).distinct().collect())  # numbers below MIN_RUN
    if not lengths:
        return None
    keys = items.select("item_id", "item_ws", plain(F.col("item_ws")).alias("item_p"))
    keys = keys.withColumn("tile", F.xxhash64(F.size("item_p"), "item_p"))
    p = F.col("p")

    def windows(n: int) -> Column:
        """Distinct hashes of the windows of n words."""
        starts = F.when(F.size(p) >= n, F.sequence(F.lit(1), F.size(p) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.lit(n), F.slice(p, i, n))))

    texts = source.where(F.col("doc_id").isNotNull()).select("doc_id", plain(words(F.col("text"))).alias("p"))
    found = texts.select("doc_id", F.explode(F.concat(*map(windows, lengths))).alias("tile")).join(bounded(keys), "tile").distinct()
    slots = F.size(F.array_distinct(F.filter(F.arrays_zip(template(F.col("item_ws")).alias("t"), "item_ws"), lambda x: F.startswith(x.t, F.lit("<")))))
    size = F.size("item_ws").cast("long")
    return found.select("doc_id", "item_id", size.alias("run_words"), size.alias("item_words"), slots.cast("long").alias("n_slots"), F.lit(0).cast("long").alias("n_refilled")).groupBy("doc_id", "item_id").agg(
        *[F.max(c).alias(c) for c in ("run_words", "item_words", "n_slots", "n_refilled")]
    )


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, run_words (longest run; one of templates goes first), item_words, n_slots (placeholders in the run), n_refilled (filled otherwise than in the item)."""
    every = benchmark.select(F.col(item_col).cast("long").alias("item_id"), words(F.col(item_text)).alias("item_ws")).where(F.size("item_ws") > 0).distinct()
    items = every.where(F.size("item_ws") >= MIN_RUN).withColumn("item_t", template(F.col("item_ws")))
    both_ways = F.concat(_windows(F.col("item_t")), _windows(F.col("item_p")))
    windows = items.withColumn("item_p", plain(F.col("item_ws"))).select("item_id", F.inline(both_ways)).distinct()
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())

    tiles = source.select("doc_id", words(F.col("text")).alias("ws")).select("doc_id", template(F.col("ws")).alias("t"), plain(F.col("ws")).alias("p"))
    tiles = tiles.select("doc_id", F.inline(F.concat(_tiles(F.col("t")), _tiles(F.col("p")))))
    # Where the item would start in the document, counted in template words.
    found = tiles.join(bounded(windows), "tile").select("doc_id", "item_id", (F.col("no") * TILE - F.col("at")).alias("shift"))
    candidates = checkpointed(found.distinct())

    # Only documents with a candidate are split again.
    ids = candidates.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    held = source.join(bounded(ids), "doc_id", "left_semi").select("doc_id", words(F.col("text")).alias("ws")).distinct()
    ws, shift, item_ws = F.col("ws"), F.col("shift"), F.col("item_ws")
    first = F.greatest(-shift, F.lit(0))
    length = F.least(F.size(item_ws) - first, F.size(ws) - (shift + first))
    # The words next before the aligned part decide whether its first word is a unit, so templates are cut, not recomputed.
    pairs = (
        candidates.join(held, "doc_id")
        .join(items, "item_id")
        .where(length >= MIN_RUN)
        .select(
            "doc_id", "item_id", F.size(item_ws).alias("item_words"),
            F.slice(ws, shift + first + 1, length).alias("dw"), F.slice(item_ws, first + 1, length).alias("iw"),
            F.slice(template(ws), shift + first + 1, length).alias("dt"), F.slice("item_t", first + 1, length).alias("it"),
        )
        .withColumn("aligned", F.arrays_zip("dw", "iw", "dt", "it"))
    )
    typed, exact = (lambda x: x.dt == x.it), (lambda x: F.ltrim(x.dw, F.lit(NAME)) == F.ltrim(x.iw, F.lit(NAME)))
    ways = F.array(F.struct(F.lit(1).alias("typed"), _flags(F.col("aligned"), typed).alias("same")), F.struct(F.lit(0).alias("typed"), _flags(F.col("aligned"), lambda x: typed(x) | exact(x)).alias("same")))
    pairs = pairs.select("doc_id", "item_id", "item_words", "aligned", F.inline(ways)).where(F.contains("same", F.lit("1" * MIN_RUN)))
    same = F.col("same")
    starts = F.filter(F.sequence(F.lit(1), F.char_length(same)), lambda i: (F.substring(same, i, F.lit(MIN_RUN)) == "1" * MIN_RUN) & ((i == 1) | (F.substring(same, i - 1, F.lit(1)) == "0")))
    runs = pairs.select("doc_id", "item_id", "item_words", "typed", "same", "aligned", F.explode(starts).alias("start"))
    runs = runs.select("doc_id", "item_id", "item_words", "typed", F.slice("aligned", F.col("start"), F.position(F.lit("0"), F.concat("same", F.lit("0")), F.col("start")) - F.col("start")).alias("words"))
    is_slot = lambda x: F.startswith(x.dt, F.lit("<")) & (x.dt == x.it)
    clash = lambda x, y: (x.dw == y.dw) != (x.iw == y.iw)
    slots = lambda words: F.array_distinct(F.filter(words, is_slot))
    runs = runs.withColumn("slots", slots(F.col("words")))
    runs = runs.withColumn("cuts", F.filter("slots", lambda x: (x.dw != x.iw) & F.exists("slots", lambda y: clash(x, y))))
    runs = runs.withColumn("held", _flags(F.col("words"), lambda x: ~F.array_contains("cuts", x))).withColumn("run", _longest(F.col("held"))).where(F.col("run") >= MIN_RUN)
    filled = runs.withColumn("slots", slots(F.slice("words", F.position(F.repeat(F.lit("1"), F.col("run")), F.col("held")), F.col("run")))).withColumn("n_slots", F.size("slots").cast("long"))
    refilled = F.size(F.filter("slots", lambda x: x.dw != x.iw)).cast("long")
    best = F.max(F.struct("typed", F.col("run").cast("long").alias("run"), (-refilled).alias("same_slots"), "n_slots", F.col("item_words").cast("long").alias("item_words")))
    long = filled.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", F.col("b.run").alias("run_words"), "b.item_words", "b.n_slots", (-F.col("b.same_slots")).alias("n_refilled"))
    short = _short(source, every.where(F.size("item_ws") < MIN_RUN))
    return long if short is None else long.unionByName(short)


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without a match, with all their columns; rows without an id or text stay."""
    hit = unused("_hit", docs)
    found = checkpointed(matches(docs, benchmark, id_col, text_col).where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias(hit)).distinct())
    return docs.join(bounded(found), docs[id_col].cast("long") == F.col(hit), "left_anti")
