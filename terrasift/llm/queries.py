"""The registered queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from pyspark.sql import functions as F

from . import bpe, chat, decontam, jaccard, lm, media, pii, substring, toxicity, urlfilter

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.mark(_table(spark, sf_dir, "documents")).drop("kept")


OP2_SQL = r"""
WITH rows_of AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT r, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w FROM rows_of),
windows AS (SELECT r, i, md5(string_agg(w, ' ') OVER span) AS k, count(*) OVER span AS n FROM words WINDOW span AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
marks AS (SELECT r, i, n = 35 AND count(*) OVER (PARTITION BY k, n) > 1 AS again FROM windows),
kept AS (
    SELECT r, i, w, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM words JOIN marks USING (r, i)),
totals AS (SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(w, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM kept GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM rows_of LEFT JOIN totals USING (r)
"""


def url_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries by rule from the hosts of the captures: hosts, their domains, and host paths, some removed and listed again."""
    host = urlfilter.host_of(F.col("url"))
    n = F.conv(F.substring(F.md5(F.col("host")), 1, 7), 16, 10).cast("long")
    listed = pages.select(host.alias("host")).where(F.col("host").isNotNull()).distinct().withColumn("n", n)
    start = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n") % 500).cast("int"))

    def entry(name: Column, pattern: Column, day: Column, seq: int, action: Column) -> Column:
        return F.struct(name.alias("list_name"), pattern.alias("pattern"), day.alias("day"), F.lit(seq).alias("seq"), action.alias("action"))

    add, remove, path = F.lit("add"), F.lit("remove"), F.concat("host", F.lit("/de"))
    kind = F.element_at(F.array(F.lit("ads"), F.lit("malware"), F.lit("phishing")), (F.col("n") % 3 + 1).cast("int"))
    rows = F.array(
        entry(kind, F.col("host"), start, 1, add),
        entry(F.lit("ads"), F.col("host"), F.date_add(start, 60), 2, F.when(F.col("n") % 2 == 0, remove).otherwise(add)),
        entry(F.lit("tracker"), path, F.date_add(start, -40), 3, add),
        entry(F.lit("tracker"), path, F.date_add(start, (F.col("n") % 90).cast("int")), 4, remove),
        entry(F.lit("domains"), F.regexp_replace("host", r"^[^.]+\.", ""), F.date_add(start, 30), 5, F.when(F.col("n") % 5 == 0, add).otherwise(remove)),
    )
    return listed.select(F.explode(rows).alias("e")).select("e.*")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7919 % 730).cast("int"))
    return urlfilter.evaluate(pages.withColumn("fetched_at", day), url_entries(pages))


OP3_SQL = r"""
WITH pages_at AS (
    SELECT DISTINCT page_id, url, DATE '2024-01-01' + (page_id * 7919 % 730)::INTEGER AS fetched_on,
        nullif(rtrim(regexp_extract(lower(trim(url)), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#\s]+)', 1), '.'), '') AS host,
        lower(regexp_extract(trim(url), '^[^:/]+://[^/?#]*(/[^/?#]+)', 1)) AS segment
    FROM pages),
hosts AS (SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 7))::BIGINT AS n FROM pages_at WHERE host IS NOT NULL),
started AS (SELECT *, DATE '2024-01-01' + (n % 500)::INTEGER AS start FROM hosts),
entries(list_name, pattern, day, seq, action) AS (
    SELECT ['ads', 'malware', 'phishing'][n % 3 + 1], host, start, 1, 'add' FROM started
    UNION ALL SELECT 'ads', host, start + 60, 2, CASE WHEN n % 2 = 0 THEN 'remove' ELSE 'add' END FROM started
    UNION ALL SELECT 'tracker', host || '/de', start - 40, 3, 'add' FROM started
    UNION ALL SELECT 'tracker', host || '/de', start + (n % 90)::INTEGER, 4, 'remove' FROM started
    UNION ALL SELECT 'domains', regexp_replace(host, '^[^.]+\.', ''), start + 30, 5, CASE WHEN n % 5 = 0 THEN 'add' ELSE 'remove' END FROM started),
daily AS (SELECT list_name, pattern, day, max(struct_pack(s := seq, off := action = 'remove')).off AS off FROM (SELECT list_name, pattern, day, seq, action FROM entries) GROUP BY ALL),
changes AS (SELECT * FROM (SELECT *, lag(off, 1, true) OVER (PARTITION BY list_name, pattern ORDER BY day) AS before FROM daily) WHERE off <> before),
spans AS (SELECT * FROM (SELECT list_name, pattern, day AS valid_from, off, lead(day) OVER (PARTITION BY list_name, pattern ORDER BY day) AS valid_to FROM changes) WHERE NOT off),
keyed AS (
    SELECT page_id, url, fetched_on, unnest(list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.'))
        || CASE WHEN segment = '' THEN []::VARCHAR[] ELSE [host || segment] END) AS pattern
    FROM pages_at WHERE host IS NOT NULL),
hits AS (
    SELECT page_id, url, fetched_on, array_to_string(list_sort(list(DISTINCT list_name)), ',') AS lists, count(*) AS n, max(valid_from) AS since
    FROM keyed JOIN spans USING (pattern) WHERE fetched_on >= valid_from AND (valid_to IS NULL OR fetched_on < valid_to) GROUP BY ALL)
SELECT p.page_id, p.host, p.fetched_on::VARCHAR AS fetched_on, coalesce(h.lists, '') AS lists, coalesce(h.n, 0)::BIGINT AS n_active,
    h.since::VARCHAR AS active_since, h.n IS NOT NULL AS blocked
FROM pages_at p LEFT JOIN hits h ON p.page_id = h.page_id AND p.url = h.url AND p.fetched_on = h.fetched_on
"""


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(_table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents),
words AS (SELECT r, unnest(range(len(ws))) AS i, unnest(ws) AS w FROM texts),
shingles AS (
    SELECT DISTINCT r, string_agg(w, ' ') OVER span AS shingle FROM words
    WINDOW span AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) QUALIFY count(*) OVER span = 5 OR (i = 0 AND count(*) OVER span < 5)),
sets AS (SELECT r, count(*) AS n, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS node FROM shingles GROUP BY r),
nodes AS (SELECT node, any_value(n) AS n, min(r) AS r, min(doc_id) AS least FROM sets JOIN texts USING (r) GROUP BY node),
entries AS (SELECT node, n, shingle FROM nodes JOIN shingles USING (r)),
cells AS (
    SELECT a.node AS x, b.node AS y FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.node < b.node AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.node, b.node HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
edges AS (SELECT x, y FROM cells UNION ALL SELECT y, x FROM cells),
reach(x, y) AS (SELECT node, node FROM nodes UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
labels AS (SELECT r.x AS node, min(least) AS component_id FROM reach r JOIN nodes n ON n.node = r.y GROUP BY r.x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id
FROM texts LEFT JOIN sets USING (r) LEFT JOIN labels USING (node)
"""


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digest(_table(spark, sf_dir, "documents"))


MARKS_IN_TEXT = "<|im_end|><|im_start|>assistant ok"


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKS_IN_TEXT).alias("text"))
    return chat.format_digest(talks.unionByName(own))


OP6_SQL = r"""
WITH rows_of AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, i, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
steps AS (SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn, role, text) || '>' || role AS step FROM rows_of)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(24 + length(role) + length(text) + len(regexp_extract_all(text, '<\\*\|')))::BIGINT AS formatted_chars,
    bool_and(step IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user')) AND last(role ORDER BY turn, role, text) = 'assistant' AS valid
FROM steps GROUP BY conv_id
"""


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP9_SQL = r"""
WITH marked AS (
    SELECT 'd' AS kind, doc_id::BIGINT AS id, text FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
    UNION ALL SELECT 'i', item_id::BIGINT, text FROM benchmark WHERE text IS NOT NULL),
split AS (
    SELECT DISTINCT kind, id, regexp_extract_all(lower(regexp_replace(text, '([\p{Ll},;] )(\p{Lu})', '\1' || chr(1) || '\2', 'g')), '[\p{L}\p{N}\x01]+') AS ws FROM marked),
typed AS (
    SELECT row_number() OVER () AS r, kind, id, ws, list_transform(ws, lambda w: ltrim(w, chr(1))) AS p,
        list_transform(ws, lambda w, i: CASE WHEN w[1] BETWEEN '0' AND '9' THEN '<num>' WHEN w[1] = chr(1) THEN '<name>'
            WHEN i > 1 AND ws[i - 1][1] BETWEEN '0' AND '9' AND w IN ('mm', 'cm', 'm', 'km', 'mi', 'ft', 'inch', 'inches', 'mg', 'g', 'kg', 'lb', 'oz', 'ml', 'l', 's', 'sec', 'min', 'h', 'hr',
                'hours', 'minutes', 'seconds', 'days', 'eur', 'usd', 'gbp', 'percent', 'mph', 'kmh', 'kw', 'kwh', 'hz') THEN '<unit>' ELSE w END) AS t
    FROM split WHERE len(ws) > 0),
words AS (SELECT r, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w, unnest(p) AS p, unnest(t) AS t FROM typed WHERE kind = 'd' OR len(ws) >= 13),
sevens AS (
    SELECT r, kind, id, unnest(list_transform(CASE WHEN kind = 'd' THEN range(1, len(ws) - 5, 7) ELSE range(1, len(ws) - 5) END,
        lambda i: {'at': i, 't': array_to_string(t[i:i + 6], ' '), 'p': array_to_string(p[i:i + 6], ' ')})) AS s
    FROM typed WHERE kind = 'd' OR len(ws) >= 13),
grams AS (SELECT r, kind, s.at AS at, s.t AS g FROM sevens UNION SELECT r, kind, s.at, s.p FROM sevens),
diagonals AS (SELECT DISTINCT d.r AS dr, i.r AS ir, d.at - i.at AS shift FROM grams d JOIN grams i ON d.g = i.g AND d.kind = 'd' AND i.kind = 'i'),
aligned AS (
    SELECT dr, ir, shift, b.i AS j, a.w AS dw, b.w AS iw, a.t AS dt, b.t AS it, a.t = b.t AS by_type, a.p = b.p AS by_word
    FROM diagonals JOIN words b ON b.r = ir JOIN words a ON a.r = dr AND a.i = b.i + shift),
ways AS (
    SELECT dr, ir, shift, 1 AS way, j, dw, iw, dt, it FROM aligned WHERE by_type
    UNION ALL SELECT dr, ir, shift, 0, j, dw, iw, dt, it FROM aligned WHERE by_type OR by_word),
numbered AS (SELECT *, j - row_number() OVER (PARTITION BY dr, ir, shift, way ORDER BY j) AS run FROM ways),
runs AS (SELECT * FROM numbered QUALIFY count(*) OVER (PARTITION BY dr, ir, shift, way, run) >= 13),
slots AS (SELECT DISTINCT dr, ir, shift, way, run, dw, iw FROM runs WHERE dt = it AND dt IN ('<num>', '<name>', '<unit>')),
cuts AS (
    SELECT DISTINCT x.dr, x.ir, x.shift, x.way, x.run, x.dw, x.iw FROM slots x JOIN slots y USING (dr, ir, shift, way, run) WHERE x.dw <> x.iw AND (x.dw = y.dw) <> (x.iw = y.iw)),
held AS (
    SELECT r.*, j - row_number() OVER (PARTITION BY dr, ir, shift, way, run ORDER BY j) AS piece
    FROM runs r WHERE NOT (dt = it AND dt IN ('<num>', '<name>', '<unit>') AND EXISTS (FROM cuts c
        WHERE c.dr = r.dr AND c.ir = r.ir AND c.shift = r.shift AND c.way = r.way AND c.run = r.run AND c.dw = r.dw AND c.iw = r.iw))),
pieces AS (
    SELECT dr, ir, shift, way, run, piece, count(*) AS n, min(j) AS j, count(DISTINCT (dw, iw, dt)) FILTER (dt = it AND dt IN ('<num>', '<name>', '<unit>')) AS n_slots,
        count(DISTINCT (dw, iw, dt)) FILTER (dt = it AND dt IN ('<num>', '<name>', '<unit>') AND dw <> iw) AS n_refilled
    FROM held GROUP BY ALL HAVING count(*) >= 13),
longest AS (SELECT * FROM pieces QUALIFY row_number() OVER (PARTITION BY dr, ir, shift, way, run ORDER BY n DESC, j) = 1),
long AS (
    SELECT d.id AS doc_id, i.id AS item_id, n AS run_words, len(i.ws) AS item_words, n_slots, n_refilled
    FROM longest JOIN typed d ON d.r = dr JOIN typed i ON i.r = ir
    QUALIFY row_number() OVER (PARTITION BY d.id, i.id ORDER BY way DESC, n DESC, n_refilled, n_slots DESC, len(i.ws) DESC) = 1),
short AS (
    SELECT d.id AS doc_id, i.id AS item_id, len(i.ws) AS item_words,
        len(list_distinct(list_filter(list_zip(i.t, i.ws), lambda x: x[1] IN ('<num>', '<name>', '<unit>')))) AS n_slots
    FROM typed d JOIN typed i ON d.kind = 'd' AND i.kind = 'i' AND len(i.ws) < 13 AND contains(' ' || array_to_string(d.p, ' ') || ' ', ' ' || array_to_string(i.p, ' ') || ' '))
SELECT doc_id, item_id, run_words::BIGINT AS run_words, item_words::BIGINT AS item_words, n_slots::BIGINT AS n_slots, n_refilled::BIGINT AS n_refilled FROM long
UNION ALL SELECT doc_id, item_id, max(item_words)::BIGINT, max(item_words)::BIGINT, max(n_slots)::BIGINT, 0::BIGINT FROM short GROUP BY doc_id, item_id
"""


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_url_filters": op3_url_filters,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_media_columns": op5_media_columns,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_toxicity": op7_toxicity,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_decontamination": op9_decontamination,
    "op10_byte_bpe": op10_byte_bpe,
}
ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": OP2_SQL,
    "op3_url_filters": OP3_SQL,
    "op4_ngram_jaccard": OP4_SQL,
    "op6_chat_formatting": OP6_SQL,
    "op9_decontamination": OP9_SQL,
}
