"""Temporal URL lists: dated entries become validity intervals, and every capture meets those active at its fetch time.

An entry names a host or domain (``example.net``) or a host with one path segment (``a.example.net/de``). A domain entry
holds for all hosts below it. All work is joins and aggregates on DataFrames.

Results: a capture without a readable host or fetch time matches nothing and stays, unblocked. Several changes of one entry on one
day count as the last by ``seq`` (ties: a removal wins). Intervals start on their day and end before the day of removal. Repeated
captures (same id, URL and time) yield one row; extra columns are ignored. Without entries nothing is blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_URL = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dots; null where there is none."""
    host = F.rtrim(F.regexp_extract(F.lower(F.trim(url)), _URL + r"([^/:?#\s]+)", 1), F.lit("."))
    return F.when(host != "", host)


def keys_of(url: Column) -> Column:
    """Keys under which entries can hold for a URL: its host with the first path segment, its host, and the domains above it."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    segment = F.regexp_extract(F.trim(url), r"^[^:/]+://[^/?#]*(/[^/?#]+)", 1)
    return F.when(host.isNotNull(), F.when(segment != "", F.array_append(domains, F.concat(host, F.lower(segment)))).otherwise(domains))


def intervals(entries: DataFrame) -> DataFrame:
    """list_name, pattern, valid_from, valid_to (null: open) out of entries (list_name, pattern, day, seq, action add/remove).

    Changes are reduced to one a day before the shuffle, and to changes of state after it, so an entry that is repeated without end
    stays small.
    """
    day = (
        entries.where(F.col("pattern").isNotNull() & F.col("day").isNotNull() & F.col("list_name").isNotNull())
        .groupBy("list_name", F.lower(F.trim("pattern")).alias("pattern"), F.col("day").cast("date").alias("day"))
        .agg(F.max(F.struct(F.coalesce("seq", F.lit(0)).cast("long"), (F.col("action") == "remove").alias("off"))).off.alias("off"))
    )
    w = Window.partitionBy("list_name", "pattern").orderBy("day")
    changes = day.withColumn("before", F.lag("off", 1, True).over(w)).where(F.coalesce("off", F.lit(False)) != F.coalesce("before", F.lit(False)))
    return (
        changes.withColumn("valid_to", F.lead("day").over(w)).where(~F.coalesce("off", F.lit(False))).select("list_name", "pattern", F.col("day").alias("valid_from"), "valid_to")
    )


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """Per capture: page_id, host, fetched_on, lists (comma-joined names), n_active entries, active_since (latest start), blocked.

    The join is by key and then by interval; Spark broadcasts the intervals only below its own size limit, and else splits skewed hosts.
    """
    rows = captures.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.to_date(F.col(time_col)).alias("fetched_on")).distinct()
    keys = rows.where(F.col("fetched_on").isNotNull()).select("*", F.explode(keys_of(F.col("url"))).alias("pattern"))
    active = keys.join(intervals(entries), "pattern").where((F.col("fetched_on") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to"))))
    hits = active.groupBy("page_id", "url", "fetched_on").agg(F.collect_set("list_name").alias("names"), F.count("*").alias("n"), F.max("valid_from").alias("since"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"h.{c}")) for c in ("page_id", "url", "fetched_on")]
    return (
        rows.alias("r")
        .join(hits.alias("h"), same[0] & same[1] & same[2], "left")
        .select(
            "r.page_id",
            host_of(F.col("r.url")).alias("host"),
            F.col("r.fetched_on").cast("string").alias("fetched_on"),
            F.array_join(F.sort_array(F.coalesce("names", F.array().cast("array<string>"))), ",").alias("lists"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n_active"),
            F.col("since").cast("string").alias("active_since"),
            F.col("n").isNotNull().alias("blocked"),
        )
    )
