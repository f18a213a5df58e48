"""Quality gates: each gives the rows or figures that break a rule, or raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


class GateError(ValueError):
    """A gate was not passed."""


def count_is(df: DataFrame, expected: int, name: str) -> DataFrame:
    n = df.count()
    if n != expected:
        raise GateError(f"{name}: {n} rows, {expected} expected")
    return df


def not_empty(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise GateError(f"{name} is empty")
    return df


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def off_by(a: str, b: str, tolerance: float = 0.05) -> Column:
    return F.abs(F.col(a) - F.col(b)) > tolerance


def warning_off_by(a: str, b: str) -> Column:
    """Beyond half a unit or 2 % of the second figure, whichever is more."""
    return F.abs(F.col(a) - F.col(b)) > F.greatest(F.lit(0.5), 0.02 * F.abs(F.col(b)))


def rank_integrity(df: DataFrame, rank: str, value: str, key: str) -> DataFrame:
    """One row: count, first and last rank, distinct ranks, and pairs of neighbours out of order (value falling, then key rising)."""
    buckets = df.select(F.col(rank).cast("long").alias("r"), F.col(value).alias("v"), F.col(key).alias("k"))
    after = buckets.select((F.col("r") - 1).alias("r"), F.col("v").alias("v2"), F.col("k").alias("k2"))
    wrong = (F.col("v2") > F.col("v")) | ((F.col("v2") == F.col("v")) & (F.col("k2") < F.col("k")))
    return buckets.join(after, "r", "left").agg(
        F.count("*").alias("n_rows"), F.min("r").alias("first_rank"), F.max("r").alias("last_rank"), F.count_distinct("r").alias("distinct_ranks"), F.count_if(wrong).alias("out_of_order")
    )


def flag_parity(df: DataFrame, flag: str, overlays: DataFrame, key: str) -> DataFrame:
    """One row: flagged rows, overlay rows, flagged without an overlay, overlays without a flag."""
    have = overlays.select(key).distinct().withColumn("_has", F.lit(1))
    j = df.select(key, flag).join(have, key, "full")
    on, has = F.coalesce(F.col(flag), F.lit(0)) == 1, F.col("_has").isNotNull()
    return j.agg(F.count_if(on).alias("n_flagged"), F.count_if(has).alias("n_overlays"), F.count_if(on & ~has).alias("n_missing"), F.count_if(~on & has).alias("n_unflagged"))


def ranked(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Rank by position, from 1. The order is total where a unique key closes it.

    Rows are split into ranges of the order, sorted there and put to rest; a rank is the number of rows in the ranges before and the place in the own range, so
    no task sees all rows. What reaches the driver is one number per range.
    """
    at_rest = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order))
    place = F.monotonically_increasing_id()
    placed = at_rest.withColumn("_place", place)
    part, inside = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = {r.p: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(p, 0)
    offsets = F.array(*map(F.lit, before)).cast("array<bigint>")
    return placed.withColumn(name, F.element_at(offsets, part.cast("int") + 1) + inside + 1).drop("_place")


def register_problems(df: DataFrame, required: list[str]) -> DataFrame:
    """(source_id, problem) for blank values in columns that must be filled."""
    checks = [F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) == "", F.lit(f"{c} is blank")) for c in required]
    return df.select("source_id", F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("problem"))


def markdown_table(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """Lines of a Markdown table, in order: header, rule, rows; bars and line feeds in cells are escaped."""
    cell = lambda c: F.regexp_replace(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"\|", r"\\|"), r"\r?\n", " ")
    lines = df.select(F.col(order).alias("_order"), F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, columns)), F.lit(" |")).alias("line"))
    rows = ranked(lines, "line_no", F.col("_order"), F.col("line")).select((F.col("line_no") + 1).cast("int").alias("line_no"), "line")
    spark = df.sparkSession
    head = spark.range(2).select((F.col("id")).cast("int").alias("line_no"), F.when(F.col("id") == 0, "| " + " | ".join(columns) + " |").otherwise("|" + " --- |" * len(columns)).alias("line"))
    return head.unionByName(rows)
