"""Layers for the registered queries: rectangles on a 50 m grid derived from the keys of the test tables, and small rasters.

The tables carry no geography; nothing here stands for a real place. ``sql_*`` give the same layers as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators.raster import Grid

# Per layer its table, key, hash multipliers, and size in metres as (base, modulus) across and up.
LAYERS = {
    "titles": ("orders", "o_orderkey", (31, 17, 53, 101), ("o_custkey", 200, 8), ("o_orderkey", 200, 7)),
    "pieces": ("part", "p_partkey", (37, 11, 59, 103), ("p_size", 100, 6), ("p_partkey", 100, 5)),
    "leases": ("supplier", "s_suppkey", (41, 19, 61, 107), ("s_suppkey", 1200, 6), ("s_suppkey", 1000, 5)),
    "overlays": ("customer", "c_custkey", (43, 23, 67, 109), ("c_custkey", 300, 6), ("c_custkey", 250, 5)),
    "roads": ("events", "event_id", (29, 13, 47, 89), ("user_id", 100, 5), None),
}
#: Overlay layers by market segment of their customer.
SEGMENTS = {"state": "AUTOMOBILE", "sac": "BUILDING", "nha": "FURNITURE", "commonage": "MACHINERY", "forest": "HOUSEHOLD"}

GRID = Grid(0.0, 50000.0, 100.0, 100.0, 500, 510)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bounds(key: Column, m: tuple[int, ...], w: Column, h: Column) -> list[Column]:
    k = key.cast("long")
    x0, y0 = ((k * k * m[0] + k * m[1]) % 1009) * 50, ((k * k * m[2] + k * m[3]) % 997) * 50
    return [x0.alias("x0"), y0.alias("y0"), (x0 + w).alias("x1"), (y0 + h).alias("y1")]


def layer(spark: SparkSession, sf_dir: str, name: str, *keep: str) -> DataFrame:
    """id, x0, y0, x1, y1, geom, and the columns asked for."""
    source, key, m, across, up = LAYERS[name]
    size = lambda s: F.lit(0) if s is None else s[1] + (F.col(s[0]).cast("long") % s[2]) * 50
    rows = table(spark, sf_dir, source).select(F.col(key).cast("long").alias("id"), *keep, *_bounds(F.col(key), m, size(across), size(up)))
    if up is None:
        text = F.format_string("LINESTRING (%d %d, %d %d)", "x0", "y0", "x1", "y1")
        return rows.withColumn("geom", geo.st_from_wkt(text))
    return rows.withColumn("geom", geo.st_rect(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]))


def overlay(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return layer(spark, sf_dir, "overlays", "c_mktsegment").where(F.col("c_mktsegment") == SEGMENTS[name]).select("id", "geom")


def sql_layer(name: str, keep: str = "") -> str:
    source, key, m, across, up = LAYERS[name]
    size = lambda s: "0" if s is None else f"{s[1]} + ({s[0]}::BIGINT % {s[2]}) * 50"
    x, y = (f"(({key} * {key} * {m[i]} + {key} * {m[i + 1]}) % {n}) * 50" for i, n in ((0, 1009), (2, 997)))
    return f"SELECT {key}::BIGINT AS id{', ' + keep if keep else ''}, {x} AS x0, {y} AS y0, {x} + {size(across)} AS x1, {y} + {size(up)} AS y1 FROM {source}"


def sql_overlay(*names: str) -> str:
    return f"SELECT id, x0, y0, x1, y1 FROM ({sql_layer('overlays', 'c_mktsegment')}) WHERE c_mktsegment IN ({', '.join(repr(SEGMENTS[n]) for n in names)})"


def cell_of(key: Column) -> list[Column]:
    """Row and column of the grid that a key falls on."""
    k = key.cast("long")
    return [(k * 31 % GRID.rows).cast("int").alias("row"), (k * 17 % GRID.cols).cast("int").alias("col")]


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elevation-like values on GRID, raised by the number of orders that fall on a cell; some cells without."""
    cells = spark.range(GRID.rows * GRID.cols).select((F.col("id") / GRID.cols).cast("int").alias("row"), (F.col("id") % GRID.cols).cast("int").alias("col"), F.lit(0).alias("order"))
    # Every order falls on a cell, so counting needs no join.
    raised = cells.unionByName(table(spark, sf_dir, "orders").select(*cell_of(F.col("o_orderkey")), F.lit(1).alias("order"))).groupBy("row", "col").agg(F.sum("order").alias("n"))
    r, c = F.col("row").cast("long"), F.col("col").cast("long")
    value = ((r * r * 7 + c * c * 11 + r * c * 3) % 97 + F.col("n")).cast("double")
    return raised.select("row", "col", F.when((r * 31 + c * 17) % 53 != 0, value).alias("value"))


SQL_RASTER = f"""SELECT r::INTEGER AS row, c::INTEGER AS col, CASE WHEN (r * 31 + c * 17) % 53 <> 0 THEN ((r * r * 7 + c * c * 11 + r * c * 3) % 97 + coalesce(n, 0))::DOUBLE END AS value
FROM range({GRID.rows}) a(r) CROSS JOIN range({GRID.cols}) b(c)
LEFT JOIN (SELECT o_orderkey * 31 % {GRID.rows} AS gr, o_orderkey * 17 % {GRID.cols} AS gc, count(*) AS n FROM orders GROUP BY 1, 2) o ON gr = r AND gc = c"""
