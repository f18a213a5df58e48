"""Rasters as grid tables (row, col, value): slope, masks, zonal sums, windows, and runs merged to rectangles. Null is NoData."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo


@dataclass(frozen=True)
class Grid:
    """North-up grid: origin is the upper left corner; rows count downwards."""

    x0: float
    y0: float
    dx: float
    dy: float
    rows: int
    cols: int

    def centre(self) -> tuple[Column, Column]:
        return self.x0 + (F.col("col") + 0.5) * self.dx, self.y0 - (F.col("row") + 0.5) * self.dy


#: Side, in cells, of the blocks that neighbours are looked up in.
BLOCK = 256


def slope_percent(grid: DataFrame, g: Grid) -> DataFrame:
    """Slope in percent after Zevenbergen and Thorne from the four neighbours; at edges and beside NoData the cell itself stands in for
    a missing neighbour and the step halves. A cell without a value has none.

    Cells go to their block once, and to a neighbouring block too where they lie at its edge; inside a block, rows and columns are sorted in place.
    """
    r, c = F.col("row"), F.col("col")
    near_block = lambda x: F.array_distinct(F.array(F.floor((x - 1) / BLOCK), F.floor(x / BLOCK), F.floor((x + 1) / BLOCK)))
    mine = lambda i, x: i == F.floor(x / BLOCK)
    # Corners are no neighbours, so a cell goes to the blocks beside it, not across.
    cross = F.concat(F.transform(near_block(r), lambda i: F.struct(i.alias("br"), F.floor(c / BLOCK).alias("bc"))), F.transform(F.filter(near_block(c), lambda j: ~mine(j, c)), lambda j: F.struct(F.floor(r / BLOCK).alias("br"), j.alias("bc"))))
    cells = grid.select("row", "col", F.col("value").cast("double").alias("c"), F.explode(cross).alias("b")).select("row", "col", "c", "b.br", "b.bc").repartition("br", "bc")
    line, stack = Window.partitionBy("br", "bc", "row").orderBy("col"), Window.partitionBy("br", "bc", "col").orderBy("row")

    def beside(w: Window, along: str, step: int) -> Column:
        return F.when(F.lag(along, step).over(w) == F.col(along) - step, F.lag("c", step).over(w))

    near = cells.withColumns({"w": beside(line, "col", 1), "e": beside(line, "col", -1)}).withColumns({"n": beside(stack, "row", 1), "s": beside(stack, "row", -1)})
    near = near.where(mine(F.col("br"), r) & mine(F.col("bc"), c))

    def gradient(a: str, b: str, step: float) -> Column:
        width = (F.col(a).isNotNull().cast("int") + F.col(b).isNotNull().cast("int")) * step
        return F.when(width > 0, (F.coalesce(a, "c") - F.coalesce(b, "c")) / width).otherwise(0.0)

    dx, dy = gradient("w", "e", g.dx), gradient("n", "s", g.dy)
    return near.select("row", "col", F.when(F.col("c").isNotNull(), 100 * F.sqrt(dx * dx + dy * dy)).alias("value"))


def mask(grid: DataFrame, low: float, high: float) -> DataFrame:
    """1 inside the closed range, 0 outside, NoData kept."""
    return grid.withColumn("value", F.when(F.col("value").isNotNull(), F.col("value").between(low, high).cast("int")))


def band_stats(grid: DataFrame) -> DataFrame:
    return grid.agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.avg("value").alias("mean_value"), F.count("value").alias("n_values"), F.count("*").alias("n_cells"))


def same_shape(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: whether two grids have the same extent of rows and columns and the same number of cells."""
    shape = lambda g, n: g.agg(F.struct(F.min("row"), F.max("row"), F.min("col"), F.max("col"), F.count("*")).alias(n))
    return shape(a, "x").join(F.broadcast(shape(b, "y"))).select((F.col("x").cast("string") == F.col("y").cast("string")).alias("same_shape"))


def window(grid: DataFrame, g: Grid, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """The cells that bounds touch, clamped to the grid; the range filter reaches the scan."""
    if xmin >= g.x0 + g.cols * g.dx or xmax <= g.x0 or ymin >= g.y0 or ymax <= g.y0 - g.rows * g.dy:
        raise ValueError("the window lies outside the grid")
    c0, c1 = max(0, int((xmin - g.x0) // g.dx)), min(g.cols - 1, -int(-(xmax - g.x0) // g.dx) - 1)
    r0, r1 = max(0, int((g.y0 - ymax) // g.dy)), min(g.rows - 1, -int(-(g.y0 - ymin) // g.dy) - 1)
    return grid.where(F.col("row").between(r0, r1) & F.col("col").between(c0, c1))


def cells_in(zones: DataFrame, grid: DataFrame, g: Grid, key: str, geom: str = "geom") -> DataFrame:
    """(key, row, col, value) of the cells whose centre lies in a zone.

    The cells under a zone's bounds are listed and tested where the zone is; only (key, row, col) travels to meet the grid, cell by cell. Both sides are
    sorted for that: a grid is never sent whole through the driver, whatever its size seems to be.
    """
    b = lambda c: F.col(f"b.{c}")
    first = lambda x: F.greatest(F.lit(0), F.ceil(x - 0.5)).cast("int")
    last = lambda x, most: F.least(F.lit(most - 1), F.floor(x - 0.5)).cast("int")
    z = zones.where(F.col(geom).isNotNull()).select(key, geom, geo.st_bounds(geom).alias("b"), geo.st_is_rectangle(geom).alias("plain"))
    z = z.withColumns({
        "r0": first((g.y0 - b("ymax")) / g.dy), "r1": last((g.y0 - b("ymin")) / g.dy, g.rows),
        "c0": first((b("xmin") - g.x0) / g.dx), "c1": last((b("xmax") - g.x0) / g.dx, g.cols),
    }).where("r0 <= r1 AND c0 <= c1")
    under = z.select(key, geom, "b", "plain", "c0", "c1", F.explode(F.sequence("r0", "r1")).alias("row")).select(key, geom, "b", "plain", "row", F.explode(F.sequence("c0", "c1")).alias("col"))
    x, y = g.centre()
    # A boundary isn't inside.
    within = F.when(F.col("plain"), (x > b("xmin")) & (x < b("xmax")) & (y > b("ymin")) & (y < b("ymax"))).otherwise(geo.st_contains(geom, geo.st_rect(x, y, x, y)))
    values = grid.select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), "value")
    return under.where(within).select(key, "row", "col").join(values.hint("merge"), ["row", "col"]).select(key, "row", "col", "value")


def zonal(zones: DataFrame, grid: DataFrame, g: Grid, key: str, geom: str = "geom") -> DataFrame:
    """Per zone: cells with a value, and the sum of values; 0 and null where no centre lies in it."""
    sums = cells_in(zones, grid, g, key, geom).groupBy(key).agg(F.count("value").alias("cells"), F.sum("value").alias("total"))
    return zones.select(key).join(sums.hint("merge"), key, "left").withColumn("cells", F.coalesce("cells", F.lit(0)))


def apportion(area: Column, part: Column, whole: Column) -> tuple[Column, Column]:
    """Share of an area by cells, clamped to 0..1, and the rest, not below 0."""
    share = F.when(whole > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), part / whole))).otherwise(0.0)
    inside = area * share
    return inside, F.greatest(F.lit(0.0), area - inside)


def merge_runs(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row0, row1, col0, col1): runs along rows, and equal runs of consecutive rows merged to rectangles."""
    line = Window.partitionBy(*keys, "row").orderBy("col")
    runs = cells.select(*keys, "row", "col").distinct().withColumn("g", F.col("col") - F.row_number().over(line)).groupBy(*keys, "row", "g").agg(F.min("col").alias("col0"), F.max("col").alias("col1"))
    stack = Window.partitionBy(*keys, "col0", "col1").orderBy("row")
    return runs.withColumn("h", F.col("row") - F.row_number().over(stack)).groupBy(*keys, "col0", "col1", "h").agg(F.min("row").alias("row0"), F.max("row").alias("row1")).drop("h")


def rectangles(runs: DataFrame, g: Grid) -> DataFrame:
    """The runs with their polygon."""
    x = lambda c: g.x0 + c * g.dx
    y = lambda r: g.y0 - r * g.dy
    return runs.withColumn("geom", geo.st_rect(x(F.col("col0")), y(F.col("row1") + 1), x(F.col("col1") + 1), y(F.col("row0"))))
