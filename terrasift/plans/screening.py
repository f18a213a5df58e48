"""The screening pipeline as table-to-table functions: title metrics, slope screen, exclusion, access, ranking and web rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import boxes, expect, raster, spatial
from ..session import checkpointed

HECTARE = 10_000.0
#: Bands of the distance to the nearest road: label, score, greatest distance.
BANDS = (("Good", 3, 1000.0), ("Moderate", 2, 2000.0))
#: Hectares from which an area counts as there.
SHOWN_HA = 0.01


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, within 0..100; 0 of nothing."""
    return F.when(whole > 0, F.least(F.lit(100.0), F.greatest(F.lit(0.0), 100 * part / whole))).otherwise(0.0)


def drop_fid(df: DataFrame, to: str | None = None) -> DataFrame:
    """Provider ids are not durable: dropped, or kept under another name."""
    out = [c for c in df.columns if c.lower() != "fid"]
    held = [F.col(c).alias(to) for c in df.columns if to and c.lower() == "fid"]
    return df.select(*held, *out)


def query_pieces(layer: DataFrame, key: str = "source_fid", geom: str = "geom") -> DataFrame:
    """Repaired single polygons, split before and after the repair, with a fresh id that depends on the geometries only."""
    parts = spatial.singleparts(spatial.usable(layer, geom), geom).withColumn(geom, geo.st_polygonal(geom))
    parts = spatial.singleparts(parts.where(F.col(geom).isNotNull()), geom)
    return expect.ranked(parts, key, F.xxhash64(geom), F.col(geom))


def titles_on(titles: DataFrame, pieces: DataFrame, key: str) -> DataFrame:
    """Titles that touch a piece, once each."""
    return spatial.spatial_join(titles, pieces, key, "left_semi")


def title_metrics(titles: DataFrame, pieces: DataFrame, leases: DataFrame, key: str) -> DataFrame:
    """title_m2, bog_m2, bog_pct, lease_m2, lease_pct, lease_flag of titles with bog; boundary touches drop out."""
    areas = spatial.covered(titles, {"bog_m2": spatial.dissolved(pieces, []), "lease_m2": spatial.dissolved(leases, [])}, key).where("bog_m2 > 0")
    out = titles.join(areas, key).withColumn("title_m2", geo.st_area("geom"))
    return out.withColumns({"bog_pct": percent(F.col("bog_m2"), F.col("title_m2")), "lease_pct": percent(F.col("lease_m2"), F.col("title_m2")), "lease_flag": (F.col("lease_m2") > 0).cast("int")})


def bog_area(titles: DataFrame, pieces: DataFrame, key: str) -> DataFrame:
    """(key, bog_m2) of titles with bog, counted once."""
    return spatial.covered(titles, {"bog_m2": spatial.dissolved(pieces, [])}, key).where("bog_m2 > 0")


def subtract(layer: DataFrame, masks: list[DataFrame], key: str) -> DataFrame:
    """All overlays taken away at once: their parts meet the layer in one join."""
    every = masks[0].select("geom")
    for m in masks[1:]:
        every = every.unionByName(m.select("geom"))
    return spatial.overlay_difference(layer, every, key)


def slope_screen(footprints: DataFrame, low: DataFrame, grid: raster.Grid, key: str, least: float) -> DataFrame:
    """bog_m2, cells, low_cells, low_pct, low_m2, over_m2, slope_pass (area of low slope at least ``least``)."""
    footprints = checkpointed(footprints)
    z = raster.zonal(footprints, low, grid, key).withColumnsRenamed({"cells": "sample_cells", "total": "low_cells"})
    area = footprints.select(key, geo.st_area("geom").alias("bog_m2")).join(z.hint("merge"), key)
    inside, over = raster.apportion(F.col("bog_m2"), F.coalesce("low_cells", F.lit(0)), F.col("sample_cells"))
    return area.select(
        key, "bog_m2", "sample_cells", F.coalesce("low_cells", F.lit(0)).alias("low_cells"), percent(F.coalesce("low_cells", F.lit(0)), F.col("sample_cells")).alias("low_pct"),
        inside.alias("low_m2"), over.alias("over_m2"), (inside >= least).cast("int").alias("slope_pass"),
    )


def low_slope_overlay(footprints: DataFrame, low: DataFrame, grid: raster.Grid, key: str) -> DataFrame:
    """Footprints less the cells that are steep or unknown, which are merged to rectangles first."""
    return spatial.overlay_difference(checkpointed(footprints), steep_boxes(low, grid), key)


def steep_boxes(low: DataFrame, grid: raster.Grid) -> DataFrame:
    """The cells that are steep or unknown, merged to rectangles."""
    steep = low.where(F.coalesce("value", F.lit(0)) != 1)
    return raster.rectangles(raster.merge_runs(steep.withColumn("tile", F.floor(F.col("row") / raster.BLOCK)), ["tile"]), grid).select("geom")


def pieces_without(pieces: DataFrame, masks: DataFrame) -> DataFrame:
    """(geom): the pieces' area less the masks', as polygons that don't overlap."""
    land = checkpointed(spatial.dissolved(pieces, []).withColumn("part", F.monotonically_increasing_id()))
    return checkpointed(spatial.overlay_difference(land, masks, "part").select("geom"))


def area_without(titles: DataFrame, pieces: DataFrame, masks: DataFrame, key: str) -> DataFrame:
    """(key, m2) of titles with any: the pieces' area less the masks', counted once. Rectangles need no geometry; a piece or mask of another shape takes all rows the general way."""
    l, r, m = boxes.laid(titles, key), boxes.laid(pieces), boxes.laid(masks)
    odd, size = boxes.surveyed([l, r, m])
    general = lambda rows: spatial.covered(rows, {"m2": pieces_without(pieces, masks)}, key)
    if odd[1] or odd[2]:
        return general(titles)
    area = boxes.common_areas(l, r, m, key, size)
    return area.unionByName(general(titles.join(l.where("NOT plain").select(key), key, "left_semi"))) if odd[0] else area


def common_areas(titles: DataFrame, pieces: DataFrame, key: str, piece_key: str) -> DataFrame:
    """(l_key, r_key, m2) of each title and piece with a common area; only pairs with another shape than a rectangle are cut."""
    l, r = boxes.laid(titles, key), boxes.laid(pieces, piece_key)
    odd, size = boxes.surveyed([l, r])
    out = boxes.common_pairs(l, r.where("plain"), key, piece_key, size)
    names = [f"l_{key}", f"r_{piece_key}"]
    cut = lambda a, b: spatial.overlay_intersection(a, b).select(*names, geo.st_area("geom").alias("m2"))
    is_odd = lambda rows, laid, k, how: rows.join(laid.where("NOT plain").select(k), k, how)
    titles, pieces = titles.select(key, "geom"), pieces.select(piece_key, "geom")
    if odd[0]:
        out = out.unionByName(cut(is_odd(titles, l, key, "left_semi"), pieces))
    if odd[1]:
        out = out.unionByName(cut(is_odd(titles, l, key, "left_anti"), is_odd(pieces, r, piece_key, "left_semi")))
    return out


def footprints_without(titles: DataFrame, pieces: DataFrame, masks: DataFrame, key: str) -> DataFrame:
    """(key, geom), at rest, of titles with any: the pieces less the masks, inside the title. As in ``area_without``, rectangles are cut without an overlay."""
    l, r, m = boxes.laid(titles, key), boxes.laid(pieces), boxes.laid(masks)
    odd, size = boxes.surveyed([l, r, m])
    general = lambda rows: spatial.union_at_rest(spatial.common_parts(rows, pieces_without(pieces, masks), key), [key])
    if odd[1] or odd[2]:
        return checkpointed(general(titles))
    fits = F.col("plain") & (F.col("x1") - F.col("x0") <= size) & (F.col("y1") - F.col("y0") <= size)
    cut = checkpointed(boxes.footprints(l.where(fits), r, m, key, size))
    rest = l.where(~fits)
    return cut.unionByName(checkpointed(general(titles.join(rest.select(key), key, "left_semi")))) if rest.limit(1).count() else cut


def exclusions(footprints: DataFrame, commonage: DataFrame, forest: DataFrame, key: str) -> DataFrame:
    """Per footprint: bog_m2, common_bog_m2, forest_bog_m2, excluded_bog_m2 (their union, counted once), clear_bog_m2 and flags."""
    out = checkpointed(footprints.withColumn("bog_m2", geo.st_area("geom")))
    return _cleared(spatial.overlap_areas(out, {"common_bog_m2": commonage, "forest_bog_m2": forest}, key, "excluded_bog_m2"))


def title_exclusions(titles: DataFrame, pieces: DataFrame, commonage: DataFrame, forest: DataFrame, key: str) -> DataFrame:
    """``exclusions`` of the titles' footprints on the pieces, without making those: the pieces are cut by commonage and forest before they meet the titles."""
    bog = spatial.dissolved(pieces, [])
    masks = spatial.dissolved(spatial.tagged({"common_bog_m2": commonage, "forest_bog_m2": forest}, together="excluded_bog_m2"), ["layer"])
    cut = spatial.overlay_intersection(bog, masks).select(F.col("r_layer").alias("layer"), "geom")
    layers = spatial.tagged({"bog_m2": bog}).unionByName(checkpointed(cut))
    names = ["bog_m2", "common_bog_m2", "forest_bog_m2", "excluded_bog_m2"]
    return _cleared(spatial.covered_by(titles, layers, names, key).where("bog_m2 > 0"))


def _cleared(out: DataFrame) -> DataFrame:
    shown = lambda c: (F.col(c) / HECTARE >= SHOWN_HA).cast("int")
    return out.withColumns({"clear_bog_m2": F.greatest(F.lit(0.0), F.col("bog_m2") - F.col("excluded_bog_m2")), "common_flag": shown("common_bog_m2"), "forest_flag": shown("forest_bog_m2")})


def band(distance: Column, assessed: Column, bands: tuple[tuple[str, int, float], ...] = BANDS) -> tuple[Column, Column]:
    """Label and score of a distance; Poor beyond the bands or without a road, Not assessed where there is nothing to reach."""
    label, score = F.when(~assessed, "Not assessed"), F.when(~assessed, 0)
    for name, points, most in bands:
        label, score = label.when(distance <= most, name), score.when(distance <= most, points)
    return label.otherwise("Poor"), score.otherwise(1)


def access(clear: DataFrame, roads: DataFrame, key: str, road_key: str, radius: float, bands: tuple[tuple[str, int, float], ...] = BANDS) -> DataFrame:
    """Nearest road within the radius of each geometry, with band and score; text nulls become empty."""
    near = spatial.nearest_within(clear, roads, key, road_key, radius)
    label, score = band(F.col("distance"), F.col("clear_bog_m2") / HECTARE >= SHOWN_HA, bands)
    return near.withColumns({"access_band": label, "access_score": score})


def histogram(df: DataFrame, score: str, values: range) -> DataFrame:
    """Rows per score, zero groups kept."""
    spark = df.sparkSession
    counts = df.groupBy(F.col(score).cast("long").alias("score")).agg(F.count("*").alias("n"))
    return spark.range(values.start, values.stop).select(F.col("id").alias("score")).join(counts, "score", "left").select("score", F.coalesce("n", F.lit(0)).alias("n_rows"))


def web_rank(df: DataFrame, value: str, key: str, name: str = "web_rank") -> DataFrame:
    return expect.ranked(df, name, F.desc(value), F.asc(key))


def search_text(*columns: str) -> Column:
    return F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in columns]))


def atlas(df: DataFrame, county: str, text: str, search: Column) -> DataFrame:
    """County equality and substring, either may be empty."""
    wanted = text.strip().lower()
    p = F.lit(True)
    if county:
        p = p & (F.col("county") == county)
    if wanted:
        p = p & (F.instr(search, wanted) > 0)
    return df.where(p)


def page(df: DataFrame, number: int, size: int, *order: str) -> DataFrame:
    """A page in order; a page past the end is the last one."""
    last = max(1, -(-df.count() // size))
    return df.orderBy(*order).offset((min(max(1, number), last) - 1) * size).limit(size)


def overlay_shown(df: DataFrame, overlays: DataFrame, key: str, flag: str) -> DataFrame:
    """Rows with ``shown``: flagged and with an overlay."""
    have = overlays.select(key).distinct().withColumn("_has", F.lit(True))
    return df.join(have, key, "left").withColumn("shown", (F.col(flag) == 1) & F.coalesce("_has", F.lit(False))).drop("_has")


def flag_text(flag: str) -> Column:
    """A 0/1 flag in words; anything else is unknown."""
    return F.when(F.col(flag) == 1, "yes").when(F.col(flag) == 0, "no").otherwise("unknown")


def screening_counters(titles: DataFrame, pieces: DataFrame, key: str) -> DataFrame:
    """One row: titles that touch a piece, those with a common area (written), and those with a boundary in common only."""
    l, r = boxes.laid(titles, key), boxes.laid(pieces)
    odd, size = boxes.surveyed([l, r])
    if odd[1]:
        each = _touching(titles, pieces, key)
    else:
        each = boxes.met(l, r, key, size)
        each = each.unionByName(_touching(titles.join(l.where("NOT plain").select(key), key, "left_semi"), pieces, key)) if odd[0] else each
    return each.agg(F.count("*").alias("n_touching"), F.count_if("inside").alias("n_written"), F.count_if(~F.col("inside")).alias("n_boundary_only"))


def _touching(titles: DataFrame, pieces: DataFrame, key: str) -> DataFrame:
    """(key, inside) of titles that touch a piece: whether they have an area in common with one."""
    # Pieces without an area aren't in the united ones, but can be touched.
    land = spatial.without_holes(spatial.dissolved(pieces, []), []).unionByName(pieces.where(geo.st_area("geom") <= 0).select("geom"))
    return spatial.common_areas(titles, land, key).groupBy(key).agg((F.max("m2") > 0).alias("inside"))


def duration_text(seconds: Column) -> Column:
    """1h 02m 03s."""
    s = F.round(seconds).cast("long")
    return F.format_string("%dh %02dm %02ds", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
