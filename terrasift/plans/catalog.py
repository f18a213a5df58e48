"""The registered queries of the screening engine and their SQL. Areas are whole square metres, so both sides agree exactly."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs, geo
from ..operators import cluster, expect, raster, spatial
from ..session import checkpoint_dir, checkpointed
from ..sources import readers
from . import fixtures as fx
from . import screening as sc
from .roundtrips import ROUNDTRIPS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def whole(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c).cast("long")


# ---- SQL parts: layers as rectangles, pairs of them, and the 50 m cells that pairs share


def with_layers(*names: str) -> str:
    parts = [f"{n} AS ({fx.sql_layer(n, {'titles': 'o_custkey', 'roads': 'event_type', 'overlays': 'c_mktsegment'}.get(n, ''))})" for n in names if n in fx.LAYERS]
    parts += [f"{n} AS ({fx.sql_overlay(n)})" for n in names if n in fx.SEGMENTS]
    return "WITH RECURSIVE " + ", ".join(parts)


TOUCH = "l.x0 <= r.x1 AND r.x0 <= l.x1 AND l.y0 <= r.y1 AND r.y0 <= l.y1"
OVERLAP = TOUCH.replace("<=", "<")


def shared_cells(left: str, right: str) -> str:
    """Distinct (id, cx, cy) of the left rectangles' cells that some right rectangle covers."""
    return f"""SELECT DISTINCT id, cx, unnest(range(ya, yb)) AS cy FROM (
        SELECT id, ya, yb, unnest(range(xa, xb)) AS cx FROM (
            SELECT l.id, greatest(l.x0, r.x0) // 50 AS xa, least(l.x1, r.x1) // 50 AS xb, greatest(l.y0, r.y0) // 50 AS ya, least(l.y1, r.y1) // 50 AS yb
            FROM {left} l JOIN {right} r ON {OVERLAP}))"""


def own_cells(layer: str) -> str:
    return f"SELECT id, cx, unnest(range(y0 // 50, y1 // 50)) AS cy FROM (SELECT id, y0, y1, unnest(range(x0 // 50, x1 // 50)) AS cx FROM {layer})"


# ---- Joins


@query(with_layers("titles", "pieces") + f" SELECT DISTINCT l.id AS title_id FROM titles l JOIN pieces r ON {TOUCH}")
def title_semi_join(spark: SparkSession, d: str) -> DataFrame:
    return sc.titles_on(fx.layer(spark, d, "titles"), fx.layer(spark, d, "pieces"), "id").select(F.col("id").alias("title_id"))


@query(with_layers("titles", "pieces") + f" SELECT id AS title_id FROM titles t WHERE id NOT IN (SELECT l.id FROM titles l JOIN pieces r ON {TOUCH})")
def title_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return spatial.spatial_join(fx.layer(spark, d, "titles"), fx.layer(spark, d, "pieces"), "id", "left_anti").select(F.col("id").alias("title_id"))


@query(with_layers("titles", "pieces") + f" SELECT o_custkey % 10 AS group_no, count(*) AS n_titles, count(*) FILTER (id IN (SELECT l.id FROM titles l JOIN pieces r ON {TOUCH})) AS n_on_bog FROM titles GROUP BY 1")
def title_exists(spark: SparkSession, d: str) -> DataFrame:
    titles = fx.layer(spark, d, "titles", "o_custkey")
    met = sc.titles_on(titles, fx.layer(spark, d, "pieces"), "id").select("id", F.lit(1).alias("met"))
    return titles.join(met, "id", "left").groupBy((F.col("o_custkey") % 10).alias("group_no")).agg(F.count("*").alias("n_titles"), F.count("met").alias("n_on_bog"))


METRICS = f"""{with_layers("titles", "pieces", "leases")},
bog AS (SELECT id, count(*) * 2500 AS bog_m2 FROM ({shared_cells("titles", "pieces")}) GROUP BY id),
lease AS (SELECT id, count(*) * 2500 AS lease_m2 FROM ({shared_cells("titles", "leases")}) GROUP BY id),
metrics AS (SELECT t.id AS title_id, o_custkey, (x1 - x0) * (y1 - y0) AS title_m2, bog_m2, coalesce(lease_m2, 0) AS lease_m2 FROM titles t JOIN bog USING (id) LEFT JOIN lease USING (id))"""


@query(METRICS + " SELECT title_id, title_m2, bog_m2, round(100.0::DOUBLE * bog_m2 / title_m2, 4) AS bog_pct, row_number() OVER (ORDER BY bog_m2 DESC, title_id) AS bog_rank FROM metrics")
def title_bog_metrics(spark: SparkSession, d: str) -> DataFrame:
    titles = fx.layer(spark, d, "titles")
    bog = sc.bog_area(titles, fx.layer(spark, d, "pieces"), "id")
    out = titles.join(bog, "id").withColumn("title_m2", geo.st_area("geom"))
    out = out.select(F.col("id").alias("title_id"), whole("title_m2").alias("title_m2"), whole("bog_m2").alias("bog_m2"), F.round(sc.percent(F.col("bog_m2"), F.col("title_m2")), 4).alias("bog_pct"))
    return sc.web_rank(out, "bog_m2", "title_id", "bog_rank")


@query(METRICS + " SELECT title_id, bog_m2::BIGINT AS bog_m2, lease_m2::BIGINT AS lease_m2, round(100.0::DOUBLE * lease_m2 / title_m2, 4) AS lease_pct, (lease_m2 > 0)::INTEGER AS lease_flag FROM metrics")
def title_lease_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = sc.title_metrics(fx.layer(spark, d, "titles"), fx.layer(spark, d, "pieces"), fx.layer(spark, d, "leases"), "id")
    return m.select(F.col("id").alias("title_id"), whole("bog_m2").alias("bog_m2"), whole("lease_m2").alias("lease_m2"), F.round("lease_pct", 4).alias("lease_pct"), "lease_flag")


@query(METRICS + " SELECT title_id, bog_m2::BIGINT AS bog_m2, (bog_m2 > 20000)::INTEGER AS over_strict, (bog_m2 >= 20000)::INTEGER AS over_inclusive FROM metrics WHERE bog_m2 >= 20000")
def titles_over_threshold(spark: SparkSession, d: str) -> DataFrame:
    bog = sc.bog_area(fx.layer(spark, d, "titles"), fx.layer(spark, d, "pieces"), "id").select(F.col("id").alias("title_id"), whole("bog_m2").alias("bog_m2"))
    return bog.where("bog_m2 >= 20000").withColumns({"over_strict": (F.col("bog_m2") > 20000).cast("int"), "over_inclusive": (F.col("bog_m2") >= 20000).cast("int")})


# ---- Overlays and unions


@query(with_layers("titles", "pieces") + f" SELECT l.id AS title_id, r.id AS piece_id, (least(l.x1, r.x1) - greatest(l.x0, r.x0)) * (least(l.y1, r.y1) - greatest(l.y0, r.y0)) AS common_m2 FROM titles l JOIN pieces r ON {OVERLAP}")
def overlay_intersection(spark: SparkSession, d: str) -> DataFrame:
    cut = sc.common_areas(fx.layer(spark, d, "titles"), fx.layer(spark, d, "pieces"), "id", "id")
    # An area isn't negative, so a half goes up as in round(), at a fraction of its cost.
    return cut.select(F.col("l_id").alias("title_id"), F.col("r_id").alias("piece_id"), F.floor(F.col("m2") + 0.5).alias("common_m2"))


def _difference_sql(*masks: str) -> str:
    union = " UNION ALL ".join(f"SELECT x0, y0, x1, y1 FROM {m}" for m in masks)
    return f"""{with_layers("pieces", *masks)}, masks AS ({union}), gone AS ({shared_cells("pieces", "masks")})
    SELECT id AS piece_id, count(*) * 2500 AS rest_m2 FROM ({own_cells("pieces")}) c WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.id = c.id AND g.cx = c.cx AND g.cy = c.cy) GROUP BY id"""


def _rest(layer: DataFrame) -> DataFrame:
    return layer.select(F.col("id").alias("piece_id"), whole(geo.st_area("geom")).alias("rest_m2"))


@query(_difference_sql("leases", "state", "sac", "nha"))
def overlay_difference_chain(spark: SparkSession, d: str) -> DataFrame:
    masks = [fx.layer(spark, d, "leases"), *[fx.overlay(spark, d, n) for n in ("state", "sac", "nha")]]
    return _rest(sc.subtract(fx.layer(spark, d, "pieces").select("id", "geom"), masks, "id"))


@query(_difference_sql("commonage"))
def lpis_difference(spark: SparkSession, d: str) -> DataFrame:
    return _rest(spatial.overlay_difference(fx.layer(spark, d, "pieces").select("id", "geom"), fx.overlay(spark, d, "commonage"), "id"))


@query(with_layers("titles", "pieces") + f" SELECT id AS title_id, count(*) * 2500 AS union_m2 FROM ({shared_cells('titles', 'pieces')}) GROUP BY id")
def union_area_by_title(spark: SparkSession, d: str) -> DataFrame:
    return sc.bog_area(fx.layer(spark, d, "titles"), fx.layer(spark, d, "pieces"), "id").select(F.col("id").alias("title_id"), whole("bog_m2").alias("union_m2"))


GROUPED = f" SELECT group_no, count(*) * 2500 AS union_m2 FROM (SELECT DISTINCT id % 7 AS group_no, cx, cy FROM ({own_cells('pieces')})) GROUP BY 1"


@query(with_layers("pieces") + GROUPED)
def batched_union(spark: SparkSession, d: str) -> DataFrame:
    return spatial.union_by(fx.layer(spark, d, "pieces").select((F.col("id") % 7).alias("group_no"), "geom"), ["group_no"]).select("group_no", whole(geo.st_area("geom")).alias("union_m2"))


@query(with_layers("pieces") + f" SELECT count(*) * 2500 AS union_m2 FROM (SELECT DISTINCT cx, cy FROM ({own_cells('pieces')}))")
def dissolve_total(spark: SparkSession, d: str) -> DataFrame:
    return spatial.union_by(fx.layer(spark, d, "pieces").select("geom"), []).select(whole(geo.st_area("geom")).alias("union_m2"))


# ---- Exclusion and ranks

CLEAR = f"""{with_layers("titles", "pieces", "commonage", "forest")},
bog AS ({shared_cells("titles", "pieces")}), boxes AS (SELECT id, cx * 50 AS x0, cy * 50 AS y0, cx * 50 + 50 AS x1, cy * 50 + 50 AS y1 FROM bog),
common AS ({shared_cells("titles", "commonage")}), forested AS ({shared_cells("titles", "forest")}),
marked AS (SELECT b.*, c.id IS NOT NULL AS c, f.id IS NOT NULL AS f FROM bog b LEFT JOIN common c USING (id, cx, cy) LEFT JOIN forested f USING (id, cx, cy)),
clear AS (SELECT id AS title_id, count(*) * 2500 AS bog_m2, count(*) FILTER (c) * 2500 AS common_bog_m2, count(*) FILTER (f) * 2500 AS forest_bog_m2, count(*) FILTER (c OR f) * 2500 AS excluded_bog_m2 FROM marked GROUP BY id),
candidates AS (SELECT *, bog_m2 - excluded_bog_m2 AS clear_bog_m2, (common_bog_m2 >= 100)::INTEGER AS common_flag, (forest_bog_m2 >= 100)::INTEGER AS forest_flag FROM clear)"""


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    out = sc.title_exclusions(fx.layer(spark, d, "titles"), fx.layer(spark, d, "pieces"), fx.overlay(spark, d, "commonage"), fx.overlay(spark, d, "forest"), "id")
    areas = [whole(c).alias(c) for c in ("bog_m2", "common_bog_m2", "forest_bog_m2", "excluded_bog_m2", "clear_bog_m2")]
    return out.select(F.col("id").alias("title_id"), *areas, "common_flag", "forest_flag")


@query(CLEAR + " SELECT title_id, bog_m2, common_bog_m2, forest_bog_m2, excluded_bog_m2, clear_bog_m2, common_flag, forest_flag FROM candidates")
def commonage_forest_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d)


@query(CLEAR + " SELECT title_id, clear_bog_m2, row_number() OVER (ORDER BY clear_bog_m2 DESC, title_id) AS web_rank FROM candidates")
def clear_bog_rank(spark: SparkSession, d: str) -> DataFrame:
    return sc.web_rank(_candidates(spark, d).select("title_id", "clear_bog_m2"), "clear_bog_m2", "title_id")


@query(CLEAR + " SELECT r.title_id, web_rank, common_bog_m2 FROM (SELECT *, row_number() OVER (ORDER BY clear_bog_m2 DESC, title_id) AS web_rank FROM candidates) r WHERE common_flag = 1")
def rank_equi_join_overlay(spark: SparkSession, d: str) -> DataFrame:
    rows = _candidates(spark, d)
    overlays = rows.where("common_flag = 1").select("title_id", "common_bog_m2")
    return overlays.join(sc.web_rank(rows.select("title_id", "clear_bog_m2"), "clear_bog_m2", "title_id").select("title_id", "web_rank"), "title_id")


RANKS = """, ranked AS (SELECT title_id AS k, clear_bog_m2 AS v, row_number() OVER (ORDER BY clear_bog_m2 DESC, title_id) AS r FROM candidates),
both_ AS (SELECT 'ranked' AS name, r, v, k FROM ranked UNION ALL SELECT 'spoilt', CASE WHEN r % 7 = 0 THEN r + 1 ELSE r END, v, k FROM ranked),
pairs_ AS (SELECT a.name, count(*) FILTER (b.v > a.v OR (b.v = a.v AND b.k < a.k)) AS out_of_order FROM both_ a JOIN both_ b ON a.name = b.name AND b.r = a.r + 1 GROUP BY a.name)
SELECT b.name, count(*) AS n_rows, min(r) AS first_rank, max(r) AS last_rank, count(DISTINCT r) AS distinct_ranks, any_value(out_of_order) AS out_of_order FROM both_ b JOIN pairs_ p ON p.name = b.name GROUP BY b.name"""


@query(CLEAR + RANKS)
def rank_integrity(spark: SparkSession, d: str) -> DataFrame:
    """The gate on a good rank and on one with every seventh rank moved."""
    good = checkpointed(clear_bog_rank(spark, d))
    spoilt = good.withColumn("web_rank", F.when(F.col("web_rank") % 7 == 0, F.col("web_rank") + 1).otherwise(F.col("web_rank")))
    gate = lambda rows, name: expect.rank_integrity(rows, "web_rank", "clear_bog_m2", "title_id").select(F.lit(name).alias("name"), "*")
    return gate(good, "ranked").unionByName(gate(spoilt, "spoilt"))


@query(CLEAR + """ SELECT count(*) FILTER (common_flag = 1) AS n_flagged, count(*) FILTER (common_bog_m2 > 5000 AND title_id % 5 > 0) AS n_overlays,
    count(*) FILTER (common_flag = 1 AND NOT (common_bog_m2 > 5000 AND title_id % 5 > 0)) AS n_missing, count(*) FILTER (common_flag = 0 AND common_bog_m2 > 5000 AND title_id % 5 > 0) AS n_unflagged FROM candidates""")
def flag_overlay_parity(spark: SparkSession, d: str) -> DataFrame:
    """Flags against overlays of which some are gone."""
    rows = checkpointed(_candidates(spark, d))
    return expect.flag_parity(rows, "common_flag", rows.where("common_bog_m2 > 5000 AND title_id % 5 > 0"), "title_id")


@query(CLEAR + """ SELECT title_id, common_flag, (common_flag = 1 AND title_id % 5 > 0) AS shown, CASE common_flag WHEN 1 THEN 'yes' WHEN 0 THEN 'no' ELSE 'unknown' END AS flag_text FROM candidates""")
def overlay_shown_flags(spark: SparkSession, d: str) -> DataFrame:
    """Overlays that the page shows: flagged rows with a file; flags as words."""
    rows = checkpointed(_candidates(spark, d))
    shown = sc.overlay_shown(rows, rows.where("title_id % 5 > 0"), "title_id", "common_flag")
    return shown.select("title_id", "common_flag", "shown", sc.flag_text("common_flag").alias("flag_text"))


@query(METRICS + """, met AS (SELECT l.id, count(r.id) AS n_pieces, coalesce(sum(p_size), 0) AS sum_size FROM titles l LEFT JOIN (SELECT p.*, q.p_size FROM pieces p JOIN part q ON p.id = q.p_partkey) r ON """ + TOUCH + """ GROUP BY l.id)
SELECT id AS title_id, n_pieces, sum_size::BIGINT AS sum_size FROM met""")
def title_left_join_sum(spark: SparkSession, d: str) -> DataFrame:
    """Left outer spatial join, summed: titles without a piece keep a row of zeros."""
    joined = spatial.spatial_join(fx.layer(spark, d, "titles").select("id", "geom"), fx.layer(spark, d, "pieces", "p_size").select("id", "p_size", "geom"), "id", "left")
    return joined.groupBy(F.col("l_id").alias("title_id")).agg(F.count("r_id").alias("n_pieces"), F.coalesce(F.sum(F.col("r_p_size").cast("long")), F.lit(0)).alias("sum_size"))


@query(with_layers("titles", "pieces") + f""", met AS (SELECT l.id, max((l.x0 < r.x1 AND r.x0 < l.x1 AND l.y0 < r.y1 AND r.y0 < l.y1)::INTEGER) AS inside FROM titles l JOIN pieces r ON {TOUCH} GROUP BY l.id)
SELECT count(*) AS n_touching, count(*) FILTER (inside = 1) AS n_written, count(*) FILTER (inside = 0) AS n_boundary_only FROM met""")
def boundary_only_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles that touch a piece, those with a common area, and those with a common boundary only."""
    return sc.screening_counters(fx.layer(spark, d, "titles").select("id", "geom"), fx.layer(spark, d, "pieces").select("geom"), "id")


@query(CLEAR + " SELECT count(*) AS n_rows, count(*) FILTER (abs(clear_bog_m2 + excluded_bog_m2 - bog_m2) > 0.05) AS off_balance, count(*) FILTER (clear_bog_m2 < 0 OR excluded_bog_m2 > bog_m2) AS out_of_range, count(*) FILTER (abs(common_bog_m2 + forest_bog_m2 - excluded_bog_m2) > greatest(0.5, 0.02 * abs(excluded_bog_m2))) AS n_warned FROM candidates")
def area_reconcile(spark: SparkSession, d: str) -> DataFrame:
    rows = _candidates(spark, d).withColumns({"sum_m2": F.col("clear_bog_m2") + F.col("excluded_bog_m2"), "parts_m2": F.col("common_bog_m2") + F.col("forest_bog_m2")})
    return rows.agg(
        F.count("*").alias("n_rows"), F.count_if(expect.off_by("sum_m2", "bog_m2")).alias("off_balance"),
        F.count_if((F.col("clear_bog_m2") < 0) | (F.col("excluded_bog_m2") > F.col("bog_m2"))).alias("out_of_range"), F.count_if(expect.warning_off_by("parts_m2", "excluded_bog_m2")).alias("n_warned"),
    )


def web_export(spark: SparkSession, d: str) -> DataFrame:
    """Ranked candidates as GeoJSON in geographic coordinates, read back; whether the projected area is the exported one to a thousandth."""
    both = fx.overlay(spark, d, "commonage").select("geom").unionByName(fx.overlay(spark, d, "forest").select("geom"))
    clear = sc.footprints_without(fx.layer(spark, d, "titles"), fx.layer(spark, d, "pieces"), both, "id").withColumn("clear_bog_m2", whole(geo.st_area("geom")))
    path = f"{checkpoint_dir(spark)}/web-{uuid.uuid4().hex}"
    readers.export_web(sc.web_rank(clear, "clear_bog_m2", "id"), path, "id", 2157, crs.st_transform)
    back = readers.read_geojson(spark, path, "id bigint, clear_bog_m2 bigint, web_rank bigint")
    area = geo.st_area(crs.st_transform("geom", 4326, 2157))
    return back.select(F.col("id").alias("title_id"), "web_rank", "clear_bog_m2", (F.abs(area - F.col("clear_bog_m2")) <= 50 + 0.001 * F.col("clear_bog_m2")).alias("area_kept"))


QUERIES["web_export"] = web_export


# ---- Clusters


def _cluster_ctes(gap: int) -> str:
    gaps = " + ".join(f"pow(greatest(0, greatest(l.{a}0, r.{a}0) - least(l.{a}1, r.{a}1)), 2)" for a in "xy")
    return f"""near{gap} AS (SELECT l.id AS a, r.id AS b FROM pieces l JOIN pieces r ON l.id <> r.id AND {gaps} <= {gap * gap}),
reach{gap}(id, root) AS (SELECT id, id FROM pieces UNION SELECT n.b, w.root FROM reach{gap} w JOIN near{gap} n ON n.a = w.id AND n.b > w.root),
named{gap} AS (SELECT p.id, min(root) AS root, any_value((x1 - x0) * (y1 - y0)) AS m2 FROM pieces p JOIN reach{gap} w USING (id) GROUP BY p.id),
sums{gap} AS (SELECT root AS first_key, count(*) AS members, sum(m2)::BIGINT AS core_m2 FROM named{gap} GROUP BY root)"""


def _clusters(spark: SparkSession, d: str, gap: int) -> DataFrame:
    c = cluster.clusters(fx.layer(spark, d, "pieces").select("id", "geom"), "id", gap, 100_000)
    return c.select(F.col("cluster_id").cast("long").alias("cluster_id"), "first_key", "members", whole("core_area").alias("core_m2"), "meets")


def _clusters_sql(gap: int) -> str:
    return f"{with_layers('pieces')}, {_cluster_ctes(gap)} SELECT row_number() OVER (ORDER BY first_key) AS cluster_id, first_key, members, core_m2, (core_m2 >= 100000)::INTEGER AS meets FROM sums{gap}"


@query(_clusters_sql(100))
def proximity_clusters_g100(spark: SparkSession, d: str) -> DataFrame:
    return _clusters(spark, d, 100)


@query(_clusters_sql(250))
def proximity_clusters_g250(spark: SparkSession, d: str) -> DataFrame:
    return _clusters(spark, d, 250)


@query(_clusters_sql(500))
def proximity_clusters_g500(spark: SparkSession, d: str) -> DataFrame:
    return _clusters(spark, d, 500)


def _gap_row(gap: int) -> str:
    return f"SELECT {gap}::BIGINT AS gap_m, count(*) AS cluster_count, count(*) FILTER (core_m2 >= 100000) AS clusters_meeting, coalesce(sum(core_m2) FILTER (core_m2 >= 100000), 0)::BIGINT AS m2_meeting, coalesce(sum(core_m2) FILTER (core_m2 < 100000), 0)::BIGINT AS m2_below FROM sums{gap}"


@query(f"{with_layers('pieces')}, {_cluster_ctes(100)}, {_cluster_ctes(250)}, {_cluster_ctes(500)} " + " UNION ALL ".join(map(_gap_row, (100, 250, 500))))
def cluster_sensitivity(spark: SparkSession, d: str) -> DataFrame:
    s = cluster.sensitivity(fx.layer(spark, d, "pieces").select("id", "geom"), "id", [100, 250, 500], 100_000)
    return s.select(whole("link_gap_m").alias("gap_m"), "cluster_count", "clusters_meeting", whole("area_meeting").alias("m2_meeting"), whole("area_below").alias("m2_below"))


@query(f"{with_layers('pieces')}, {_cluster_ctes(250)} SELECT id AS piece_id, m2::BIGINT AS piece_m2 FROM named250 JOIN sums250 ON first_key = root WHERE core_m2 >= 100000")
def eligible_pieces(spark: SparkSession, d: str) -> DataFrame:
    pieces = fx.layer(spark, d, "pieces").select("id", "geom")
    names = cluster.link(pieces, "id", 250).join(pieces.select("id", geo.st_area("geom").alias("m2")), "id")
    big = names.groupBy("cluster").agg(F.sum("m2").alias("core")).where("core >= 100000")
    return names.join(big, "cluster", "left_semi").select(F.col("id").alias("piece_id"), whole("m2").alias("piece_m2"))


# ---- Rasters

SLOPE = f"""WITH g AS ({fx.SQL_RASTER}),
near AS (SELECT row, col, value AS c, lag(value) OVER v AS n, lead(value) OVER v AS s, lag(value) OVER h AS w, lead(value) OVER h AS e FROM g
    WINDOW v AS (PARTITION BY col ORDER BY row), h AS (PARTITION BY row ORDER BY col)),
grad AS (SELECT row, col, c,
    CASE WHEN w IS NULL AND e IS NULL THEN 0 ELSE (coalesce(w, c) - coalesce(e, c)) / (((w IS NOT NULL)::INTEGER + (e IS NOT NULL)::INTEGER) * {fx.GRID.dx}) END AS dx,
    CASE WHEN n IS NULL AND s IS NULL THEN 0 ELSE (coalesce(n, c) - coalesce(s, c)) / (((n IS NOT NULL)::INTEGER + (s IS NOT NULL)::INTEGER) * {fx.GRID.dy}) END AS dy FROM near),
slope AS (SELECT row, col, CASE WHEN c IS NOT NULL THEN 100 * sqrt(dx * dx + dy * dy) END AS value FROM grad)"""


@query(SLOPE + " SELECT row, col, round(value, 4) AS slope_pct FROM slope")
def slope_zt(spark: SparkSession, d: str) -> DataFrame:
    return raster.slope_percent(fx.raster(spark, d), fx.GRID).select("row", "col", F.round("value", 4).alias("slope_pct"))


@query(SLOPE + " SELECT count(*) AS n_cells, count(value) AS n_values, count(*) FILTER (value BETWEEN 0 AND 15) AS n_low, round(max(value), 4) AS max_slope, (min(value) >= 0 AND max(value) > 0) AS in_range FROM slope")
def slope_mask(spark: SparkSession, d: str) -> DataFrame:
    slope = raster.slope_percent(fx.raster(spark, d), fx.GRID)
    low = raster.mask(slope, 0, 15)
    s = raster.band_stats(slope)
    return low.agg(F.sum("value").alias("n_low")).join(s).select(
        "n_cells", "n_values", "n_low", F.round("max_value", 4).alias("max_slope"), ((F.col("min_value") >= 0) & (F.col("max_value") > 0)).alias("in_range")
    )


SHAPES_SQL = f"""WITH g AS ({fx.SQL_RASTER}), shapes AS (
    SELECT 'grid' AS name, min(row) AS a, max(row) AS b, min(col) AS c, max(col) AS d, count(*) AS n FROM g UNION ALL SELECT 'low', min(row), max(row), min(col), max(col), count(*) FROM g
    UNION ALL SELECT 'cropped', min(row), max(row), min(col), max(col), count(*) FROM g WHERE row < 400 UNION ALL SELECT 'known', min(row), max(row), min(col), max(col), count(*) FROM g WHERE value IS NOT NULL)
SELECT x.name, (x.a = y.a AND x.b = y.b AND x.c = y.c AND x.d = y.d AND x.n = y.n) AS same_shape FROM shapes x, shapes y WHERE y.name = 'grid'"""


@query(SHAPES_SQL)
def grid_shape_equal(spark: SparkSession, d: str) -> DataFrame:
    """A grid against itself, its mask, a part of it, and its cells with a value."""
    grid = fx.raster(spark, d)
    others = {"grid": grid, "low": raster.mask(grid, 0, 15), "cropped": grid.where("row < 400"), "known": grid.where("value IS NOT NULL")}
    out = None
    for name, other in others.items():
        one = raster.same_shape(grid, other).select(F.lit(name).alias("name"), "same_shape")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT printf('N%02d_W%03d', a, b) AS tile FROM range(51, 56) x(a), range(6, 12) y(b) EXCEPT SELECT 'N53_W00' || (6 + n_nationkey % 3) FROM nation")
def missing_degree_tiles(spark: SparkSession, d: str) -> DataFrame:
    there = fx.table(spark, d, "nation").select(F.concat(F.lit("N53_W00"), (F.col("n_nationkey") % 3 + 6).cast("string")).alias("tile"))
    return readers.degree_tiles(spark, range(51, 56), range(-11, -5)).join(there, "tile", "left_anti")


LOW = f"low AS (SELECT row, col, CASE WHEN value IS NOT NULL THEN (value BETWEEN 0 AND 60)::INTEGER END AS value FROM ({fx.SQL_RASTER}))"
ZONES = f"""{with_layers("titles")}, {LOW},
zoned AS (SELECT id, value FROM (SELECT id, c, unnest(range(r0, r1 + 1)) AS r FROM (SELECT id, r0, r1, unnest(range(c0, c1 + 1)) AS c FROM (
    SELECT id, (x0 + 50) // 100 AS c0, (x1 - 51) // 100 AS c1, (50000 - y1 + 50) // 100 AS r0, (50000 - y0 - 51) // 100 AS r1 FROM titles)))
    JOIN low ON low.row = r AND low.col = c),
zonal AS (SELECT t.id, (x1 - x0) * (y1 - y0) AS bog_m2, count(z.value) AS cells, coalesce(sum(z.value), 0)::BIGINT AS low_cells FROM titles t LEFT JOIN zoned z USING (id) GROUP BY ALL)"""


def _low(spark: SparkSession, d: str) -> DataFrame:
    return raster.mask(fx.raster(spark, d), 0, 60)


@query(ZONES + " SELECT id AS title_id, cells, low_cells FROM zonal")
def zonal_low_slope(spark: SparkSession, d: str) -> DataFrame:
    z = raster.zonal(fx.layer(spark, d, "titles").select("id", "geom"), _low(spark, d), fx.GRID, "id")
    return z.select(F.col("id").alias("title_id"), "cells", F.coalesce("total", F.lit(0)).alias("low_cells"))


@query(ZONES + ", s AS (SELECT *, CASE WHEN cells > 0 THEN bog_m2 * (low_cells / cells) ELSE 0 END AS low FROM zonal) SELECT id AS title_id, round(CASE WHEN cells > 0 THEN 100 * low_cells / cells ELSE 0 END, 4) AS low_pct, round(low, 2) AS low_m2, round(bog_m2 - low, 2) AS over_m2, (low >= 60000)::INTEGER AS slope_pass FROM s")
def slope_screen_pass(spark: SparkSession, d: str) -> DataFrame:
    s = sc.slope_screen(fx.layer(spark, d, "titles").select("id", "geom"), _low(spark, d), fx.GRID, "id", 60_000)
    return s.select(F.col("id").alias("title_id"), F.round("low_pct", 4).alias("low_pct"), F.round("low_m2", 2).alias("low_m2"), F.round("over_m2", 2).alias("over_m2"), "slope_pass")


@query(ZONES + ", s AS (SELECT *, CASE WHEN cells > 0 THEN bog_m2 * (low_cells / cells) ELSE 0 END AS low FROM zonal) SELECT id AS title_id, round(low, 2) AS low_m2, row_number() OVER (ORDER BY low DESC, id) AS low_rank FROM s")
def low15_rank(spark: SparkSession, d: str) -> DataFrame:
    s = sc.slope_screen(fx.layer(spark, d, "titles").select("id", "geom"), _low(spark, d), fx.GRID, "id", 60_000)
    return sc.web_rank(s.select(F.col("id").alias("title_id"), "low_m2"), "low_m2", "title_id", "low_rank").select("title_id", F.round("low_m2", 2).alias("low_m2"), F.col("low_rank"))


@query(f"""WITH {LOW}, steep AS (SELECT row, col, row // 256 AS tile FROM low WHERE coalesce(value, 0) <> 1),
runs AS (SELECT tile, row, min(col) AS col0, max(col) AS col1 FROM (SELECT *, col - row_number() OVER (PARTITION BY row ORDER BY col) AS g FROM steep) GROUP BY tile, row, g)
SELECT min(row) AS row0, max(row) AS row1, col0, col1 FROM (SELECT *, row - row_number() OVER (PARTITION BY tile, col0, col1 ORDER BY row) AS h FROM runs) GROUP BY tile, col0, col1, h""")
def run_merge_rectangles(spark: SparkSession, d: str) -> DataFrame:
    steep = _low(spark, d).where(F.coalesce("value", F.lit(0)) != 1).withColumn("tile", F.floor(F.col("row") / raster.BLOCK))
    return raster.merge_runs(steep, ["tile"]).select("row0", "row1", "col0", "col1")


@query(f"""{with_layers("titles", "pieces")}, {LOW}, bog AS ({shared_cells("titles", "pieces")})
SELECT id AS title_id, count(*) * 2500 AS low_slope_m2 FROM bog LEFT JOIN low ON low.col = cx // 2 AND low.row = floor((999 - cy) / 2) WHERE low.value = 1 OR low.row IS NULL GROUP BY id""")
def low_slope_overlay_area(spark: SparkSession, d: str) -> DataFrame:
    area = sc.area_without(fx.layer(spark, d, "titles"), fx.layer(spark, d, "pieces"), sc.steep_boxes(_low(spark, d), fx.GRID), "id")
    return area.select(F.col("id").alias("title_id"), whole("m2").alias("low_slope_m2"))


# ---- Nearest road

ROAD_TYPES = ("click", "view", "purchase")
FIXTURE_BANDS = (("Good", 3, 150.0), ("Moderate", 2, 300.0))
NEAR = f"""{with_layers("pieces", "roads")},
met AS (SELECT l.id AS piece_id, r.id AS road_id, event_type, pow(greatest(0, greatest(l.x0, r.x0) - least(l.x1, r.x1)), 2) + pow(greatest(0, greatest(l.y0, r.y0) - least(l.y1, r.y1)), 2) AS d2
    FROM pieces l JOIN roads r ON event_type IN {ROAD_TYPES} AND l.x0 - 500 <= r.x1 AND r.x0 <= l.x1 + 500 AND l.y0 - 500 <= r.y1 AND r.y0 <= l.y1 + 500),
best AS (SELECT piece_id, min(d2) AS d2, arg_min(road_id, (d2, road_id)) AS road_id, arg_min(event_type, (d2, road_id)) AS road_class FROM met WHERE d2 <= 250000 GROUP BY piece_id),
banded AS (SELECT p.id AS piece_id, road_id, coalesce(road_class, '') AS road_class, round(sqrt(d2), 4) AS access_dist_m,
    CASE WHEN d2 <= 22500 THEN 'Good' WHEN d2 <= 90000 THEN 'Moderate' ELSE 'Poor' END AS access_band, CASE WHEN d2 <= 22500 THEN 3 WHEN d2 <= 90000 THEN 2 ELSE 1 END AS access_score
    FROM pieces p LEFT JOIN best ON best.piece_id = p.id)"""


def _access(spark: SparkSession, d: str) -> DataFrame:
    roads = fx.layer(spark, d, "roads", "event_type").where(F.col("event_type").isin(*ROAD_TYPES)).select(F.col("id").alias("road_id"), F.col("event_type").alias("road_class"), "geom")
    clear = fx.layer(spark, d, "pieces").select("id", "geom").withColumn("clear_bog_m2", geo.st_area("geom"))
    return sc.access(clear, roads, "id", "road_id", 500.0, FIXTURE_BANDS)


@query(NEAR + " SELECT piece_id, road_id, road_class, access_dist_m, access_band, access_score FROM banded")
def nearest_road(spark: SparkSession, d: str) -> DataFrame:
    return _access(spark, d).select(F.col("id").alias("piece_id"), "road_id", F.coalesce("road_class", F.lit("")).alias("road_class"), F.round("distance", 4).alias("access_dist_m"), "access_band", "access_score")


@query(NEAR + " SELECT s::BIGINT AS score, count(piece_id) AS n_rows FROM range(4) v(s) LEFT JOIN banded ON access_score = s GROUP BY s")
def access_band_histogram(spark: SparkSession, d: str) -> DataFrame:
    return sc.histogram(_access(spark, d), "access_score", range(4))


@query(NEAR + " SELECT road_id, count(*) AS n_pieces FROM met GROUP BY road_id")
def road_prefilter(spark: SparkSession, d: str) -> DataFrame:
    roads = fx.layer(spark, d, "roads", "event_type").where(F.col("event_type").isin(*ROAD_TYPES)).select("id", "geom")
    return spatial.count_near(fx.layer(spark, d, "pieces"), roads, "id", 500.0).select(F.col("id").alias("road_id"), F.col("n").alias("n_pieces"))


@query(NEAR + """ SELECT count(*) AS n_rows, count(*) FILTER (road_id IS NULL) AS n_without,
    count(*) FILTER (access_score <> CASE WHEN access_dist_m <= 150 THEN 3 WHEN access_dist_m <= 300 THEN 2 ELSE 1 END) AS n_inconsistent FROM banded""")
def access_consistency(spark: SparkSession, d: str) -> DataFrame:
    a = _access(spark, d)
    dist, score = F.col("distance"), F.col("access_score")
    ok = ((score == 3) & (dist <= 150)) | ((score == 2) & (dist > 150) & (dist <= 300)) | ((score == 1) & (dist.isNull() | (dist > 300))) | (score == 0)
    return a.agg(F.count("*").alias("n_rows"), F.count_if(F.col("road_id").isNull()).alias("n_without"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("n_inconsistent"))


# ---- Geometry and scalars


@query(with_layers("pieces") + " SELECT id % 50 AS group_no, id AS piece_id, (x1 - x0) * (y1 - y0) AS part_m2 FROM pieces UNION ALL SELECT id % 50, id, 50 * (y1 - y0) FROM pieces")
def multipart_explode(spark: SparkSession, d: str) -> DataFrame:
    """Multipolygons of a piece and a strip beside it, one row per part."""
    pieces = fx.layer(spark, d, "pieces")
    strip = geo.st_rect(F.col("x1") + 50, F.col("y0"), F.col("x1") + 100, F.col("y1"))
    twin = pieces.select("id", geo.st_collect(F.array("geom", strip)).alias("geom"))
    return spatial.singleparts(twin).select((F.col("id") % 50).alias("group_no"), F.col("id").alias("piece_id"), whole(geo.st_area("geom")).alias("part_m2"))


@query(with_layers("titles") + " SELECT min(x0)::DOUBLE AS xmin, min(y0)::DOUBLE AS ymin, max(x1)::DOUBLE AS xmax, max(y1)::DOUBLE AS ymax FROM titles")
def bbox_extent(spark: SparkSession, d: str) -> DataFrame:
    return spatial.extent(fx.layer(spark, d, "titles"))


@query(with_layers("titles") + " SELECT DISTINCT tx, unnest(range(y0 // 20000, y1 // 20000 + 1)) AS ty FROM (SELECT y0, y1, unnest(range(x0 // 20000, x1 // 20000 + 1)) AS tx FROM titles)")
def tile_keys(spark: SparkSession, d: str) -> DataFrame:
    b = fx.layer(spark, d, "titles").select(geo.st_bounds("geom").alias("b"))
    return b.select(F.explode(spatial.tiles(*[F.col(f"b.{c}") for c in ("xmin", "ymin", "xmax", "ymax")], 20_000)).alias("t")).select("t.tx", "t.ty").distinct()


@query(with_layers("titles") + " SELECT id AS title_id, true AS contained, (x0 + x1) // 2 AS itm_easting FROM titles")
def interior_point_contained(spark: SparkSession, d: str) -> DataFrame:
    p = fx.layer(spark, d, "titles").withColumn("p", geo.st_interior_point("geom"))
    return p.select(F.col("id").alias("title_id"), geo.st_contains("geom", "p").alias("contained"), F.round(geo.st_x("p")).cast("long").alias("itm_easting"))


# Geometries with known outcomes (name, text, area after normalising or null).
SHAPES = (
    ("square", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))", 100), ("hole", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (2 2, 4 2, 4 4, 2 4, 2 2))", 96),
    ("bow tie", "POLYGON ((0 0, 10 10, 10 0, 0 10, 0 0))", 50), ("collection", "GEOMETRYCOLLECTION (POLYGON ((0 0, 5 0, 5 5, 0 5, 0 0)), LINESTRING (0 0, 9 9), POINT (1 1))", 25),
    ("with Z", "POLYGON Z ((0 0 7, 4 0 7, 4 4 7, 0 4 7, 0 0 7))", 16), ("line", "LINESTRING (0 0, 1 1)", None), ("empty", "POLYGON EMPTY", None), ("absent", None, None),
)


def _values(rows: tuple[tuple, ...]) -> str:
    cell = lambda v: "NULL" if v is None else str(v) if isinstance(v, int | float) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows)


@query(f"SELECT name, m2::BIGINT AS m2, CASE WHEN m2 IS NOT NULL THEN 'MultiPolygon' END AS kind FROM (VALUES {_values(tuple((n, a) for n, _, a in SHAPES))}) v(name, m2)")
def geometry_normalise(spark: SparkSession, d: str) -> DataFrame:
    shapes = spark.sql(f"SELECT * FROM VALUES {_values(tuple((n, t) for n, t, _ in SHAPES))} v(name, wkt)").withColumn("g", geo.st_polygonal(geo.st_from_wkt("wkt")))
    return shapes.select("name", whole(geo.st_area("g")).alias("m2"), geo.st_type("g").alias("kind"))


LINES = (("line", "LINESTRING Z (0 0 1, 3 4 1)", 5), ("collection", "GEOMETRYCOLLECTION (LINESTRING (0 0, 0 7), POINT (1 1))", 7), ("point", "POINT (1 1)", None), ("absent", None, None))


@query(f"SELECT name, m::BIGINT AS length_m FROM (VALUES {_values(tuple((n, a) for n, _, a in LINES))}) v(name, m)")
def line_normalise(spark: SparkSession, d: str) -> DataFrame:
    shapes = spark.sql(f"SELECT * FROM VALUES {_values(tuple((n, t) for n, t, _ in LINES))} v(name, wkt)")
    return shapes.select("name", whole(geo.st_length(geo.st_linear(geo.st_from_wkt("wkt")))).alias("length_m"))


@query(f"""{with_layers("pieces", "state", "sac")}, both_ AS (SELECT x0, y0, x1, y1 FROM state UNION ALL SELECT x0, y0, x1, y1 FROM sac),
active AS (SELECT DISTINCT cx, unnest(range(y0 // 50, y1 // 50)) AS cy FROM (SELECT y0, y1, unnest(range(x0 // 50, x1 // 50)) AS cx FROM both_)), bog AS (SELECT DISTINCT cx, cy FROM ({own_cells("pieces")})),
f AS (SELECT count(*) * 2500 AS total, count(*) FILTER (EXISTS (SELECT 1 FROM bog WHERE bog.cx = active.cx AND bog.cy = active.cy)) * 2500 AS inside FROM active)
SELECT 'total' AS metric, total AS m2, 100.0::DOUBLE AS pct FROM f UNION ALL SELECT 'overlap', inside, round(100.0::DOUBLE * inside / total, 2) FROM f UNION ALL SELECT 'outside', total - inside, round(100.0::DOUBLE * (total - inside) / total, 2) FROM f""")
def qa_agreement_pct(spark: SparkSession, d: str) -> DataFrame:
    merged = fx.overlay(spark, d, "state").select("geom", F.lit("a").alias("first")).unionByName(fx.overlay(spark, d, "sac").select("geom", F.lit("b").alias("second")), allowMissingColumns=True)
    parts = merged.select("geom").withColumn("id", F.xxhash64("geom"))
    bog = fx.layer(spark, d, "pieces").select("geom")
    # Areas are counted once: the parts are cut by the bog, then everything is dissolved.
    inside = spatial.union_by(spatial.footprint(parts.dropDuplicates(["id"]), bog, "id").select("geom"), []).select(geo.st_area("geom").alias("inside"))
    f = spatial.union_by(parts.select("geom"), []).select(geo.st_area("geom").alias("total")).join(F.broadcast(inside))
    pct = lambda c: F.round(F.when(F.col("total") != 0, 100 * c / F.col("total")).otherwise(0.0), 2)
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), whole(c).alias("m2"), pct(c).alias("pct")) for n, c in (("total", F.col("total")), ("overlap", F.col("inside")), ("outside", F.col("total") - F.col("inside")))])
    return f.select(F.explode(rows).alias("r")).select("r.*")


# ---- Rows for the atlas

ATLAS = f"""{with_layers("titles")}, atlas AS (SELECT t.id AS title_id, n_name AS county, row_number() OVER (ORDER BY (x1 - x0) * (y1 - y0) DESC, t.id) AS web_rank, (x1 - x0) * (y1 - y0) AS title_m2, x0 AS easting, y0 AS northing
FROM titles t JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""


def _atlas(spark: SparkSession, d: str) -> DataFrame:
    county = fx.table(spark, d, "customer").join(fx.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("county"))
    rows = fx.layer(spark, d, "titles", "o_custkey").join(county, F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.select(F.col("id").alias("title_id"), "county", whole(geo.st_area("geom")).alias("title_m2"), F.col("x0").alias("easting"), F.col("y0").alias("northing"))
    return sc.web_rank(rows, "title_m2", "title_id")


@query(ATLAS + " SELECT title_id, web_rank, county FROM atlas WHERE county = (SELECT min(n_name) FROM nation) AND contains(lower(concat_ws(' ', web_rank, county, easting, northing)), '50')")
def atlas_filter(spark: SparkSession, d: str) -> DataFrame:
    county = fx.table(spark, d, "nation").agg(F.min("n_name")).first()[0]
    return sc.atlas(_atlas(spark, d), county, " 50 ", sc.search_text("web_rank", "county", "easting", "northing")).select("title_id", "web_rank", "county")


@query(ATLAS + " SELECT title_id, web_rank, ((web_rank + 24) // 25) AS page_no FROM atlas ORDER BY web_rank LIMIT 25 OFFSET 50")
def atlas_page(spark: SparkSession, d: str) -> DataFrame:
    return sc.page(_atlas(spark, d), 3, 25, "web_rank").select("title_id", "web_rank", F.ceil(F.col("web_rank") / 25).alias("page_no"))


@query(ATLAS + " SELECT title_id, web_rank, county FROM atlas WHERE web_rank = regexp_extract('#candidate-17', '^#candidate-(\\d+)$', 1)::BIGINT")
def select_candidate(spark: SparkSession, d: str) -> DataFrame:
    wanted = F.regexp_extract(F.lit("#candidate-17"), r"^#candidate-(\d+)$", 1).cast("long")
    return _atlas(spark, d).where(F.col("web_rank") == wanted).select("title_id", "web_rank", "county")


@query(ATLAS + " SELECT DISTINCT county FROM atlas ORDER BY county")
def distinct_counties(spark: SparkSession, d: str) -> DataFrame:
    return _atlas(spark, d).select("county").distinct().orderBy("county")


@query(ATLAS + " SELECT county, count(*) AS n_rows, count(DISTINCT title_id) AS n_ids, count(DISTINCT title_m2) AS n_areas, min(web_rank) AS best_rank, sum(title_m2)::BIGINT AS sum_m2 FROM atlas GROUP BY county")
def count_distinct_ids(spark: SparkSession, d: str) -> DataFrame:
    return _atlas(spark, d).groupBy("county").agg(F.count("*").alias("n_rows"), F.count_distinct("title_id").alias("n_ids"), F.count_distinct("title_m2").alias("n_areas"), F.min("web_rank").alias("best_rank"), F.sum("title_m2").alias("sum_m2"))


@query("SELECT l_orderkey, l_partkey, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_key_check(spark: SparkSession, d: str) -> DataFrame:
    return expect.duplicates(fx.table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"])


@query("SELECT l_orderkey, l_linenumber AS first_line, l_partkey AS first_part FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) = 1")
def dedupe_keep_first(spark: SparkSession, d: str) -> DataFrame:
    first = F.min(F.struct("l_linenumber", "l_partkey")).alias("f")
    return fx.table(spark, d, "lineitem").groupBy("l_orderkey").agg(first).select("l_orderkey", F.col("f.l_linenumber").alias("first_line"), F.col("f.l_partkey").alias("first_part"))


@query("SELECT event_id, coalesce(CASE WHEN event_type <> 'view' THEN event_type END, '') AS label, event_type || ':' || coalesce(CASE WHEN user_id % 3 > 0 THEN user_id END, event_id)::VARCHAR AS key_text FROM events")
def null_clean_text(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "events")
    text = F.when(F.col("event_type") != "view", F.col("event_type"))
    return e.select("event_id", F.coalesce(text, F.lit("")).alias("label"), F.concat_ws(":", "event_type", F.coalesce(F.when(F.col("user_id") % 3 > 0, F.col("user_id")), F.col("event_id")).cast("string")).alias("key_text"))


@query("SELECT l_orderkey, l_linenumber, round(CASE WHEN l_quantity - 10 > 0 THEN least(100.0, greatest(0.0, 100 * (l_discount * 1000) / (l_quantity - 10))) ELSE 0.0 END, 4) AS pct FROM lineitem")
def percent_clamp(spark: SparkSession, d: str) -> DataFrame:
    p = sc.percent(F.col("l_discount") * 1000, F.col("l_quantity") - 10)
    return fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(p, 4).alias("pct"))


@query("SELECT o_orderkey, printf('%dh %02dm %02ds', o_orderkey // 3600, o_orderkey // 60 % 60, o_orderkey % 60) AS duration, lpad(o_custkey::VARCHAR, 7, '0') AS padded, lower(trim(o_orderpriority)) AS priority, starts_with(o_orderpriority, '1') AS urgent, printf('%.2f', o_orderkey / 7) AS two_places, (o_orderkey // 7) AS quotient, (o_orderkey % 7) AS remainder FROM orders")
def format_cases(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return fx.table(spark, d, "orders").select(
        "o_orderkey", sc.duration_text(k).alias("duration"), F.lpad(F.col("o_custkey").cast("string"), 7, "0").alias("padded"), F.lower(F.trim("o_orderpriority")).alias("priority"),
        F.startswith("o_orderpriority", F.lit("1")).alias("urgent"), F.format_string("%.2f", k / 7).alias("two_places"), F.floor(k / 7).alias("quotient"), (k % 7).alias("remainder"),
    )


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS price FROM customer UNION ALL BY NAME SELECT p_partkey AS id, p_name AS name, NULL AS segment, p_retailprice AS price FROM part")
def merge_by_name(spark: SparkSession, d: str) -> DataFrame:
    a = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = fx.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT e.event_id, json_extract_string(props, '$.k')::BIGINT AS k, coalesce(json_extract_string(props, '$.none'), 'absent') AS none FROM events e")
def json_properties(spark: SparkSession, d: str) -> DataFrame:
    return fx.table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.coalesce(F.get_json_object("props", "$.none"), F.lit("absent")).alias("none"))


# Ellipsoid and projection parameters of the projected national system (EPSG:2157).
TM = {"a": 6378137.0, "f": 298.257222101, "k0": 0.99982, "lat0": 53.5, "lon0": -8.0, "e0": 600000.0, "n0": 750000.0}
#: The projection as a plain series of powers of the longitude, independent of the one in ``crs``.
PROJECT_SQL = f"""WITH p AS (SELECT n_nationkey, radians(51.6 + n_nationkey * 0.14) AS lat, radians(-10.2 + n_nationkey * 0.17) - radians({TM["lon0"]}) AS l, {TM["a"]}::DOUBLE AS a, 1 / {TM["f"]}::DOUBLE AS f, radians({TM["lat0"]}) AS lat0 FROM nation),
e AS (SELECT *, f * (2 - f) AS e2, f / (2 - f) AS n, a * (1 - f) AS b FROM p),
m AS (SELECT *, e2 / (1 - e2) * pow(cos(lat), 2) AS eta2, a / sqrt(1 - e2 * pow(sin(lat), 2)) AS nu, tan(lat) AS t,
    b * {TM["k0"]} * ((1 + n + 5 / 4::DOUBLE * n * n + 5 / 4::DOUBLE * n * n * n) * (lat - lat0) - (3 * n + 3 * n * n + 21 / 8::DOUBLE * n * n * n) * sin(lat - lat0) * cos(lat + lat0)
        + (15 / 8::DOUBLE * n * n + 15 / 8::DOUBLE * n * n * n) * sin(2 * (lat - lat0)) * cos(2 * (lat + lat0)) - 35 / 24::DOUBLE * n * n * n * sin(3 * (lat - lat0)) * cos(3 * (lat + lat0))) AS arc FROM e)
SELECT n_nationkey, round({TM["e0"]} + {TM["k0"]} * nu * (l * cos(lat) + pow(l * cos(lat), 3) / 6 * (1 - t * t + eta2) + pow(l * cos(lat), 5) / 120 * (5 - 18 * t * t + pow(t, 4) + 14 * eta2 - 58 * t * t * eta2)))::BIGINT AS easting,
    round({TM["n0"]} + arc + {TM["k0"]} * nu * t * (pow(l * cos(lat), 2) / 2 + pow(l * cos(lat), 4) / 24 * (5 - t * t + 9 * eta2 + 4 * eta2 * eta2) + pow(l * cos(lat), 6) / 720 * (61 - 58 * t * t + pow(t, 4) + 270 * eta2 - 330 * t * t * eta2)))::BIGINT AS northing,
    true AS back_within_mm FROM m"""


@query(PROJECT_SQL)
def crs_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Geographic points projected (to the metre), and whether they come back through a third system to a millimetre."""
    lat, lon = 51.6 + F.col("n_nationkey") * 0.14, -10.2 + F.col("n_nationkey") * 0.17
    points = fx.table(spark, d, "nation").withColumn("g", geo.st_from_wkt(F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))))
    points = points.withColumn("p", crs.st_transform("g", 4326, 2157))
    back = geo.st_distance("p", crs.st_transform(crs.st_transform("p", 2157, 29902), 29902, 2157))
    return points.select(F.col("n_nationkey").cast("int").alias("n_nationkey"), whole(geo.st_x("p")).alias("easting"), whole(geo.st_y("p")).alias("northing"), (back < 0.001).alias("back_within_mm"))


QUERIES.update(ROUNDTRIPS)
_SQUARES = "SELECT {} FROM (VALUES (1::BIGINT, 'plain', 100::BIGINT), (2::BIGINT, 'holed', 96::BIGINT)) v(id, name, m2)"
_REGISTER = "register AS (SELECT n_nationkey AS k, n_nationkey::VARCHAR AS source_id, n_name || ' | data, \"quoted\"' AS dataset_name FROM nation)"
ORACLE_SQL.update({
    "geojson_roundtrip": with_layers("nha") + " SELECT id AS source_fid, (x1 - x0) * (y1 - y0) AS m2 FROM nha",
    "publish_roundtrip": with_layers("pieces") + " SELECT id, (x1 - x0) * (y1 - y0) AS m2 FROM pieces",
    "web_export": CLEAR + " SELECT title_id, row_number() OVER (ORDER BY clear_bog_m2 DESC, title_id) AS web_rank, clear_bog_m2, true AS area_kept FROM candidates WHERE clear_bog_m2 > 0",
    "shapefile_scan": _SQUARES.format("id, name, m2"),
    "gpkg_scan": _SQUARES.format("id AS source_fid, name AS county, m2"),
    "register_required_columns": f"WITH {_REGISTER} SELECT source_id, 'download_url is blank' AS problem FROM register WHERE k % 5 = 0 UNION ALL SELECT source_id, 'local_file is blank' FROM register WHERE k % 7 = 0",
    "register_report": f"""WITH {_REGISTER} SELECT 0 AS line_no, '| source_id | dataset_name | status |' AS line UNION ALL SELECT 1, '| --- | --- | --- |'
        UNION ALL SELECT (row_number() OVER (ORDER BY source_id) + 1)::INTEGER, '| ' || source_id || ' | ' || replace(dataset_name, '|', '\\|') || ' | x |' FROM register""",
    "report_roundtrip": "SELECT c_mktsegment, printf('%.2f', sum(c_acctbal)) AS total, count(*)::VARCHAR AS n_rows FROM customer GROUP BY c_mktsegment",
})
