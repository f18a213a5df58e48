"""Cases that a review found: what failed, was wrong, or grew too fast."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasift.functions import crs, geo
from terrasift.operators import raster, spatial
from terrasift.sources import readers

from .test_geometry import areas, box, covered, random_boxes, shapes


def test_polygons_are_exported_as_multipolygons(spark, tmp_path):
    """an untouched footprint is a plain polygon, which the export refused."""
    p = shapes(spark, [(1, box(600000, 750000, 601000, 751000)), (2, "MULTIPOLYGON (((600000 750000, 600500 750000, 600500 750500, 600000 750500, 600000 750000)))")])
    readers.export_web(p, f"{tmp_path}/web", "id", 2157, crs.st_transform)
    back = readers.read_geojson(spark, f"{tmp_path}/web", "id bigint")
    got = {r.id: (r.kind, round(r.m2, -3)) for r in back.select("id", geo.st_type("geom").alias("kind"), geo.st_area(crs.st_transform("geom", 4326, 2157)).alias("m2")).collect()}
    assert got == {1: ("MultiPolygon", 1_000_000), 2: ("MultiPolygon", 250_000)}


def test_dissolved_parts_are_disjoint(spark):
    """F11 to F24: what lies on each other is united per cell before a left row meets it; parts of several grids don't overlap, and none has a hole after the cut."""
    rects = [(i, r) for i, r in random_boxes(11, 150, 2000, 400)] + [(500, (-3000, -200, 3000, 150)), (501, (100, -2500, 250, 2500))]
    ring = [(600, (5000, 5000, 5300, 5050)), (601, (5000, 5000, 5050, 5300)), (602, (5250, 5000, 5300, 5300)), (603, (5000, 5250, 5300, 5300))]
    right = shapes(spark, [(i, box(*r)) for i, r in rects + ring] + [(998, None), (999, "POLYGON EMPTY")])
    parts = spatial.without_holes(spatial.dissolved(right, []), [])
    total = len(covered([r for _, r in rects + ring])) * 2500
    assert parts.select(F.sum(geo.st_area("geom"))).first()[0] == total
    assert spatial.union_by(parts, []).select(geo.st_area("geom")).first()[0] == total
    assert parts.where(geo.st_num_parts(geo.st_boundary("geom")) > 1).count() == 0
    # Rectangles, the same turned into triangles' sums, and a title inside the hole.
    left = random_boxes(12, 80, 2500, 700) + [(900, (5100, 5100, 5200, 5200)), (901, (4900, 4900, 5400, 5400))]
    cells = covered([r for _, r in rects + ring])
    want = {i: len(covered([r]) & cells) * 2500.0 for i, r in left}
    whole = spatial.covered(shapes(spark, [(i, box(*r)) for i, r in left]), {"m2": parts}, "id")
    assert {r.id: r.m2 for r in whole.collect()} == {i: v for i, v in want.items() if v}
    halves = [(2 * i + k, f"POLYGON (({x0} {y0}, {x1 if k else x0} {y0 if k else y1}, {x1} {y1}, {x0} {y0}))") for i, (x0, y0, x1, y1) in left for k in (0, 1)]
    got = Counter()
    for r in spatial.covered(shapes(spark, halves), {"m2": parts}, "id").collect():
        got[r.id // 2] += r.m2
    assert got == pytest.approx({i: v for i, v in want.items() if v})


def test_cost_does_not_grow_with_the_depth(spark):
    """F11 to F24: two hundred pieces on one spot meet a title in as few rows as one piece."""
    pile = shapes(spark, [(i, box(0, 0, 300 + i, 300)) for i in range(200)])
    assert spatial.dissolved(pile, []).count() <= 4
    title = shapes(spark, [(1, box(100, 100, 1000, 200))])
    assert spatial.covered(title, {"m2": spatial.dissolved(pile, [])}, "id").first().m2 == 39_900


def test_zonal_sends_no_grid_through_the_driver(spark):
    """F1 to F3: the grid was broadcast. Cells whose centre is on a boundary stay out, of rectangles as of other polygons."""
    g = raster.Grid(0.0, 100.0, 10.0, 10.0, 10, 10)
    grid = spark.range(100).select((F.col("id") / 10).cast("int").alias("row"), (F.col("id") % 10).cast("int").alias("col"), F.lit(1).alias("value"))
    zones = shapes(spark, [(1, box(5, 5, 35, 35)), (2, "POLYGON ((5 5, 35 5, 35 35, 20 35, 5 35, 5 5))"), (3, box(0, 0, 30, 30)), (4, "POLYGON ((0 0, 30 0, 30 30, 15 30, 0 30, 0 0))"), (5, None)])
    z = raster.zonal(zones, grid, g, "id")
    assert {r.id: (r.cells, r.total) for r in z.collect()} == {1: (4, 4), 2: (4, 4), 3: (9, 9), 4: (9, 9), 5: (0, None)}
    assert "Broadcast" not in z._jdf.queryExecution().executedPlan().toString()


def test_nearest_row_of_many_equal_ones(spark):
    """F4, F5 and F8: copies of a road count once, and a row that is touched is settled without the pairs of the whole radius."""
    left = shapes(spark, [(1, box(0, 0, 100, 100)), (2, box(1000, 0, 1100, 100)), (3, box(9000, 0, 9100, 100)), (4, box(2000, 0, 2100, 100)), (5, None)])
    roads = [(i, f"LINESTRING (50 {y}, 60 {y})") for i, y in ((9, 50), (7, 50), (8, 60))] + [(3, "LINESTRING (50 101, 60 101)"), (20, "LINESTRING (1050 150, 1060 150)"), (21, "LINESTRING (1050 150, 1060 150)")]
    roads += [(30, "LINESTRING (2050 600, 2060 600)"), (31, "LINESTRING (2000 601, 2060 601)"), (40, None)]
    right = shapes(spark, roads).select(F.col("id").alias("road"), F.col("id").cast("string").alias("name"), "geom")
    got = {r.id: (r.distance, r.road, r.name) for r in spatial.nearest_within(left, right, "id", "road", 500.0).collect()}
    assert got == {1: (0.0, 7, "7"), 2: (50.0, 20, "20"), 3: (None, None, None), 4: (500.0, 30, "30"), 5: (None, None, None)}


def test_near_rows_are_counted_without_pairs(spark, monkeypatch):
    """counts are those of the pairs, also where cells are split into blocks; a pile of copies forms no pair."""
    left = shapes(spark, [(i, box(*r)) for i, r in random_boxes(21, 150, 3000, 500)] + [(900, box(-9000, -9000, 9000, 9000)), (901, None), (902, "POINT (100 100)")])
    right = shapes(spark, [(i, f"LINESTRING ({x0} {y0}, {x1} {y0})") for i, (x0, y0, x1, _) in random_boxes(22, 150, 3000, 400)] + [(903, "POLYGON EMPTY"), (904, box(0, 0, 5000, 50))])
    for distance in (0.0, 137.5):
        want = Counter(r.r_id for r in spatial.pairs(left, right, "bounds", distance).select("r_id").collect())
        for block in (500_000, 7):
            monkeypatch.setattr(spatial, "COUNT_BLOCK", block)
            assert {r.id: r.n for r in spatial.count_near(left, right, "id", distance).collect()} == want
    monkeypatch.undo()
    pile, roads = spark.range(40_000).withColumn("geom", geo.st_from_wkt(F.lit(box(0, 0, 100, 100)))), spark.range(40_000).withColumn("geom", geo.st_from_wkt(F.lit("LINESTRING (0 150, 90 150)")))
    counted = spatial.count_near(pile, roads, "id", 60.0)
    assert "Join" not in counted.drop("n")._jdf.queryExecution().optimizedPlan().toString().replace("Join LeftOuter", "")
    assert counted.agg(F.min("n"), F.max("n"), F.count("*")).first()[:] == (40_000, 40_000, 40_000)


def test_clusters_of_many_copies(spark):
    """a pile of copies links without its pairs (20,000 copies made 200 million); links over the small cells' borders are kept, of rectangles and others."""
    from terrasift.operators import cluster

    rects = random_boxes(31, 120, 2500, 200)
    rows = [(i, box(*r)) for i, r in rects[:80]] + [(i, f"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y0}))") for i, (x0, y0, x1, y1) in rects[80:]] + [(900, "LINESTRING (-2000 -2000, 2000 -1500)"), (901, None), (902, "POINT (50 7000)")]
    pieces = shapes(spark, rows)
    for gap in (0.0, 60.0, 240.0):
        near = spatial.pairs(pieces, pieces, "dwithin", gap).select("l_id", "r_id").collect()
        name = {i: i for i, _ in rows}
        while new := {r.l_id: name[r.r_id] for r in near if name[r.r_id] < name[r.l_id]}:
            name |= new
        assert {r.id: r.cluster for r in cluster.link(pieces, "id", gap).collect()} == name
        assert 1 < len(set(name.values())) < len(rows)
    pile = spark.range(20_000).withColumn("geom", geo.st_from_wkt(F.when(F.col("id") % 2 == 0, box(0, 0, 100, 100)).otherwise(box(190, 0, 300, 100)))).unionByName(shapes(spark, [(50_000, box(1000, 0, 1100, 100))]))
    got = cluster.sensitivity(pile, "id", [250, 100, 50], 20_000).collect()
    assert {r.link_gap_m: (r.cluster_count, r.clusters_meeting, r.area_below) for r in got} == {50.0: (3, 2, 10_000.0), 100.0: (2, 1, 10_000.0), 250.0: (2, 1, 10_000.0)}


def test_cluster_points_are_not_broadcast(spark):
    """F1 of round 3: the 25 points of a piece were guessed to be as small as one, and all of them went through the driver to be joined."""
    from terrasift.operators import cluster

    x, y = F.col("id") % 100 * 140, F.floor(F.col("id") / 100) * 240
    pieces = spark.range(30_000).select("id", geo.st_rect(x, y, x + 100, y + 100).alias("geom"))
    # 750,000 points take 64 MB; a small table takes 32 MB and little more.
    limits = {"spark.sql.autoBroadcastJoinThreshold": "1m", "spark.sql.maxBroadcastTableSize": "40m"}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        got = cluster.sensitivity(pieces, "id", [200, 50], 20_000).collect()
    finally:
        for k in limits:
            spark.conf.unset(k)
    assert {r.link_gap_m: (r.cluster_count, r.clusters_meeting, r.area_meeting, r.area_below) for r in got} == {50.0: (300, 300, 3e8, 0.0), 200.0: (1, 1, 3e8, 0.0)}
    # The guess had ten times as many digits after each gap.
    rows = spark.range(3)
    names = cluster._merged(rows.select("id", F.col("id").alias("component")), rows.where("id > 1").select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b")), "id")
    assert names._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() == 2**63 - 1
    assert {r.id: r.component for r in names.collect()} == {0: 0, 1: 1, 2: 0}


def test_many_small_files_are_dealt_over_tasks(spark, tmp_path, monkeypatch):
    """rows of one small partition were written by one task, and read by one task for every few files; a key in two partitions made two files."""
    monkeypatch.setattr(readers, "FILES", 10)
    rows = shapes(spark, [(i, box(0, 0, 10 + i, 10)) for i in range(60)]).coalesce(1)
    readers.write_geojson(rows, f"{tmp_path}/g", "id")
    made = [p.parent.name for p in tmp_path.glob("g/*/part-*")]
    assert sorted(made) == sorted(f"id={i}" for i in range(60))
    assert len({p.name.split("-")[1] for p in tmp_path.glob("g/*/part-*")}) > 1
    back = readers.read_geojson(spark, f"{tmp_path}/g", "n bigint")
    assert back.count() == 60 and back.select(F.spark_partition_id()).distinct().count() <= 7
    with pytest.raises(ValueError):
        readers.write_geojson(shapes(spark, [(-1, box(0, 0, 1, 1))]), f"{tmp_path}/h", "id")


def odd_boxes(seed: int, n: int, span: int, most: int) -> list[tuple[int, tuple[int, int, int, int]]]:
    """Boxes off the grid of ``random_boxes``: many different coordinates."""
    return [(i, (x0 // 50 * 49 + 7 * i % 50, y0 // 50 * 51 + 3 * i % 50, x1 // 50 * 49 + 7 * i % 50 + 1 + i % 13, y1 // 50 * 51 + 3 * i % 50 + 1 + i % 17)) for i, (x0, y0, x1, y1) in random_boxes(seed, n, span, most)]


def test_area_without_masks_needs_no_geometry(spark, monkeypatch):
    """every title met every polygon of the cut land. Rectangles meet none, also where tiles are halved or blocks split; other shapes go the general way."""
    from terrasift.operators import boxes
    from terrasift.plans import catalog, screening as sc

    from .conftest import SMALL

    assert "Join" not in catalog.QUERIES["low_slope_overlay_area"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    titles, pieces, masks = odd_boxes(41, 60, 2500, 700) + [(900, (-4000, -4000, 6000, 6000))], odd_boxes(42, 80, 2000, 400) + [(901, (0, 0, 128, 5000))], odd_boxes(43, 30, 2000, 300)
    land, bare = np.zeros((10_000, 10_000), bool), np.zeros((10_000, 10_000), bool)
    for rects, grids, value in ((pieces, (land, bare), True), (masks, (land,), False)):
        for _, (x0, y0, x1, y1) in rects:
            for grid in grids:
                grid[4000 + x0 : 4000 + x1, 4000 + y0 : 4000 + y1] = value
    want = {i: n for i, (x0, y0, x1, y1) in titles if (n := int(land[4000 + x0 : 4000 + x1, 4000 + y0 : 4000 + y1].sum()))}
    l, r, m = (shapes(spark, [(i, box(*r)) for i, r in rows] + [(998, None), (999, "POLYGON EMPTY")]) for rows in (titles, pieces, masks))
    for ranks, block in ((1_000_000, 500_000), (300, 7)):
        monkeypatch.setattr(boxes, "RANKS", ranks)
        monkeypatch.setattr(boxes, "BLOCK", block)
        assert {x.id: x.m2 for x in sc.area_without(l, r, m, "id").collect()} == want
    assert {x.id: x.m2 for x in sc.area_without(l, r, shapes(spark, []), "id").where("id = 900").collect()} == {900: bare.sum()}
    halves = [(2000 + k, f"POLYGON ((0 0, {1500 if k else 0} {0 if k else 1500}, 1500 1500, 0 0))") for k in (0, 1)]
    got = {x.id: x.m2 for x in sc.area_without(l.unionByName(shapes(spark, halves)), r, m, "id").collect()}
    assert {i: v for i, v in got.items() if i < 2000} == want
    assert got[2000] + got[2001] == pytest.approx(land[4000:5500, 4000:5500].sum())
    bent = shapes(spark, [(1, "POLYGON ((0 0, 1000 0, 0 1000, 0 0))")])
    assert {x.id: x.m2 for x in sc.area_without(shapes(spark, [(5, box(0, 0, 1000, 1000))]), bent, shapes(spark, [(1, box(0, 0, 100, 100))]), "id").collect()} == pytest.approx({5: 490_000.0})


def test_footprints_without_an_overlay(spark, tmp_path, monkeypatch):
    """every title met every polygon of the clear land, and its parts were united. Rectangles are traced: shapes are valid and equal the overlay's, also where cells meet at points, with holes, in halves, and beside other shapes."""
    from terrasift.operators import boxes
    from terrasift.plans import screening as sc

    titles, pieces, masks = random_boxes(51, 60, 2500, 700) + [(900, (-3000, -3000, 6000, 6000))], random_boxes(52, 90, 2000, 300), random_boxes(53, 90, 2000, 200)
    # Two squares that meet at a point, a ring with a hole, a ring closed at a point only, and a ring around a square.
    pieces += [(200, (9000, 0, 9050, 50)), (201, (9050, 50, 9100, 100)), (202, (9000, 1000, 9300, 1300)), (203, (9000, 2000, 9150, 2150)), (204, (9000, 3000, 9300, 3300)), (205, (9100, 3100, 9200, 3200))]
    masks += [(200, (9100, 1100, 9200, 1200)), (201, (9050, 2050, 9100, 2100)), (202, (9100, 2100, 9150, 2150)), (203, (9050, 3050, 9250, 3100)), (204, (9050, 3200, 9250, 3250)), (205, (9050, 3050, 9100, 3250)), (206, (9200, 3050, 9250, 3250))]
    titles += [(910 + k, (8900, 1000 * k - 50, 9400, 1000 * k + 400)) for k in range(4)]
    sides = [shapes(spark, [(i, box(*r)) for i, r in rows] + [(998, None), (999, "POLYGON EMPTY")]) for rows in (titles, pieces, masks)]
    triangle = shapes(spark, [(950, "POLYGON ((0 0, 1500 0, 0 1500, 0 0))")])
    general = spatial.union_at_rest(spatial.common_parts(sides[0].unionByName(triangle), sc.pieces_without(*sides[1:]), "id"), ["id"])
    want = {r.id: r.geom for r in general.collect()}
    for ranks in (1_000_000, 300):
        monkeypatch.setattr(boxes, "RANKS", ranks)
        got = sc.footprints_without(sides[0].unionByName(triangle), *sides[1:], "id")
        rows = got.withColumn("good", geo.st_is_valid("geom") & (geo.st_num_parts("geom") > 0)).collect()
        assert len(rows) == len(want) == len({r.id for r in rows}) and all(r.good for r in rows) and {r.id for r in rows} == set(want)
        both = spark.createDataFrame([(r.id, bytes(r.geom), bytes(want[r.id])) for r in rows], "id long, a binary, b binary")
        off = both.where((geo.st_area(geo.st_difference("a", "b")) > 1e-6) | (geo.st_area(geo.st_difference("b", "a")) > 1e-6))
        assert off.count() == 0
    # The text of the export is that of the column function.
    placed = shapes(spark, [(1, "MULTIPOLYGON (((0 0, 10.12345678 0, 10 10.5, 0 0), (1 1, 2 1, 2 2, 1 1)), ((20 20, 30 20, 30 30, 20 20)))"), (2, "POLYGON ((0 0, -5 0, -5 -5.0000004, 0 0))"), (3, "POLYGON Z ((0 0 7, 5 0 7, 5 5 7, 0 0 7))")])
    texts = placed.select(F.to_json(readers.geojson_geometry("geom")).alias("text"), "geom").where("id < 3").collect()
    assert readers.geojson_texts([bytes(r.geom) for r in texts]) == [r.text for r in texts]
    with pytest.raises(ValueError):
        readers.geojson_texts([bytes(shapes(spark, [(1, "LINESTRING (0 0, 1 1)")]).first().geom)])


def test_touches_without_pairs(spark, monkeypatch):
    """every title met every polygon of the united pieces. Touches of rectangles form no pair; on boundaries, at corners, in halves and beside other shapes too."""
    from terrasift.operators import boxes
    from terrasift.plans import catalog, screening as sc

    from .conftest import SMALL

    assert "Join" not in catalog.QUERIES["boundary_only_titles"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    titles, pieces = random_boxes(61, 300, 4000, 200) + [(900, (512, 0, 600, 50)), (901, (-9000, -9000, -8000, -8000))], random_boxes(62, 40, 4000, 150) + [(901, (400, 0, 512, 50)), (902, (-8000, -8000, -7900, -7900))]
    touch = lambda a, b, gap: a[0] <= b[2] - gap and b[0] <= a[2] - gap and a[1] <= b[3] - gap and b[1] <= a[3] - gap
    want = {i: any(touch(t, p, 1) for _, p in pieces) for i, t in titles if any(touch(t, p, 0) for _, p in pieces)}
    assert {True, False} == set(want.values()) and want[900] is False and want[901] is False
    l, r = (shapes(spark, [(i, box(*x)) for i, x in rows] + [(998, None), (999, "POLYGON EMPTY")]) for rows in (titles, pieces))
    for ranks, block in ((1_000_000, 500_000), (200, 7)):
        monkeypatch.setattr(boxes, "RANKS", ranks)
        monkeypatch.setattr(boxes, "BLOCK", block)
        a, b = boxes.laid(l, "id"), boxes.laid(r)
        odd, size = boxes.surveyed([a, b])
        assert odd == [0, 0] and {x.id: x.inside for x in boxes.met(a, b, "id", size).collect()} == want
    n = sum(want.values())
    # A title that touches with a corner of a triangle, and a point and a line as pieces.
    l = l.unionByName(shapes(spark, [(950, "POLYGON ((-8000 -7900, -8100 -7800, -8000 -7800, -8000 -7900))")]))
    assert sc.screening_counters(l, r, "id").first()[:] == (len(want) + 1, n, len(want) + 1 - n)
    r = r.unionByName(shapes(spark, [(960, "POINT (-9000 -9000)"), (961, "LINESTRING (-8100 -7800, -8200 -7700)")]))
    assert sc.screening_counters(l, r, "id").first()[:] == (len(want) + 1, n, len(want) + 1 - n)


def test_pairs_without_geometry(spark, monkeypatch):
    """F16: each pair of rectangles was cut to a geometry. Pairs of rectangles are formed from their corners, once each; pairs with another shape are still cut."""
    from terrasift.operators import boxes
    from terrasift.plans import catalog, screening as sc

    from .conftest import SMALL

    assert "Join" not in catalog.QUERIES["overlay_intersection"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    # Some begin on borders of tiles, some reach over several, equal ones count each.
    titles, pieces = random_boxes(71, 150, 6000, 600) + [(900, (512, 512, 1024, 1024)), (901, (-9000, -9000, 9000, 9000)), (902, (0, -512, 2048, 0))], random_boxes(72, 120, 6000, 500) + [(900, (512, 512, 1024, 1024)), (901, (512, 512, 1024, 1024)), (902, (-1024, -2048, 1024, 1024))]
    common = lambda a, b: max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
    want = {(i, j): m for i, t in titles for j, p in pieces if (m := common(t, p))}
    l, r = (shapes(spark, [(i, box(*x)) for i, x in rows] + [(998, None), (999, "POLYGON EMPTY")]) for rows in (titles, pieces))
    for candidates, block in ((4_000_000, 500_000), (200, 7)):
        monkeypatch.setattr(boxes, "CANDIDATES", candidates)
        monkeypatch.setattr(boxes, "BLOCK", block)
        rows = sc.common_areas(l, r, "id", "id").collect()
        assert len(rows) == len(want) and {(x.l_id, x.r_id): x.m2 for x in rows} == want
    bent = {950: "POLYGON ((0 0, 3000 0, 0 3000, 0 0))", 951: "POLYGON ((0 0, 3000 0, 3000 3000, 0 0))"}
    l, r = (rows.unionByName(shapes(spark, list(bent.items()))) for rows in (l, r))
    slow = spatial.overlay_intersection(l, r).select("l_id", "r_id", geo.st_area("geom").alias("m2")).collect()
    rows = sc.common_areas(l, r, "id", "id").collect()
    assert len(rows) == len(slow) > len(want) and {(x.l_id, x.r_id): x.m2 for x in rows} == pytest.approx({(x.l_id, x.r_id): x.m2 for x in slow})
