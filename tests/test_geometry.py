"""Geometry functions, spatial operators, rasters, clusters, systems, readers and gates on small cases."""

import json
import hashlib
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasift.functions import crs, geo
from terrasift.operators import cluster, expect, graph, raster, spatial
from terrasift.plans import roundtrips, screening
from terrasift.sources import readers


def shapes(spark, rows):
    """(id, geom) from (id, WKT)."""
    return spark.createDataFrame(rows, "id long, wkt string").select("id", geo.st_from_wkt("wkt").alias("geom"))


def box(x0, y0, x1, y1):
    return f"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"


def areas(df):
    return {r.id: round(r.a, 6) for r in df.select("id", geo.st_area("geom").alias("a")).collect()}


def test_scalars(spark):
    g = shapes(spark, [(1, box(0, 0, 10, 10)), (2, "POLYGON ((0 0, 10 10, 10 0, 0 10, 0 0))"), (3, None), (4, "POLYGON EMPTY")])
    rows = g.select("id", geo.st_area("geom").alias("area"), geo.st_is_valid("geom").alias("valid"), geo.st_area(geo.st_fix("geom")).alias("fixed"), geo.st_num_parts("geom").alias("parts"), geo.st_is_empty("geom").alias("empty")).orderBy("id").collect()
    assert [r.area for r in rows[:1]] == [100.0] and rows[0].valid and not rows[1].valid and rows[1].fixed == 50.0
    assert rows[2].area is None and rows[2].parts is None and rows[3].empty
    b = shapes(spark, [(1, box(1, 2, 3, 5))]).select(geo.st_bounds("geom").alias("b"), geo.st_area(geo.st_buffer("geom", 1.0)).alias("buffered"), geo.st_as_wkt(geo.st_interior_point("geom")).alias("p")).first()
    assert tuple(b.b) == (1.0, 2.0, 3.0, 5.0) and b.p == "POINT (2 3.5)" and 6 + 10 + 3.1 < b.buffered < 6 + 10 + math.pi


def test_code_generation_covers_geometry(spark):
    g = spark.range(3).select(geo.st_rect(F.col("id"), F.col("id"), F.col("id") + 1, F.col("id") + 1).alias("geom"))
    plan = g.select(geo.st_area("geom"))._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "Python" not in plan and "Arrow" not in plan


def random_boxes(seed, n, span=4000, most=700):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, y = rng.randrange(-span, span, 50), rng.randrange(-span, span, 50)
        out.append((i, (x, y, x + rng.randrange(50, most, 50), y + rng.randrange(50, most, 50))))
    return out


@pytest.mark.parametrize("cell", [137.0, 1000.0])
def test_joins_equal_brute_force(spark, cell):
    a, b = random_boxes(1, 60), random_boxes(2, 50)
    left, right = (shapes(spark, [(i, box(*r)) for i, r in x] + [(999, None), (998, "POLYGON EMPTY")]) for x in (a, b))
    touch = {(i, j) for i, p in a for j, q in b if p[0] <= q[2] and q[0] <= p[2] and p[1] <= q[3] and q[1] <= p[3]}
    got = spatial.pairs(left, right, cell=cell).select("l_id", "r_id").collect()
    assert len(got) == len(touch) and {tuple(r) for r in got} == touch
    hit = {i for i, _ in touch}
    assert {r.id for r in spatial.spatial_join(left, right, "id", "left_semi", cell=cell).collect()} == hit
    assert {r.id for r in spatial.spatial_join(left, right, "id", "left_anti", cell=cell).collect()} == ({i for i, _ in a} | {998, 999}) - hit
    outer = spatial.spatial_join(left, right, "id", "left", cell=cell).collect()
    assert len(outer) == len(touch) + 62 - len(hit)

    gap = lambda p, q: math.hypot(max(0, max(p[0], q[0]) - min(p[2], q[2])), max(0, max(p[1], q[1]) - min(p[3], q[3])))
    close = {(i, j) for i, p in a for j, q in b if gap(p, q) <= 300}
    near = spatial.pairs(left, right, "dwithin", 300, cell=cell).select("l_id", "r_id").collect()
    assert len(near) == len(close) and {tuple(r) for r in near} == close
    best = {r.id: (r.distance, r.road) for r in spatial.nearest_within(left, right.withColumnRenamed("id", "road"), "id", "road", 300, cell=cell).collect()}
    for i, p in a:
        want = min(((gap(p, q), j) for j, q in b if gap(p, q) <= 300), default=(None, None))
        assert best[i] == (pytest.approx(want[0]) if want[0] is not None else None, want[1])


def covered(rects):
    return {(x, y) for r in rects for x in range(r[0] // 50, r[2] // 50) for y in range(r[1] // 50, r[3] // 50)}


def test_overlays_equal_cell_sets(spark):
    a, b = random_boxes(3, 40), random_boxes(4, 60)
    left, right = (shapes(spark, [(i, box(*r)) for i, r in x]) for x in (a, b))
    mask = covered(r for _, r in b)
    inside = {i: len(covered([r]) & mask) * 2500 for i, r in a}
    assert areas(spatial.footprint(left, right, "id")) == {i: v for i, v in inside.items() if v}
    rest = {i: len(covered([r]) - mask) * 2500 for i, r in a}
    assert areas(spatial.overlay_difference(left, right, "id")) == {i: v for i, v in rest.items() if v}
    total = spatial.union_by(right.select("geom"), []).select(geo.st_area("geom")).first()[0]
    assert total == len(mask) * 2500
    assert {r.id: r.c for r in spatial.overlap_area(left, right, "id", "c").collect()} == pytest.approx(inside)


def test_union_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(spatial, "UNION_BUCKET", 3)
    rows = random_boxes(5, 40)
    g = shapes(spark, [(i % 2, box(*r)) for i, r in rows])
    assert areas(spatial.union_by(g, ["id"])) == {k: len(covered(r for i, r in rows if i % 2 == k)) * 2500 for k in (0, 1)}


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(100)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(root)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_clusters(spark):
    p = shapes(spark, [(1, box(0, 0, 100, 100)), (2, box(150, 0, 250, 100)), (3, box(600, 0, 700, 100)), (4, box(5000, 0, 5100, 100))])
    got = {gap: sorted((r.first_key, r.members) for r in cluster.clusters(p, "id", gap, 20_000).collect()) for gap in (49, 50, 350)}
    assert got == {49: [(1, 1), (2, 1), (3, 1), (4, 1)], 50: [(1, 2), (3, 1), (4, 1)], 350: [(1, 3), (4, 1)]}
    s = {r.link_gap_m: r for r in cluster.sensitivity(p, "id", [49, 350], 20_000).collect()}
    assert s[350.0].clusters_meeting == 1 and s[350.0].area_meeting + s[350.0].area_below == s[49.0].area_below == 40_000


def grid_rows(values):
    return [(r, c, float(v) if v is not None else None) for r, row in enumerate(values) for c, v in enumerate(row)]


def test_slope(spark):
    plane = [[3 * c + 4 * r for c in range(5)] for r in range(4)]
    g = raster.Grid(0, 0, 1, 1, 4, 5)
    got = raster.slope_percent(spark.createDataFrame(grid_rows(plane), "row int, col int, value double"), g).collect()
    assert len(got) == 20 and all(r.value == pytest.approx(500) for r in got)
    plane[1][1] = None
    got = {(r.row, r.col): r.value for r in raster.slope_percent(spark.createDataFrame(grid_rows(plane), "row int, col int, value double"), g).collect()}
    assert got[1, 1] is None and got[1, 2] == pytest.approx(500) and len(got) == 20


def test_mask_zonal_runs(spark):
    values = [[5, 15, 15.01, None], [0, -1, 15, 15], [20, 20, 1, 1]]
    grid = spark.createDataFrame(grid_rows(values), "row int, col int, value double")
    g = raster.Grid(0, 30, 10, 10, 3, 4)
    low = raster.mask(grid, 0, 15)
    assert [r.value for r in low.orderBy("row", "col").collect()] == [1, 1, 0, None, 1, 0, 1, 1, 0, 0, 1, 1]
    zones = shapes(spark, [(1, box(0, 0, 40, 30)), (2, box(0, 0, 16, 30)), (3, box(100, 0, 101, 1)), (4, box(0, 0, 5, 5))])
    z = {r.id: (r.cells, r.total) for r in raster.zonal(zones, low, g, "id").collect()}
    assert z == {1: (11, 7), 2: (6, 3), 3: (0, None), 4: (0, None)}
    steep = low.where(F.coalesce("value", F.lit(0)) != 1).withColumn("t", F.lit(0))
    runs = sorted((r.row0, r.row1, r.col0, r.col1) for r in raster.merge_runs(steep, ["t"]).collect())
    assert runs == [(0, 0, 2, 3), (1, 1, 1, 1), (2, 2, 0, 1)]
    boxes = raster.rectangles(raster.merge_runs(steep, ["t"]), g).withColumn("id", F.lit(1))
    assert spatial.union_by(boxes.select("geom"), []).select(geo.st_area("geom")).first()[0] == 500
    assert raster.window(grid, g, 10, 0, 20, 10).count() == 1 and raster.window(grid, g, 9, 0, 21, 30).count() == 9
    with pytest.raises(ValueError):
        raster.window(grid, g, 500, 0, 600, 10)


def test_systems_round_trip_and_known_points():
    x, y = crs.transform(np.array([-8.0]), np.array([53.5]), 4326, 2157)
    assert (x[0], y[0]) == pytest.approx((600_000, 750_000), abs=1e-6)
    # A published example point of the Irish grids: the Spire in Dublin.
    x, y = crs.transform(np.array([-6.260273]), np.array([53.349805]), 4326, 2157)
    assert (x[0], y[0]) == pytest.approx((715_830, 734_697), abs=12)
    gx, gy = crs.transform(x, y, 2157, 29902)
    assert (gx[0], gy[0]) == pytest.approx((315_905, 234_671), abs=15)
    for s in (2157, 29902, 29903):
        lon, lat = np.meshgrid(np.linspace(-10.5, -5.5, 9), np.linspace(51.4, 55.4, 9))
        a, b = crs.transform(*crs.transform(lon.ravel(), lat.ravel(), 4326, s), s, 4326)
        assert np.abs(a - lon.ravel()).max() < 2e-8 and np.abs(b - lat.ravel()).max() < 2e-8


def test_transform_keeps_structure(spark):
    wkts = ["POINT (600000 750000)", "MULTIPOLYGON (((600000 750000, 600100 750000, 600100 750100, 600000 750000)))", "GEOMETRYCOLLECTION (POINT (600000 750000), LINESTRING (600000 750000, 600010 750010))", None]
    g = shapes(spark, list(enumerate(wkts)))
    out = g.select("id", geo.st_as_wkt(crs.st_transform("geom", 2157, 4326)).alias("w")).collect()
    assert {r.id: (r.w or "none").split(" ")[0] for r in out} == {0: "POINT", 1: "MULTIPOLYGON", 2: "GEOMETRYCOLLECTION", 3: "none"}
    with pytest.raises(ValueError):
        crs.st_transform("geom", 1, 2)


def overlay_file(folder, key, east, north):
    """A one-feature file as the page reads them: a square of 1 km in geographic coordinates with a hole of 200 m."""
    ring = lambda e, n, size: [[e, n], [e + size, n], [e + size, n + size], [e, n + size], [e, n]]
    rings = []
    for r in (ring(east, north, 1000.0), ring(east + 100, north + 100, 200.0)):
        lon, lat = crs.transform(np.array([p[0] for p in r]), np.array([p[1] for p in r]), 2157, 4326)
        rings.append([[round(float(x), 6), round(float(y), 6)] for x, y in zip(lon, lat, strict=True)])
    feature = {"type": "Feature", "properties": {"source_fid": key, "county": f"County {key % 2}", "overlay_ha": 96.0}, "geometry": {"type": "MultiPolygon", "coordinates": [rings]}}
    (folder / f"{key}.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature]}))


def test_overlay_files(spark, tmp_path):
    """Properties come through, and projected areas agree with the stated ones."""
    for i in range(5):
        overlay_file(tmp_path, 10 + i, 500_000.0 + 40_000 * i, 600_000.0 + 50_000 * i)
    rows = readers.read_geojson(spark, str(tmp_path), "source_fid bigint, county string, overlay_ha double")
    rows = rows.withColumn("ha", geo.st_area(crs.st_transform("geom", 4326, 2157)) / 10_000).collect()
    assert len(rows) == 5 and all(r.file == f"{r.source_fid}.geojson" for r in rows)
    assert all(abs(r.ha - r.overlay_ha) < 0.05 for r in rows) and len({r.county for r in rows}) == 2


def test_geojson_collections_and_errors(spark, tmp_path):
    (tmp_path / "a.geojson").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"k":1},"geometry":{"type":"GeometryCollection","geometries":[{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,0]]]},{"type":"Point","coordinates":[1,1]}]}}]}')
    assert readers.read_geojson(spark, str(tmp_path), "k int").select(geo.st_area("geom"), geo.st_type("geom")).first()[:] == (2.0, "MultiPolygon")
    (tmp_path / "a.geojson").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"k":1},"geometry":{"type":"Point","coordinates":[1,1]}}]}')
    with pytest.raises(Exception, match="not a polygon"):
        readers.read_geojson(spark, str(tmp_path), "k int").collect()


def test_shapefile_and_geopackage(spark):
    want = [(1, "plain", 100), (2, "holed", 96)]
    assert sorted(map(tuple, roundtrips.shapefile_scan(spark, "").collect())) == want
    assert sorted(map(tuple, roundtrips.gpkg_scan(spark, "").collect())) == want


def test_geopackage_checks(spark, tmp_path):
    readers.register(spark)
    path = roundtrips.make_geopackage(str(tmp_path / "x.gpkg"), "x", [(1, "a", readers._wkb_polygon(roundtrips.SQUARES[0][2]))])
    for options in ({"layer": "none"}, {"srs": "4326"}):
        with pytest.raises(Exception):
            spark.read.format("geopackage").options(**options).load(path).collect()
    (tmp_path / "bad.gpkg").write_bytes(b"nothing")
    with pytest.raises(Exception):
        spark.read.format("geopackage").load(str(tmp_path / "bad.gpkg")).collect()


def test_publish_and_readers(spark, tmp_path):
    df = spark.range(5)
    target = str(tmp_path / "out")
    assert readers.publish(df, target, 5) == 5
    with pytest.raises(ValueError):
        readers.publish(df.limit(2), target, 5)
    assert spark.read.parquet(target).count() == 5
    with pytest.raises(ValueError):
        readers.exactly_one(str(tmp_path / "*.none"))
    with pytest.raises(ValueError):
        readers.layer(df, ["ID", "geom"])
    readers.append_log(spark, str(tmp_path / "log"), dataset="a", status="complete")
    readers.append_log(spark, str(tmp_path / "log"), dataset="b", status="failed")
    assert spark.read.json(str(tmp_path / "log")).count() == 2


def test_bands_and_gates(spark):
    rows = [(1, 1000.0, 500.0), (2, 1000.01, 500.0), (3, 2000.0, 500.0), (4, 2000.1, 500.0), (5, None, 500.0), (6, 10.0, 99.0), (7, 10.0, 100.0)]
    label, score = screening.band(F.col("d"), F.col("m2") / 10_000 >= 0.01)
    got = {r.id: (r.b, r.s) for r in spark.createDataFrame(rows, "id int, d double, m2 double").select("id", label.alias("b"), score.alias("s")).collect()}
    assert got == {1: ("Good", 3), 2: ("Moderate", 2), 3: ("Moderate", 2), 4: ("Poor", 1), 5: ("Poor", 1), 6: ("Not assessed", 0), 7: ("Good", 3)}
    df = spark.createDataFrame([(1, 3.0, 10), (2, 3.0, 11), (3, 4.0, 12)], "r int, v double, k int")
    bad = expect.rank_integrity(df, "r", "v", "k").first()
    assert (bad.n_rows, bad.first_rank, bad.last_rank, bad.out_of_order) == (3, 1, 3, 1)
    with pytest.raises(expect.GateError):
        expect.count_is(df, 2, "rows")
    with pytest.raises(expect.GateError):
        expect.not_empty(df.limit(0), "rows")
    assert {r.id: r.t for r in spark.createDataFrame([(1, 3723.4), (2, 59.6)], "id int, s double").select("id", screening.duration_text(F.col("s")).alias("t")).collect()} == {1: "1h 02m 03s", 2: "0h 01m 00s"}


def test_fids_and_query_pieces(spark):
    df = spark.createDataFrame([(7, "a")], "FID long, x string")
    assert screening.drop_fid(df).columns == ["x"] and screening.drop_fid(df, "source_fid").columns == ["source_fid", "x"]
    g = shapes(spark, [(1, f"MULTIPOLYGON ((({', '.join(box(0, 0, 10, 10)[10:-2].split(', '))})), (({', '.join(box(20, 0, 30, 10)[10:-2].split(', '))})))"), (2, "POLYGON ((0 0, 10 10, 10 0, 0 10, 0 0))"), (3, None)])
    p = screening.query_pieces(g).select("id", geo.st_type("geom").alias("t"), geo.st_area("geom").alias("a"), "source_fid").collect()
    assert sorted((r.id, r.t, r.a) for r in p) == [(1, "Polygon", 100.0)] * 2 + [(2, "Polygon", 25.0)] * 2 and len({r.source_fid for r in p}) == 4


def test_feature_server_pages(spark):
    from terrasift.sources import feature_server as fs

    pages = []

    class Fake(fs.FeatureServerReader):
        @staticmethod
        def fetch(url, timeout):
            offset = int(url.split("resultOffset=")[1].split("&")[0])
            pages.append(offset)
            return {"features": [{"properties": {"k": offset + i}, "geometry": None} for i in range(min(3, 7 - offset))]}

    r = Fake({"url": "http://x", "xmin": "0", "ymin": "0", "xmax": "39999", "ymax": "1", "page": "3", "rate": "1000"})
    tiles = r.partitions()
    assert [t.bounds for t in tiles] == [(0, 0, 20000, 20000), (20000, 0, 40000, 20000)]
    assert [x[0] for x in r.read(tiles[0])] == [f'{{"k": {i}}}' for i in range(7)] and pages == [0, 3, 6]
    spark.dataSource.register(fs.FeatureServerSource)


def test_feature_server_own_limit_and_errors():
    from terrasift.sources import feature_server as fs

    def keys(limit, says, broken=None):
        class Fake(fs.FeatureServerReader):
            @staticmethod
            def fetch(url, timeout):
                offset = int(url.split("resultOffset=")[1].split("&")[0])
                if broken is not None and offset:
                    return broken
                n = max(0, min(limit(offset), 7 - offset))
                return {"features": [{"properties": {"k": offset + i}, "geometry": None} for i in range(n)]} | says(offset + n < 7)

        r = Fake({"url": "http://x", "xmin": "0", "ymin": "0", "xmax": "1", "ymax": "1", "page": "5", "rate": "1000"})
        return [json.loads(x[0])["k"] for x in r.read(r.partitions()[0])]

    for says in (lambda more: {}, lambda more: {"exceededTransferLimit": more}, lambda more: {"properties": {"exceededTransferLimit": True}} if more else {}):
        assert keys(lambda offset: 2, says) == list(range(7))
    # Pages limited by bytes differ in length.
    assert keys(lambda offset: 3 if offset == 0 else 1, lambda more: {"exceededTransferLimit": more}) == list(range(7))
    for broken in ({"error": {"code": 500}}, {}):
        with pytest.raises(RuntimeError):
            keys(lambda offset: 5, lambda more: {}, broken)


def test_one_feature_reports_and_checksums(spark, tmp_path):
    overlay_file(tmp_path, 7, 600_000.0, 700_000.0)
    assert readers.one_feature(spark, str(tmp_path), 7, "source_fid bigint, county string").first().source_fid == 7
    os.rename(tmp_path / "7.geojson", tmp_path / "8.geojson")
    with pytest.raises(ValueError):
        readers.one_feature(spark, str(tmp_path), 8, "source_fid bigint, county string")
    readers.report_csv(spark.createDataFrame([(1, 2.0 / 3, None)], "a int, b double, c double"), str(tmp_path / "r"))
    assert spark.read.csv(str(tmp_path / "r"), header=True).first()[:] == ("1", "0.67", None)
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "x.bin").write_bytes(b"abc")
    assert readers.checksums(spark, str(tmp_path / "f")).first()[:] == ("x.bin", 3, hashlib.sha256(b"abc").hexdigest())


def test_arrivals_are_screened_once(spark, tmp_path):
    from terrasift.streaming import incremental

    pieces = shapes(spark, [(1, box(0, 0, 10, 10))])
    titles = shapes(spark, [(i, box(i * 4, 0, i * 4 + 3, 3)) for i in range(6)])
    folder = str(tmp_path / "in")
    args = (spark, folder, titles.schema, pieces, "id", str(tmp_path / "out"), str(tmp_path / "log"), str(tmp_path / "checkpoint"))
    titles.where("id < 2").write.mode("append").parquet(folder)
    incremental.screen_arrivals(*args).awaitTermination()
    titles.where("id >= 1").write.mode("append").parquet(folder)
    for _ in range(2):
        incremental.screen_arrivals(*args).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2]
    p = incremental.progress(spark, str(tmp_path / "log")).first()
    assert (p.titles_read, p.titles_written) == (7, 3)


def scans(df):
    """Reads of files in the physical plan."""
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_plans_read_their_tables_once(spark):
    from terrasift.plans import catalog

    from .conftest import SMALL

    for name, most in (("title_bog_metrics", 3), ("title_lease_metrics", 4), ("overlay_difference_chain", 6), ("commonage_forest_metrics", 3), ("clear_bog_rank", 0)):
        assert scans(catalog.QUERIES[name](spark, SMALL)) <= most, name


def test_pairs_of_very_different_sizes(spark):
    """Geometries of a metre and of a thousand kilometres meet, each pair once, whichever side the large one is on."""
    rng = random.Random(8)
    rows = [(i, (x := rng.randrange(0, 900_000), y := rng.randrange(0, 900_000), x + 10 ** rng.randrange(0, 7), y + 10 ** rng.randrange(0, 6))) for i in range(150)]
    table = shapes(spark, [(i, box(*b)) for i, b in rows])
    got = spatial.pairs(table, table).select("l_id", "r_id").collect()
    want = {(i, j) for i, a in rows for j, b in rows if a[0] <= b[2] and b[0] <= a[2] and a[1] <= b[3] and b[1] <= a[3]}
    assert len(got) == len(want) and set(map(tuple, got)) == want
    none = table.where("id < 0")
    assert spatial.pairs(table, none).count() == spatial.pairs(none, table).count() == 0


def test_large_groups_unite_in_steps(spark, monkeypatch):
    monkeypatch.setattr(spatial, "UNION_BUCKET", 4)
    rows = [(i % 2, box(i * 10, 0, i * 10 + 15, 10)) for i in range(60)] + [(0, box(0, 0, 15, 10))] * 20
    got = {r.id: r.a for r in spatial.union_by(shapes(spark, rows), ["id"]).select("id", geo.st_area("geom").alias("a")).collect()}
    assert got == {0: 30 * 150.0, 1: 30 * 150.0}


def test_rank_without_a_single_task(spark):
    rows = spark.range(5000, numPartitions=7).select("id", ((F.col("id") * 37) % 101).alias("v"))
    got = expect.ranked(rows, "r", F.desc("v"), F.asc("id")).collect()
    want = sorted(range(5000), key=lambda i: (-(i * 37 % 101), i))
    assert {x.id: x.r for x in got} == {i: n for n, i in enumerate(want, 1)}
    assert expect.ranked(rows.limit(0), "r", F.asc("id")).count() == 0


def test_slope_across_block_edges(spark, monkeypatch):
    """Small blocks give what one large block gives, on a grid with gaps."""
    rng = random.Random(4)
    rows = [(r, c, float(rng.randrange(50)) if rng.random() > 0.1 else None) for r in range(13) for c in range(11) if rng.random() > 0.05]
    g = raster.Grid(0, 0, 10, 10, 13, 11)
    table = spark.createDataFrame(rows, "row int, col int, value double")
    whole = sorted(map(tuple, raster.slope_percent(table, g).collect()), key=str)
    monkeypatch.setattr(raster, "BLOCK", 3)
    assert sorted(map(tuple, raster.slope_percent(table, g).collect()), key=str) == whole and len(whole) == len(rows)
    value = {(r, c): v for r, c, v in rows}
    for r, c, s in raster.slope_percent(table, g).collect():
        if value[r, c] is None:
            assert s is None
            continue
        step = []
        for a, b in (((r, c - 1), (r, c + 1)), ((r - 1, c), (r + 1, c))):
            x, y = value.get(a), value.get(b)
            n = (x is not None) + (y is not None)
            step.append(((value[r, c] if x is None else x) - (value[r, c] if y is None else y)) / (10 * n) if n else 0.0)
        assert s == pytest.approx(100 * (step[0] ** 2 + step[1] ** 2) ** 0.5)


def test_publish_replaces_and_keeps_one_version(spark, tmp_path):
    target = str(tmp_path / "t")
    assert readers.publish(spark.range(3), target, 3) == 3 and readers.publish(spark.range(5), target, 5) == 5
    assert spark.read.parquet(target).count() == 5 and sorted(os.listdir(tmp_path)) == ["t"]
    with pytest.raises(ValueError):
        readers.publish(spark.range(2), target, 3)
    assert spark.read.parquet(target).count() == 5
