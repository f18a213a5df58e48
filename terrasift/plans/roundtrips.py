"""Queries over readers and writers: each writes layers to the shared folder, reads them back and returns what came through."""

from __future__ import annotations

import os
import sqlite3
import struct
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import expect
from ..session import checkpoint_dir
from ..sources import readers
from . import fixtures as fx


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def geojson_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Overlays as one GeoJSON file per key, read again: key and area."""
    rows = fx.overlay(spark, d, "nha").select("id", geo.st_polygonal("geom").alias("geom"), F.col("id").alias("source_fid"))
    path = _folder(spark, "geojson")
    readers.write_geojson(rows, path, "id")
    return readers.read_geojson(spark, path, "source_fid bigint").select("source_fid", F.round(geo.st_area("geom")).cast("long").alias("m2"))


def publish_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A layer written beside its target, counted, moved, and read."""
    rows = fx.layer(spark, d, "pieces").select("id", "geom")
    path = _folder(spark, "published")
    readers.publish(rows, path, rows.count())
    return spark.read.parquet(path).select("id", F.round(geo.st_area("geom")).cast("long").alias("m2"))


def _shared_files(spark: SparkSession, name: str) -> str:
    """A new folder for files that executors open themselves: on a file system that all machines mount."""
    path = _folder(spark, name)
    if "://" in path and not path.startswith("file://"):
        raise ValueError("files for the readers need a mounted shared folder in spark.checkpoint.dir")
    path = path.removeprefix("file://")
    os.makedirs(path)
    return path


def make_shapefile(stem: str, rows: list[tuple[int, str, list[list[tuple[float, float]]]]]) -> str:
    """A small polygon shapefile: (id, name, rings) each; shells clockwise."""
    shapes, at = b"", 50
    for i, (_, _, rings) in enumerate(rows):
        points = [p for r in rings for p in r]
        starts = [sum(len(r) for r in rings[:k]) for k in range(len(rings))]
        box = (min(p[0] for p in points), min(p[1] for p in points), max(p[0] for p in points), max(p[1] for p in points))
        body = struct.pack("<i4dii", 5, *box, len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<dd", *p) for p in points)
        shapes += struct.pack(">ii", i + 1, len(body) // 2) + body
        at += 4 + len(body) // 2
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, at) + struct.pack("<ii8d", 1000, 5, *[0.0] * 8)
    with open(stem + ".shp", "wb") as f:
        f.write(head + shapes)
    fields = [("ID", "N", 10), ("NAME", "C", 20)]
    with open(stem + ".dbf", "wb") as f:
        f.write(struct.pack("<BBBBIHH20x", 3, 24, 1, 1, len(rows), 32 + 32 * len(fields) + 1, 1 + sum(w for *_, w in fields)))
        for name, kind, width in fields:
            f.write(name.encode().ljust(11, b"\0") + kind.encode() + b"\0" * 4 + bytes([width, 0]) + b"\0" * 14)
        f.write(b"\r")
        for i, name, _ in rows:
            f.write(b" " + str(i).rjust(10).encode() + name.ljust(20).encode())
    return stem + ".shp"


# Squares with a hole in the second, and their areas.
SQUARES = [(1, "plain", [[(0.0, 0.0), (0.0, 10.0), (10.0, 10.0), (10.0, 0.0), (0.0, 0.0)]]),
           (2, "holed", [[(20.0, 0.0), (20.0, 10.0), (30.0, 10.0), (30.0, 0.0), (20.0, 0.0)], [(22.0, 2.0), (24.0, 2.0), (24.0, 4.0), (22.0, 4.0), (22.0, 2.0)]])]


def shapefile_scan(spark: SparkSession, d: str) -> DataFrame:
    """A zipped shapefile through the reader. The file is small; executors open it themselves."""
    import zipfile

    readers.register(spark)
    folder = _shared_files(spark, "shapefile")
    make_shapefile(f"{folder}/squares", SQUARES)
    with zipfile.ZipFile(f"{folder}/squares.zip", "w") as z:
        for s in (".shp", ".dbf"):
            z.write(f"{folder}/squares{s}", f"squares{s}")
    rows = spark.read.format("shapefile").load(readers.exactly_one(f"{folder}/*.zip"))
    return rows.select(F.col("ID").cast("long").alias("id"), F.col("NAME").alias("name"), F.round(geo.st_area("geom")).cast("long").alias("m2"))


def make_geopackage(path: str, layer: str, rows: list[tuple[int, str, bytes]], srs: int = 2157) -> str:
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z INTEGER, m INTEGER)")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'MULTIPOLYGON', ?, 0, 0)", (layer, srs))
        db.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY, geom BLOB, source_fid INTEGER, county TEXT)')
        db.executemany(f'INSERT INTO "{layer}" (geom, source_fid, county) VALUES (?, ?, ?)', [(readers.geopackage_value(g, srs), i, c) for i, c, g in rows])
    return path


def gpkg_scan(spark: SparkSession, d: str) -> DataFrame:
    """A GeoPackage layer in several partitions through the reader."""
    readers.register(spark)
    folder = _shared_files(spark, "geopackage")
    small = [(i, name, readers._wkb_polygon(rings)) for i, name, rings in SQUARES]
    path = make_geopackage(os.path.join(folder, "squares.gpkg"), "squares", small)
    rows = spark.read.format("geopackage").option("layer", "squares").option("srs", "2157").option("rows", "1").load(path)
    return rows.select("source_fid", "county", F.round(geo.st_area("geom")).cast("long").alias("m2"))


# Columns of a source register.
REGISTER_COLUMNS = ["source_id", "dataset_name", "provider", "download_url", "access_date", "licence", "source_crs", "local_file", "purpose", "limitations", "status"]


def _register(spark: SparkSession, d: str) -> DataFrame:
    """A register of the test tables, written as CSV and read back."""
    path = _folder(spark, "register")
    rows = fx.table(spark, d, "nation").select(
        F.col("n_nationkey").cast("string").alias("source_id"), F.concat(F.col("n_name"), F.lit(" | data, \"quoted\"")).alias("dataset_name"), F.lit("provider").alias("provider"),
        F.when(F.col("n_nationkey") % 5 != 0, F.concat(F.lit("https://example.org/"), F.col("n_nationkey"))).alias("download_url"), *[F.lit("x").alias(c) for c in ("access_date", "licence", "source_crs")],
        F.when(F.col("n_nationkey") % 7 != 0, F.lit("file.zip")).otherwise(" ").alias("local_file"), *[F.lit("x").alias(c) for c in ("purpose", "limitations", "status")],
    )
    rows.write.csv(path, header=True, quote='"', escape='"')
    return readers.read_register(spark, path, REGISTER_COLUMNS)


def register_required_columns(spark: SparkSession, d: str) -> DataFrame:
    return expect.register_problems(_register(spark, d), ["download_url", "local_file"])


def register_report(spark: SparkSession, d: str) -> DataFrame:
    return expect.markdown_table(_register(spark, d), ["source_id", "dataset_name", "status"], "source_id")


def report_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A report in CSV with two places, and its checksum list's number of files."""
    path = _folder(spark, "report")
    rows = fx.table(spark, d, "customer").groupBy("c_mktsegment").agg(F.sum("c_acctbal").alias("total"), F.count("*").alias("n_rows"))
    readers.report_csv(rows, path)
    return spark.read.csv(path, header=True)


ROUNDTRIPS = {f.__name__: f for f in (geojson_roundtrip, publish_roundtrip, shapefile_scan, gpkg_scan, register_required_columns, register_report, report_roundtrip)}
