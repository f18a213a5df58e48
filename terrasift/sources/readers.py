"""Readers and writers of layers: GeoJSON, shapefile (plain or zipped), GeoPackage, grids and CSV registers."""

from __future__ import annotations

import glob
import io
import os
import re
import sqlite3
import struct
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

from ..functions import geo

# ---- GeoJSON

#: Small files that a task writes or reads.
FILES = 1000


def exactly_one(pattern: str) -> str:
    """The only match of a file pattern; an error for none and for several."""
    found = sorted(glob.glob(pattern))
    if len(found) != 1:
        raise ValueError(f"{pattern}: {len(found)} files match, exactly one must")
    return found[0]


def _ring(points: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(points, lambda p: F.concat_ws(" ", F.element_at(p, 1).cast("string"), F.element_at(p, 2).cast("string"))), ","), F.lit(")"))


def _polygon(rings: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(rings, _ring), ","), F.lit(")"))


def read_geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Features of FeatureCollections: the properties (DDL schema), ``geom`` as a WKB multipolygon, and ``file``.

    Polygons become multipolygons of one part, collections keep their polygons; other geometries are an error.
    """
    nested = "array<array<array<array<double>>>>"
    schema = f"struct<features:array<struct<properties:struct<{_colons(properties)}>,geometry:struct<type:string,coordinates:string,geometries:array<struct<type:string,coordinates:string>>>>>>"
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    text = _in_fewer(files, files.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), "value")).select("file", F.explode(F.from_json("value", schema).features).alias("f"))
    shape = F.col("f.geometry")
    one = F.when(shape.type == "GeometryCollection", F.filter(shape.geometries, lambda g: g.type.isin("Polygon", "MultiPolygon"))).otherwise(
        F.array(F.struct(shape.type.alias("type"), shape.coordinates.alias("coordinates")))
    )
    parsed = F.flatten(F.transform(one, lambda g: F.when(g.type == "MultiPolygon", F.from_json(g.coordinates, nested)).when(g.type == "Polygon", F.from_json(F.concat(F.lit("["), g.coordinates, F.lit("]")), nested)).otherwise(F.raise_error(F.concat(F.lit("not a polygon: "), g.type)).cast(nested))))
    wkt = F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform(parsed, _polygon), ","), F.lit(")"))
    return text.select("file", "f.properties.*", geo.st_from_wkt(wkt).alias("geom"))


def _in_fewer(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of the files in as many tasks as their number and bytes call for; by itself, a scan puts a few small files into a task."""
    n_bytes = int(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    n_files, most = len(files._jdf.inputFiles()), files.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(files.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
    return rows.coalesce(max(1, -(-n_files // FILES) + n_bytes // most))


def _colons(ddl: str) -> str:
    return ",".join(re.sub(r"^\s*(\w+)\s+", r"\1:", p) for p in ddl.split(","))


def geojson_geometry(geom: str = "geom", decimals: int = 6) -> Column:
    """A geometry column as a GeoJSON multipolygon with rounded coordinates; a polygon becomes its one part."""
    wkt = geo.st_as_wkt(geom)
    kind = F.regexp_extract(wkt, r"^([A-Z]+)", 1)
    number = r"(-?[0-9.]+(?:E-?[0-9]+)?)"
    parts = F.regexp_replace(F.regexp_replace(wkt, r"^POLYGON (.*)$", "MULTIPOLYGON ($1)"), r"^[A-Z]+ ", "")
    pairs = F.regexp_replace(F.regexp_replace(parts, rf"{number} {number}", r"[$1,$2]"), r"\(", "[")
    nested = F.from_json(F.regexp_replace(pairs, r"\)", "]"), "array<array<array<array<double>>>>")
    deep = lambda f: lambda a: F.transform(a, f)
    rounded = F.transform(nested, deep(deep(deep(lambda x: F.round(x, decimals)))))
    name = F.when(kind.isin("MULTIPOLYGON", "POLYGON"), "MultiPolygon").otherwise(F.raise_error(F.concat(F.lit("not a multipolygon: "), kind)))
    return F.struct(name.alias("type"), rounded.alias("coordinates"))


def _polygon_arrays(data: bytes) -> list[list[tuple[int, int, int, str]]]:
    """Per polygon of a WKB polygon or multipolygon, its rings: (offset, points, ordinates, byte order)."""

    def polygon(at: int) -> tuple[list[tuple[int, int, int, str]], int]:
        order, base, size, at = head(at)
        if base != 3:
            raise ValueError(f"not a multipolygon: WKB type {base}")
        (n,) = struct.unpack_from(order + "I", data, at)
        at, rings = at + 4, []
        for _ in range(n):
            (k,) = struct.unpack_from(order + "I", data, at)
            rings.append((at + 4, k, size, order))
            at += 4 + 8 * size * k
        return rings, at

    def head(at: int) -> tuple[str, int, int, int]:
        order = "<" if data[at] else ">"
        (kind,) = struct.unpack_from(order + "I", data, at + 1)
        base = kind & 0x0FFFFFFF
        size = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000) + (0, 1, 1, 2)[base // 1000]
        return order, base % 1000, size, at + 5 + 4 * bool(kind & 0x20000000)

    order, base, _, at = head(0)
    if base != 6:
        rings, _ = polygon(0)
        return [rings] if rings else []
    (n,) = struct.unpack_from(order + "I", data, at)
    at, out = at + 4, []
    for _ in range(n):
        rings, at = polygon(at)
        out.append(rings)
    return out


def geojson_texts(values: list[bytes | None], decimals: int = 6) -> list[str]:
    """GeoJSON multipolygons of WKB values, as ``geojson_geometry`` has them."""
    if any(v is None for v in values):
        raise ValueError("not a multipolygon: null")
    shapes = [_polygon_arrays(v) for v in values]
    rings = [np.frombuffer(v, order + "f8", n * size, at).reshape(n, size)[:, :2] for v, shape in zip(values, shapes, strict=True) for polygon in shape for at, n, size, order in polygon]
    points = np.round(np.concatenate(rings), decimals).tolist() if rings else []
    out, at = [], 0
    for shape in shapes:
        polygons = []
        for polygon in shape:
            texts = []
            for _, n, _, _ in polygon:
                texts.append(str(points[at : at + n]).replace(" ", ""))
                at += n
            polygons.append(f"[{','.join(texts)}]")
        out.append(f'{{"type":"MultiPolygon","coordinates":[{",".join(polygons)}]}}')
    return out


def write_geojson(df: DataFrame, path: str, key: str, geom: str = "geom") -> None:
    """One folder per key with one FeatureCollection; keys must be whole numbers."""
    wrong = F.col(key).isNull() | ~F.col(key).cast("string").rlike("^[0-9]+$")
    n_rows, n_wrong = df.agg(F.count("*"), F.count_if(wrong)).first()
    if n_wrong:
        raise ValueError(f"{key} must be a whole number")
    properties = F.struct(*[c for c in df.columns if c != geom])
    feature = F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), geojson_geometry(geom).alias("geometry"))
    collection = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features")))
    # Files are dealt over tasks whatever their bytes, and each task moves its own into place.
    dealt = df.select(F.col(key), collection.alias("value")).repartition(max(1, -(-n_rows // FILES)), key)
    dealt.write.partitionBy(key).option("mapreduce.fileoutputcommitter.algorithm.version", "2").mode("overwrite").text(path)


def export_web(df: DataFrame, path: str, key: str, srs: int, reproject: Callable[[str, int, int], Column], geom: str = "geom") -> None:
    """Features in geographic coordinates (six decimals), one FeatureCollection in one file per output partition; keys must be whole numbers."""
    if df.where(F.col(key).isNull() | ~F.col(key).cast("string").rlike("^[0-9]+$")).limit(1).count():
        raise ValueError(f"{key} must be a whole number")
    placed = df.withColumn(geom, reproject(geom, srs, 4326))
    properties = F.to_json(F.struct(*[c for c in df.columns if c != geom]))
    lines = placed.select(properties.alias("properties"), geom)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The features of a partition between the two ends of a collection, a line each."""
        head = '{"type":"FeatureCollection","features":['
        for batch in batches:
            shapes = geojson_texts(batch.column(1).to_pylist())
            values = [f'{{"type":"Feature","properties":{p},"geometry":{g}}}' for p, g in zip(batch.column(0).to_pylist(), shapes, strict=True)]
            if values:
                yield pa.RecordBatch.from_pydict({"value": [head + values[0], *["," + v for v in values[1:]]]})
                head = ","
        yield pa.RecordBatch.from_pydict({"value": ["]}"] if head == "," else ['{"type":"FeatureCollection","features":[]}']})

    lines.mapInArrow(collect, "value string").write.mode("overwrite").text(path)


def one_feature(spark: SparkSession, folder: str, key: int, properties: str) -> DataFrame:
    """The overlay of one key, which must hold exactly one feature with that key."""
    rows = read_geojson(spark, f"{folder}/{key}.geojson", properties)
    if rows.count() != 1 or rows.where(F.col("source_fid") == key).count() != 1:
        raise ValueError(f"{folder}/{key}.geojson must hold exactly the feature {key}")
    return rows


# ---- Shapefile


def _members(path: str) -> dict[str, bytes]:
    """The .shp and .dbf of a shapefile; of a zip archive, which must hold exactly one."""
    if path.endswith(".zip"):
        with zipfile.ZipFile(path) as z:
            shapes = [n for n in z.namelist() if n.lower().endswith(".shp")]
            if len(shapes) != 1:
                raise ValueError(f"{path}: {len(shapes)} layers, exactly one is needed")
            stem = shapes[0][:-4]
            return {n[len(stem) :].lower(): z.read(n) for n in z.namelist() if n.startswith(stem + ".")}
    stem = path[:-4]
    return {s: open(stem + s, "rb").read() for s in (".shp", ".dbf") if os.path.exists(stem + s)}


def _dbf_fields(dbf: bytes) -> list[tuple[str, str, int]]:
    out, at = [], 32
    while dbf[at] != 0x0D:
        out.append((dbf[at : at + 11].split(b"\0")[0].decode("latin-1"), chr(dbf[at + 11]), dbf[at + 16]))
        at += 32
    return out


def _dbf_rows(dbf: bytes) -> Iterator[list]:
    n, head, size = struct.unpack_from("<IHH", dbf, 4)
    fields = _dbf_fields(dbf)
    for i in range(n):
        at, row = head + i * size + 1, []
        for _, kind, width in fields:
            text = dbf[at : at + width].decode("utf-8", "replace").strip()
            at += width
            row.append((float(text) if text and not text.startswith("*") else None) if kind in "NF" else (text or None))
        yield row


def _ring_area(points: list[tuple[float, float]]) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:], strict=False)) / 2


def _inside(point: tuple[float, float], ring: list[tuple[float, float]]) -> bool:
    x, y = point
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def _wkb_polygon(rings: list[list[tuple[float, float]]]) -> bytes:
    return struct.pack("<BII", 1, 3, len(rings)) + b"".join(struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", *p) for p in r) for r in rings)


def _shape_wkb(record: bytes) -> bytes | None:
    """WKB of a shape record; Z and M are dropped. Clockwise rings are shells, the others holes of the shell around them."""
    (kind,) = struct.unpack_from("<i", record)
    base = kind % 10
    if kind == 0:
        return None
    if base == 1:
        return struct.pack("<BI", 1, 1) + record[4:20]
    if base not in (3, 5):
        raise ValueError(f"shape type {kind} isn't read")
    n_parts, n_points = struct.unpack_from("<ii", record, 36)
    starts = [*struct.unpack_from(f"<{n_parts}i", record, 44), n_points]
    points = list(struct.iter_unpack("<dd", record[44 + 4 * n_parts : 44 + 4 * n_parts + 16 * n_points]))
    parts = [points[a:b] for a, b in zip(starts, starts[1:], strict=False)]
    if base == 3:
        lines = b"".join(struct.pack("<BII", 1, 2, len(p)) + b"".join(struct.pack("<dd", *q) for q in p) for p in parts)
        return struct.pack("<BII", 1, 5, len(parts)) + lines
    shells = [[p] for p in parts if _ring_area(p) <= 0]
    for hole in (p for p in parts if _ring_area(p) > 0):
        owner = next((s for s in shells if _inside(hole[0], s[0])), None)
        if owner is None:
            shells.append([hole])
        else:
            owner.append(hole)
    return struct.pack("<BII", 1, 6, len(shells)) + b"".join(map(_wkb_polygon, shells))


class _Shapefile(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        parts = _members(self.path)
        shp, rows = io.BytesIO(parts[".shp"]), _dbf_rows(parts[".dbf"]) if ".dbf" in parts else None
        shp.seek(100)
        fid = 0
        while head := shp.read(8):
            _, words = struct.unpack(">ii", head)
            yield (fid, *(next(rows) if rows else ()), _shape_wkb(shp.read(2 * words)))
            fid += 1


class ShapefileSource(DataSource):
    """``spark.read.format("shapefile").load(path)``: fid, the table's columns, and geom as WKB."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> StructType:
        parts = _members(self.options["path"])
        fields = _dbf_fields(parts[".dbf"]) if ".dbf" in parts else []
        return StructType([StructField("fid", LongType()), *[StructField(n, DoubleType() if k in "NF" else StringType()) for n, k, _ in fields], StructField("geom", BinaryType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Shapefile(self.options["path"])


# ---- GeoPackage


def _strip_header(blob: bytes | None) -> bytes | None:
    """WKB of a GeoPackage geometry value."""
    if blob is None:
        return None
    if blob[:2] != b"GP":
        raise ValueError("not a GeoPackage geometry")
    return None if blob[3] & 0x10 else blob[8 + (0, 32, 48, 48, 64)[blob[3] >> 1 & 7] :]


def geopackage_value(wkb: bytes, srs: int) -> bytes:
    return b"GP\0\x01" + struct.pack("<i", srs) + wkb


class _Range(InputPartition):
    def __init__(self, low: int, high: int) -> None:
        self.low, self.high = low, high


class _GeoPackage(DataSourceReader):
    """Partitions by ranges of the row id."""

    def __init__(self, path: str, layer: str, geom: str, columns: list[str], rows: int) -> None:
        self.path, self.layer, self.geom, self.columns, self.rows = path, layer, geom, columns, rows

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            low, high = db.execute(f'SELECT coalesce(min(rowid), 0), coalesce(max(rowid), -1) FROM "{self.layer}"').fetchone()
        return [_Range(i, min(high, i + self.rows - 1)) for i in range(low, high + 1, self.rows)] or [_Range(0, -1)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        names = ", ".join(f'"{c}"' for c in self.columns)
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            for row in db.execute(f'SELECT rowid, {names + ", " if names else ""}"{self.geom}" FROM "{self.layer}" WHERE rowid BETWEEN ? AND ?', (partition.low, partition.high)):
                yield (*row[:-1], _strip_header(row[-1]))


class GeoPackageSource(DataSource):
    """``spark.read.format("geopackage").option("layer", ...).load(path)``: fid, the layer's columns, and geom as WKB."""

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def _layer(self) -> tuple[str, str, list[tuple[str, str]], int]:
        with open(self.options["path"], "rb") as f:
            if f.read(16) != b"SQLite format 3\0":
                raise ValueError("not a GeoPackage: the file lacks the SQLite mark")
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            found = db.execute("SELECT table_name, column_name, srs_id FROM gpkg_geometry_columns").fetchall()
            layer = self.options.get("layer") or (found[0][0] if len(found) == 1 else None)
            match = [x for x in found if x[0] == layer]
            if not match:
                raise ValueError(f"no layer {layer!r}; there are {[x[0] for x in found]}")
            _, geom, srs = match[0]
            if (want := self.options.get("srs")) and int(want) != srs:
                raise ValueError(f"layer {layer} is in system {srs}, not {want}")
            columns = [(n, t.upper(), pk) for _, n, t, _, _, pk in db.execute(f'PRAGMA table_info("{layer}")')]
        return layer, geom, [(n, t) for n, t, pk in columns if n != geom and not pk], srs

    def schema(self) -> StructType:
        kind = lambda t: LongType() if "INT" in t else DoubleType() if re.search("REAL|DOUBLE|FLOAT", t) else StringType()
        return StructType([StructField("fid", LongType()), *[StructField(n, kind(t)) for n, t in self._layer()[2]], StructField("geom", BinaryType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        layer, geom, columns, _ = self._layer()
        return _GeoPackage(self.options["path"], layer, geom, [n for n, _ in columns], int(self.options.get("rows", "50000")))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ShapefileSource)
    spark.dataSource.register(GeoPackageSource)


# ---- Tables with required columns, registers, atomic publishing


def layer(df: DataFrame, required: list[str], name: str = "layer") -> DataFrame:
    """The table, once its required columns are there (case doesn't matter)."""
    missing = sorted(set(c.lower() for c in required) - {c.lower() for c in df.columns})
    if missing:
        raise ValueError(f"{name} lacks {missing}")
    return df


def read_register(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """A CSV register as strings."""
    return layer(spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"'), required, path)


def publish(df: DataFrame, path: str, expected: int | None = None) -> int:
    """Write beside the target, count what was written, then move into place. The old version is moved aside for that moment and
    deleted after it, so one whole version is there at any time, under the target's name or with ``_REPLACED`` behind it."""
    spark = df.sparkSession
    temporary = f"{path}_IN_PROGRESS"
    df.write.mode("overwrite").parquet(temporary)
    written = spark.read.parquet(temporary).count()
    if expected is not None and written != expected:
        raise ValueError(f"{path}: {written} rows written, {expected} expected")
    jvm = spark._jvm
    target, source = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(temporary)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}_REPLACED")
    fs.delete(aside, True)
    if fs.exists(target) and not fs.rename(target, aside):
        raise OSError(f"{path} can't be moved aside")
    if not fs.rename(source, target):
        raise OSError(f"{temporary} can't be moved to {path}; the version before is in {path}_REPLACED")
    fs.delete(aside, True)
    return written


def append_log(spark: SparkSession, path: str, **fields) -> None:
    """One row to a run log."""
    spark.createDataFrame([fields]).withColumn("finished_utc", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")).write.mode("append").json(path)


def report_csv(df: DataFrame, path: str) -> None:
    """A CSV report with a header; fractions have two places."""
    cells = [F.when(F.col(c).isNotNull(), F.format_string("%.2f", c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    df.select(*cells).write.mode("overwrite").csv(path, header=True)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, sha256) of the files under a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def degree_tiles(spark: SparkSession, lat: range, lon: range) -> DataFrame:
    """Names of the one-degree tiles of an area, as N53_W008."""
    one = lambda r, n: spark.range(r.start, r.stop).select(F.col("id").alias(n))
    name = F.format_string("%s%02d_%s%03d", F.when(F.col("lat") < 0, "S").otherwise("N"), F.abs("lat"), F.when(F.col("lon") < 0, "W").otherwise("E"), F.abs("lon"))
    # Two ranges of a few numbers each.
    return one(lat, "lat").withColumn("lon", F.explode(F.sequence(F.lit(lon.start), F.lit(lon.stop - 1)))).select(name.alias("tile"))
