"""Geometry functions on WKB columns, evaluated inside Spark's own code generation.

The topology library that ships with Spark is called through Catalyst's object expressions, so no Python runs on executors and no jar is
added. Null in, null out. This module alone touches Spark's internal classes (classic sessions only).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_J = "org.locationtech.jts."
INTERSECTION, UNION, DIFFERENCE = 1, 2, 3


class _Catalyst:
    """Builders of Catalyst object expressions in the active session's JVM."""

    def __init__(self) -> None:
        spark = SparkSession.getActiveSession()
        if spark is None:
            raise RuntimeError("geometry functions need an active session")
        self.jvm = jvm = spark._jvm
        self.objects = jvm.org.apache.spark.sql.catalyst.expressions.objects
        self.utils = jvm.org.apache.spark.sql.classic.ExpressionUtils
        self.types = jvm.org.apache.spark.sql.types
        self.none = getattr(getattr(jvm.scala, "None$"), "MODULE$")

    def cls(self, name: str) -> Any:
        return self.jvm.java.lang.Class.forName(name)

    def object(self, name: str) -> Any:
        return self.types.ObjectType(self.cls(name))

    def type(self, name: str) -> Any:
        return self.types.DataType.fromDDL(name)

    def seq(self, *items: Any) -> Any:
        out = self.jvm.java.util.ArrayList()
        for x in items:
            out.add(x)
        return self.jvm.scala.jdk.javaapi.CollectionConverters.asScala(out).toSeq()

    def expr(self, c: Any) -> Any:
        return self.utils.expression(c._jc) if isinstance(c, Column) else c

    def new(self, name: str, *args: Any) -> Any:
        return self.objects.NewInstance(self.cls(name), self.seq(*map(self.expr, args)), self.seq(), True, self.object(name), self.none)

    def call(self, target: Any, method: str, result: Any, *args: Any) -> Any:
        return self.objects.Invoke(target, method, result, self.seq(*map(self.expr, args)), self.seq(), True, True, True)

    def static(self, name: str, method: str, result: Any, *args: Any) -> Any:
        return self.objects.StaticInvoke(self.cls(name), result, method, self.seq(*map(self.expr, args)), self.seq(), True, True, True, self.none)

    def read(self, wkb: Any) -> Any:
        return self.call(self.new(_J + "io.WKBReader"), "read", self.object(_J + "geom.Geometry"), wkb)

    def column(self, e: Any) -> Column:
        return Column(self.utils.column(e))

    def wkb(self, geometry: Any) -> Column:
        return self.column(self.call(self.new(_J + "io.WKBWriter"), "write", self.type("binary"), geometry))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _get(g: Column | str, method: str, result: str, *args: Any) -> Column:
    k = _Catalyst()
    return k.column(k.call(k.read(_col(g)), method, k.type(result), *args))


def _pair(a: Column | str, b: Column | str, method: str, result: str, *args: Any) -> Column:
    k = _Catalyst()
    return k.column(k.call(k.read(_col(a)), method, k.type(result), k.read(_col(b)), *args))


def _overlay(a: Column | str, b: Column | str, op: int) -> Column:
    k = _Catalyst()
    return k.wkb(k.static(_J + "operation.overlayng.OverlayNGRobust", "overlay", k.object(_J + "geom.Geometry"), k.read(_col(a)), k.read(_col(b)), F.lit(op)))


def st_area(g: Column | str) -> Column:
    return _get(g, "getArea", "double")


def st_length(g: Column | str) -> Column:
    return _get(g, "getLength", "double")


def st_is_empty(g: Column | str) -> Column:
    return _get(g, "isEmpty", "boolean")


def st_is_valid(g: Column | str) -> Column:
    return _get(g, "isValid", "boolean")


def st_type(g: Column | str) -> Column:
    k = _Catalyst()
    text = k.call(k.read(_col(g)), "getGeometryType", k.object("java.lang.String"))
    return k.column(k.static("org.apache.spark.unsafe.types.UTF8String", "fromString", k.type("string"), text))


def st_is_rectangle(g: Column | str) -> Column:
    """Whether a polygon has five points and right angles along the axes."""
    return _get(g, "isRectangle", "boolean")


def st_num_parts(g: Column | str) -> Column:
    return _get(g, "getNumGeometries", "int")


def st_part(g: Column | str, i: Column | int) -> Column:
    """The i-th part, from 0."""
    k = _Catalyst()
    return k.wkb(k.call(k.read(_col(g)), "getGeometryN", k.object(_J + "geom.Geometry"), F.lit(i)))


def st_parts(g: Column | str) -> Column:
    """All parts; to be exploded."""
    g = _col(g)
    n = st_num_parts(g)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: st_part(g, i)))


def st_intersects(a: Column | str, b: Column | str) -> Column:
    """True on touch too."""
    return _pair(a, b, "intersects", "boolean")


def st_contains(a: Column | str, b: Column | str) -> Column:
    return _pair(a, b, "contains", "boolean")


def st_distance(a: Column | str, b: Column | str) -> Column:
    return _pair(a, b, "distance", "double")


def st_dwithin(a: Column | str, b: Column | str, distance: Column | float) -> Column:
    return _pair(a, b, "isWithinDistance", "boolean", F.lit(distance).cast("double"))


def st_intersection(a: Column | str, b: Column | str) -> Column:
    return _overlay(a, b, INTERSECTION)


def st_union(a: Column | str, b: Column | str) -> Column:
    return _overlay(a, b, UNION)


def st_difference(a: Column | str, b: Column | str) -> Column:
    return _overlay(a, b, DIFFERENCE)


def st_buffer(g: Column | str, distance: Column | float, segments: int = 8) -> Column:
    """Round caps and joins, ``segments`` to a quarter circle."""
    k = _Catalyst()
    return k.wkb(k.call(k.read(_col(g)), "buffer", k.object(_J + "geom.Geometry"), F.lit(distance).cast("double"), F.lit(segments)))


def st_fix(g: Column | str) -> Column:
    """Repaired by structure."""
    k = _Catalyst()
    return k.wkb(k.static(_J + "geom.util.GeometryFixer", "fix", k.object(_J + "geom.Geometry"), k.read(_col(g))))


def st_polygonal(g: Column | str) -> Column:
    """Repaired, polygon parts only, as a multipolygon without Z and M; null where no area is left."""
    k = _Catalyst()
    fixed = k.static(_J + "geom.util.GeometryFixer", "fix", k.object(_J + "geom.Geometry"), k.read(_col(g)))
    found = k.static(_J + "geom.util.PolygonExtracter", "getPolygons", k.object("java.util.List"), fixed)
    array = k.static(_J + "geom.GeometryFactory", "toPolygonArray", k.object(f"[L{_J}geom.Polygon;"), found)
    return _where(k.wkb(k.call(k.new(_J + "geom.GeometryFactory"), "createMultiPolygon", k.object(_J + "geom.MultiPolygon"), array)), st_area)


def _where(value: Column, measure: Callable[[Column], Column]) -> Column:
    """The value where its measure is positive, null elsewhere. The value is named once, so it is computed once."""
    return F.get(F.filter(F.array(value), lambda g: measure(g) > 0), 0)


def _overlay_polygons(a: Column | str, b: Column | str, op: int) -> Column:
    """Polygons of an overlay in one step, without a detour through bytes."""
    k = _Catalyst()
    both = k.static(_J + "operation.overlayng.OverlayNGRobust", "overlay", k.object(_J + "geom.Geometry"), k.read(_col(a)), k.read(_col(b)), F.lit(op))
    found = k.static(_J + "geom.util.PolygonExtracter", "getPolygons", k.object("java.util.List"), both)
    array = k.static(_J + "geom.GeometryFactory", "toPolygonArray", k.object(f"[L{_J}geom.Polygon;"), found)
    return k.wkb(k.call(k.new(_J + "geom.GeometryFactory"), "createMultiPolygon", k.object(_J + "geom.MultiPolygon"), array))


def st_common_polygons(a: Column | str, b: Column | str) -> Column:
    """Polygons of the intersection; empty where there is none."""
    return _overlay_polygons(a, b, INTERSECTION)


def st_common_area(a: Column | str, b: Column | str) -> Column:
    """Area of the intersection, which isn't written out."""
    k = _Catalyst()
    both = k.static(_J + "operation.overlayng.OverlayNGRobust", "overlay", k.object(_J + "geom.Geometry"), k.read(_col(a)), k.read(_col(b)), F.lit(INTERSECTION))
    return k.column(k.call(both, "getArea", k.type("double")))


def st_clipped_area(g: Column | str, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Area of a polygon without holes inside bounds. Its ring is clipped edge by edge; what runs along the bounds has no area."""
    k = _Catalyst()
    array = k.object(f"[L{_J}geom.Coordinate;")
    envelope = k.new(_J + "geom.Envelope", *[c.cast("double") for c in (xmin, xmax, ymin, ymax)])
    ring = k.call(k.new(_J + "operation.overlayng.RingClipper", envelope), "clip", array, k.call(k.read(_col(g)), "getCoordinates", array))
    return k.column(k.static(_J + "algorithm.Area", "ofRing", k.type("double"), ring))


def st_boundary(g: Column | str) -> Column:
    """Rings of a polygon; one line where it has no holes, else several parts."""
    k = _Catalyst()
    return k.wkb(k.call(k.read(_col(g)), "getBoundary", k.object(_J + "geom.Geometry")))


def st_rest_polygons(a: Column | str, b: Column | str) -> Column:
    """Polygons of the difference; empty where there is none."""
    return _overlay_polygons(a, b, DIFFERENCE)


def st_linear(g: Column | str) -> Column:
    """Line parts only, as one line geometry without Z and M; null where no length is left."""
    k = _Catalyst()
    lines = k.static(_J + "geom.util.LinearComponentExtracter", "getGeometry", k.object(_J + "geom.Geometry"), k.read(_col(g)))
    return _where(k.wkb(lines), st_length)


def st_interior_point(g: Column | str) -> Column:
    k = _Catalyst()
    return k.wkb(k.call(k.read(_col(g)), "getInteriorPoint", k.object(_J + "geom.Point")))


def st_bounds(g: Column | str) -> Column:
    """struct<xmin, ymin, xmax, ymax>."""
    k = _Catalyst()
    envelope = k.call(k.read(_col(g)), "getEnvelopeInternal", k.object(_J + "geom.Envelope"))
    return F.struct(*[k.column(k.call(envelope, f"get{m}", k.type("double"))).alias(n) for m, n in (("MinX", "xmin"), ("MinY", "ymin"), ("MaxX", "xmax"), ("MaxY", "ymax"))])


def st_x(g: Column | str) -> Column:
    return st_bounds(g)["xmin"]


def st_y(g: Column | str) -> Column:
    return st_bounds(g)["ymin"]


def st_rect(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Rectangle from its bounds."""
    k = _Catalyst()
    envelope = k.new(_J + "geom.Envelope", *[c.cast("double") for c in (xmin, xmax, ymin, ymax)])
    return k.wkb(k.call(k.new(_J + "geom.GeometryFactory"), "toGeometry", k.object(_J + "geom.Geometry"), envelope))


def st_from_wkt(text: Column | str) -> Column:
    k = _Catalyst()
    string = k.call(k.expr(_col(text)), "toString", k.object("java.lang.String"))
    return k.wkb(k.call(k.new(_J + "io.WKTReader"), "read", k.object(_J + "geom.Geometry"), string))


def st_as_wkt(g: Column | str) -> Column:
    k = _Catalyst()
    text = k.call(k.read(_col(g)), "toText", k.object("java.lang.String"))
    return k.column(k.static("org.apache.spark.unsafe.types.UTF8String", "fromString", k.type("string"), text))


def st_collect(parts: Column) -> Column:
    """A geometry collection of an array of WKB, put together byte by byte."""
    head = F.unhex(F.concat(F.lit("0000000007"), F.lpad(F.hex(F.size(parts)), 8, "0")))
    # Strings only carry the bytes here; nothing reads them as text.
    return F.concat(head, F.array_join(F.transform(parts, lambda p: p.cast("string")), "").cast("binary"))


def st_union_all(parts: Column) -> Column:
    """Union of an array of WKB; one part is itself, none is null."""
    k = _Catalyst()
    union = k.wkb(k.call(k.read(st_collect(parts)), "union", k.object(_J + "geom.Geometry")))
    return F.when(F.size(parts) == 1, F.element_at(parts, 1)).when(F.size(parts) > 1, union)


def st_self_union(g: Column | str) -> Column:
    """Union of the parts of one geometry."""
    k = _Catalyst()
    return k.wkb(k.call(k.read(_col(g)), "union", k.object(_J + "geom.Geometry")))


def st_union_agg(g: Column | str) -> Column:
    """Union of a group, null geometries left out. For groups of unknown size see ``spatial.union_by``."""
    return st_union_all(F.collect_list(_col(g)))
