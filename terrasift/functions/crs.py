"""Coordinate systems without a projection library: transverse Mercator by Krueger series, datum shifts by Helmert transforms.

Systems by EPSG number: 4326 (degrees, taken as ETRS89), 2157 (Irish Transverse Mercator), 29902 and 29903 (Irish Grid, TM65 and TM75).
The Irish Grid shift is good to about a metre.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Projection:
    a: float
    inverse_f: float
    lat0: float
    lon0: float
    scale: float
    x0: float
    y0: float
    #: Position-vector Helmert to ETRS89: metres, arc seconds, parts per million.
    shift: tuple[float, ...] | None = None


# Published parameters of the systems.
GRS80 = (6378137.0, 298.257222101)
AIRY_MODIFIED = (6377340.189, 299.3249646)
IRISH_SHIFT = (482.5, -130.6, 564.6, -1.042, -0.214, -0.631, 8.15)
SYSTEMS = {
    4326: None,
    2157: Projection(*GRS80, 53.5, -8.0, 0.99982, 600000.0, 750000.0),
    29902: Projection(*AIRY_MODIFIED, 53.5, -8.0, 1.000035, 200000.0, 250000.0, IRISH_SHIFT),
    29903: Projection(*AIRY_MODIFIED, 53.5, -8.0, 1.000035, 200000.0, 250000.0, IRISH_SHIFT),
}


def _series(n: float) -> tuple[np.ndarray, np.ndarray]:
    """Krueger coefficients forwards and backwards, to the fourth order of the third flattening."""
    forward = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280]
    back = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280]
    return np.array(forward), np.array(back)


def _constants(p: Projection):
    f = 1 / p.inverse_f
    n = f / (2 - f)
    radius = p.a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    e = np.sqrt(f * (2 - f))
    forward, back = _series(n)
    return radius * p.scale, e, forward, back


def _conformal(lat: np.ndarray, e: float) -> np.ndarray:
    return np.sinh(np.arctanh(np.sin(lat)) - e * np.arctanh(e * np.sin(lat)))


def _xi(t: np.ndarray, lon: np.ndarray, forward: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    xi, eta = np.arctan2(t, np.cos(lon)), np.arcsinh(np.sin(lon) / np.hypot(t, np.cos(lon)))
    j = 2 * np.arange(1, 5)[:, None]
    return xi + (forward[:, None] * np.sin(j * xi) * np.cosh(j * eta)).sum(0), eta + (forward[:, None] * np.cos(j * xi) * np.sinh(j * eta)).sum(0)


def project(lon: np.ndarray, lat: np.ndarray, p: Projection) -> tuple[np.ndarray, np.ndarray]:
    """Degrees on the projection's own datum to eastings and northings."""
    k, e, forward, _ = _constants(p)
    origin = _xi(_conformal(np.radians([p.lat0]), e), np.zeros(1), forward)[0]
    xi, eta = _xi(_conformal(np.radians(lat), e), np.radians(lon - p.lon0), forward)
    return p.x0 + k * eta, p.y0 + k * (xi - origin)


def unproject(x: np.ndarray, y: np.ndarray, p: Projection) -> tuple[np.ndarray, np.ndarray]:
    k, e, forward, back = _constants(p)
    origin = _xi(_conformal(np.radians([p.lat0]), e), np.zeros(1), forward)[0]
    xi, eta = (y - p.y0) / k + origin, (x - p.x0) / k
    j = 2 * np.arange(1, 5)[:, None]
    xi, eta = xi - (back[:, None] * np.sin(j * xi) * np.cosh(j * eta)).sum(0), eta - (back[:, None] * np.cos(j * xi) * np.sinh(j * eta)).sum(0)
    t = np.sin(xi) / np.hypot(np.sinh(eta), np.cos(xi))
    lat = np.arctan(t)
    for _ in range(8):
        lat = np.arctan(np.sinh(np.arcsinh(t) + e * np.arctanh(e * np.sin(lat))))
    return p.lon0 + np.degrees(np.arctan2(np.sinh(eta), np.cos(xi))), np.degrees(lat)


def _shifted(lon: np.ndarray, lat: np.ndarray, source: tuple[float, float], target: tuple[float, float], shift: tuple[float, ...], sign: int) -> tuple[np.ndarray, np.ndarray]:
    """Degrees moved between datums through geocentric coordinates, on the ellipsoid's surface."""
    a, f = source[0], 1 / source[1]
    e2 = f * (2 - f)
    phi, lam = np.radians(lat), np.radians(lon)
    v = a / np.sqrt(1 - e2 * np.sin(phi) ** 2)
    xyz = np.array([v * np.cos(phi) * np.cos(lam), v * np.cos(phi) * np.sin(lam), v * (1 - e2) * np.sin(phi)])
    t, (rx, ry, rz), s = np.array(shift[:3])[:, None], np.radians(np.array(shift[3:6]) / 3600), 1 + shift[6] * 1e-6
    turn = np.array([[1, -rz, ry], [rz, 1, -rx], [-ry, rx, 1]])
    xyz = t + s * (turn @ xyz) if sign > 0 else np.linalg.inv(turn) @ ((xyz - t) / s)
    a, f = target[0], 1 / target[1]
    e2 = f * (2 - f)
    r = np.hypot(xyz[0], xyz[1])
    phi = np.arctan2(xyz[2], r * (1 - e2))
    for _ in range(6):
        v = a / np.sqrt(1 - e2 * np.sin(phi) ** 2)
        phi = np.arctan2(xyz[2] + e2 * v * np.sin(phi), r)
    return np.degrees(np.arctan2(xyz[1], xyz[0])), np.degrees(phi)


def transform(x: np.ndarray, y: np.ndarray, source: int, target: int) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates from one system to another."""
    if source == target:
        return x, y
    a, b = SYSTEMS[source], SYSTEMS[target]
    if a is not None:
        x, y = unproject(x, y, a)
        if a.shift:
            x, y = _shifted(x, y, (a.a, a.inverse_f), GRS80, a.shift, 1)
    if b is not None:
        if b.shift:
            x, y = _shifted(x, y, GRS80, (b.a, b.inverse_f), b.shift, -1)
        x, y = project(x, y, b)
    return x, y


def _points(data: bytes) -> list[tuple[int, int, int, str]]:
    """(offset, points, ordinates, byte order) of every coordinate array in a WKB value."""
    out: list[tuple[int, int, int, str]] = []

    def walk(at: int) -> int:
        order = "<" if data[at] else ">"
        (kind,) = struct.unpack_from(order + "I", data, at + 1)
        at += 5
        if kind & 0x20000000:
            at += 4
        size = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000)
        base = kind & 0x0FFFFFFF
        if base >= 1000:
            size += (1, 1, 2)[base // 1000 - 1]
        base %= 1000
        if base == 1:
            out.append((at, 1, size, order))
            return at + 8 * size
        (n,) = struct.unpack_from(order + "I", data, at)
        at += 4
        if base == 2:
            out.append((at, n, size, order))
            return at + 8 * size * n
        for _ in range(n):
            if base == 3:
                (k,) = struct.unpack_from(order + "I", data, at)
                out.append((at + 4, k, size, order))
                at += 4 + 8 * size * k
            else:
                at = walk(at)
        return at

    walk(0)
    return out


def transform_batch(values: list[bytes | None], source: int, target: int) -> list[bytes | None]:
    """WKB values with their coordinates in another system; Z and M stay as they are. All coordinates go through the series at once."""
    # Arrays of all values lie in one buffer, so those of one kind are moved together.
    buffer = np.frombuffer(bytearray(b"".join(v for v in values if v is not None)), np.uint8)
    found: dict[tuple[int, str], list[tuple[int, int]]] = {}
    begin = 0
    for data in values:
        if data is not None:
            for at, n, size, order in _points(data):
                found.setdefault((size, order), []).append((begin + at, n))
            begin += len(data)
    for (size, order), arrays in found.items():
        at, n = np.array(arrays, np.int64).T
        first = np.repeat(at - 8 * size * (np.cumsum(n) - n), n) + 8 * size * np.arange(n.sum())
        if not len(first):
            continue
        where = first[:, None] + np.arange(16)
        c = buffer[where].view(order + "f8").astype(float)
        c[:, 0], c[:, 1] = transform(c[:, 0], c[:, 1], source, target)
        buffer[where] = c.astype(order + "f8").view(np.uint8)
    out, whole, begin = [], buffer.tobytes(), 0
    for data in values:
        out.append(None if data is None else whole[begin : begin + len(data)])
        begin += len(data or b"")
    return out


def transform_wkb(data: bytes, source: int, target: int) -> bytes:
    """One WKB value in another system."""
    return transform_batch([data], source, target)[0]


def st_transform(g: Column | str, source: int, target: int) -> Column:
    """Reprojected WKB column (Arrow batches; the series have no built-in form)."""
    if source not in SYSTEMS or target not in SYSTEMS:
        raise ValueError(f"unknown system; known: {sorted(SYSTEMS)}")

    @F.pandas_udf("binary")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series(transform_batch([None if v is None else bytes(v) for v in values], source, target), index=values.index)

    return F.col(g) if isinstance(g, str) and source == target else g if source == target else run(g)
