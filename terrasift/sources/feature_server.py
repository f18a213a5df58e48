"""Paged feature servers as a data source: one partition per square tile of the extent, pages until one is empty or the server says that no more follow.

A server that says nothing of it has also ended where a page is shorter than one before; a first page below the size asked for may be the server's own limit.

Requests are spaced, so all tasks together stay near the polite rate when they run one at a time per server; keep the number of concurrent tasks low.
Options: url, xmin, ymin, xmax, ymax, tile (metres), page (rows), rate (requests a second), timeout (seconds), where.
"""

from __future__ import annotations

import json
import math
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Tile(InputPartition):
    def __init__(self, xmin: float, ymin: float, xmax: float, ymax: float) -> None:
        self.bounds = (xmin, ymin, xmax, ymax)


def tile_grid(xmin: float, ymin: float, xmax: float, ymax: float, size: float) -> list[Tile]:
    """Tiles aligned to multiples of the size that cover the extent."""
    xs = range(math.floor(xmin / size), math.floor(xmax / size) + 1)
    ys = range(math.floor(ymin / size), math.floor(ymax / size) + 1)
    return [Tile(x * size, y * size, (x + 1) * size, (y + 1) * size) for x in xs for y in ys]


def fetch(url: str, timeout: float) -> dict:
    with urllib.request.urlopen(url, timeout=timeout) as answer:
        return json.load(answer)


def more_follow(answer: dict) -> bool | None:
    """What the server says of further rows, beside the features or in their properties; None where it says nothing."""
    return answer.get("exceededTransferLimit", (answer.get("properties") or {}).get("exceededTransferLimit"))


class FeatureServerReader(DataSourceReader):
    fetch = staticmethod(fetch)

    def __init__(self, options: dict[str, str]) -> None:
        number = lambda k, d: float(options.get(k, d))
        self.url, self.where = options["url"], options.get("where", "1=1")
        self.extent = tuple(float(options[k]) for k in ("xmin", "ymin", "xmax", "ymax"))
        self.size, self.page, self.pause, self.timeout = number("tile", 20_000), int(number("page", 2000)), 1 / number("rate", 4), number("timeout", 90)

    def partitions(self) -> list[InputPartition]:
        return tile_grid(*self.extent, self.size)

    def read(self, partition: Tile) -> Iterator[tuple]:
        offset = longest = 0
        while True:
            query = {
                "f": "geojson", "where": self.where, "outFields": "*", "geometry": ",".join(map(str, partition.bounds)), "geometryType": "esriGeometryEnvelope",
                "spatialRel": "esriSpatialRelIntersects", "resultOffset": offset, "resultRecordCount": self.page,
            }
            answer = self.fetch(f"{self.url}/query?{urllib.parse.urlencode(query)}", self.timeout)
            # Errors come in the body, with HTTP status 200.
            if "error" in answer or not isinstance(answer.get("features"), list):
                raise RuntimeError(f"{self.url}, tile {partition.bounds}, offset {offset}: {json.dumps(answer.get('error', 'no features in the answer'))}")
            features = answer["features"]
            for f in features:
                yield json.dumps(f.get("properties") or {}), json.dumps(f.get("geometry"))
            more = more_follow(answer)
            if not features or more is False or (more is None and len(features) < longest):
                return
            longest = max(longest, len(features))
            offset += len(features)
            time.sleep(self.pause)


class FeatureServerSource(DataSource):
    """``spark.read.format("feature_server").options(...).load()``: properties and geometry as JSON text.

    A feature that meets several tiles comes once per tile; drop duplicates by its key.
    """

    @classmethod
    def name(cls) -> str:
        return "feature_server"

    def schema(self) -> str:
        return "properties string, geometry string"

    def reader(self, schema) -> DataSourceReader:
        return FeatureServerReader(self.options)
