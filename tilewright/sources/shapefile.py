"""Zipped Shapefile source: bundles are read whole (``binaryFile``) and parsed per file in Python.

Binary parsing has no native counterpart; everything after it is native.
"""

from __future__ import annotations

import io
import json
import math
import struct
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs, geometry

MAX_MEMBER = 4 << 30
MAX_PARTS, MAX_POINTS = 1_000_000, 100_000_000

# Shape types by base kind; Z and M kinds carry more values, which are dropped.
POINTS, LINES, POLYGONS, MULTIPOINTS = (1, 11, 21), (3, 13, 23), (5, 15, 25), (8, 18, 28)


class ShapefileError(ValueError):
    def __init__(self, code: str, text: str):
        super().__init__(text)
        self.code = code


def open_bundle(data: bytes) -> dict[str, bytes]:
    """Members by lower-case extension; of several the last counts."""
    try:
        bundle = zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile as e:
        raise ShapefileError("INVALID_SHAPEFILE", f"not a zip file: {e}") from e
    found: dict[str, bytes] = {}
    for info in bundle.infolist():
        if info.is_dir():
            continue
        name = info.filename.replace("\\", "/")
        if name.startswith("/") or ".." in name.split("/"):
            raise ShapefileError("INVALID_SHAPEFILE", f"unsafe path {info.filename!r}")
        if info.file_size > MAX_MEMBER:
            raise ShapefileError("INVALID_SHAPEFILE", f"member too large: {info.filename!r}")
        base = name.rsplit("/", 1)[-1]
        if "." in base:
            found[base.rsplit(".", 1)[-1].lower()] = bundle.read(info)
    for part in ("shp", "dbf"):
        if part not in found:
            raise ShapefileError("MISSING_SHAPEFILE_COMPONENTS", f"Missing required .{part} file.")
    return found


def ring_area2(ring: list[tuple[float, float]]) -> float:
    return sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True))


def group_rings(rings: list[list[tuple[float, float]]]) -> list[list[list[tuple[float, float]]]]:
    """Polygons of rings: negative area opens one, positive is a hole of the last; a leading hole is promoted."""
    polygons: list = []
    for ring in rings:
        area = ring_area2(ring) if len(ring) >= 4 else 0.0
        if abs(area) <= 2.220446049250313e-16:
            continue
        if area < 0 or not polygons:
            polygons.append([ring])
        else:
            polygons[-1].append(ring)
    return polygons


def read_shp(data: bytes) -> Iterator[tuple[int, str | None, list | None]]:
    """(record number from 0, kind, parts); null shapes have no kind."""
    if len(data) < 100 or struct.unpack_from(">i", data)[0] != 9994:
        raise ShapefileError("INVALID_SHAPEFILE", "bad .shp header")
    end, at, number = min(struct.unpack_from(">i", data, 24)[0] * 2, len(data)), 100, 0
    while at + 12 <= end:
        size = struct.unpack_from(">i", data, at + 4)[0] * 2
        body, at = data[at + 8 : at + 8 + size], at + 8 + size
        try:
            yield number, *_shape(body)
        except struct.error as e:
            raise ShapefileError("INVALID_SHAPEFILE", f"truncated record {number}") from e
        number += 1


def _shape(body: bytes) -> tuple[str | None, list | None]:
    kind = struct.unpack_from("<i", body)[0]
    if kind == 0:
        return None, None
    if kind in POINTS:
        return "Point", [[[struct.unpack_from("<2d", body, 4)]]]
    if kind in MULTIPOINTS:
        points = _points(body, 40, struct.unpack_from("<i", body, 36)[0])
        return ("MultiPoint", [[points]]) if points else (None, None)
    if kind not in LINES + POLYGONS:
        raise ShapefileError("INVALID_SHAPEFILE", f"unsupported shape type {kind}")
    n_parts, n_points = struct.unpack_from("<2i", body, 36)
    if not 0 <= n_parts <= MAX_PARTS:
        raise ShapefileError("INVALID_SHAPEFILE", "implausible part count")
    starts = [*struct.unpack_from(f"<{n_parts}i", body, 44), n_points]
    points = _points(body, 44 + 4 * n_parts, n_points)
    if any(not 0 <= a <= b <= n_points for a, b in zip(starts[:-1], starts[1:], strict=True)):
        raise ShapefileError("INVALID_SHAPEFILE", "corrupt part offsets")
    lines = [points[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
    if kind in LINES:
        lines = [line for line in lines if len(line) >= 2]
        return ("MultiLineString", [lines]) if lines else (None, None)
    polygons = group_rings(lines)
    if not polygons:
        return None, None
    return ("Polygon" if len(polygons) == 1 else "MultiPolygon"), polygons


def _points(body: bytes, at: int, n: int) -> list[tuple[float, float]]:
    if not 0 <= n <= MAX_POINTS:
        raise ShapefileError("INVALID_SHAPEFILE", "implausible point count")
    flat = struct.unpack_from(f"<{2 * n}d", body, at)
    return list(zip(flat[::2], flat[1::2], strict=True))


def _text(raw: bytes) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def decode_field(kind: str, decimals: int, raw: bytes):
    """A value by field type; dates stay text."""
    text = _text(raw).strip("\0 \t\r\n")
    if kind in "NF":
        if not text:
            return None
        if decimals == 0 and "." not in text:
            try:
                return int(text)
            except ValueError:
                pass
        try:
            value = float(text)
        except ValueError:
            return text
        return value if math.isfinite(value) else text
    if kind == "L":
        return True if text[:1] in tuple("TtYy1") else False if text[:1] in tuple("FfNn0") else None
    return text


def read_dbf(data: bytes) -> Iterator[tuple[int, dict | None]]:
    """(record number from 0, attributes); deleted records have none."""
    if len(data) < 32:
        raise ShapefileError("INVALID_SHAPEFILE", "truncated .dbf header")
    count, header, size = struct.unpack_from("<IHH", data, 4)
    columns, at = [], 32
    while at < len(data) and data[at] != 0x0D:
        if at + 32 > len(data):
            raise ShapefileError("INVALID_SHAPEFILE", "truncated .dbf field")
        columns.append((_text(data[at : at + 11].split(b"\0", 1)[0]).strip(), chr(data[at + 11]), data[at + 16], data[at + 17]))
        at += 32
    for number in range(count):
        record = data[header + number * size : header + (number + 1) * size]
        if len(record) < size:
            raise ShapefileError("INVALID_SHAPEFILE", f"truncated .dbf record {number}")
        if record[:1] == b"*":
            yield number, None
            continue
        values, offset = {}, 1
        for name, kind, width, decimals in columns:
            values[name] = decode_field(kind, decimals, record[offset : offset + width])
            offset += width
        yield number, values


def read_bundle(data: bytes, compat: bool = False) -> tuple[list[tuple[int, str, list, dict]], str | None]:
    """(number, kind, parts, attributes) of each feature, and the .prj text.

    Shapes and attributes pair by record number.  ``compat`` pairs them by position after null
    shapes and deleted records went, which can shift attributes.
    """
    members = open_bundle(data)
    shapes = [(n, k, p) for n, k, p in read_shp(members["shp"]) if k is not None]
    rows = [(n, v) for n, v in read_dbf(members["dbf"]) if v is not None]
    if compat:
        paired = [(i, k, p, v) for i, ((_, k, p), (_, v)) in enumerate(zip(shapes, rows, strict=False))]
    else:
        values = dict(rows)
        paired = [(n, k, p, values[n]) for n, k, p in shapes if n in values]
    projection = members.get("prj")
    return paired, projection and _text(projection)


_ROW = f"path string, ord int, geom {geometry.GEOMETRY}, props map<string,string>, prj string, error_code string"


def scan(files: DataFrame, compat: bool = False) -> DataFrame:
    """``path, ord, id, geom, props, crs, assumed, error_code`` from ``path, content``; bad bundles give one error row."""
    coord = pa.struct([("x", pa.float64()), ("y", pa.float64())])
    shape = pa.struct([("kind", pa.string()), ("parts", pa.list_(pa.list_(pa.list_(coord))))])
    schema = pa.schema([("path", pa.string()), ("ord", pa.int32()), ("geom", shape), ("props", pa.map_(pa.string(), pa.string())), ("prj", pa.string()), ("error_code", pa.string())])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                try:
                    found, projection = read_bundle(row["content"], compat)
                    for number, kind, parts, values in found:
                        nested = [[[{"x": x, "y": y} for x, y in line] for line in p] for p in parts]
                        props = [(k, json.dumps(v, ensure_ascii=False)) for k, v in values.items()]
                        out.append({"path": row["path"], "ord": number, "geom": {"kind": kind, "parts": nested}, "props": props, "prj": projection})
                except ShapefileError as e:
                    out.append({"path": row["path"], "ord": 0, "error_code": e.code})
                for a in range(0, len(out), 10_000):
                    yield pa.RecordBatch.from_pylist(out[a : a + 10_000], schema=schema)

    return files.select("path", "content").mapInArrow(run, _ROW)


def features(scanned: DataFrame, assume_wgs84: bool = False) -> DataFrame:
    """Scanned rows in WGS84 with ids from 1, CRS and the CRS errors of their bundle."""
    known = scanned.withColumn("_c", crs.resolve(crs.detect(F.col("prj")), assume_wgs84))
    error = F.coalesce("error_code", "_c.error_code")
    return known.select("path", "ord", (F.col("ord") + 1).cast("decimal(20,0)").alias("id"), F.when(error.isNull(), crs.to_wgs84(F.col("geom"), F.col("_c.crs"))).alias("geom"), "props", F.col("_c.crs").alias("source_crs"), F.col("_c.assumed").alias("assumed_crs"), error.alias("error_code"))


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")
