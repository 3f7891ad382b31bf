"""Vector-tile codec: integer geometry commands, layers and the protobuf wire format.

Pure functions on Python values, run inside Arrow functions; see ``operators.tiles``.
"""

from __future__ import annotations

import gzip
import math
import struct
from collections.abc import Iterable

MOVE_TO, LINE_TO, CLOSE_PATH = 1, 2, 7
GEOM_TYPES = {"Point": 1, "MultiPoint": 1, "LineString": 2, "MultiLineString": 2, "Polygon": 3, "MultiPolygon": 3}

# --- wire format ----------------------------------------------------------------------------


def varint(value: int) -> bytes:
    """Base-128 code; negative values as 64-bit two's complement."""
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


_SMALL = [varint(n) for n in range(1 << 14)]


def packed(values: list[int]) -> bytes:
    """Varints of unsigned values, end to end."""
    return b"".join([_SMALL[v] if v < 1 << 14 else varint(v) for v in values])


def field(number: int, payload: bytes) -> bytes:
    return varint(number << 3 | 2) + varint(len(payload)) + payload


def uint_field(number: int, value: int) -> bytes:
    return varint(number << 3) + varint(value)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise ValueError("bad varint")
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterable[tuple[int, int, int | bytes]]:
    """(number, wire type, value) of every field of a message."""
    at = 0
    while at < len(data):
        tag, at = read_varint(data, at)
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            value, at = read_varint(data, at)
        else:
            if wire == 2:
                size, at = read_varint(data, at)
            elif wire in (1, 5):
                size = 8 if wire == 1 else 4
            else:
                raise ValueError(f"bad wire type {wire}")
            if at + size > len(data):
                raise ValueError("truncated field")
            value, at = data[at : at + size], at + size
        yield number, wire, value


# --- geometry -------------------------------------------------------------------------------


def zigzag(value: int) -> int:
    return value << 1 if value >= 0 else (-value << 1) - 1


def command(op: int, count: int) -> int:
    return op | count << 3


class Pen:
    """Delta-coded commands."""

    def __init__(self):
        self.x = self.y = 0
        self.out: list[int] = []

    def to(self, points: list[tuple[int, int]]) -> None:
        for x, y in points:
            self.out += (zigzag(x - self.x), zigzag(y - self.y))
            self.x, self.y = x, y


def encode_points(points: list[tuple[int, int]]) -> list[int]:
    pen = Pen()
    if points:
        pen.out.append(command(MOVE_TO, len(points)))
        pen.to(points)
    return pen.out


def encode_lines(lines: list[list[tuple[int, int]]]) -> list[int]:
    pen = Pen()
    for line in lines:
        if len(line) >= 2:
            pen.out.append(command(MOVE_TO, 1))
            pen.to(line[:1])
            pen.out.append(command(LINE_TO, len(line) - 1))
            pen.to(line[1:])
    return pen.out


def area2(ring: list[tuple[int, int]]) -> int:
    return sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True))


def encode_rings(polygons: list[list[list[tuple[int, int]]]]) -> list[int]:
    """Exteriors with positive area, holes with negative; rings without area are dropped."""
    pen = Pen()
    for rings in polygons:
        for i, ring in enumerate(rings):
            area = area2(ring) if len(ring) >= 3 else 0
            if not area:
                continue
            if (area > 0) != (i == 0):
                ring = ring[::-1]
            pen.out.append(command(MOVE_TO, 1))
            pen.to(ring[:1])
            pen.out.append(command(LINE_TO, len(ring) - 1))
            pen.to(ring[1:])
            pen.out.append(command(CLOSE_PATH, 1))
    return pen.out


def round_half_away(value: float) -> int:
    return int(math.floor(abs(value) + 0.5)) * (1 if value >= 0 else -1)


def distinct_run(points: list[tuple[int, int]]) -> list[tuple[int, int]]:
    return [p for i, p in enumerate(points) if not i or p != points[i - 1]]


def encode_geometry(kind: str, parts: list, quantize, extent: int, buffer: int) -> list[int]:
    """Commands of a geometry; points outside the buffered tile go, lines and polygons are never clipped."""
    if kind in ("Point", "MultiPoint"):
        points = [quantize(*c) for p in parts for line in p for c in line]
        return encode_points([p for p in points if all(-buffer <= v <= extent + buffer for v in p)])
    if kind in ("LineString", "MultiLineString"):
        return encode_lines([distinct_run([quantize(*c) for c in line]) for p in parts for line in p])
    polygons = []
    for rings in parts:
        kept = []
        for i, ring in enumerate(rings):
            points = distinct_run([quantize(*c) for c in ring])
            if len(points) > 1 and points[0] == points[-1]:
                points.pop()
            if len(points) >= 3:
                kept.append(points)
            elif not i:
                break
        if kept:
            polygons.append(kept)
    return encode_rings(polygons)


# --- layers ---------------------------------------------------------------------------------


def encode_value(value) -> bytes:
    """Value message: text 1, double 3, int 4, uint 5, boolean 7."""
    if isinstance(value, bool):
        return uint_field(7, int(value))
    if isinstance(value, int):
        return uint_field(4, value) if value < 1 << 63 else uint_field(5, value)
    if isinstance(value, float):
        return varint(3 << 3 | 1) + struct.pack("<d", value)
    return field(1, str(value).encode())


class Layer:
    """Collects features; keys and values are interned in the order they come."""

    def __init__(self, name: str, extent: int):
        self.name, self.extent = name, extent
        self.keys: dict[str, int] = {}
        self.values: dict[bytes, int] = {}
        self.interned: dict[tuple[type, object], int] = {}
        self.features: list[bytes] = []

    def add(self, feature_id: int | None, kind: str, commands: list[int], properties: dict) -> None:
        if not commands:
            return
        tags: list[int] = []
        for key in sorted(properties, key=str.encode):
            tags.append(self.keys.setdefault(key, len(self.keys)))
            value = properties[key]
            of = self.interned.get((value.__class__, value))
            if of is None:
                of = self.interned[value.__class__, value] = self.values.setdefault(encode_value(value), len(self.values))
            tags.append(of)
        message = b"" if feature_id is None else uint_field(1, feature_id)
        if tags:
            message += field(2, packed(tags))
        message += uint_field(3, GEOM_TYPES[kind]) + field(4, packed(commands))
        self.features.append(message)

    def encode(self) -> bytes:
        """The whole tile: this layer as its only one."""
        layer = field(1, self.name.encode()) + b"".join(field(2, f) for f in self.features)
        layer += b"".join(field(3, k.encode()) for k in self.keys) + b"".join(field(4, v) for v in self.values)
        return field(3, layer + uint_field(5, self.extent) + uint_field(15, 2))


def compress(data: bytes, level: int = 6) -> bytes:
    return gzip.compress(data, level, mtime=0)


def _packed(data: bytes) -> list[int]:
    out, at = [], 0
    while at < len(data):
        value, at = read_varint(data, at)
        out.append(value)
    return out


def decode(data: bytes) -> list[dict]:
    """Layers of a tile (gzipped or not), structurally; unknown fields are skipped."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    layers = []
    for number, _, payload in fields(data):
        if number != 3:
            continue
        layer = {"name": "", "version": 1, "extent": 4096, "keys": [], "value_count": 0, "features": []}
        for n, _, value in fields(payload):
            if n == 1:
                layer["name"] = value.decode()
            elif n == 2:
                feature = {"id": None, "geom_type": 0, "commands": 0, "tags": 0}
                for k, _, v in fields(value):
                    if k == 1:
                        feature["id"] = v
                    elif k == 2:
                        feature["tags"] = len(_packed(v)) // 2
                    elif k == 3:
                        feature["geom_type"] = v
                    elif k == 4:
                        feature["commands"] = len(_packed(v))
                layer["features"].append(feature)
            elif n == 3:
                layer["keys"].append(value.decode())
            elif n == 4:
                layer["value_count"] += 1
            elif n == 5:
                layer["extent"] = value
            elif n == 15:
                layer["version"] = value
        layers.append(layer)
    return layers
