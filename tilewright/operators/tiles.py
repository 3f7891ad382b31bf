"""Tiles: an Arrow function over sorted partitions encodes each tile under the size ladder; statistics are plain aggregates.

A tile's features meet in one task, as its bytes depend on all of them; a low-zoom tile can hold every
feature, so choose ``min_zoom`` for the data.
"""

from __future__ import annotations

import functools
import json
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, mvt, properties, simplify, tilemath
from .assign import assign


@dataclass(frozen=True)
class TileConfig:
    """Tile settings; invalid combinations are refused."""

    layer: str = "features"
    min_zoom: int = 0
    max_zoom: int = 14
    extent: int = 4096
    buffer: int = 256
    simplify_below: int = 14
    gzip_level: int = 6
    target_bytes: int = 250_000
    hard_bytes: int = 750_000
    drop: str = "lightest"  # which half goes first when a tile stays too large

    def __post_init__(self):
        if self.extent <= 0 or not 0 <= self.min_zoom <= self.max_zoom <= 20 or not 1 <= self.gzip_level <= 9 or self.target_bytes > self.hard_bytes:
            raise ValueError(f"invalid tile configuration: {self}")


def prepare(features: DataFrame) -> DataFrame:
    """``ord, id, geom, props`` with world box and vertex count; empty or non-finite shapes go."""
    box = geometry.bbox(F.col("geom"))
    found = features.where(F.col("geom").isNotNull()).withColumn("vertices", geometry.vertex_count(F.col("geom")))
    found = found.where((F.col("vertices") > 0) & F.forall(geometry.vertices(F.col("geom")), geometry.is_finite)).withColumn("_b", box)
    world = {"wx0": tilemath.world_x(F.col("_b.min_x")), "wy0": tilemath.world_y(F.col("_b.max_y")), "wx1": tilemath.world_x(F.col("_b.max_x")), "wy1": tilemath.world_y(F.col("_b.min_y"))}
    return found.withColumns(world).drop("_b")


@functools.lru_cache(1 << 14)
def tile_value(raw: str):
    """Tile value of a JSON-encoded property: integer, double, boolean or text; null is none, the rest is JSON text."""
    value = json.loads(raw)
    if isinstance(value, (list, dict)):
        return json.dumps(value, separators=(",", ":"), ensure_ascii=False)
    if isinstance(value, int) and not isinstance(value, bool) and not -(1 << 63) <= value < 1 << 64:
        return float(value)
    return value


def typed(props) -> dict:
    """Tile values of (key, JSON text) pairs; nulls go."""
    return {key: value for key, raw in props if (value := tile_value(raw)) is not None}


def nested(shape: list[list[int]], xs: list[float], ys: list[float]) -> list[list[list[tuple[float, float]]]]:
    """Parts of a geometry from the sizes of their lines and all coordinates."""
    points, parts, at = list(zip(xs, ys, strict=True)), [], 0
    for sizes in shape:
        lines = []
        for n in sizes:
            lines.append(points[at : at + n])
            at += n
        parts.append(lines)
    return parts


def build_tile(z: int, x: int, y: int, rows: list[dict], config: TileConfig) -> dict | None:
    """One tile under the ladder: all properties, core ones, none, coarser shapes, then half the features."""
    base = 0.0 if z >= config.simplify_below else 360.0 / (2**z * config.extent) * 0.5
    mode, extra, dropped, active = "full", False, 0, rows
    n = 2.0**z

    def quantize(lon: float, lat: float) -> tuple[int, int]:
        wx, wy = world(lon, lat)
        return mvt.round_half_away((wx * n - x) * config.extent), mvt.round_half_away((wy * n - y) * config.extent)

    while True:
        layer, instances = mvt.Layer(config.layer, config.extent), 0
        for row in active:
            parts = simplify.simplify(row["kind"], row["parts"], base * (4 if extra else 1))
            if parts is None:
                continue
            commands = mvt.encode_geometry(row["kind"], parts, quantize, config.extent, config.buffer)
            layer.add(row["id"], row["kind"], commands, {} if mode == "none" else row["core"] if mode == "core" else row["full"])
            instances += 1
        if not layer.features:
            return None
        raw = layer.encode()
        data = mvt.compress(raw, config.gzip_level)
        fits = len(data) <= config.hard_bytes
        if not fits and mode != "none":
            mode = "core" if mode == "full" else "none"
        elif not fits and z < config.simplify_below and not extra:
            extra = True
        elif not fits and len(active) > 1:
            ranked = sorted(active, key=lambda r: -r["vertices"] if config.drop == "lightest" else r["vertices"])
            cut = max(1, len(active) // 2)
            active, dropped = ranked[: len(active) - cut], dropped + cut
        else:
            return {"z": z, "x": x, "y": y, "data": data, "raw_bytes": len(raw), "gzip_bytes": len(data), "instances": instances, "dropped": dropped, "mitigated": not fits or mode != "full" or extra or dropped > 0}


@functools.lru_cache(1 << 16)
def world(lon: float, lat: float) -> tuple[float, float]:
    phi = math.radians(max(-tilemath.MAX_LATITUDE, min(tilemath.MAX_LATITUDE, lat)))
    wx, wy = (lon + 180.0) / 360.0, (1.0 - math.log(math.tan(phi) + 1.0 / math.cos(phi)) / math.pi) / 2.0
    return max(0.0, min(1.0, wx)), max(0.0, min(1.0, wy))


TILE = "z int, x long, y long, data binary, raw_bytes long, gzip_bytes long, instances long, dropped long, mitigated boolean"


def build(features: DataFrame, config: TileConfig = TileConfig()) -> DataFrame:
    """Encoded tiles of ``ord, id, geom, props`` (props: JSON-encoded values); empty tiles give no row."""
    ready = prepare(features).withColumns({"full": properties.tile_properties(F.col("props")), "core": properties.tile_properties(F.col("props"), "core")})
    coords = geometry.vertices(F.col("geom"))
    # flat arrays of doubles are much cheaper to take over into Python than nested structs
    shape = F.transform("geom.parts", lambda p: F.transform(p, F.size))
    flat = ready.select("ord", "id", F.col("geom.kind").alias("kind"), shape.alias("shape"), F.transform(coords, lambda c: c["x"]).alias("xs"), F.transform(coords, lambda c: c["y"]).alias("ys"), "vertices", "full", "core", "wx0", "wy0", "wx1", "wy1")
    placed = assign(flat, config.min_zoom, config.max_zoom, config.extent, config.buffer)
    schema = pa.schema([("z", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("data", pa.binary()), ("raw_bytes", pa.int64()), ("gzip_bytes", pa.int64()), ("instances", pa.int64()), ("dropped", pa.int64()), ("mitigated", pa.bool_())])

    def run(batches):
        at, rows = None, []

        def encoded():
            found = build_tile(*at, rows, config) if rows else None
            return [found] if found else []

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if (r["z"], r["x"], r["y"]) != at:
                    out += encoded()
                    at, rows = (r["z"], r["x"], r["y"]), []
                rows.append({"id": None if r["id"] is None else int(r["id"]), "kind": r["kind"], "parts": nested(r["shape"], r["xs"], r["ys"]), "vertices": r["vertices"], "full": typed(r["full"]), "core": typed(r["core"])})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        yield pa.RecordBatch.from_pylist(encoded(), schema=schema)

    # sorted partitions are read as a stream: a tile is encoded when its last row has come
    together = placed.drop("wx0", "wy0", "wx1", "wy1").repartition("z", "x", "y").sortWithinPartitions("z", "x", "y", "ord")
    return together.mapInArrow(run, TILE)


def zoom_stats(tiles: DataFrame) -> DataFrame:
    return tiles.groupBy("z").agg(F.count("*").alias("tiles"), F.sum("gzip_bytes").alias("gzip_bytes"), F.max("gzip_bytes").alias("max_bytes"), F.sum("instances").alias("instances"), F.sum("dropped").alias("dropped"), F.count_if("mitigated").alias("mitigated"))


def run_stats(tiles: DataFrame) -> DataFrame:
    """Totals and the largest tile, ties by position."""
    largest = F.max(F.struct("gzip_bytes", (-F.col("z")).alias("mz"), (-F.col("x")).alias("mx"), (-F.col("y")).alias("my")))
    return tiles.agg(F.count("*").alias("tiles"), F.sum("gzip_bytes").alias("gzip_bytes"), F.sum("dropped").alias("dropped"), largest.alias("l")).select("tiles", "gzip_bytes", "dropped", F.col("l.gzip_bytes").alias("max_bytes"), F.struct((-F.col("l.mz")).alias("z"), (-F.col("l.mx")).alias("x"), (-F.col("l.my")).alias("y")).alias("largest"))


def inspect(tiles: DataFrame) -> DataFrame:
    """Structure of each tile's layers, from ``z, x, y, data``."""
    schema = "z int, x long, y long, layer string, version int, extent int, features long, keys array<string>, values long, geom_types array<int>, commands long"

    def run(batches):
        for batch in batches:
            out = [
                {"z": r["z"], "x": r["x"], "y": r["y"], "layer": layer["name"], "version": layer["version"], "extent": layer["extent"], "features": len(layer["features"]), "keys": layer["keys"], "values": layer["value_count"], "geom_types": [f["geom_type"] for f in layer["features"]], "commands": sum(f["commands"] for f in layer["features"])}
                for r in batch.to_pylist()
                for layer in mvt.decode(r["data"])
            ]
            kinds = [("z", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("layer", pa.string()), ("version", pa.int32()), ("extent", pa.int32()), ("features", pa.int64()), ("keys", pa.list_(pa.string())), ("values", pa.int64()), ("geom_types", pa.list_(pa.int32())), ("commands", pa.int64())]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(kinds))

    return tiles.select("z", "x", "y", "data").mapInArrow(run, schema)


def simplify_column(df: DataFrame, column: str, epsilon: float) -> DataFrame:
    """``df`` with an array of coordinates simplified, a batch at a time."""
    at, kind = df.columns.index(column), pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))

    def run(batches):
        for batch in batches:
            lines = []
            for coords in batch.column(at).to_pylist():
                kept = simplify.simplify_line(np.array([(c["x"], c["y"]) for c in coords or []]).reshape(-1, 2), epsilon)
                lines.append(None if coords is None else [{"x": x, "y": y} for x, y in kept.tolist()])
            yield batch.set_column(at, column, pa.array(lines, kind))

    return df.mapInArrow(run, df.schema)
