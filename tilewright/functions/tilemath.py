"""Web Mercator and tile-grid arithmetic as Column expressions (no UDFs)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
MAX_LATITUDE = 85.05112901783463
EARTH_RADIUS = 6378137.0
EXTENT = 4096
BUFFER = 256


def clamp(value: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def world_x(lon: Column) -> Column:
    return clamp((lon + 180.0) / 360.0, 0.0, 1.0)


def world_y(lat: Column) -> Column:
    phi = F.radians(clamp(lat, -MAX_LATITUDE, MAX_LATITUDE))
    return clamp((1.0 - F.log(F.tan(phi) + 1.0 / F.cos(phi)) / math.pi) / 2.0, 0.0, 1.0)


def world_lon(x: Column) -> Column:
    return x * 360.0 - 180.0


def world_lat(y: Column) -> Column:
    return F.degrees(F.atan(F.sinh(math.pi * (1.0 - 2.0 * y))))


def mercator_to_lon(x: Column) -> Column:
    return F.degrees(x / EARTH_RADIUS)


def mercator_to_lat(y: Column) -> Column:
    return F.degrees(2.0 * F.atan(F.exp(y / EARTH_RADIUS)) - math.pi / 2.0)


def lon_to_mercator(lon: Column) -> Column:
    return F.radians(lon) * EARTH_RADIUS


def lat_to_mercator(lat: Column) -> Column:
    return F.log(F.tan(math.pi / 4.0 + F.radians(lat) / 2.0)) * EARTH_RADIUS


def tiles_across(z: Column) -> Column:
    return F.pow(F.lit(2.0), z)


def tile_range(low: Column, high: Column, z: Column, extent: int = EXTENT, buffer: int = BUFFER) -> tuple[Column, Column]:
    """First and last tile index that a world interval meets with the buffer, clamped to the grid."""
    n, margin = tiles_across(z), buffer / extent
    first = F.greatest(F.lit(0.0), F.least(n - 1, F.floor(low * n - margin).cast("double")))
    last = F.greatest(F.lit(0.0), F.least(n - 1, F.floor(high * n + margin).cast("double")))
    return first.cast("bigint"), last.cast("bigint")


def tile_units(world: Column, z: Column, tile: Column, extent: int = EXTENT) -> Column:
    """Tile-local integer coordinate; halves round away from zero."""
    return F.round((world * tiles_across(z) - tile) * extent).cast("bigint")


def in_tile(units: Column, extent: int = EXTENT, buffer: int = BUFFER) -> Column:
    return units.between(-buffer, extent + buffer)


def tile_bounds(z: Column, x: Column, y: Column) -> Column:
    """min_lon, min_lat, max_lon, max_lat of a tile."""
    n = tiles_across(z)
    return F.struct(world_lon(x / n).alias("min_lon"), world_lat((y + 1) / n).alias("min_lat"), world_lon((x + 1) / n).alias("max_lon"), world_lat(y / n).alias("max_lat"))


def epsilon(z: Column, simplify_below: int = 14, extent: int = EXTENT) -> Column:
    """Simplification tolerance in degrees: half a tile unit, none from ``simplify_below`` on."""
    if extent == 0:
        return F.lit(0.0)
    return F.when(z >= simplify_below, F.lit(0.0)).otherwise(360.0 / (tiles_across(z) * extent) * 0.5)


def valid_tile(z: Column, x: Column, y: Column, min_zoom: Column, max_zoom: Column) -> Column:
    n = tiles_across(z)
    return z.between(min_zoom, max_zoom) & (x >= 0) & (x < n) & (y >= 0) & (y < n)


def zigzag(value: Column) -> Column:
    """Zigzag code of a BIGINT."""
    return F.shiftleft(value, 1).bitwiseXOR(F.shiftright(value, 63))
