"""Geometry columns: ``struct<kind, parts>`` with parts[polygon][ring or line][vertex], all native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COORD = "struct<x:double,y:double>"
GEOMETRY = f"struct<kind:string,parts:array<array<array<{COORD}>>>>"
KINDS = ("Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon")


def vertices(geom: Column) -> Column:
    return F.flatten(F.flatten(geom["parts"]))


def is_finite(c: Column) -> Column:
    def ok(v: Column) -> Column:
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))

    return ok(c["x"]) & ok(c["y"])



def dedup_consecutive(coords: Column) -> Column:
    """Drop vertices equal to the one before."""
    return F.filter(coords, lambda c, i: (i == 0) | (c != F.get(coords, i - 1)))


def repair_line(coords: Column) -> Column:
    """Drop repeated, then non-finite vertices; null under two."""
    kept = F.filter(dedup_consecutive(coords), is_finite)
    return F.when(F.size(kept) >= 2, kept)


def repair_ring(coords: Column) -> Column:
    """Drop non-finite, then repeated vertices, close; null if no area can be held."""
    finite = F.filter(coords, is_finite)
    kept = dedup_consecutive(finite)
    closed = F.when(F.get(kept, F.lit(0)) == F.element_at(kept, -1), kept).otherwise(F.concat(kept, F.slice(kept, 1, 1)))
    return F.when(F.size(kept) >= 3, F.when(F.size(closed) >= 4, closed))


def repair_polygon(rings: Column) -> Column:
    """Null without an exterior; bad holes go."""
    mended = F.transform(rings, repair_ring)
    return F.when(F.get(mended, F.lit(0)).isNotNull(), F.filter(mended, lambda r: r.isNotNull()))


def repair(geom: Column) -> Column:
    """Repaired geometry, null where nothing can be kept."""
    kind, parts = geom["kind"], geom["parts"]
    points = F.transform(parts, lambda p: F.transform(p, lambda line: F.filter(line, is_finite)))
    lines = F.transform(parts, lambda p: F.filter(F.transform(p, repair_line), lambda x: x.isNotNull()))
    polygons = F.filter(F.transform(parts, repair_polygon), lambda x: x.isNotNull())
    mended = F.when(kind.isin("Point", "MultiPoint"), points).when(kind.isin("LineString", "MultiLineString"), lines).when(kind.isin("Polygon", "MultiPolygon"), polygons)
    return F.when(F.size(F.flatten(F.flatten(mended))) > 0, F.struct(kind.alias("kind"), mended.alias("parts")))


def bbox(geom: Column) -> Column:
    coords = vertices(geom)
    xs, ys = F.transform(coords, lambda c: c["x"]), F.transform(coords, lambda c: c["y"])
    return F.struct(F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"), F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))


def vertex_count(geom: Column) -> Column:
    return F.size(vertices(geom))


def is_null_island(geom: Column) -> Column:
    """Exactly one vertex, and it is (0, 0)."""
    coords = vertices(geom)
    first = F.get(coords, F.lit(0))
    return (F.size(coords) == 1) & (first["x"] == 0) & (first["y"] == 0)


def all_in_range(geom: Column) -> Column:
    """Every vertex finite with longitude in [-180, 180] and latitude in [-90, 90]."""
    return F.forall(vertices(geom), lambda c: is_finite(c) & c["x"].between(-180.0, 180.0) & c["y"].between(-90.0, 90.0))


def signed_area2(xs: Column, ys: Column) -> Column:
    """Twice the shoelace area of a ring given as integer arrays; positive is exterior with y down."""
    n = F.size(xs)
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0).cast("bigint"), lambda a, i: a + F.get(xs, i).cast("bigint") * F.get(ys, (i + 1) % n) - F.get(xs, (i + 1) % n).cast("bigint") * F.get(ys, i))


def map_vertices(geom: Column, change) -> Column:
    """Geometry with ``change`` applied to every vertex."""
    parts = F.transform(geom["parts"], lambda p: F.transform(p, lambda line: F.transform(line, change)))
    return F.struct(geom["kind"].alias("kind"), parts.alias("parts"))


def kind_summary(kind: Column) -> Column:
    """Aggregate: the one kind there is, else MIXED."""
    return F.when(F.count_distinct(kind) == 1, F.max(kind)).otherwise(F.lit("MIXED"))
