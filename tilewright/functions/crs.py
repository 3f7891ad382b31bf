"""Coordinate reference systems: detection from WKT, policy and reprojection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import geometry, tilemath


def epsg_code(wkt: Column) -> Column:
    """Code of the last EPSG authority in the WKT, which names the root system."""
    codes = F.regexp_extract_all(wkt, F.lit(r'(?i)AUTHORITY[^"]*"\s*EPSG\s*"[^"]*"\s*([0-9]+)\s*"'), F.lit(1))
    return F.when(F.size(codes) > 0, F.element_at(codes, -1).cast("bigint"))


def detect(wkt: Column) -> Column:
    """WGS84, NAD83, WEB_MERCATOR, UNSUPPORTED, or UNKNOWN without WKT."""
    code, upper = epsg_code(wkt), F.upper(wkt)
    by_code = F.when(code == 4326, "WGS84").when(code == 4269, "NAD83").when(code.isin(3857, 900913, 102100), "WEB_MERCATOR").otherwise("UNSUPPORTED")
    by_name = (
        F.when(upper.contains("GCS_WGS_1984") | (upper.contains("WGS_1984") & upper.contains("GEOGCS")), "WGS84")
        .when(upper.contains("GCS_NORTH_AMERICAN_1983") | upper.contains("NAD83"), "NAD83")
        .when(upper.contains("WEB_MERCATOR") | upper.contains("MERCATOR_AUXILIARY_SPHERE"), "WEB_MERCATOR")
        .otherwise("UNSUPPORTED")
    )
    return F.when(wkt.isNull(), "UNKNOWN").when(code.isNotNull(), by_code).otherwise(by_name)


def resolve(kind: Column, assume_wgs84: bool) -> Column:
    """struct<crs, assumed, error_code> under the policy for unknown systems."""
    unknown = kind == "UNKNOWN"
    error = F.when(kind == "UNSUPPORTED", "UNSUPPORTED_CRS")
    if not assume_wgs84:
        error = error.when(unknown, "UNKNOWN_CRS")
    assumed = unknown & F.lit(assume_wgs84)
    return F.struct(F.when(assumed, "WGS84").otherwise(kind).alias("crs"), assumed.alias("assumed"), error.alias("error_code"))


def to_wgs84(geom: Column, crs: Column) -> Column:
    mercator = geometry.map_vertices(geom, lambda c: F.struct(tilemath.mercator_to_lon(c["x"]).alias("x"), tilemath.mercator_to_lat(c["y"]).alias("y")))
    return F.when(crs == "WEB_MERCATOR", mercator).when(crs.isin("WGS84", "NAD83"), geom)
