"""Assignment of features to tiles: an arithmetic range explode, never a scan of the grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tilemath

MAX_FANOUT = 65_536


def assign(features: DataFrame, min_zoom, max_zoom, extent: int = tilemath.EXTENT, buffer: int = tilemath.BUFFER, max_fanout: int = MAX_FANOUT) -> DataFrame:
    """A row for every tile ``z, x, y`` that a feature's world box meets with the buffer.

    ``features`` has ``wx0, wy0, wx1, wy1``; its other columns are carried.  A feature that would
    meet more than ``max_fanout`` tiles at a zoom is skipped at that zoom, before anything is exploded.
    """
    low, high = (F.lit(v) if isinstance(v, int) else v for v in (min_zoom, max_zoom))
    zoomed = features.withColumn("z", F.explode(F.sequence(low, high)))
    x0, x1 = tilemath.tile_range(F.col("wx0"), F.col("wx1"), F.col("z"), extent, buffer)
    y0, y1 = tilemath.tile_range(F.col("wy0"), F.col("wy1"), F.col("z"), extent, buffer)
    ranged = zoomed.withColumns({"_x0": x0, "_x1": x1, "_y0": y0, "_y1": y1})
    fits = (F.col("_x1") - F.col("_x0") + 1) * (F.col("_y1") - F.col("_y0") + 1) <= max_fanout
    columns = ranged.where(fits).withColumn("x", F.explode(F.sequence("_x0", "_x1")))
    return columns.withColumn("y", F.explode(F.sequence("_y0", "_y1"))).drop("_x0", "_x1", "_y0", "_y1")


def with_world_point(df: DataFrame, lon, lat) -> DataFrame:
    """Adds the world box of a point."""
    x, y = tilemath.world_x(lon), tilemath.world_y(lat)
    return df.withColumns({"wx0": x, "wy0": y, "wx1": x, "wy1": y})


def fanout(features: DataFrame, min_zoom: int, max_zoom: int) -> DataFrame:
    """Tiles of each feature and zoom by arithmetic alone."""
    zoomed = features.withColumn("z", F.explode(F.sequence(F.lit(min_zoom), F.lit(max_zoom))))
    x0, x1 = tilemath.tile_range(F.col("wx0"), F.col("wx1"), F.col("z"))
    y0, y1 = tilemath.tile_range(F.col("wy0"), F.col("wy1"), F.col("z"))
    return zoomed.withColumn("n_tiles", (x1 - x0 + 1) * (y1 - y0 + 1))
