"""Validation, repair and cleaning of scanned features, and the summary of a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, properties

MAX_BYTES, MAX_FEATURES = 2 << 30, 1_000_000
ID_KEYS = ("parcelId", "assetId", "propertyId")


def payload_gate(files: DataFrame, limit: int = MAX_BYTES) -> DataFrame:
    return files.withColumn("error_code", F.when(F.octet_length("content") > limit, "PAYLOAD_TOO_LARGE"))


def normalize(features: DataFrame) -> DataFrame:
    """Repaired geometry and cleaned properties; rows beyond repair keep a null geometry."""
    return features.withColumns({"geom": geometry.repair(F.col("geom")), "props": properties.clean(F.col("props"))})


def summary(normalized: DataFrame, raw: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """One row: counts, warnings, box, kind and the error that refuses the dataset, if any."""
    geom = F.col("geom")
    box = geometry.bbox(geom)
    kept = F.when(geom.isNotNull(), F.lit(1))
    counts = normalized.agg(
        F.count("*").alias("parsed"), F.count(kept).alias("features"), F.count_if(geom.isNull()).alias("rejected"), F.count_if(geom.isNotNull() & geometry.is_null_island(geom)).alias("null_island"),
        F.min(box["min_x"]).alias("min_x"), F.min(box["min_y"]).alias("min_y"), F.max(box["max_x"]).alias("max_x"), F.max(box["max_y"]).alias("max_y"), geometry.kind_summary(geom["kind"]).alias("kind"),
    )
    markers = raw.select(F.explode(F.map_filter("props", lambda k, v: k.isin(*ID_KEYS))).alias("k", "v"))
    doubles = markers.groupBy("k", "v").agg((F.count("*") - 1).alias("d")).agg(F.coalesce(F.sum("d"), F.lit(0)).alias("duplicate_ids"))
    error = F.when(F.col("parsed") > max_features, "FILE_TOO_LARGE").when(F.col("parsed") == 0, "EMPTY_DATASET").when(F.col("features") == 0, "GEOMETRY_ERRORS")
    return counts.join(F.broadcast(doubles)).withColumn("error_code", error)  # two single rows
