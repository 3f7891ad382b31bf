"""SQL names for the operators that native expressions cannot form."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf, udtf

from ..sources import shapefile
from . import mvt, simplify

_LAYERS = "array<struct<name:string,version:int,extent:int,features:int,keys:array<string>,value_count:int>>"
_COORDS = "array<struct<x:double,y:double>>"


def _layers(data: pd.Series) -> pd.Series:
    def one(tile):
        if tile is None:
            return None
        return [{k: len(v) if k == "features" else v for k, v in layer.items()} for layer in mvt.decode(tile)]

    return data.map(one)


def _simplify(coords: pd.Series, epsilon: pd.Series) -> pd.Series:
    def one(line, tolerance):
        if line is None:
            return None
        kept = simplify.simplify_line(np.array([(c["x"], c["y"]) for c in line]).reshape(-1, 2), tolerance)
        return [{"x": x, "y": y} for x, y in kept.tolist()]

    return pd.Series([one(c, e) for c, e in zip(coords, epsilon, strict=True)])


class _ReadShapefile:
    """One row a feature of a zipped bundle: number, kind, parts and attributes as JSON."""

    def eval(self, content: bytes):
        for number, kind, parts, attributes in shapefile.read_bundle(content)[0]:
            yield number, kind, json.dumps(parts), json.dumps(attributes, ensure_ascii=False)


def register(spark: SparkSession) -> None:
    """Adds ``mvt_layers(binary)``, ``simplify_line(coords, epsilon)`` and the table function ``read_shapefile(binary)``."""
    spark.udf.register("mvt_layers", pandas_udf(_layers, _LAYERS))
    spark.udf.register("simplify_line", pandas_udf(_simplify, _COORDS))
    spark.udtf.register("read_shapefile", udtf(_ReadShapefile, returnType="number int, kind string, parts string, attributes string"))
