"""GeoJSON source: documents to feature rows, in native expressions.

A FeatureCollection, a Feature or a bare geometry.  Any bad geometry fails its whole file: the
file's row carries ``error_code`` and no feature of it is returned by ``features``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry

_POINT = "array<double>"
_RAW = "map<string,string>"


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """``path, text`` of each file, whole."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def _coord(c: Column) -> Column:
    return F.struct(F.get(c, F.lit(0)).alias("x"), F.get(c, F.lit(1)).alias("y"))


def to_geometry(text: Column) -> Column:
    """Geometry of a GeoJSON geometry's text; null if it is not one of the six kinds or malformed."""
    kind = F.get_json_object(text, "$.type")
    raw = F.get_json_object(text, "$.coordinates")
    flat = lambda depth: F.from_json(raw, "array<" * depth + _POINT + ">" * depth)
    line = lambda points: F.transform(points, _coord)
    rings = lambda polygon: F.transform(polygon, line)
    parts = (
        F.when(kind == "Point", F.array(F.array(F.array(_coord(flat(0))))))
        .when(kind == "MultiPoint", F.array(F.array(line(flat(1)))))
        .when(kind == "LineString", F.array(F.array(line(flat(1)))))
        .when(kind == "MultiLineString", F.array(F.transform(flat(2), line)))
        .when(kind == "Polygon", F.when(F.size(flat(2)) > 0, F.array(rings(flat(2)))))
        .when(kind == "MultiPolygon", F.transform(flat(3), rings))
    )
    whole = F.forall(F.flatten(F.flatten(parts)), lambda c: c["x"].isNotNull() & c["y"].isNotNull())
    return F.when(parts.isNotNull() & whole, F.struct(kind.alias("kind"), parts.alias("parts")))


def json_values(raw: Column) -> Column:
    """Top-level members of a JSON object as JSON-encoded texts (quotes, 10 and 10.0 stay as they are)."""
    read = F.struct(F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>")).alias("keys"), F.from_json(raw, _RAW).alias("texts"), F.parse_json(raw).alias("document"))

    def values(r: Column) -> Column:
        keys, texts, document = r["keys"], r["texts"], r["document"]
        quoted = F.transform(keys, lambda k: F.when(F.schema_of_variant(F.variant_get(document, F.concat(F.lit("$['"), k, F.lit("']")), "variant")) == "STRING", F.to_json(F.struct(texts[k].alias("v")))).otherwise(F.coalesce(texts[k], F.lit("null"))))
        return F.map_from_arrays(keys, F.transform(quoted, lambda v: F.when(v.startswith('{"v":'), F.regexp_extract(v, r'(?s)^\{"v":(.*)\}$', 1)).otherwise(v)))

    return F.get(F.transform(F.array(read), values), F.lit(0))  # read once, not once a key


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with ``value``, which no filter above repeats: pushed through projections, they multiply it in the plan."""
    return rows.select(*[c for c in rows.columns if c != name], F.explode(F.array(value)).alias(name))


def scan(texts: DataFrame) -> DataFrame:
    """``path, ord, id, geom, props, error_code`` of every feature with a geometry, from ``path, text``.

    Features without a geometry are skipped.  A row with an error code stands for a bad geometry.
    """
    kind = F.get_json_object("text", "$.type")
    collection = F.from_json(F.get_json_object("text", "$.features"), "array<string>")
    features = F.when(kind == "FeatureCollection", F.coalesce(collection, F.array().cast("array<string>"))).when(kind == "Feature", F.array(F.col("text"))).when(kind.isin(*geometry.KINDS), F.array(F.to_json(F.struct(F.lit("Feature").alias("type"), F.parse_json("text").alias("geometry")))))
    listed = _once(_once(texts.select("path", "text"), "text", F.col("text")), "_f", features)
    each = listed.select("path", F.col("_f").isNull().alias("_bad"), F.posexplode(F.coalesce("_f", F.array(F.lit(None).cast("string")))).alias("ord", "_f"))
    raw = each.select("path", "ord", "_bad", F.get_json_object("_f", "$.id").alias("_id"), F.get_json_object("_f", "$.geometry").alias("_g"), F.get_json_object("_f", "$.properties").alias("_p"), F.col("_f")).where("_bad or _g is not null")
    number = F.schema_of_variant(F.variant_get(F.parse_json("_f"), "$.id", "variant")) != "STRING"
    identity = F.when(F.col("_id").rlike("^[0-9]{1,20}$") & number, F.expr("try_cast(_id as decimal(20,0))"))
    props = F.when(~F.col("_bad"), F.coalesce(json_values(F.col("_p")), F.create_map().cast("map<string,string>")))
    read = _once(raw, "geom", to_geometry(F.col("_g"))).select("path", "ord", identity.alias("id"), "geom", props.alias("props"))
    return read.withColumn("error_code", F.when(F.col("geom").isNull() | ~geometry.all_in_range(F.col("geom")), F.lit("INVALID_GEOJSON")))


def features(scanned: DataFrame) -> DataFrame:
    """Features of the files without an error."""
    failed = scanned.where("error_code is not null").select("path").distinct()
    return scanned.join(failed, "path", "left_anti").drop("error_code")


def write_collection(features_: DataFrame, path: str) -> None:
    """One FeatureCollection with its box at ``path``: executors write the features, the driver the frame around them.

    Features are lines of part files in order of ``ord``; the first part opens the collection and the last closes it.
    """
    box = features_.select(geometry.bbox(F.col("geom")).alias("b")).agg(F.min("b.min_x"), F.min("b.min_y"), F.max("b.max_x"), F.max("b.max_y")).first()
    frame = '{"type":"FeatureCollection","bbox":' + ("null" if box[0] is None else "[" + ",".join(repr(float(v)) for v in box) + "]") + ',"features":['
    spark, text = features_.sparkSession, write_text(features_)
    last = text.agg(F.max("ord")).first()[0]
    lines = text.select("ord", F.concat("value", F.when(F.col("ord") != last, F.lit(",")).otherwise(F.lit(""))).alias("value"))
    ends = spark.createDataFrame([(-(1 << 62), frame), (1 << 62, "]}")], "ord long, value string")
    lines.select(F.col("ord").cast("long"), "value").unionByName(ends).orderBy("ord").select("value").write.mode("overwrite").text(path)


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """``path, text`` of what ``write_collection`` wrote, the parts put together again."""
    parts = spark.read.text(path).select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"), "value")
    return parts.agg(F.array_sort(F.collect_list(F.struct("f", "i", "value"))).alias("v")).select(F.lit(path).alias("path"), F.array_join(F.transform("v", lambda x: x["value"]), "\n").alias("text"))


def write_text(features_: DataFrame) -> DataFrame:
    """``ord, value``: each feature as one GeoJSON text (properties are JSON texts already)."""
    pair = lambda c: F.array(c["x"], c["y"])
    kind, parts = F.col("geom.kind"), F.col("geom.parts")
    flat, first = F.flatten(F.flatten(parts)), F.get(parts, F.lit(0))
    nested = F.transform(parts, lambda p: F.transform(p, lambda r: F.transform(r, pair)))
    one = F.transform(first, lambda r: F.transform(r, pair))
    text = (
        F.when(kind == "Point", F.to_json(pair(F.get(flat, F.lit(0)))))
        .when(kind.isin("MultiPoint", "LineString"), F.to_json(F.transform(flat, pair)))
        .when(kind.isin("MultiLineString", "Polygon"), F.to_json(one))
        .otherwise(F.to_json(nested))
    )
    members = F.array_join(F.transform(F.array_sort(F.map_entries("props")), lambda e: F.concat(F.regexp_extract(F.to_json(F.struct(e["key"].alias("v"))), r'(?s)^\{"v":(.*)\}$', 1), F.lit(":"), e["value"])), ",")
    identity = F.coalesce(F.concat(F.lit('"id":'), F.col("id").cast("string"), F.lit(",")), F.lit(""))
    value = F.concat(F.lit('{"type":"Feature",'), identity, F.lit('"geometry":{"type":"'), kind, F.lit('","coordinates":'), text, F.lit('},"properties":{'), members, F.lit("}}"))
    return features_.select("ord", value.alias("value"))
