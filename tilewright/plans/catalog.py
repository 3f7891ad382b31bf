"""Registered queries of the geospatial and operations planes, with the SQL that checks them.

The driver's tables hold no geometry; integer arithmetic on their keys gives the same points in
every engine.  Transcendental doubles are never returned raw: tile numbers, quantized integers and
rounded values are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry, properties, tilemath
from ..operators import assign, ingest, jobs, metrics, publish, tiles
from ..sources import geojson

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(sql: str | None = None):
    def add(query):
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLE_SQL[query.__name__] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def longitude(key: Column) -> Column:
    return F.lit(-180.0) + ((key * 7919) % 36000) / F.lit(100.0)


def latitude(key: Column) -> Column:
    return F.lit(-80.0) + ((key * 104729) % 16000) / F.lit(100.0)


def points(df: DataFrame, key: str) -> DataFrame:
    return assign.with_world_point(df, longitude(F.col(key)), latitude(F.col(key)))


# The same geometry in SQL; {k} is the key, {side} an edge in degrees.
_LON, _LAT = "(-180.0::DOUBLE + (({k} * 7919) % 36000) / 100.0::DOUBLE)", "(-80.0::DOUBLE + (({k} * 104729) % 16000) / 100.0::DOUBLE)"
_WX = "greatest(0.0::DOUBLE, least(1.0::DOUBLE, ({lon} + 180.0::DOUBLE) / 360.0::DOUBLE))"
_WY = "greatest(0.0::DOUBLE, least(1.0::DOUBLE, (1.0::DOUBLE - ln(tan(radians({lat})) + 1.0::DOUBLE / cos(radians({lat}))) / pi()) / 2.0::DOUBLE))"


def _world(key: str) -> tuple[str, str]:
    lon, lat = _LON.format(k=key), _LAT.format(k=key)
    return _WX.format(lon=lon), _WY.format(lat=lat)


def _first(w: str) -> str:
    return f"greatest(0, least(pow(2, z) - 1, floor({w} * pow(2, z) - 0.0625)))::BIGINT"


def _last(w: str) -> str:
    return f"greatest(0, least(pow(2, z) - 1, floor({w} * pow(2, z) + 0.0625)))::BIGINT"


def _assigned(source: str, key: str, low: int, high: int) -> str:
    wx, wy = _world(key)
    return f"""
p AS (SELECT {key} AS id, {wx} AS wx, {wy} AS wy FROM {source}),
zs AS (SELECT p.*, z FROM p, unnest(generate_series({low}, {high})) AS t(z)),
r AS (SELECT *, {_first('wx')} AS x0, {_last('wx')} AS x1, {_first('wy')} AS y0, {_last('wy')} AS y1 FROM zs),
a AS (SELECT id, z, x, y FROM r, unnest(generate_series(x0, x1)) AS u(x), unnest(generate_series(y0, y1)) AS v(y))"""


@register(f"WITH {_assigned('customer', 'c_custkey', 0, 8)} SELECT z::INTEGER AS z, count(*) AS instances, count(DISTINCT (x, y)) AS tiles FROM a GROUP BY z")
def tile_count_by_zoom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: instances and tiles by zoom.  Counting tiles first keeps the shuffle to one row a tile and task."""
    placed = assign.assign(points(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey"), 0, 8)
    by_tile = placed.groupBy("z", "x", "y").agg(F.count("*").alias("n"))
    return by_tile.groupBy("z").agg(F.sum("n").alias("instances"), F.count("*").alias("tiles"))


@register(f"WITH {_assigned('supplier', 's_suppkey', 0, 6)} SELECT id AS s_suppkey, z::INTEGER AS z, x, y FROM a")
def feature_tile_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign.assign(points(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey"), 0, 6).select("s_suppkey", "z", "x", "y")


@register(f"WITH {_assigned('customer', 'c_custkey', 6, 6)} SELECT x, y, count(*) AS n FROM a GROUP BY x, y ORDER BY n DESC, x, y LIMIT 20")
def tile_density_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign.assign(points(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey"), 6, 6)
    return placed.groupBy("x", "y").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "x", "y").limit(20)


@register(f"""WITH {_assigned('customer', 'c_custkey', 10, 10)}, q AS (
SELECT id AS c_custkey, a.x, a.y, round((p.wx * 1024 - a.x) * 4096)::BIGINT AS px, round((p.wy * 1024 - a.y) * 4096)::BIGINT AS py FROM a JOIN p USING (id))
SELECT * FROM q WHERE px BETWEEN -256 AND 4352 AND py BETWEEN -256 AND 4352""")
def quantized_xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign.assign(points(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey"), 10, 10)
    px, py = (tilemath.tile_units(F.col(w), F.col("z"), F.col(t)) for w, t in (("wx0", "x"), ("wy0", "y")))
    local = placed.select("c_custkey", "x", "y", px.alias("px"), py.alias("py"))
    return local.where(tilemath.in_tile(F.col("px")) & tilemath.in_tile(F.col("py")))


@register(f"SELECT c_mktsegment, min({_LON.format(k='c_custkey')}) AS min_lon, min({_LAT.format(k='c_custkey')}) AS min_lat, max({_LON.format(k='c_custkey')}) AS max_lon, max({_LAT.format(k='c_custkey')}) AS max_lat FROM customer GROUP BY 1")
def bbox_union_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.min(longitude(key)).alias("min_lon"), F.min(latitude(key)).alias("min_lat"), F.max(longitude(key)).alias("max_lon"), F.max(latitude(key)).alias("max_lat"))


@register("""SELECT p_brand, CASE WHEN count(DISTINCT kind) = 1 THEN max(kind) ELSE 'MIXED' END AS kind, count(DISTINCT kind) AS kinds FROM (
SELECT p_brand, CASE p_size % 6 WHEN 0 THEN 'Point' WHEN 1 THEN 'MultiPoint' WHEN 2 THEN 'LineString' WHEN 3 THEN 'MultiLineString' WHEN 4 THEN 'Polygon' ELSE 'MultiPolygon' END AS kind FROM part) GROUP BY 1""")
def geometry_kind_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(*[F.lit(k) for k in geometry.KINDS]), (F.col("p_size") % 6 + 1).cast("int"))
    kinds = table(spark, sf_dir, "part").select("p_brand", kind.alias("kind"))
    return kinds.groupBy("p_brand").agg(geometry.kind_summary(F.col("kind")).alias("kind"), F.count_distinct("kind").alias("kinds"))


@register(f"""WITH m AS (SELECT s_suppkey, radians({_LON.format(k='s_suppkey')}) * 6378137.0 AS mx, ln(tan(pi() / 4 + radians({_LAT.format(k='s_suppkey')}) / 2)) * 6378137.0 AS my FROM supplier)
SELECT s_suppkey, round(degrees(mx / 6378137.0), 6) AS lon, round(degrees(2 * atan(exp(my / 6378137.0)) - pi() / 2), 6) AS lat FROM m""")
def webmercator_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    projected = table(spark, sf_dir, "supplier").select(key, tilemath.lon_to_mercator(longitude(key)).alias("mx"), tilemath.lat_to_mercator(latitude(key)).alias("my"))
    return projected.select("s_suppkey", F.round(tilemath.mercator_to_lon(F.col("mx")), 6).alias("lon"), F.round(tilemath.mercator_to_lat(F.col("my")), 6).alias("lat"))


def _squares(spark: SparkSession, sf_dir: str, factor: float) -> DataFrame:
    """World boxes of squares north-east of each part's point, sides p_size * factor degrees."""
    key, side = F.col("p_partkey"), F.col("p_size") * factor
    lon, lat = longitude(key), latitude(key)
    boxed = table(spark, sf_dir, "part").select(key, "p_size", tilemath.world_x(lon).alias("wx0"), tilemath.world_y(lat + side).alias("wy0"), tilemath.world_x(lon + side).alias("wx1"), tilemath.world_y(lat).alias("wy1"))
    return boxed


def _square_sql(factor: str, low: int, high: int) -> str:
    lon, lat = _LON.format(k="p_partkey"), _LAT.format(k="p_partkey")
    top = f"greatest(-85.05112901783463::DOUBLE, least(85.05112901783463::DOUBLE, {lat} + p_size * {factor}))"
    return f"""WITH b AS (SELECT p_partkey, p_size, {_WX.format(lon=lon)} AS wx0, {_WY.format(lat=top)} AS wy0, {_WX.format(lon=f'({lon} + p_size * {factor})')} AS wx1, {_WY.format(lat=lat)} AS wy1 FROM part),
zs AS (SELECT b.*, z FROM b, unnest(generate_series({low}, {high})) AS t(z)),
r AS (SELECT p_partkey, z::INTEGER AS z, {_first('wx0')} AS x0, {_last('wx1')} AS x1, {_first('wy0')} AS y0, {_last('wy1')} AS y1 FROM zs)"""


@register(_square_sql("0.01::DOUBLE", 8, 12) + " SELECT p_partkey, z, (x1 - x0 + 1) * (y1 - y0 + 1) AS n_tiles FROM r")
def polygon_tile_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign.fanout(_squares(spark, sf_dir, 0.01), 8, 12).select("p_partkey", "z", "n_tiles")


@register(_square_sql("1.0::DOUBLE", 8, 14) + " SELECT z, count(*) AS features, count_if((x1 - x0 + 1) * (y1 - y0 + 1) > 65536) AS skipped, coalesce(sum(CASE WHEN (x1 - x0 + 1) * (y1 - y0 + 1) <= 65536 THEN (x1 - x0 + 1) * (y1 - y0 + 1) END), 0)::BIGINT AS instances FROM r GROUP BY z")
def fanout_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = F.col("n_tiles") > assign.MAX_FANOUT
    return assign.fanout(_squares(spark, sf_dir, 1.0), 8, 14).groupBy("z").agg(F.count("*").alias("features"), F.count_if(wide).alias("skipped"), F.coalesce(F.sum(F.when(~wide, F.col("n_tiles"))), F.lit(0)).alias("instances"))


@register("SELECT p_partkey, (2 * CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE -1 END * p_size::BIGINT * p_size)::BIGINT AS area2, p_partkey % 2 = 0 AS is_exterior FROM part")
def ring_signed_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares on the tile grid, every other one wound the other way."""
    a, b = (F.col("p_partkey") % 4096).cast("bigint"), F.col("p_size").cast("bigint")
    xs, ys = F.array(a, a + b, a + b, a), F.array(a, a, a + b, a + b)
    even = F.col("p_partkey") % 2 == 0
    area = F.when(even, geometry.signed_area2(xs, ys)).otherwise(geometry.signed_area2(F.reverse(xs), F.reverse(ys)))
    return table(spark, sf_dir, "part").select("p_partkey", area.alias("area2"), (area > 0).alias("is_exterior"))


@register("""SELECT o_custkey, o_orderkey, CASE WHEN d >= 0 THEN 2 * d ELSE -2 * d - 1 END AS code FROM (
SELECT o_custkey, o_orderkey, o_orderkey % 4096 - coalesce(lag(o_orderkey % 4096) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 0) AS d FROM orders)""")
def zigzag_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    unit = F.col("o_orderkey") % 4096
    moved = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (unit - F.coalesce(F.lag(unit).over(path), F.lit(0))).alias("d"))
    return moved.select("o_custkey", "o_orderkey", tilemath.zigzag(F.col("d")).alias("code"))


@register("""SELECT o_custkey, count(*) AS n, count_if(prev IS NULL OR prev <> o_orderpriority) AS kept FROM (
SELECT o_custkey, o_orderpriority, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev FROM orders) GROUP BY 1""")
def consecutive_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey", "o_orderpriority"))).alias("v"))
    values = ordered.select("o_custkey", F.transform("v", lambda x: x["o_orderpriority"]).alias("v"))
    return values.select("o_custkey", F.size("v").cast("bigint").alias("n"), F.size(geometry.dedup_consecutive(F.col("v"))).cast("bigint").alias("kept"))


@register("SELECT count(*) AS features, count_if(c_custkey % 97 = 0) AS null_island, count_if(c_custkey % 97 <> 0) AS elsewhere FROM customer")
def null_island_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.col("c_custkey") % 97 == 0
    at = F.struct(F.when(zero, 0.0).otherwise(longitude(F.col("c_custkey"))).alias("x"), F.when(zero, 0.0).otherwise(latitude(F.col("c_custkey")) + 0.001).alias("y"))
    geom = F.struct(F.lit("Point").alias("kind"), F.array(F.array(F.array(at))).alias("parts"))
    found = table(spark, sf_dir, "customer").select(geom.alias("geom")).select(geometry.is_null_island(F.col("geom")).alias("n"))
    return found.agg(F.count("*").alias("features"), F.count_if("n").alias("null_island"), F.count_if(~F.col("n")).alias("elsewhere"))


@register("""SELECT sum(n - d)::BIGINT AS duplicates FROM (SELECT k, count(*) AS n, count(DISTINCT v) AS d FROM (
SELECT 'parcelId' AS k, left(c_name, 16) AS v FROM customer UNION ALL SELECT 'assetId', (c_custkey % 500)::VARCHAR FROM customer) GROUP BY k)""")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.create_map(F.lit("parcelId"), F.left("c_name", F.lit(16)), F.lit("assetId"), (F.col("c_custkey") % 500).cast("string"))
    markers = table(spark, sf_dir, "customer").select(F.explode(props).alias("k", "v"))
    return markers.groupBy("k").agg((F.count("*") - F.count_distinct("v")).alias("d")).agg(F.sum("d").alias("duplicates"))


@register("""WITH kv AS (SELECT p_partkey, k, v FROM part, LATERAL (VALUES ('brand', p_brand), ('name', p_name), ('price', p_retailprice::VARCHAR), ('size', p_size::VARCHAR), ('type', repeat(p_type, 1 + (p_size % 40)::INTEGER))) AS t(k, v)),
s AS (SELECT *, sum(strlen(k) + strlen(v)) OVER (PARTITION BY p_partkey ORDER BY k ROWS UNBOUNDED PRECEDING) AS total, row_number() OVER (PARTITION BY p_partkey ORDER BY k) AS rn FROM kv WHERE k <> 'price')
SELECT p_partkey, count_if(total <= 256 AND rn <= 32) AS kept, coalesce(max(CASE WHEN total <= 256 AND rn <= 32 THEN total END), 0)::BIGINT AS bytes FROM s GROUP BY 1""")
def property_budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.create_map(F.lit("name"), F.col("p_name"), F.lit("brand"), F.col("p_brand"), F.lit("type"), F.expr("repeat(p_type, 1 + p_size % 40)"), F.lit("size"), F.col("p_size").cast("string"))
    cleaned = table(spark, sf_dir, "part").select("p_partkey", properties.clean(props, max_bytes=256).alias("m"))
    used = F.aggregate(F.map_entries("m"), F.lit(0), lambda a, e: a + F.octet_length(e["key"]) + F.octet_length(e["value"]))
    return cleaned.select("p_partkey", F.size("m").cast("bigint").alias("kept"), used.cast("bigint").alias("bytes"))


@register("""SELECT k, count(*) AS n FROM (SELECT unnest(['c_name', 'Email', 'OWNER_NAME', 'c_mktsegment', 'phone', 'Ssn', 'market']) AS k FROM customer)
WHERE lower(k) NOT IN ('owner_name', 'ownername', 'owner', 'owner_first', 'owner_last', 'mailing_address', 'email', 'phone', 'ssn', 'tax_id') GROUP BY k""")
def pii_denylist(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("c_name", "Email", "OWNER_NAME", "c_mktsegment", "phone", "Ssn", "market")
    keys = table(spark, sf_dir, "customer").select(F.explode(F.array(*[F.lit(n) for n in names])).alias("k"))
    return keys.where(properties.allowed(F.col("k"))).groupBy("k").agg(F.count("*").alias("n"))


@register("SELECT z::INTEGER AS z, round(CASE WHEN z >= 14 THEN 0.0 ELSE 360.0::DOUBLE / (pow(2, z) * 4096) * 0.5 END, 12) AS epsilon FROM unnest(generate_series(0, 20)) AS t(z)")
def epsilon_by_zoom(spark: SparkSession, sf_dir: str) -> DataFrame:
    zooms = spark.range(21).select(F.col("id").cast("int").alias("z"))
    return zooms.select("z", F.round(tilemath.epsilon(F.col("z")), 12).alias("epsilon"))


_CATEGORY = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'PARCEL' WHEN 'BUILDING' THEN 'ZONING' WHEN 'FURNITURE' THEN 'FLOOD_RISK' WHEN 'MACHINERY' THEN 'MACRO' ELSE 'OTHER' END"


@register(f"""SELECT category, min_zoom, max_zoom, layer, count(*) AS n FROM (SELECT category,
CASE category WHEN 'PARCEL' THEN 10 WHEN 'ZONING' THEN 8 WHEN 'FLOOD_RISK' THEN 6 ELSE 0 END AS min_zoom,
CASE category WHEN 'PARCEL' THEN 16 WHEN 'ZONING' THEN 16 WHEN 'FLOOD_RISK' THEN 14 WHEN 'MACRO' THEN 8 ELSE 16 END AS max_zoom,
CASE category WHEN 'PARCEL' THEN 'parcel_boundary' WHEN 'ZONING' THEN 'zoning_district' WHEN 'FLOOD_RISK' THEN 'flood_100yr' WHEN 'MACRO' THEN 'macro_region' ELSE 'base_features' END AS layer
FROM (SELECT {_CATEGORY} AS category FROM customer)) GROUP BY ALL""")
def category_zoom_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = F.expr(_CATEGORY)
    known = table(spark, sf_dir, "customer").select(category.alias("category"))
    zooms = known.select("category", properties.zoom_range(F.col("category")).alias("r"), properties.layer_name(F.col("category"), F.lit("base")).alias("layer"))
    return zooms.groupBy("category", F.col("r.min_zoom").alias("min_zoom"), F.col("r.max_zoom").alias("max_zoom"), "layer").agg(F.count("*").alias("n"))


_STATUS = "CASE (o_orderkey % 9)::INTEGER WHEN 0 THEN 'UPLOAD_PENDING' WHEN 1 THEN 'QUEUED' WHEN 2 THEN 'VALIDATING' WHEN 3 THEN 'NORMALIZING' WHEN 4 THEN 'TILING' WHEN 5 THEN 'PUBLISHING' WHEN 6 THEN 'COMPLETED' WHEN 7 THEN 'FAILED' ELSE 'CANCELLED' END"
_STATUSES = ("UPLOAD_PENDING", "QUEUED", "VALIDATING", "NORMALIZING", "TILING", "PUBLISHING", "COMPLETED", "FAILED", "CANCELLED")


def _status(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in _STATUSES]), (key % 9 + 1).cast("int"))


@register(f"SELECT CASE WHEN s IN ('VALIDATING', 'NORMALIZING', 'TILING', 'PUBLISHING') THEN 'active' ELSE lower(s) END AS bucket, count(*) AS n FROM (SELECT {_STATUS} AS s FROM orders) GROUP BY 1")
def job_state_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.job_states(table(spark, sf_dir, "orders").select(_status(F.col("o_orderkey")).alias("status")))


_EVENT_STATUS = _STATUS.replace("o_orderkey", "event_id")


@register(f"""SELECT s AS status, prev AS previous, count(*) AS n, prev || '>' || s IN ({', '.join(f"'{a}>{b}'" for a, b in jobs.EDGES)}) AS legal FROM (
SELECT s, lag(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM (SELECT *, {_EVENT_STATUS} AS s FROM events)) WHERE prev IS NOT NULL GROUP BY ALL""")
def state_transition_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", _status(F.col("event_id")).alias("status"))
    previous = F.lag("status").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    moves = steps.select("status", previous.alias("previous")).where("previous is not null")
    return moves.groupBy("status", "previous").agg(F.count("*").alias("n")).withColumn("legal", jobs.can_move(F.col("previous"), F.col("status")))


_PRINT = "'sha256:' || sha256(concat_ws(chr(0), 'event', user_id::VARCHAR, event_type, coalesce(props, '')))"


@register(f"SELECT fp, event_id FROM (SELECT {_PRINT} AS fp, event_id, row_number() OVER (PARTITION BY {_PRINT} ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def event_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = table(spark, sf_dir, "events").select("event_id", "ts", properties.fingerprint("event", F.col("user_id"), F.col("event_type"), F.col("props")).alias("fp"))
    return jobs.first_events(marked, "fp", "ts", "event_id").select("fp", "event_id")


@register("SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)")
def orphan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return jobs.orphans(table(spark, sf_dir, "events").select("event_id", "user_id"), known, "user_id")


@register(f"""SELECT decision, count(*) AS n FROM (SELECT CASE WHEN s IS NULL THEN 'ORPHAN' WHEN seen THEN 'DUPLICATE' WHEN s = 'UPLOAD_PENDING' THEN 'START_RUN'
WHEN s IN ('QUEUED', 'VALIDATING', 'NORMALIZING', 'TILING', 'PUBLISHING') THEN 'DUPLICATE' ELSE 'TERMINAL_ACK' END AS decision FROM (
SELECT {_STATUS} AS s, row_number() OVER (PARTITION BY {_PRINT} ORDER BY ts, event_id) > 1 AS seen FROM events LEFT JOIN orders ON o_orderkey = user_id)) GROUP BY 1""".replace("CASE (o_orderkey % 9)", "CASE WHEN o_orderkey IS NULL THEN NULL ELSE CASE (o_orderkey % 9)").replace("ELSE 'CANCELLED' END", "ELSE 'CANCELLED' END END"))
def ingest_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("fp", properties.fingerprint("event", F.col("user_id"), F.col("event_type"), F.col("props")))
    ranked = events.withColumn("seen", F.row_number().over(Window.partitionBy("fp").orderBy("ts", "event_id")) > 1)
    known = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("user_id"), _status(F.col("o_orderkey")).alias("status"))
    joined = ranked.join(known, "user_id", "left")
    return joined.groupBy(jobs.ingest_decision(F.col("status"), F.col("seen")).alias("decision")).agg(F.count("*").alias("n"))


_CODES = ("S3_THROTTLED", "INVALID_GEOJSON", "UNKNOWN_CRS", "PIPELINE_ERROR", "STORE_ERROR", "GEOMETRY_ERRORS", "LEASE_CONFLICT")
_CODE = "CASE (event_id % 7)::INTEGER " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CODES)) + " END"
_CLASS = f"CASE WHEN code IN ({', '.join(map(repr, properties.TRANSIENT))}) THEN 'TRANSIENT' WHEN code IN ({', '.join(map(repr, properties.PERMANENT))}) THEN 'PERMANENT_VALIDATION' ELSE 'MANUAL_REVIEW' END"
_ELIGIBLE = f"(code IN ({', '.join(map(repr, properties.TRANSIENT))}) OR code = 'UNKNOWN_CRS')"


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.array(*[F.lit(c) for c in _CODES]), (F.col("event_id") % 7 + 1).cast("int"))
    return table(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", "ts", F.col("user_id").alias("job_id"), code.alias("error_code"))


@register(f"SELECT class AS error_class, eligible, count(*) AS n FROM (SELECT {_CLASS} AS class, {_ELIGIBLE} AS eligible FROM (SELECT {_CODE} AS code FROM events WHERE event_type = 'error')) GROUP BY ALL")
def error_class_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("error_code")
    return _failures(spark, sf_dir).groupBy(properties.error_class(code).alias("error_class"), properties.replay_eligible(code).alias("eligible")).agg(F.count("*").alias("n"))


@register(f"""SELECT job_id, error_code, error_class, event_id FROM (SELECT user_id AS job_id, code AS error_code, {_CLASS} AS error_class, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
FROM (SELECT *, {_CODE} AS code FROM events WHERE event_type = 'error') WHERE code <> 'LEASE_CONFLICT') WHERE r = 1""")
def dlq_latest_per_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.dead_letters(_failures(spark, sf_dir), "ts", "event_id").select("job_id", "error_code", properties.error_class(F.col("error_code")).alias("error_class"), "event_id")


@register(f"""SELECT decision, count(*) AS n FROM (SELECT CASE WHEN s = 'COMPLETED' AND NOT nv THEN 'NO_OP' WHEN s = 'CANCELLED' THEN 'NOT_ALLOWED' WHEN s NOT IN ('COMPLETED', 'FAILED', 'CANCELLED') THEN 'ALREADY_ACTIVE'
WHEN s = 'FAILED' AND NOT {_ELIGIBLE} THEN 'NOT_ALLOWED' WHEN replays >= 3 THEN 'LIMIT_REACHED' ELSE 'REPLAY' END AS decision
FROM (SELECT {_STATUS} AS s, {_CODE.replace('event_id', 'o_custkey')} AS code, o_orderkey % 5 AS replays, o_custkey % 2 = 0 AS nv FROM orders)) GROUP BY 1""")
def replay_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.array(*[F.lit(c) for c in _CODES]), (F.col("o_custkey") % 7 + 1).cast("int"))
    asked = table(spark, sf_dir, "orders").select(_status(F.col("o_orderkey")).alias("status"), code.alias("code"), (F.col("o_orderkey") % 5).alias("replays"), (F.col("o_custkey") % 2 == 0).alias("new_version"))
    return asked.groupBy(jobs.replay_decision(F.col("status"), F.col("code"), F.col("replays"), F.col("new_version")).alias("decision")).agg(F.count("*").alias("n"))


@register("SELECT 'events{kind=' || event_type || ',shard=' || (user_id % 4)::VARCHAR || '}' AS series, count(*) AS total FROM events GROUP BY 1")
def metric_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = F.create_map(F.lit("shard"), (F.col("user_id") % 4).cast("string"), F.lit("kind"), F.col("event_type"))
    return metrics.series(table(spark, sf_dir, "events").select(F.lit("events").alias("name"), dims.alias("dims"), F.lit(1).cast("bigint").alias("value")))


@register("""WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS k FROM events WHERE value IS NOT NULL),
l AS (SELECT event_type, list_sort(list(value)) AS v FROM r WHERE k <= 4096 GROUP BY 1),
w AS (SELECT event_type, count(value) AS "count", min(value) AS "min", max(value) AS "max" FROM events GROUP BY 1)
SELECT w.*, v[round(0.5 * (len(v) - 1))::INTEGER + 1] AS p50, v[round(0.95 * (len(v) - 1))::INTEGER + 1] AS p95 FROM w LEFT JOIN l USING (event_type)""")
def histogram_nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.histogram(table(spark, sf_dir, "events").select("event_type", "value", "event_id"), "event_type", "value", "event_id").select("event_type", "count", "min", "max", "p50", "p95")


@register("""SELECT rule, severity, current_value, threshold, coalesce(current_value > threshold, false) AS triggered FROM (VALUES
('Tile5xxRateHigh', 'P1', (SELECT count_if(event_type = 'error') / count(*) FROM events), 0.01::DOUBLE), ('OriginFailureRateHigh', 'P1', NULL, 0.01), ('DlqMessageReceived', 'P2', (SELECT count_if(event_type = 'error')::DOUBLE FROM events), 0.0),
('JobFailureRateHigh', 'P2', (SELECT count_if(event_type = 'error') / count_if(event_type IN ('error', 'purchase')) FROM events), 0.05), ('NoCompletedJobsWithBacklog', 'P2', NULL, 0.0), ('JobDurationHigh', 'P3', NULL, 600.0), ('TileSizeP95High', 'P3', NULL, 512000.0),
('ReplayFailureRateHigh', 'P2', NULL, 0.2), ('TenantAuthorizationFailureSpike', 'P2', NULL, 0.0), ('LayerStalenessHigh', 'P2', NULL, 604800.0), ('RollbackOccurred', 'P2', NULL, 0.0), ('CrossTenantDenialSpike', 'P2', NULL, 5.0), ('PrivilegedAccessOccurred', 'P2', NULL, 0.0)) AS t(rule, severity, current_value, threshold)""")
def alert_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert rules over counters made of the events."""
    kind = F.col("event_type")
    names = F.array_compact(F.array(F.lit("tile_requests"), F.when(kind == "error", "tile_5xx"), F.when(kind == "error", "dlq_message_count"), F.when(kind == "error", "ingest_jobs_failed"), F.when(kind == "purchase", "ingest_jobs_completed")))
    counters = table(spark, sf_dir, "events").select(F.explode(names).alias("series"), F.lit(1.0).alias("value"))
    return metrics.alerts(spark, metrics.resolve(counters))


@register("SELECT event_id, user_id, event_type FROM events WHERE event_type = 'signup' ORDER BY event_id DESC LIMIT 200")
def audit_query_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = table(spark, sf_dir, "events").withColumn("append_seq", F.col("event_id"))
    return jobs.audit_query(audit, F.col("event_type") == "signup").select("event_id", "user_id", "event_type")


@register("SELECT n_nationkey AS layer_id, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE contains(lower(n_name), 'eur') OR contains(lower(r_name), 'eur') ORDER BY 1")
def catalog_filter_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    layers = table(spark, sf_dir, "nation").join(regions, "n_regionkey").select(F.col("n_nationkey").alias("layer_id"), F.col("n_name").alias("name"), F.array("r_name").alias("tags"))
    return jobs.catalog(layers, market="EUR").select("layer_id", "name")


@register("SELECT o_custkey AS layer_id, greatest(0, epoch(TIMESTAMP '1998-01-01')::BIGINT - epoch(max(o_orderdate))::BIGINT)::BIGINT AS staleness_seconds FROM orders GROUP BY 1")
def layer_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("layer_id")).agg(F.max("o_orderdate").alias("generated_at"))
    return metrics.staleness(layers, F.to_timestamp(F.lit("1998-01-01 00:00:00"))).select("layer_id", F.col("staleness_seconds").cast("bigint").alias("staleness_seconds"))


@register("SELECT o_custkey AS layer_id, o_orderkey AS version, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_version FROM orders")
def version_lag_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("layer_id"), F.col("o_orderkey").alias("version"), F.col("o_orderdate").alias("occurred_at"))
    return jobs.version_chain(published).select("layer_id", "version", "previous_version")


@register("SELECT s_suppkey AS layer_id, z::INTEGER AS z FROM supplier, unnest(generate_series(0, 12)) AS t(z) EXCEPT SELECT l_suppkey, (l_quantity::INTEGER % 9)::INTEGER FROM lineitem")
def missing_zooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("layer_id"), F.explode(F.sequence(F.lit(0), F.lit(12))).alias("z"))
    present = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("layer_id"), (F.col("l_quantity").cast("int") % 9).alias("z")).distinct()
    return expected.exceptAll(present)


@register(f"""WITH {_assigned('supplier', 's_suppkey', 0, 5)}, tiles AS (SELECT DISTINCT id % 5 AS layer_id, z, x, y FROM a),
q AS (SELECT c_custkey, c_custkey % 7 AS layer_id, c_custkey % 8 AS z, (c_custkey * 31) % 40 AS x, (c_custkey * 17) % 40 AS y FROM customer)
SELECT status, count(*) AS n FROM (SELECT CASE WHEN q.layer_id > 4 THEN 404 WHEN q.z > 5 OR q.x >= pow(2, q.z) OR q.y >= pow(2, q.z) THEN 422 WHEN tiles.z IS NULL THEN 204 ELSE 200 END AS status
FROM q LEFT JOIN tiles ON q.layer_id = tiles.layer_id AND q.z = tiles.z AND q.x = tiles.x AND q.y = tiles.y) GROUP BY 1""")
def tile_lookup_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for tiles of five layers: 404 no layer, 422 no such tile number, 204 empty, 200."""
    placed = assign.assign(points(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey"), 0, 5)
    tiles = placed.select((F.col("s_suppkey") % 5).alias("layer_id"), F.lit("v1").alias("version"), F.col("z").cast("bigint").alias("z"), "x", "y").distinct().withColumn("data", F.lit(b"tile"))
    key, tenant = F.col("c_custkey"), F.lit("tenant-a").alias("tenant_id")
    asked = table(spark, sf_dir, "customer").select(tenant, (key % 7).alias("layer_id"), (key % 8).alias("z"), (key * 31 % 40).alias("x"), (key * 17 % 40).alias("y"))
    layers = spark.range(5).select(tenant, F.col("id").alias("layer_id"), F.lit(0).alias("min_zoom"), F.lit(5).alias("max_zoom"), F.lit("v0").alias("tile_version"))
    published = layers.select("tenant_id", "layer_id", F.lit("v1").alias("current_version"))
    return publish.lookup(asked, layers, published, tiles).groupBy("status").agg(F.count("*").alias("n"))


@register("SELECT c_custkey, c_name FROM customer WHERE 'tenant-' || (c_nationkey % 3)::VARCHAR = 'tenant-1'")
def tenant_scoped_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    owned = table(spark, sf_dir, "customer").withColumn("tenant_id", F.concat(F.lit("tenant-"), (F.col("c_nationkey") % 3).cast("string")))
    return jobs.tenant_scoped(owned, "tenant-1").select("c_custkey", "c_name")


@register("""SELECT 'sha256:' || sha256(string_agg(line, '' ORDER BY path)) AS checksum FROM (SELECT s_suppkey::VARCHAR || '.pbf' AS path,
s_suppkey::VARCHAR || '.pbf' || chr(9) || sha256(s_name) || chr(9) || length(s_name)::VARCHAR || chr(10) AS line FROM supplier)""")
def aggregate_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Textual variant of the ordered fold; ``operators.publish.aggregate_checksum`` has the binary one."""
    path = F.concat(F.col("s_suppkey").cast("string"), F.lit(".pbf"))
    line = F.concat(path, F.lit("\t"), F.sha2("s_name", 256), F.lit("\t"), F.length("s_name").cast("string"), F.lit("\n"))
    lines = table(spark, sf_dir, "supplier").agg(F.array_sort(F.collect_list(F.struct(path.alias("p"), line.alias("l")))).alias("v"))
    return lines.select(F.concat(F.lit("sha256:"), F.sha2(F.array_join(F.transform("v", lambda x: x["l"]), ""), 256)).alias("checksum"))


# --- rows-only queries: binary and iterative operators, held against fixtures in tests/ -------


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares of the parts and points of the customers as features with properties."""
    key, side = F.col("p_partkey"), F.col("p_size") * 0.01
    lon, lat = longitude(key), latitude(key)
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ring = F.array(corner(lon, lat), corner(lon + side, lat), corner(lon + side, lat + side), corner(lon, lat + side), corner(lon, lat))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    squares = table(spark, sf_dir, "part").select(
        key.alias("ord"), key.cast("decimal(20,0)").alias("id"), F.struct(F.lit("Polygon").alias("kind"), F.array(F.array(ring)).alias("parts")).alias("geom"),
        F.create_map(F.lit("parcelId"), key.cast("string"), F.lit("propertyType"), quoted(F.col("p_type")), F.lit("ownerName"), quoted(F.col("p_name")), F.lit("price"), F.col("p_retailprice").cast("string")).alias("props"),
    )
    customer = F.col("c_custkey")
    spots = table(spark, sf_dir, "customer").select(
        (customer + 1_000_000_000).alias("ord"), customer.cast("decimal(20,0)").alias("id"), F.struct(F.lit("Point").alias("kind"), F.array(F.array(F.array(corner(longitude(customer), latitude(customer))))).alias("parts")).alias("geom"),
        F.create_map(F.lit("assetId"), customer.cast("string"), F.lit("market"), quoted(F.col("c_mktsegment"))).alias("props"),
    )
    return squares.unionByName(spots)


@register()
def normalized_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.normalize(_features(spark, sf_dir)).select("ord", "id", "geom", "props")


@register()
def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _features(spark, sf_dir)
    return ingest.summary(ingest.normalize(raw), raw)


@register()
def build_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = ingest.normalize(_features(spark, sf_dir)).select("ord", "id", "geom", "props")
    return tiles.build(clean, tiles.TileConfig(layer="parcel_boundary", min_zoom=2, max_zoom=6))


@register()
def tile_zoom_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.zoom_stats(build_tiles(spark, sf_dir))


@register()
def mvt_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.inspect(build_tiles(spark, sf_dir))


@register()
def simplify_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order paths of customers at zoom 3's tolerance."""
    path = F.struct("o_orderdate", "o_orderkey")
    lines = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(path)).alias("v"))
    coords = F.transform("v", lambda x: F.struct((x["o_orderkey"] % 3600 / 10.0 - 180.0).alias("x"), (x["o_orderkey"] * 31 % 1600 / 10.0 - 80.0).alias("y")))
    return tiles.simplify_column(lines.select("o_custkey", coords.alias("coords")), "coords", 20.0)


@register()
def write_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geojson.write_text(ingest.normalize(_features(spark, sf_dir)))


@register()
def read_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written as one-feature collections and scanned again."""
    written = write_geojson(spark, sf_dir)
    texts = written.select(F.col("ord").cast("string").alias("path"), F.concat(F.lit('{"type":"FeatureCollection","features":['), "value", F.lit("]}")).alias("text"))
    return geojson.scan(texts)
