"""More registered queries with the SQL that checks them: gates, geometry, lookups, stores and tiles as decoded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs, geometry, properties, tilemath
from ..operators import ingest, jobs, publish, stores, tiles
from ..sources import geojson
from .catalog import _CATEGORY, _CODE, _LAT, _LON, _STATUS, _assigned, _failures, _features, _status, latitude, longitude, read_geojson, register, table


def pick(key: Column, *values) -> Column:
    """The value at ``key`` modulo their number."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def _pick(key: str, *values) -> str:
    quoted = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"([{quoted}])[(({key}) % {len(values)})::INTEGER + 1]"


# --- lookups and labels ---------------------------------------------------------------------

_REMEDY = (
    f"CASE WHEN code IN ({', '.join(map(repr, properties.TRANSIENT))}) THEN '{properties.RETRY_TEXT}' "
    + " ".join(f"WHEN code = '{c}' THEN '{t}'" for c, t in properties.REMEDIATION.items())
    + f" ELSE '{properties.REVIEW_TEXT}' END"
)


@register(f"SELECT code AS error_code, {_REMEDY} AS remediation, count(*) AS n FROM (SELECT {_CODE} AS code FROM events WHERE event_type = 'error') GROUP BY ALL")
def error_remediation(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("error_code")
    return _failures(spark, sf_dir).groupBy("error_code", properties.remediation(code).alias("remediation")).agg(F.count("*").alias("n"))


_KINDS = ("WGS84", "NAD83", "WEB_MERCATOR", "UNSUPPORTED", "UNKNOWN")


@register(f"""SELECT category, crs, count(*) AS n FROM (SELECT CASE WHEN c IN ('MACRO', 'SUBMARKET', 'PARCEL', 'ASSET_POINT', 'FLOOD_RISK', 'ZONING', 'OTHER') THEN c ELSE 'OTHER' END AS category,
CASE k WHEN 'WGS84' THEN 'EPSG:4326' WHEN 'NAD83' THEN 'EPSG:4269 (treated as EPSG:4326)' WHEN 'WEB_MERCATOR' THEN 'EPSG:3857' WHEN 'UNSUPPORTED' THEN 'UNSUPPORTED' ELSE 'UNKNOWN' END AS crs
FROM (SELECT {_pick('c_custkey', 'PARCEL', 'MACRO', 'strange', None)} AS c, {_pick('c_nationkey', *_KINDS)} AS k FROM customer)) GROUP BY ALL""")
def bounded_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = pick(F.col("c_custkey"), "PARCEL", "MACRO", "strange", None)
    labels = table(spark, sf_dir, "customer").select(properties.category_label(category).alias("category"), properties.crs_label(pick(F.col("c_nationkey"), *_KINDS)).alias("crs"))
    return labels.groupBy("category", "crs").agg(F.count("*").alias("n"))


@register(f"SELECT lower(replace(category, '_', '')) || ':' || (c_custkey % 5)::VARCHAR || '-' || (c_custkey % 7 + 9)::VARCHAR AS profile, count(*) AS n FROM (SELECT *, {_CATEGORY} AS category FROM customer) GROUP BY 1")
def profile_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").groupBy(properties.profile_label(F.expr(_CATEGORY), key % 5, key % 7 + 9).alias("profile")).agg(F.count("*").alias("n"))


@register("SELECT p AS prefix, count(*) AS n, count(*) AS ids, count(*) AS well_formed FROM events, (VALUES ('job'), ('evt'), ('replay'), ('auto'), ('audit')) AS t(p) GROUP BY p")
def minted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids are random; what holds of them is their form and that none comes twice."""
    prefixes = ("job", "evt", "replay", "auto", "audit")
    ids = table(spark, sf_dir, "events").select(F.explode(F.array(*[F.struct(F.lit(p).alias("prefix"), properties.minted(p).alias("id")) for p in prefixes])).alias("m")).select("m.*")
    return ids.groupBy("prefix").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count_if(F.col("id").rlike("^(job|evt|replay|auto|audit)_[0-9a-f]{32}$")).alias("well_formed"))


@register("SELECT p_partkey, sha256(p_name) AS source_hash FROM part")
def source_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", properties.source_hash(F.col("p_name").cast("binary")).alias("source_hash"))


@register("SELECT c_custkey, '\"v' || (c_nationkey % 3)::VARCHAR || '/' || (c_custkey % 17)::VARCHAR || '/' || (c_custkey % 11)::VARCHAR || '/' || (c_custkey % 13)::VARCHAR || '\"' AS etag, CASE WHEN c_custkey % 17 <= 10 THEN 86400 ELSE 3600 END::INTEGER AS max_age FROM customer")
def tile_cache_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    version = F.concat(F.lit("v"), (F.col("c_nationkey") % 3).cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", properties.etag(version, key % 17, key % 11, key % 13).alias("etag"), properties.cache_seconds(key % 17).cast("int").alias("max_age"))


# --- gates ----------------------------------------------------------------------------------

_NAMES, _TYPES = ("a.geojson", "b.JSON", "c.zip", "d.shp", "e.GeoJSON"), ("application/geo+json; charset=utf-8", "application/zip", "TEXT/PLAIN", None, "image/png", "application/octet-stream")


@register(f"""SELECT format, name, mime, count(*) AS n, CASE format WHEN 'GEOJSON' THEN (lower(name) LIKE '%.geojson' OR lower(name) LIKE '%.json') AND (mime IS NULL OR lower(trim(split_part(mime, ';', 1))) IN ('application/geo+json', 'application/json', 'text/plain', 'application/octet-stream'))
WHEN 'SHAPEFILE' THEN lower(name) LIKE '%.zip' AND (mime IS NULL OR lower(trim(split_part(mime, ';', 1))) IN ('application/zip', 'application/x-zip-compressed', 'application/octet-stream')) ELSE false END AS ok
FROM (SELECT {_pick('p_partkey', *_NAMES)} AS name, {_pick('p_size', *_TYPES)} AS mime, {_pick('p_partkey + p_size', 'GEOJSON', 'SHAPEFILE', 'KML')} AS format FROM part) GROUP BY format, name, mime""")
def file_type_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    files = table(spark, sf_dir, "part").select(pick(key, *_NAMES).alias("name"), pick(size, *_TYPES).alias("mime"), pick(key + size, "GEOJSON", "SHAPEFILE", "KML").alias("format"))
    return files.groupBy("format", "name", "mime", properties.file_type_ok(F.col("name"), F.col("mime"), F.col("format")).alias("ok")).agg(F.count("*").alias("n"))


_TENANTS, _RESOURCES = ("tenant-a", "Tenant", "ab", "x_1", "has space"), ("layer", "", "a/b", "a..b", "tab\tbed", "ok.v1")
_URIS = ("s3://b/input/tenant-a/f", "s3://b/input/other/f", "s3://b/elsewhere/f", "x_1/input/f")


@register(f"""SELECT tenant, resource, uri, count(*) AS n, regexp_full_match(tenant, '[a-z0-9_-]{{3,64}}') AS tenant_ok,
strlen(resource) <= 128 AND resource <> '' AND NOT regexp_matches(resource, '[/\\\\\\x00-\\x1F\\x7F]') AND NOT contains(resource, '..') AS resource_ok,
NOT contains(uri, '/input/') OR contains(uri, '/' || tenant || '/') OR starts_with(uri, tenant || '/') AS aligned
FROM (SELECT {_pick('c_custkey', *_TENANTS)} AS tenant, {_pick('c_nationkey', *_RESOURCES)} AS resource, {_pick('c_custkey + c_nationkey', *_URIS)} AS uri FROM customer) GROUP BY tenant, resource, uri""")
def tenant_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    asked = table(spark, sf_dir, "customer").select(pick(key, *_TENANTS).alias("tenant"), pick(nation, *_RESOURCES).alias("resource"), pick(key + nation, *_URIS).alias("uri"))
    gates = properties.tenant_id_ok(F.col("tenant")).alias("tenant_ok"), properties.resource_id_ok(F.col("resource")).alias("resource_ok"), properties.tenant_aligned(F.col("uri"), F.col("tenant")).alias("aligned")
    return asked.groupBy("tenant", "resource", "uri", *gates).agg(F.count("*").alias("n"))


@register("SELECT CASE WHEN strlen(p_name) > 24 THEN 'PAYLOAD_TOO_LARGE' END AS error_code, count(*) AS n FROM part GROUP BY 1")
def payload_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "part").select(F.col("p_name").cast("binary").alias("content"))
    return ingest.payload_gate(files, limit=24).groupBy("error_code").agg(F.count("*").alias("n"))


@register("SELECT x BETWEEN -180 AND 180 AND y BETWEEN -90 AND 90 AS ok, count(*) AS n FROM (SELECT (c_custkey % 800) - 400.0 AS x, (c_custkey % 300) - 150.0 AS y FROM customer) GROUP BY 1")
def coordinate_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    at = F.struct(((key % 800) - 400.0).cast("double").alias("x"), ((key % 300) - 150.0).cast("double").alias("y"))
    geom = F.struct(F.lit("Point").alias("kind"), F.array(F.array(F.array(at))).alias("parts"))
    return table(spark, sf_dir, "customer").select(geom.alias("geom")).groupBy(geometry.all_in_range(F.col("geom")).alias("ok")).agg(F.count("*").alias("n"))


# --- geometry -------------------------------------------------------------------------------


@register("""SELECT p_partkey, z::INTEGER AS z, round(x / pow(2, z) * 360 - 180, 9) AS min_lon, round((x + 1) / pow(2, z) * 360 - 180, 9) AS max_lon,
round(degrees(atan((exp(b) - exp(-b)) / 2)), 9) AS min_lat, round(degrees(atan((exp(t) - exp(-t)) / 2)), 9) AS max_lat
FROM (SELECT *, pi() * (1 - 2 * (y + 1) / pow(2, z)) AS b, pi() * (1 - 2 * y / pow(2, z)) AS t FROM (SELECT p_partkey, p_size % 12 AS z, (p_partkey * 31) % pow(2, p_size % 12)::BIGINT AS x, (p_partkey * 17) % pow(2, p_size % 12)::BIGINT AS y FROM part))""")
def tile_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = (F.col("p_size") % 12).cast("int")
    n = F.pow(F.lit(2.0), z).cast("bigint")
    placed = table(spark, sf_dir, "part").select("p_partkey", z.alias("z"), (F.col("p_partkey") * 31 % n).alias("x"), (F.col("p_partkey") * 17 % n).alias("y"))
    bounds = placed.select("p_partkey", "z", tilemath.tile_bounds(F.col("z"), F.col("x"), F.col("y")).alias("b"))
    return bounds.select("p_partkey", "z", *[F.round(f"b.{c}", 9).alias(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat")])


_PART_LON, _PART_LAT = _LON.format(k="p_partkey"), _LAT.format(k="p_partkey")
_CUST_LON, _CUST_LAT = _LON.format(k="c_custkey"), _LAT.format(k="c_custkey")
_SIDE = "p_size * 0.01::DOUBLE"
_MEASURES = f"""SELECT p_partkey AS ord, 'Polygon' AS kind, 5 AS vertices, {_PART_LON} AS min_x, {_PART_LAT} AS min_y, {_PART_LON} + {_SIDE} AS max_x, {_PART_LAT} + {_SIDE} AS max_y, 3 AS n_props, p_partkey AS id FROM part
UNION ALL SELECT c_custkey + 1000000000, 'Point', 1, {_CUST_LON}, {_CUST_LAT}, {_CUST_LON}, {_CUST_LAT}, 2, c_custkey FROM customer"""


def _measured(features: DataFrame) -> DataFrame:
    box = geometry.bbox(F.col("geom"))
    return features.select(F.col("ord").cast("bigint").alias("ord"), F.col("id").cast("bigint").alias("id"), F.col("geom.kind").alias("kind"), geometry.vertex_count(F.col("geom")).alias("vertices"), box["min_x"].alias("min_x"), box["min_y"].alias("min_y"), box["max_x"].alias("max_x"), box["max_y"].alias("max_y"), F.size("props").alias("n_props"))


@register(_MEASURES)
def normalized_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized features by what can be measured of them: vertices, box, kept properties."""
    return _measured(ingest.normalize(_features(spark, sf_dir)))


@register(_MEASURES)
def geojson_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written as GeoJSON texts and scanned again are those that were written."""
    return _measured(read_geojson(spark, sf_dir).withColumn("ord", F.col("path")))


@register(f"""WITH m AS ({_MEASURES}) SELECT count(*) AS parsed, count(*) AS features, 0::BIGINT AS rejected, count_if(kind = 'Point' AND min_x = 0 AND min_y = 0) AS null_island, min(min_x) AS min_x, min(min_y) AS min_y, max(max_x) AS max_x, max(max_y) AS max_y,
CASE WHEN count(DISTINCT kind) = 1 THEN max(kind) ELSE 'MIXED' END AS kind, 0::BIGINT AS duplicate_ids, CASE WHEN count(*) > 1000000 THEN 'FILE_TOO_LARGE' WHEN count(*) = 0 THEN 'EMPTY_DATASET' END AS error_code FROM m""")
def dataset_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _features(spark, sf_dir)
    return ingest.summary(ingest.normalize(raw), raw)


#: Lines and rings with repeated and non-finite vertices, and what repair leaves of each: kind, vertices or none.
_BROKEN = (
    ("LineString", [[[(0, 0), (0, 0), (1, 1)]]], 2), ("LineString", [[[(0, 0), (0, 0)]]], None), ("LineString", [[[(0, 0), (None, 1), (2, 2)]]], 2),
    ("Polygon", [[[(0, 0), (1, 0), (1, 1)]]], 4), ("Polygon", [[[(0, 0), (1, 0), (1, 0), (0, 0)]]], None), ("Polygon", [[[(0, 0), (4, 0), (4, 4), (0, 0)], [(1, 1), (1, 1)]]], 4),
    ("Point", [[[(None, 0)]]], None), ("MultiPoint", [[[(1, 1), (None, None), (2, 2)]]], 2), ("MultiLineString", [[[(0, 0), (1, 1)], [(5, 5)]]], 2), ("MultiPolygon", [[[(0, 0), (1, 0), (1, 1)]], [[(0, 0)]]], 4),
)


@register(
    "SELECT kind, vertices, count(*) AS n FROM (SELECT "
    + f"CASE p_partkey % {len(_BROKEN)} " + " ".join(f"WHEN {i} THEN " + ("NULL" if n is None else f"'{k}'") for i, (k, _, n) in enumerate(_BROKEN)) + " END AS kind, "
    + f"CASE p_partkey % {len(_BROKEN)} " + " ".join(f"WHEN {i} THEN {'NULL' if n is None else n}" for i, (*_, n) in enumerate(_BROKEN)) + " END AS vertices FROM part) GROUP BY ALL"
)
def repaired_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = spark.createDataFrame([(i, {"kind": k, "parts": [[[{"x": float("nan") if x is None else float(x), "y": float("nan") if y is None else float(y)} for x, y in line] for line in part] for part in parts]}) for i, (k, parts, _) in enumerate(_BROKEN)], f"i long, geom {geometry.GEOMETRY}")
    features = table(spark, sf_dir, "part").select((F.col("p_partkey") % len(_BROKEN)).alias("i")).join(F.broadcast(cases), "i")
    mended = features.select(geometry.repair(F.col("geom")).alias("geom"))
    return mended.groupBy(F.col("geom.kind").alias("kind"), F.when(F.col("geom").isNotNull(), geometry.vertex_count(F.col("geom"))).alias("vertices")).agg(F.count("*").alias("n"))


_WKT = (
    ('GEOGCS["GCS_WGS_1984"]', "WGS84"), ('PROJCS["x",GEOGCS["y",AUTHORITY["EPSG","4326"]],AUTHORITY["EPSG","3857"]]', "WEB_MERCATOR"), (None, "UNKNOWN"),
    ('PROJCS["z",AUTHORITY["EPSG","2263"]]', "UNSUPPORTED"), ("GEOGCS[NAD83]", "NAD83"), ('GEOGCS["GCS_North_American_1983"]', "NAD83"),
)


@register(f"SELECT kind, crs, assumed, error_code, count(*) AS n FROM (SELECT kind, CASE WHEN kind = 'UNKNOWN' THEN 'WGS84' ELSE kind END AS crs, kind = 'UNKNOWN' AS assumed, CASE WHEN kind = 'UNSUPPORTED' THEN 'UNSUPPORTED_CRS' END AS error_code FROM (SELECT {_pick('p_partkey', *[k for _, k in _WKT])} AS kind FROM part)) GROUP BY ALL")
def crs_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Systems detected from WKT, and what becomes of them if unknown ones count as WGS84."""
    found = table(spark, sf_dir, "part").select(crs.detect(pick(F.col("p_partkey"), *[w for w, _ in _WKT])).alias("kind"))
    resolved = found.select("kind", crs.resolve(F.col("kind"), assume_wgs84=True).alias("r"))
    return resolved.groupBy("kind", "r.crs", "r.assumed", "r.error_code").agg(F.count("*").alias("n"))


@register(f"""SELECT s_suppkey, kind, CASE kind WHEN 'WEB_MERCATOR' THEN round(degrees(x / 6378137.0::DOUBLE), 9) ELSE round(x, 9) END AS lon, CASE kind WHEN 'WEB_MERCATOR' THEN round(degrees(2 * atan(exp(y / 6378137.0::DOUBLE)) - pi() / 2), 9) ELSE round(y, 9) END AS lat
FROM (SELECT s_suppkey, {_pick('s_suppkey', 'WGS84', 'WEB_MERCATOR', 'NAD83')} AS kind, {_LON.format(k='s_suppkey')} AS x, {_LAT.format(k='s_suppkey')} AS y FROM supplier)""")
def reprojected(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    at = F.struct(longitude(key).alias("x"), latitude(key).alias("y"))
    geom = F.struct(F.lit("Point").alias("kind"), F.array(F.array(F.array(at))).alias("parts"))
    placed = table(spark, sf_dir, "supplier").select("s_suppkey", pick(key, "WGS84", "WEB_MERCATOR", "NAD83").alias("kind"), geom.alias("geom"))
    turned = placed.select("s_suppkey", "kind", F.get(geometry.vertices(crs.to_wgs84(F.col("geom"), F.col("kind"))), F.lit(0)).alias("v"))
    return turned.select("s_suppkey", "kind", F.round("v.x", 9).alias("lon"), F.round("v.y", 9).alias("lat"))


@register("""SELECT p_partkey, 2 AS n_core, (strlen('parcelId') + strlen(p_partkey::VARCHAR) + strlen('propertyType') + strlen(p_type))::BIGINT AS core_bytes,
(strlen('parcelId') + strlen(p_partkey::VARCHAR) + strlen('propertyType') + strlen(p_type) + strlen('price') + 8 + strlen('active') + 1 + strlen('floors') + 10)::BIGINT AS full_bytes FROM part""")
def tile_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Core and full properties of tile features with their size estimates; nulls are no properties."""
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    props = F.create_map(F.lit("parcelId"), quoted(F.col("p_partkey").cast("string")), F.lit("propertyType"), quoted(F.col("p_type")), F.lit("price"), F.concat(F.col("p_size").cast("string"), F.lit(".5")), F.lit("active"), F.lit("true"), F.lit("floors"), F.col("p_size").cast("string"), F.lit("gone"), F.lit("null"))
    parts = table(spark, sf_dir, "part").select("p_partkey", properties.tile_properties(props, "core").alias("core"), properties.tile_properties(props).alias("full"))
    return parts.select("p_partkey", F.size("core").alias("n_core"), properties.payload_bytes(F.col("core")).cast("bigint").alias("core_bytes"), properties.payload_bytes(F.col("full")).cast("bigint").alias("full_bytes"))


# --- stores and jobs ------------------------------------------------------------------------


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(key.alias("jobId"), F.concat(F.lit("tenant-"), (F.col("o_custkey") % 4).cast("string")).alias("tenantId"), _status(key).alias("status"), F.col("o_custkey").alias("idempotencyKey"), F.col("o_orderdate").alias("createdAt"))


@register("SELECT idempotencyKey, min(jobId) AS jobId FROM (SELECT o_custkey AS idempotencyKey, o_orderkey AS jobId, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS r FROM orders) WHERE r = 1 GROUP BY 1")
def idempotent_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.by_idempotency_key(_jobs(spark, sf_dir), "idempotencyKey").select("idempotencyKey", "jobId")


@register("SELECT o_orderkey AS jobId, o_orderdate AS createdAt FROM orders WHERE o_custkey % 4 = 1 ORDER BY o_orderdate DESC, o_orderkey LIMIT 500")
def jobs_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.newest_first(_jobs(spark, sf_dir), "createdAt", "jobId", tenant="tenant-1").limit(500).select("jobId", "createdAt")


@register("SELECT event_id, user_id AS jobId FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id LIMIT 500")
def dead_letters_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.newest_first(_failures(spark, sf_dir), "ts", "event_id").limit(500).select("event_id", F.col("job_id").alias("jobId"))


@register("SELECT 'tenant-' || (user_id % 4)::VARCHAR AS tenantId, count(DISTINCT user_id) AS depth FROM events WHERE event_type = 'error' GROUP BY 1")
def dead_letter_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = _failures(spark, sf_dir).select(F.concat(F.lit("tenant-"), (F.col("job_id") % 4).cast("string")).alias("tenantId"), F.col("job_id").alias("jobId"))
    return stores.dead_letter_depth(dead)


@register("""SELECT o_orderkey AS jobId, coalesce(q.source, s.source) AS source, CASE WHEN q.source IS NOT NULL THEN 'quarantine' WHEN s.source IS NOT NULL THEN 'staging' END AS origin FROM orders
LEFT JOIN (SELECT s_suppkey AS k, 'q/' || s_name AS source FROM supplier) q ON q.k = o_orderkey LEFT JOIN (SELECT c_custkey AS k, 's/' || c_name AS source FROM customer) s ON s.k = o_orderkey""")
def replay_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("jobId"))
    quarantined = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("jobId"), F.concat(F.lit("q/"), "s_name").alias("source"))
    staged = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("jobId"), F.concat(F.lit("s/"), "c_name").alias("source"))
    return stores.replay_sources(asked, quarantined, staged)


@register(f"""SELECT granted, count(*) AS n FROM (SELECT s IN ('UPLOAD_PENDING', 'QUEUED') AND (o_custkey % 3 = 0 OR o_orderdate::TIMESTAMP <= TIMESTAMP '1995-01-01') AS granted FROM (SELECT *, {_STATUS} AS s FROM orders)) GROUP BY 1""")
def lease_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    expires = F.when(F.col("o_custkey") % 3 != 0, F.col("o_orderdate").cast("timestamp"))
    granted = jobs.lease_granted(expires, _status(F.col("o_orderkey")), F.to_timestamp(F.lit("1995-01-01 00:00:00")))
    return table(spark, sf_dir, "orders").groupBy(granted.alias("granted")).agg(F.count("*").alias("n"))


@register("SELECT class, attempt, CASE WHEN class = 'TRANSIENT' AND attempt < 4 THEN ([0, 30, 60, 120])[least(attempt + 1, 4)] END::INTEGER AS delay, count(*) AS n FROM (SELECT " + _pick("event_id", "TRANSIENT", "MANUAL_REVIEW") + " AS class, (user_id % 6 + 1)::INTEGER AS attempt FROM events) GROUP BY ALL")
def retry_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    tries = table(spark, sf_dir, "events").select(pick(F.col("event_id"), "TRANSIENT", "MANUAL_REVIEW").alias("class"), (F.col("user_id") % 6 + 1).cast("int").alias("attempt"))
    return tries.groupBy("class", "attempt", jobs.retry_delay(F.col("class"), F.col("attempt")).alias("delay")).agg(F.count("*").alias("n"))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("tenant-"), (key % 4).cast("string")).alias("tenantId"), F.concat(F.lit("layer_"), key.cast("string")).alias("layerId"), F.lit("v1").alias("tileVersion"), (key % 5).cast("int").alias("minZoom"), (key % 5 + 8).cast("int").alias("maxZoom"), (key * 3).alias("tileCount"), F.timestamp_seconds(F.lit(946684800) + key).alias("generatedAt"), F.lit("secret").alias("sourceJobId"))


@register("SELECT 'tenant-' || (s_suppkey % 4)::VARCHAR AS tenantId, 'layer_' || s_suppkey::VARCHAR AS layerId, 'v1' AS tileVersion, (s_suppkey % 5)::INTEGER AS minZoom, (s_suppkey % 5 + 8)::INTEGER AS maxZoom, s_suppkey * 3 AS tileCount, '/tiles/tenant-' || (s_suppkey % 4)::VARCHAR || '/layer_' || s_suppkey::VARCHAR || '/versions/{tileVersion}/{z}/{x}/{y}.pbf' AS tileUrlTemplate FROM supplier")
def live_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.tile_manifests(_candidates(spark, sf_dir)).drop("generatedAt")


@register("SELECT 'layer_' || s_suppkey::VARCHAR AS layerId, s_suppkey * 3 AS tileCount, greatest(0, 1000 - s_suppkey)::BIGINT AS stalenessSeconds FROM supplier")
def layer_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.layer_health(_candidates(spark, sf_dir), F.timestamp_seconds(F.lit(946684800 + 1000))).select("layerId", "tileCount", F.col("stalenessSeconds").cast("bigint").alias("stalenessSeconds"))


# --- tiles as decoded -----------------------------------------------------------------------


def _point_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    spots = _features(spark, sf_dir).where("geom.kind = 'Point'")
    return tiles.build(ingest.normalize(spots).select("ord", "id", "geom", "props"), tiles.TileConfig(layer="asset_point", min_zoom=0, max_zoom=5, hard_bytes=1 << 30, target_bytes=250_000))


@register(f"WITH {_assigned('customer', 'c_custkey', 0, 5)} SELECT z::INTEGER AS z, x, y, 'asset_point' AS layer, count(*) AS features, (3 * count(*))::BIGINT AS commands FROM a GROUP BY z, x, y")
def decoded_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of points from zoom 0, encoded and decoded again: each feature that the grid assigns is in its tile, as one MoveTo."""
    return tiles.inspect(_point_tiles(spark, sf_dir)).select("z", "x", "y", "layer", "features", F.col("commands").cast("bigint").alias("commands"))


@register(f"WITH {_assigned('customer', 'c_custkey', 0, 5)} SELECT z::INTEGER AS z, count(DISTINCT (x, y)) AS tiles, count(*) AS instances, 0::BIGINT AS dropped, 0::BIGINT AS mitigated FROM a GROUP BY z")
def point_tile_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.zoom_stats(_point_tiles(spark, sf_dir)).select("z", "tiles", "instances", "dropped", "mitigated")


@register(f"WITH {_assigned('customer', 'c_custkey', 0, 5)} SELECT count(DISTINCT (z, x, y)) AS tiles, 0::BIGINT AS dropped FROM a")
def point_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.run_stats(_point_tiles(spark, sf_dir)).select("tiles", "dropped")
