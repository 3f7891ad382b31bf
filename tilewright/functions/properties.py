"""Feature properties as ``map<string,string>`` of JSON-encoded values, and the engine's lookups."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
DENYLIST = ("owner_name", "ownername", "owner", "owner_first", "owner_last", "mailing_address", "email", "phone", "ssn", "tax_id")
CORE = ("assetId", "parcelId", "propertyId", "propertyType", "market", "submarket")
MAX_BYTES, MAX_FIELDS = 512, 32
ZOOMS = {"MACRO": (0, 8), "SUBMARKET": (4, 12), "PARCEL": (10, 16), "ASSET_POINT": (4, 16), "FLOOD_RISK": (6, 14), "ZONING": (8, 16), "OTHER": (0, 16)}
LAYER_NAMES = {"PARCEL": "parcel_boundary", "ZONING": "zoning_district", "FLOOD_RISK": "flood_100yr", "SUBMARKET": "submarket_area", "ASSET_POINT": "asset_point", "MACRO": "macro_region"}
TRANSIENT = ("PROCESSING_TIMEOUT", "S3_THROTTLED", "ECS_TASK_TIMEOUT", "TEMPORARY_INTERNAL_ERROR", "INTERNAL_ERROR", "STORE_ERROR", "PROMOTION_CONFLICT")
PERMANENT = ("INVALID_FILE_TYPE", "INVALID_SHAPEFILE", "MISSING_SHAPEFILE_COMPONENTS", "INVALID_GEOJSON", "EMPTY_DATASET", "UNSUPPORTED_CRS", "UNKNOWN_CRS", "GEOMETRY_ERRORS", "ENCODING_ERROR", "PAYLOAD_TOO_LARGE", "FILE_TOO_LARGE", "TILE_SIZE_EXCEEDED", "TILE_GENERATION_FAILED", "PUBLISH_VALIDATION_FAILED")
GEOJSON_TYPES = ("application/geo+json", "application/json", "text/plain", "application/octet-stream")
ZIP_TYPES = ("application/zip", "application/x-zip-compressed", "application/octet-stream")


def allowed(key: Column, allowlist: tuple[str, ...] | None = None, denylist: tuple[str, ...] = DENYLIST) -> Column:
    """An allowlist, if set, overrides the denylist; case does not matter."""
    low = F.lower(key)
    return low.isin(*[k.lower() for k in allowlist]) if allowlist is not None else ~low.isin(*[k.lower() for k in denylist])


def _prefix(entries: Column, size, max_bytes: int, max_fields: int) -> Column:
    """Entries in key order until one would pass the byte or field budget; that one ends the list."""
    entries = F.slice(entries, 1, max_fields)  # what lies beyond is never looked at
    running = F.transform(entries, lambda e, i: F.struct(e.alias("e"), F.aggregate(F.slice(entries, 1, i + 1), F.lit(0), lambda a, x: a + size(x)).alias("total")))
    kept = F.filter(running, lambda r: r["total"] <= max_bytes)
    return F.map_from_entries(F.transform(kept, lambda r: r["e"]))


def clean(props: Column, allowlist: tuple[str, ...] | None = None, max_bytes: int = MAX_BYTES, max_fields: int = MAX_FIELDS) -> Column:
    """Allowed properties in key order within the budget of key and JSON bytes."""
    entries = F.array_sort(F.map_entries(F.map_filter(props, lambda k, v: allowed(k, allowlist))))
    return _prefix(entries, lambda e: F.octet_length(e["key"]) + F.octet_length(e["value"]), max_bytes, max_fields)


def value_size(value: Column) -> Column:
    """Size estimate of a typed value: text bytes, 1 for a boolean, 10 for an integer, 8 for a double."""
    text = F.when(value.startswith('"'), F.octet_length(F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v"))).otherwise(F.octet_length(value))
    return F.when(value.startswith('"') | value.startswith("{") | value.startswith("["), text).when(value.isin("true", "false"), 1).when(value.rlike("^-?[0-9]+$"), 10).otherwise(8)


def tile_properties(props: Column, mode: str = "full", max_bytes: int = MAX_BYTES, max_fields: int = MAX_FIELDS) -> Column:
    """Properties a tile carries: all, the core ones or none; nulls are skipped before counting."""
    if mode == "none":
        return F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))
    kept = F.map_filter(props, lambda k, v: v.isNotNull() & (v != "null"))
    if mode == "core":
        kept = F.map_filter(kept, lambda k, v: F.lower(k).isin(*[c.lower() for c in CORE]))
    return _prefix(F.array_sort(F.map_entries(kept)), lambda e: F.octet_length(e["key"]) + value_size(e["value"]), max_bytes, max_fields)


def payload_bytes(props: Column) -> Column:
    return F.aggregate(F.map_entries(props), F.lit(0), lambda a, e: a + F.octet_length(e["key"]) + value_size(e["value"]))


def lookup(table: dict, key: Column, default=None) -> Column:
    """Native map lookup; tables are fixed and small."""
    found = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in table.items()))[key]
    return found if default is None else F.coalesce(found, default)


def zoom_range(category: Column) -> Column:
    low = lookup({k: v[0] for k, v in ZOOMS.items()}, category, F.lit(ZOOMS["OTHER"][0]))
    high = lookup({k: v[1] for k, v in ZOOMS.items()}, category, F.lit(ZOOMS["OTHER"][1]))
    return F.struct(low.alias("min_zoom"), high.alias("max_zoom"))


def layer_name(category: Column, layer_id: Column) -> Column:
    return lookup(LAYER_NAMES, category, F.concat(layer_id, F.lit("_features")))


def error_class(code: Column) -> Column:
    return F.when(code.isin(*TRANSIENT), "TRANSIENT").when(code.isin(*PERMANENT), "PERMANENT_VALIDATION").otherwise("MANUAL_REVIEW")


def replay_eligible(code: Column) -> Column:
    return F.coalesce(code.isin(*TRANSIENT) | (code == "UNKNOWN_CRS"), F.lit(False))


# What to do about an error code.
REMEDIATION = {
    "INVALID_FILE_TYPE": "Match fileName/content-Type to the declared sourceFormat (.geojson/.json or .zip).",
    "MISSING_SHAPEFILE_COMPONENTS": "Upload a zipped Shapefile containing .shp, .shx, .dbf, and .prj.",
    "INVALID_SHAPEFILE": "Re-export the Shapefile; verify the bundle opens in a GIS tool.",
    "INVALID_GEOJSON": "Validate against RFC 7946; split GeometryCollections into typed features.",
    "EMPTY_DATASET": "Provide a non-empty feature collection.",
    "UNSUPPORTED_CRS": "Reproject the source to EPSG:4326 (WGS84) before upload.",
    "UNKNOWN_CRS": "Re-upload with a .prj file, or replay after confirming WGS84.",
    "GEOMETRY_ERRORS": "Repair the flagged geometries (degenerate rings, non-finite coordinates) and re-upload.",
    "ENCODING_ERROR": "Re-export DBF attributes as UTF-8.",
    "PAYLOAD_TOO_LARGE": "Split the upload below the size limit.",
    "FILE_TOO_LARGE": "Split the dataset below the 1,000,000-feature cap.",
    "TILE_SIZE_EXCEEDED": "Inspect the candidate version; adjust the property policy or source density.",
    "TILE_GENERATION_FAILED": "Inspect the candidate version; adjust the property policy or source density.",
    "PUBLISH_VALIDATION_FAILED": "Inspect the candidate version; adjust the property policy or source density.",
}
RETRY_TEXT = "Transient failure: retry; it is redriven automatically in production."
REVIEW_TEXT = "Inspect the failure report; permanent failures need corrected source data, unknown failures need manual review."
CRS_LABELS = {"WGS84": "EPSG:4326", "NAD83": "EPSG:4269 (treated as EPSG:4326)", "WEB_MERCATOR": "EPSG:3857", "UNSUPPORTED": "UNSUPPORTED", "UNKNOWN": "UNKNOWN"}


def remediation(code: Column) -> Column:
    """What an operator is told about an error code."""
    return F.when(code.isin(*TRANSIENT), RETRY_TEXT).otherwise(lookup(REMEDIATION, code, F.lit(REVIEW_TEXT)))


def category_label(category: Column) -> Column:
    """A bounded metric label: one of the categories, else OTHER."""
    return F.when(category.isin(*ZOOMS), category).otherwise("OTHER")


def crs_label(kind: Column) -> Column:
    return lookup(CRS_LABELS, kind, F.lit("UNKNOWN"))


def minted(prefix: str) -> Column:
    """A new id for each row: ``job_``, ``evt_``, ``replay_``, ``auto_`` or ``audit_`` and 32 hexadecimal digits."""
    return F.concat(F.lit(f"{prefix}_"), F.replace(F.uuid(), F.lit("-"), F.lit("")))


def trace_id() -> Column:
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))


def span_id() -> Column:
    return F.left(trace_id(), F.lit(16))


def source_hash(content: Column) -> Column:
    """Lower-case SHA-256 of a payload."""
    return F.sha2(content, 256)


def fingerprint(kind: str, *parts: Column) -> Column:
    """``sha256:`` and the hash of kind and parts, separated by NUL; null parts are empty."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.concat(F.lit("sha256:"), F.sha2(F.concat_ws("\0", F.lit(kind), *texts), 256))


def profile_label(category: Column, min_zoom: Column, max_zoom: Column) -> Column:
    name = F.coalesce(F.lower(F.replace(category, F.lit("_"), F.lit(""))), F.lit("other"))
    return F.concat(name, F.lit(":"), min_zoom.cast("string"), F.lit("-"), max_zoom.cast("string"))


def metric_key(name: Column, dims: Column) -> Column:
    """``name{k=v,...}`` with sorted dimensions; the bare name without any."""
    pairs = F.array_join(F.transform(F.array_sort(F.map_entries(dims)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return F.when(F.size(dims) > 0, F.concat(name, F.lit("{"), pairs, F.lit("}"))).otherwise(name)


def etag(version: Column, z: Column, x: Column, y: Column) -> Column:
    return F.concat(F.lit('"'), F.concat_ws("/", version, z.cast("string"), x.cast("string"), y.cast("string")), F.lit('"'))


def cache_seconds(z: Column) -> Column:
    return F.when(z <= 10, 86400).otherwise(3600)


def file_type_ok(name: Column, content_type: Column, source_format: Column) -> Column:
    """Whether extension and MIME type (its parameters aside) fit the declared format."""
    low = F.lower(name)
    mime = F.lower(F.trim(F.split_part(content_type, F.lit(";"), F.lit(1))))
    geojson = (low.endswith(".geojson") | low.endswith(".json")) & F.coalesce(mime.isin(*GEOJSON_TYPES), F.lit(True))
    shapefile = low.endswith(".zip") & F.coalesce(mime.isin(*ZIP_TYPES), F.lit(True))
    return F.when(source_format == "GEOJSON", geojson).when(source_format == "SHAPEFILE", shapefile).otherwise(F.lit(False))


def tenant_id_ok(tenant: Column) -> Column:
    return tenant.rlike("^[a-z0-9_-]{3,64}$")


def resource_id_ok(resource: Column) -> Column:
    return (F.octet_length(resource) <= 128) & (resource != "") & ~resource.rlike(r"[/\\\x00-\x1F\x7F]") & ~resource.contains("..")


def tenant_aligned(uri: Column, tenant: Column) -> Column:
    """Input URIs must lie below their tenant; others are not judged."""
    return ~uri.contains("/input/") | F.contains(uri, F.concat(F.lit("/"), tenant, F.lit("/"))) | F.startswith(uri, F.concat(tenant, F.lit("/")))
