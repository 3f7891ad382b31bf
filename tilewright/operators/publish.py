"""Publishing: verification of a candidate, checksum, and the conditional version pointer.

Verification is one aggregate over the candidate's files.  The pointer is a small file changed by
compare-and-swap under an exclusive lock file, by one driver, as row-level swaps need a table format.
"""

from __future__ import annotations

import contextlib
import json
import os
import time
import uuid
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import PipelineError

# Names in a version's and a layer's folder.
URL_TEMPLATE = "/tiles/{tenant}/{layer}/versions/{{tileVersion}}/{{z}}/{{x}}/{{y}}.pbf"
CANDIDATE, SUCCESS = "_manifest/candidate.json", "_SUCCESS"
LOCK_SECONDS = 60.0


class PublishError(PipelineError):
    """A refused publication."""


def tile_entries(spark: SparkSession, root: str) -> DataFrame:
    """``rel_path, sha256, len, z`` of every tile file below ``root``, manifests aside."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pbf").load(root)
    rel = F.regexp_extract("path", r"/([0-9]+/[0-9]+/[0-9]+\.pbf)$", 1)
    return files.where(~F.col("path").contains("/_manifest/")).select(rel.alias("rel_path"), F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("sha256"), F.octet_length("content").cast("bigint").alias("len"), F.split_part(rel, F.lit("/"), F.lit(1)).cast("int").alias("z"))


def aggregate_checksum() -> Column:
    """Aggregate over ``rel_path, sha256, len``: SHA-256 of path NUL hash NUL length (u64, little-endian) newline, by path."""
    wide = F.lpad(F.hex(F.col("len")), 16, "0")
    little = F.array_join(F.transform(F.sequence(F.lit(8), F.lit(1), F.lit(-1)), lambda i: F.substr(wide, 2 * i - 1, F.lit(2))), "")
    line = F.concat(F.hex(F.col("rel_path")), F.lit("00"), F.hex(F.col("sha256")), F.lit("00"), little, F.lit("0A"))
    ordered = F.array_sort(F.collect_list(F.struct("rel_path", line.alias("h"))))
    return F.concat(F.lit("sha256:"), F.sha2(F.unhex(F.array_join(F.transform(ordered, lambda x: x["h"]), "")), 256))


def verify(entries: DataFrame, manifest: dict | None) -> dict:
    """Checks in order: manifest, empty files, count, every zoom, checksum; raises at the first that fails."""
    if manifest is None:
        raise PublishError("PUBLISH_VALIDATION_FAILED", "no manifest")
    found = entries.agg(F.count("*").alias("n"), F.count_if(F.col("len") == 0).alias("empty"), F.collect_set("z").alias("zooms"), F.coalesce(F.sum("len"), F.lit(0)).alias("bytes"), aggregate_checksum().alias("checksum")).first()
    missing = set(range(manifest["minZoom"], manifest["maxZoom"] + 1)) - set(found.zooms)
    for bad, why in ((found.empty, "empty tile"), (found.n != manifest["tileCount"], "tile count differs"), (missing, f"no tiles at zooms {sorted(missing)}"), (found.checksum != manifest["aggregateChecksum"], "checksum differs")):
        if bad:
            raise PublishError("PUBLISH_VALIDATION_FAILED", why)
    return found.asDict()


def version_stamp(now: datetime, suffix: str | None = None) -> str:
    return f"{now.astimezone(timezone.utc):%Y-%m-%dT%H-%M-%SZ}-{suffix or uuid.uuid4().hex[:8]}"


class Registry:
    """Version pointers and audit of layers, by tenant and layer, in a folder."""

    def __init__(self, root: str | Path):
        self.root = Path(root)

    def _path(self, tenant: str, layer: str) -> Path:
        return self.root / tenant / f"{layer}.json"

    def get(self, tenant: str, layer: str) -> dict | None:
        path = self._path(tenant, layer)
        return json.loads(path.read_text()) if path.exists() else None

    @contextlib.contextmanager
    def _locked(self, tenant: str, layer: str, wait: float = 10.0):
        lock = self._path(tenant, layer).with_suffix(".lock")
        lock.parent.mkdir(parents=True, exist_ok=True)
        until = time.monotonic() + wait
        while True:
            try:
                os.close(os.open(lock, os.O_CREAT | os.O_EXCL))
                break
            except FileExistsError:
                with contextlib.suppress(FileNotFoundError):  # its owner may have let go meanwhile
                    if time.time() - lock.stat().st_mtime > LOCK_SECONDS:  # an owner that died
                        lock.unlink()
                        continue
                if time.monotonic() > until:
                    raise PublishError("PROMOTION_CONFLICT", "locked") from None
                time.sleep(0.02)
        try:
            yield
        finally:
            lock.unlink()

    def _write(self, tenant: str, layer: str, record: dict, audit: dict) -> dict:
        path = self._path(tenant, layer)
        fresh = path.with_suffix(f".{uuid.uuid4().hex}.tmp")
        fresh.write_text(json.dumps(record))
        os.replace(fresh, path)
        with (self.root / "audit.jsonl").open("a") as f:
            f.write(json.dumps(audit | {"tenantId": tenant, "layerId": layer}) + "\n")
        return record

    def promote(self, tenant: str, layer: str, version: str, expected: str | None, actor: str, now: datetime) -> dict:
        """Point to ``version`` if the pointer still is at ``expected``."""
        with self._locked(tenant, layer):
            record = self.get(tenant, layer)
            current = record and record["currentTileVersion"]
            if current != expected:
                raise PublishError("PROMOTION_CONFLICT", f"at {current}, expected {expected}")
            new = {"layerId": layer, "tenantId": tenant, "currentTileVersion": version, "previousTileVersion": current, "publishStatus": "PUBLISHED", "updatedAt": now.isoformat(), "publishedBy": actor}
            return self._write(tenant, layer, new, {"eventType": "LAYER_PUBLISHED", "version": version, "actor": actor, "occurredAt": now.isoformat()})

    def rollback(self, tenant: str, layer: str, version: str, candidates: set[str], reason: str, actor: str, now: datetime) -> dict:
        """Point back to a version that has a manifest; nothing changes if it is current already."""
        with self._locked(tenant, layer):
            record = self.get(tenant, layer)
            if record is None:
                raise PublishError("NOT_FOUND", layer)
            if record["currentTileVersion"] == version:
                return record
            if version not in candidates:
                raise PublishError("PUBLISH_VALIDATION_FAILED", f"no manifest of {version}")
            new = record | {"previousTileVersion": record["currentTileVersion"], "currentTileVersion": version, "publishStatus": "ROLLED_BACK", "rollbackReason": reason, "rolledBackAt": now.isoformat(), "rolledBackBy": actor, "updatedAt": now.isoformat()}
            return self._write(tenant, layer, new, {"eventType": "LAYER_ROLLED_BACK", "version": version, "actor": actor, "reason": reason, "occurredAt": now.isoformat()})


def candidate_manifest(entries: DataFrame, job: dict, version: str, summary: dict, now: datetime, crs: str = "EPSG:4326", tile_root: str = "") -> dict:
    """What a finished set of tiles claims to be; ``verify`` holds the tiles against it."""
    found = entries.agg(F.count("*").alias("n"), F.coalesce(F.sum("len"), F.lit(0)).alias("bytes"), aggregate_checksum().alias("checksum")).first()
    return {
        "schemaVersion": 1, "tenantId": job["tenantId"], "layerId": job["layerId"], "tileVersion": version, "status": "CANDIDATE", "sourceJobId": job["jobId"], "sourceFormat": job.get("sourceFormat", "GEOJSON"), "crs": crs,
        "minZoom": summary["minZoom"], "maxZoom": summary["maxZoom"], "featureCount": summary["featureCount"], "tileCount": found.n, "totalGzipBytes": found.bytes, "boundingBox": summary["boundingBox"],
        "generatedAt": now.astimezone(timezone.utc).isoformat(), "checksumAlgorithm": "sha256", "aggregateChecksum": found.checksum, "tileRoot": tile_root,
    }


def url_template(tenant: Column, layer: Column) -> Column:
    return F.concat(F.lit("/tiles/"), tenant, F.lit("/"), layer, F.lit("/versions/{tileVersion}/{z}/{x}/{y}.pbf"))


def tile_manifests(candidates: DataFrame) -> DataFrame:
    """The reader's view of candidate manifests."""
    kept = [c for c in ("schemaVersion", "tenantId", "layerId", "tileVersion", "minZoom", "maxZoom", "tileCount", "totalGzipBytes", "boundingBox", "generatedAt") if c in candidates.columns]
    return candidates.select(*kept, url_template(F.col("tenantId"), F.col("layerId")).alias("tileUrlTemplate"))


def tile_manifest(candidate: dict) -> dict:
    """``tile_manifests`` of one."""
    kept = ("schemaVersion", "tenantId", "layerId", "tileVersion", "minZoom", "maxZoom", "tileCount", "totalGzipBytes", "boundingBox", "generatedAt")
    return {k: candidate[k] for k in kept} | {"tileUrlTemplate": URL_TEMPLATE.format(tenant=candidate["tenantId"], layer=candidate["layerId"])}


def write_candidate(files, root: str, candidate: dict) -> None:
    """``candidate.json`` of a version below ``root`` (of ``stores.Files``), whole or not at all."""
    files.write(f"{root}/{CANDIDATE}", json.dumps(candidate).encode())


def read_candidate(files, root: str) -> dict | None:
    data = files.read(f"{root}/{CANDIDATE}")
    return json.loads(data) if data else None


def write_pointers(files, candidate: dict) -> None:
    """``manifest.json`` and ``latest.json`` of the layer."""
    for name in ("manifest", "latest"):
        files.write(f"manifests/{candidate['tenantId']}/{candidate['layerId']}/{name}.json", json.dumps(tile_manifest(candidate)).encode())


def promote_version(stores, root: str, registry: Registry, actor: str, now: datetime, expected: str | None) -> dict:
    """Verify the candidate below ``root``, swap the pointer, then write pointers, marker and event.

    A failure before the swap leaves the version before in place.
    """
    from .stores import Files

    files = Files(stores.spark, stores.root)
    candidate = read_candidate(files, root)
    record = publish(tile_entries(stores.spark, f"{stores.root}/{root}"), candidate, registry, actor, now, expected)
    write_pointers(files, candidate)
    files.write(f"{root}/{SUCCESS}", record["updatedAt"].encode())
    stores.emit("vector.tile.version.promoted", now, tenantId=candidate["tenantId"], layerId=candidate["layerId"], jobId=candidate["sourceJobId"], fromTileVersion=expected, toTileVersion=candidate["tileVersion"], actor=actor)
    return record


def publish(entries: DataFrame, manifest: dict | None, registry: Registry, actor: str, now: datetime, expected: str | None) -> dict:
    """Verify, then swap the pointer."""
    verify(entries, manifest)
    return registry.promote(manifest["tenantId"], manifest["layerId"], manifest["tileVersion"], expected, actor, now)


def lookup(requests: DataFrame, layers: DataFrame, publications: DataFrame, tiles: DataFrame) -> DataFrame:
    """Tile requests (tenant_id, layer_id, z, x, y) answered from the current version: status, etag and cache seconds."""
    from ..functions import properties, tilemath

    current = layers.join(publications.select("tenant_id", "layer_id", F.col("current_version").alias("_v")), ["tenant_id", "layer_id"], "left").select("tenant_id", "layer_id", "min_zoom", "max_zoom", F.coalesce("_v", "tile_version").alias("version"))
    known = requests.join(current, ["tenant_id", "layer_id"], "left")
    found = known.join(tiles.select("layer_id", "version", "z", "x", "y", "data"), ["layer_id", "version", "z", "x", "y"], "left")
    valid = tilemath.valid_tile(F.col("z"), F.col("x"), F.col("y"), F.col("min_zoom"), F.col("max_zoom"))
    status = F.when(F.col("version").isNull(), 404).when(~valid, 422).when(F.col("data").isNull(), 204).otherwise(200)
    return found.select(*requests.columns, status.alias("status"), F.when(status == 200, properties.etag(F.col("version"), F.col("z"), F.col("x"), F.col("y"))).alias("etag"), properties.cache_seconds(F.col("z")).alias("max_age"), "data")
