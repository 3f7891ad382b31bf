"""A job from source to published tiles, with states, events, quarantine, retries and dead letters.

The driver walks the stages; what touches features or tiles is distributed.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import properties
from ..sources import geojson, shapefile
from . import ingest, jobs, publish, sinks, tiles
from .errors import PipelineError, error_code
from .stores import Files, Stores, mint, now_utc

STAGES = ("VALIDATING", "NORMALIZING", "TILING", "PUBLISHING", "COMPLETED")
#: Codes that speak of the source itself; such sources are kept aside.
SOURCE_CODES = ("INVALID_FILE_TYPE", "INVALID_SHAPEFILE", "MISSING_SHAPEFILE_COMPONENTS", "INVALID_GEOJSON", "EMPTY_DATASET", "UNSUPPORTED_CRS", "UNKNOWN_CRS", "GEOMETRY_ERRORS", "ENCODING_ERROR", "PAYLOAD_TOO_LARGE", "FILE_TOO_LARGE")


def _holds(stores: Stores, condition, **values) -> bool:
    row = stores.spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return bool(row.select(condition(*[F.col(k) for k in values])).first()[0])


def check_tenant(stores: Stores, job: dict) -> None:
    """Refuse malformed ids and sources outside the tenant's folder before any file is touched."""
    if not _holds(stores, lambda t: properties.tenant_id_ok(t), t=job["tenantId"]):
        raise PipelineError("TENANT_MISMATCH", f"malformed tenant id {job['tenantId']!r}")
    if not _holds(stores, lambda r: properties.resource_id_ok(r), r=job["layerId"]):
        raise PipelineError("TENANT_MISMATCH", f"malformed layer id {job['layerId']!r}")
    if not _holds(stores, lambda u, t: properties.tenant_aligned(u, t), u=job["sourceUri"], t=job["tenantId"]):
        raise PipelineError("TENANT_MISMATCH", f"{job['sourceUri']} lies outside {job['tenantId']}")


def read_source(stores: Stores, job: dict, assume_wgs84: bool = False) -> DataFrame:
    """Features of a job's source, or the error of its file."""
    files = stores.spark.read.format("binaryFile").load(job["sourceUri"]).select("path", "length", "content")
    size = files.agg(F.max("length")).first()[0]
    if size is None:
        raise PipelineError("EMPTY_DATASET", job["sourceUri"])
    if size > ingest.MAX_BYTES:
        raise PipelineError("PAYLOAD_TOO_LARGE", f"{size} bytes")
    if job.get("sourceFormat") == "SHAPEFILE":
        scanned = shapefile.features(shapefile.scan(files.select("path", "content")), assume_wgs84=assume_wgs84)
    else:
        scanned = geojson.scan(files.select("path", F.col("content").cast("string").alias("text")))
    failed = scanned.where("error_code is not null").select("error_code").first()
    if failed:
        raise PipelineError(failed.error_code, job["sourceUri"])
    return scanned.select("ord", "id", "geom", "props")


def run_job(stores: Stores, job: dict, registry: publish.Registry, config: tiles.TileConfig | None = None, worker: str = "worker", clock: Callable[[], datetime] = now_utc, assume_wgs84: bool = False) -> dict:
    """Run a job to its end: the published version and its counts, or the error after it is on record.

    A job that is completed or cancelled is refused; one that another worker holds is left alone.
    """
    known, _ = stores.jobs.create_or_get(job, clock())
    if known["status"] in ("COMPLETED", "CANCELLED"):
        raise PipelineError("STATE_CONFLICT", f"{known['jobId']} is {known['status']}")
    check_tenant(stores, known)
    token = stores.jobs.acquire(known["jobId"], worker, clock())
    version, at = publish.version_stamp(clock()), {"stage": known["status"]}
    try:
        return _stages(stores, known, registry, config, token, version, at, clock, assume_wgs84)
    except Exception as e:
        _failed(stores, known, e, at["stage"], version, clock())
        raise


def _stages(stores, job, registry, config, token, version, at, clock, assume_wgs84) -> dict:
    def enter(stage: str) -> None:
        stores.jobs.transition(job["jobId"], at["stage"], stage, clock(), token)
        at["stage"] = stage

    if at["stage"] == "UPLOAD_PENDING":
        enter("QUEUED")
    enter("VALIDATING")
    raw = read_source(stores, job, assume_wgs84)
    enter("NORMALIZING")
    clean = ingest.normalize(raw)
    summary = ingest.summary(clean, raw).first()
    if summary.error_code:
        raise PipelineError(summary.error_code, f"{summary.parsed} features read, {summary.features} usable")
    enter("TILING")
    low, high = properties.ZOOMS.get(job.get("category") or "OTHER", properties.ZOOMS["OTHER"])
    name = properties.LAYER_NAMES.get(job.get("category"), f"{job['layerId']}_features")
    config = config or tiles.TileConfig(layer=name, min_zoom=low, max_zoom=high)
    root = f"tiles/{job['tenantId']}/{job['layerId']}/versions/{version}"
    place = f"{stores.root}/{root}"
    sinks.export_tree(tiles.build(clean, config), place)
    enter("PUBLISHING")
    entries = publish.tile_entries(stores.spark, place)
    told = {"minZoom": config.min_zoom, "maxZoom": config.max_zoom, "featureCount": summary.features, "boundingBox": [summary.min_x, summary.min_y, summary.max_x, summary.max_y]}
    candidate = publish.candidate_manifest(entries, job, version, told, clock(), tile_root=root)
    publish.write_candidate(Files(stores.spark, stores.root), root, candidate)
    current = registry.get(job["tenantId"], job["layerId"])
    publish.promote_version(stores, root, registry, job.get("createdBy", "worker"), clock(), current and current["currentTileVersion"])
    stores.layers.put(f"{job['tenantId']}/{job['layerId']}", {"tenantId": job["tenantId"], "layerId": job["layerId"], "name": job.get("name", job["layerId"]), "category": job.get("category"), "tags": job.get("tags", []), "tileVersion": version, "minZoom": config.min_zoom, "maxZoom": config.max_zoom, "updatedAt": clock()})
    enter("COMPLETED")
    stores.jobs.finish(job["jobId"], clock(), error=None, errorCode=None)
    stores.emit("vector.tile.job.completed", clock(), tenantId=job["tenantId"], jobId=job["jobId"], layerId=job["layerId"], tileVersion=version, tileCount=candidate["tileCount"])
    return {"tileVersion": version, "featureCount": summary.features, "tileCount": candidate["tileCount"], "rejected": summary.rejected}


def _failed(stores: Stores, job: dict, error: Exception, stage: str, version: str, now: datetime) -> None:
    """Put a failure on record: job, event, and the source aside if it is at fault."""
    code, text = error_code(error), str(error)
    if code in ("LEASE_CONFLICT", "STATE_CONFLICT"):
        return
    kind = "TRANSIENT" if code in properties.TRANSIENT else "PERMANENT_VALIDATION" if code in properties.PERMANENT else "MANUAL_REVIEW"
    told = {"jobId": job["jobId"], "tenantId": job["tenantId"], "layerId": job["layerId"], "errorCode": code, "errorClass": kind, "errorMessage": text, "failedStage": stage}
    stores.jobs.finish(job["jobId"], now, status="FAILED", error=text, errorCode=code, errorClass=kind, failedStage=stage, replayEligible=kind == "TRANSIENT" or code == "UNKNOWN_CRS")
    if stage == "PUBLISHING":
        stores.emit("vector.tile.publish.failed", now, tileVersion=version, **told)
    if code in SOURCE_CODES:
        stores.quarantine.put(f"{job['tenantId']}/{job['jobId']}", told | {"attempts": job.get("attempts", 0) + 1, "failedAt": now, "sourceUri": job["sourceUri"]})
        stores.emit("vector.tile.job.quarantined", now, **told)
    stores.emit("vector.tile.job.failed", now, **told)


def run_with_retries(stores: Stores, job: dict, run: Callable[[], dict], clock: Callable[[], datetime] = now_utc, sleep: Callable[[float], None] = time.sleep) -> dict:
    """Run a job until it succeeds or its error allows no further attempt; then it becomes a dead letter.

    Lost leases and state conflicts are another worker's business: they are raised at once and leave no dead letter.
    """
    attempt = 1
    while True:
        try:
            return run()
        except Exception as e:
            code = error_code(e)
            if code in ("LEASE_CONFLICT", "STATE_CONFLICT"):
                raise
            transient = code in properties.TRANSIENT
            if transient and attempt < jobs.MAX_ATTEMPTS:
                sleep(jobs.DELAYS[min(attempt, len(jobs.DELAYS) - 1)])
                record = stores.jobs.get(job["jobId"])
                if record and record["status"] == "FAILED":
                    stores.jobs.transition(job["jobId"], "FAILED", "QUEUED", clock())
                attempt += 1
                continue
            kind = "TRANSIENT" if transient else "PERMANENT_VALIDATION" if code in properties.PERMANENT else "MANUAL_REVIEW"
            record = stores.jobs.get(job["jobId"]) or {}
            stores.dead.put(f"{job['tenantId']}/{job['jobId']}", {"jobId": job["jobId"], "tenantId": job["tenantId"], "layerId": job["layerId"], "errorCode": code, "errorClass": kind, "errorMessage": str(e), "failedStage": record.get("failedStage"), "attempts": attempt, "failedAt": clock()})
            raise


def replay(stores: Stores, job_id: str, run: Callable[[dict], dict], reason: str, clock: Callable[[], datetime] = now_utc, new_version: bool = False) -> str:
    """Run a finished job again if the rules allow it; the decision taken."""
    job = stores.jobs.get(job_id)
    row = stores.spark.createDataFrame([(job and job["status"], job and job.get("errorCode"), job.get("replays") or 0 if job else 0, new_version)], "s string, c string, n long, v boolean")
    decision = row.select(jobs.replay_decision(*[F.col(c) for c in "scnv"])).first()[0]
    if decision != "REPLAY":
        stores.emit("vector.tile.replay.denied", clock(), jobId=job_id, reason=decision)
        return decision
    kept = stores.quarantine.get(f"{job['tenantId']}/{job_id}")
    job = job | {"sourceUri": (kept or job)["sourceUri"]}
    stores.emit("vector.tile.replay.requested", clock(), jobId=job_id, tenantId=job["tenantId"], reason=reason, replayId=mint("replay"))
    stores.jobs.finish(job_id, clock(), replays=(job.get("replays") or 0) + 1, sourceUri=job["sourceUri"])
    stores.jobs.transition(job_id, job["status"], "QUEUED", clock())
    run(stores.jobs.get(job_id))
    return decision
