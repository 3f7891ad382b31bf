"""Keyed record stores of the control plane: one JSON document a key, below a folder of any Hadoop file system.

A record is replaced by writing a new file and renaming it over the old one, so a reader meets the
old or the new document, never a part.  What must happen once is an exclusive creation.  Listings and
look-ups over many records are DataFrame scans of the same files.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import time
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jobs
from .errors import PipelineError

JOB = (
    "jobId string, tenantId string, layerId string, status string, sourceUri string, sourceFormat string, category string, idempotencyKey string, "
    "error string, errorCode string, errorClass string, failedStage string, replayEligible boolean, stateVersion long, attempts long, replays long, "
    "leaseToken string, lockedBy string, leaseExpiresAt timestamp, createdAt timestamp, updatedAt timestamp"
)
DEAD_LETTER = "jobId string, tenantId string, layerId string, errorCode string, errorClass string, errorMessage string, failedStage string, attempts long, failedAt timestamp"
MANIFEST = "tenantId string, layerId string, tileVersion string, minZoom int, maxZoom int, tileCount long, totalGzipBytes long, generatedAt timestamp, tileUrlTemplate string"
LAYER = "tenantId string, layerId string, name string, category string, tags array<string>, tileVersion string, minZoom int, maxZoom int, updatedAt timestamp"


def now_utc() -> datetime:
    return datetime.now(timezone.utc)


def mint(prefix: str) -> str:
    """A new id: prefix and 32 hexadecimal digits."""
    return f"{prefix}_{uuid.uuid4().hex}"


class Files:
    """The few operations stores need, on the file system that owns ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self.hadoop = jvm.org.apache.hadoop.fs
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.hadoop.Path(self.root).getFileSystem(self.conf)
        self.swap = self.hadoop.FileContext.getFileContext(self.hadoop.Path(self.root).toUri() if "://" in self.root else self.fs.getUri(), self.conf)

    def path(self, name: str):
        return self.hadoop.Path(f"{self.root}/{name}")

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def read(self, name: str) -> bytes | None:
        if not self.exists(name):
            return None
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def create(self, name: str, data: bytes) -> bool:
        """Write a file that must not exist yet; whether this call made it."""
        fresh = self._beside(name, data)
        try:
            self.swap.rename(fresh, self.path(name), self._options("NONE"))
            return True
        except Exception as e:  # the Java error class tells
            if "FileAlreadyExists" in str(e) or self.exists(name):
                self.fs.delete(fresh, False)
                return False
            raise

    def write(self, name: str, data: bytes) -> None:
        self.swap.rename(self._beside(name, data), self.path(name), self._options("OVERWRITE"))

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), False)

    def _beside(self, name: str, data: bytes):
        fresh = self.path(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(fresh, True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        return fresh

    def _options(self, name: str):
        kind = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = getattr(kind, name)
        return options

    @contextlib.contextmanager
    def locked(self, name: str, wait: float = 10.0, stale: float = 60.0) -> Iterator[None]:
        """Hold ``name``.lock; the lock of an owner that has been gone for ``stale`` seconds is broken."""
        lock, mine = f"{name}.lock", json.dumps({"owner": uuid.uuid4().hex, "at": time.time()}).encode()
        until = time.monotonic() + wait
        while not self.create(lock, mine):
            held = self.read(lock)
            if held and time.time() - json.loads(held)["at"] > stale and self.read(lock) == held:
                self.delete(lock)
            elif time.monotonic() > until:
                raise PipelineError("PROMOTION_CONFLICT", f"{name} is locked")
            else:
                time.sleep(0.02)
        try:
            yield
        finally:
            if self.read(lock) == mine:
                self.delete(lock)


def _encode(value):
    return value.astimezone(timezone.utc).isoformat() if isinstance(value, datetime) else value


class Records:
    """JSON documents by key."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.files, self.schema = Files(spark, root), schema

    def get(self, key: str) -> dict | None:
        data = self.files.read(f"{key}.json")
        return json.loads(data) if data else None

    def put(self, key: str, record: dict) -> dict:
        self.files.write(f"{key}.json", json.dumps({k: _encode(v) for k, v in record.items()}).encode())
        return record

    def add(self, key: str, record: dict) -> bool:
        """Whether the key was new; an older record stays as it is."""
        return self.files.create(f"{key}.json", json.dumps({k: _encode(v) for k, v in record.items()}).encode())

    def scan(self, strict: bool = False) -> DataFrame:
        """All records; malformed documents are left out, or refused if ``strict``.  No folder is no records."""
        spark = self.files.spark
        reader = spark.read.schema(self.schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("mode", "FAILFAST" if strict else "DROPMALFORMED")
        try:
            return reader.json(self.files.root)
        except AnalysisException:
            return spark.createDataFrame([], self.schema)


class JobStore(Records):
    """Jobs by id, with idempotent creation, state transitions and worker leases."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, f"{root}/jobs", JOB)
        self.keys = Records(spark, f"{root}/idempotency", "jobId string")

    def create_or_get(self, job: dict, now: datetime) -> tuple[dict, bool]:
        """The job of this idempotency key: the one there is, or ``job`` as a new one (then True)."""
        key = job.get("idempotencyKey") or mint("auto")
        name = hashlib.sha256(f"{job['tenantId']}\0{key}".encode()).hexdigest()
        new = {"status": "UPLOAD_PENDING", "stateVersion": 0, "attempts": 0, "replays": 0, "createdAt": now, "updatedAt": now} | job | {"idempotencyKey": key}
        if not self.keys.add(name, {"jobId": new["jobId"]}):
            known = self.get(self.keys.get(name)["jobId"])
            if known is not None:
                return known, False
        return self.put(new["jobId"], new), True

    def _change(self, job_id: str, change) -> dict:
        with self.files.locked(job_id):
            job = self.get(job_id)
            if job is None:
                raise PipelineError("STORE_ERROR", f"no job {job_id}")
            new = change(job)
            return self.put(job_id, job | new | {"stateVersion": job.get("stateVersion", 0) + 1})

    def transition(self, job_id: str, before: str, after: str, now: datetime, token: str | None = None) -> dict:
        """Move a job along an edge of the life cycle; the holder of a lease must show it."""

        def change(job: dict) -> dict:
            if token and job.get("leaseToken") and token != job["leaseToken"]:
                raise PipelineError("LEASE_CONFLICT", f"{job_id} is leased by {job.get('lockedBy')}")
            if job["status"] != before or (before, after) not in jobs.EDGES:
                raise PipelineError("STATE_CONFLICT", f"{job_id}: {before} to {after}, at {job['status']}")
            return {"status": after, "updatedAt": now}

        return self._change(job_id, change)

    def acquire(self, job_id: str, worker: str, now: datetime, seconds: int = jobs.LEASE_SECONDS) -> str:
        """Lease a runnable job; a lease that has run out is taken over."""
        token = mint("lease")

        def change(job: dict) -> dict:
            if job["status"] not in ("UPLOAD_PENDING", "QUEUED"):
                raise PipelineError("STATE_CONFLICT", f"{job_id} is not runnable ({job['status']})")
            if job.get("leaseToken") and datetime.fromisoformat(job["leaseExpiresAt"]) > now:
                raise PipelineError("LEASE_CONFLICT", f"{job_id} is locked by {job['lockedBy']}")
            return {"leaseToken": token, "lockedBy": worker, "leaseExpiresAt": now + timedelta(seconds=seconds), "updatedAt": now}

        self._change(job_id, change)
        return token

    def renew(self, job_id: str, token: str, now: datetime, seconds: int = jobs.LEASE_SECONDS) -> dict:
        def change(job: dict) -> dict:
            if job.get("leaseToken") != token:
                raise PipelineError("LEASE_CONFLICT", f"{job_id} is leased by {job.get('lockedBy')}")
            return {"leaseExpiresAt": now + timedelta(seconds=seconds), "updatedAt": now}

        return self._change(job_id, change)

    def finish(self, job_id: str, now: datetime, **changes) -> dict:
        """Set the outcome and give the lease back."""
        return self._change(job_id, lambda job: changes | {"leaseToken": None, "lockedBy": None, "leaseExpiresAt": None, "updatedAt": now})


class Stores:
    """The stores of one data folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jobs = JobStore(spark, self.root)
        self.dead = Records(spark, f"{self.root}/dlq", DEAD_LETTER)
        self.quarantine = Records(spark, f"{self.root}/quarantine", DEAD_LETTER + ", sourceUri string")
        self.seen = Records(spark, f"{self.root}/dedupe", "fingerprint string, jobId string, at timestamp")
        self.orphans = Records(spark, f"{self.root}/orphans", "eventId string, jobId string, at timestamp")
        self.layers = Records(spark, f"{self.root}/catalog", LAYER)
        self.events = Records(spark, f"{self.root}/events", "eventId string, eventType string, tenantId string, jobId string, layerId string, occurredAt timestamp")

    def emit(self, kind: str, now: datetime, **fields) -> dict:
        """Append an event; each is a document of its own, so concurrent emitters never meet."""
        event = {"eventId": mint("evt"), "eventType": kind, "occurredAt": now} | fields
        return self.events.put(event["eventId"], event)

    def first_seen(self, fingerprint: str, job_id: str, now: datetime) -> bool:
        """Whether an event's fingerprint is new."""
        return self.seen.add(fingerprint.removeprefix("sha256:"), {"fingerprint": fingerprint, "jobId": job_id, "at": now})


# --- listings -------------------------------------------------------------------------------


def newest_first(records: DataFrame, at: str, *ties: str, tenant: str | None = None) -> DataFrame:
    """Jobs by creation, dead letters by failure: the latest first, of one tenant if asked."""
    found = records if tenant is None else records.where(F.col("tenantId") == tenant)
    return found.orderBy(F.desc(at), *ties)


def by_idempotency_key(records: DataFrame, key: str, order: tuple[str, ...] = ("createdAt", "jobId")) -> DataFrame:
    """The first job of each idempotency key: one row a key, by partial aggregation."""
    first = F.min(F.struct(*order, F.struct(*[c for c in records.columns if c not in order and c != key]).alias("_rest"))).alias("_f")
    return records.where(F.col(key).isNotNull()).groupBy(key).agg(first).select(key, *[F.col(f"_f.{c}") for c in order], "_f._rest.*")


def dead_letter_depth(dead: DataFrame) -> DataFrame:
    """How many jobs are dead-lettered, by tenant."""
    return dead.groupBy("tenantId").agg(F.count_distinct("jobId").alias("depth"))


def layer_health(manifests: DataFrame, now: Column) -> DataFrame:
    """Published layers with the age of their tiles, by layer id."""
    age = F.greatest(F.lit(0), F.unix_timestamp(now) - F.unix_timestamp("generatedAt"))
    return manifests.select("layerId", "tenantId", "tileVersion", "minZoom", "maxZoom", "tileCount", "generatedAt", age.alias("stalenessSeconds")).orderBy("layerId", "tenantId")


def replay_sources(asked: DataFrame, quarantined: DataFrame, staged: DataFrame) -> DataFrame:
    """``jobId, source`` to run again from: what was quarantined, else the staged upload, else null."""
    q, s = quarantined.select("jobId", F.col("source").alias("_q")), staged.select("jobId", F.col("source").alias("_s"))
    return asked.select("jobId").join(q, "jobId", "left").join(s, "jobId", "left").select("jobId", F.coalesce("_q", "_s").alias("source"), F.when(F.col("_q").isNotNull(), "quarantine").when(F.col("_s").isNotNull(), "staging").alias("origin"))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Layers of a catalog file, a JSON array of them; no file is no layers."""
    try:
        return spark.read.schema(LAYER).option("multiLine", True).json(path)
    except AnalysisException:
        return spark.createDataFrame([], LAYER)


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Live manifests ``root/manifests/tenant/layer/manifest.json``; unreadable ones are left out."""
    try:
        return spark.read.schema(MANIFEST).option("multiLine", True).option("mode", "DROPMALFORMED").json(f"{root}/manifests/*/*/manifest.json").where("layerId is not null")
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST)
