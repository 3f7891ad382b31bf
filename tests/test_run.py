"""Jobs from source to published tiles, and the stores around them."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tilewright.operators import publish, run, sinks, stores, tiles
from tilewright.operators.errors import PipelineError, error_code
from tilewright.sources import geojson

NOW = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
SQUARE = {"type": "Polygon", "coordinates": [[[13.40, 52.51], [13.41, 52.51], [13.41, 52.52], [13.40, 52.52], [13.40, 52.51]]]}


@pytest.fixture
def data(spark, tmp_path):
    return stores.Stores(spark, str(tmp_path / "data")), publish.Registry(tmp_path / "registry"), tmp_path


def source(folder, features, name="in.geojson"):
    path = folder / name
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "id": i, "geometry": g, "properties": {"parcelId": f"p{i}"}} for i, g in enumerate(features)]}))
    return f"file://{path}"


def job(uri, job_id="job_1", **more):
    return {"jobId": job_id, "tenantId": "tenant-a", "layerId": "parcels", "sourceUri": uri, "sourceFormat": "GEOJSON", "category": "PARCEL", "idempotencyKey": f"key-{job_id}"} | more


def test_a_job_is_published(spark, data):
    kept, registry, folder = data
    config = tiles.TileConfig(layer="parcel_boundary", min_zoom=10, max_zoom=12)
    done = run.run_job(kept, job(source(folder, [SQUARE, {"type": "Point", "coordinates": [13.405, 52.515]}])), registry, config, clock=lambda: NOW)
    assert done["featureCount"] == 2 and done["tileCount"] >= 3
    record = kept.jobs.get("job_1")
    assert record["status"] == "COMPLETED" and record["leaseToken"] is None and record["stateVersion"] >= 7
    assert registry.get("tenant-a", "parcels")["currentTileVersion"] == done["tileVersion"]
    files = stores.Files(spark, kept.root)
    root = f"tiles/tenant-a/parcels/versions/{done['tileVersion']}"
    candidate = publish.read_candidate(files, root)
    assert candidate["tileCount"] == done["tileCount"] and files.exists(f"{root}/_SUCCESS")
    publish.verify(publish.tile_entries(spark, f"{kept.root}/{root}"), candidate)
    latest = json.loads(files.read("manifests/tenant-a/parcels/latest.json"))
    assert latest == publish.tile_manifest(candidate) == json.loads(files.read("manifests/tenant-a/parcels/manifest.json"))
    (health,) = stores.layer_health(stores.read_manifests(spark, kept.root), F.lit(NOW + timedelta(seconds=90))).collect()
    assert (health.layerId, health.tileVersion, health.tileCount, health.stalenessSeconds) == ("parcels", done["tileVersion"], done["tileCount"], 90)
    assert [r.layerId for r in kept.layers.scan().collect()] == ["parcels"]
    assert {r.eventType for r in kept.events.scan().collect()} == {"vector.tile.version.promoted", "vector.tile.job.completed"}
    with pytest.raises(PipelineError, match="STATE_CONFLICT"):
        run.run_job(kept, job("file:///none"), registry, config)
    found = tiles.inspect(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pbf").load(f"{kept.root}/{root}").select(F.lit(0).alias("z"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), F.col("content").alias("data")))
    assert {r.layer for r in found.collect()} == {"parcel_boundary"}


def test_a_bad_source_is_quarantined_and_dead_lettered(spark, data):
    kept, registry, folder = data
    bad = job(source(folder, [{"type": "Point", "coordinates": [500, 0]}]), "job_2")
    with pytest.raises(PipelineError, match="INVALID_GEOJSON"):
        run.run_with_retries(kept, bad, lambda: run.run_job(kept, bad, registry, clock=lambda: NOW), clock=lambda: NOW)
    record = kept.jobs.get("job_2")
    assert (record["status"], record["errorCode"], record["failedStage"], record["replayEligible"]) == ("FAILED", "INVALID_GEOJSON", "VALIDATING", False)
    assert registry.get("tenant-a", "parcels") is None
    assert [(r.jobId, r.attempts) for r in kept.dead.scan().collect()] == [("job_2", 1)]
    assert kept.quarantine.get("tenant-a/job_2")["sourceUri"] == bad["sourceUri"]
    assert run.replay(kept, "job_2", lambda j: {}, "try again", clock=lambda: NOW) == "NOT_ALLOWED"
    assert [(r.tenantId, r.depth) for r in stores.dead_letter_depth(kept.dead.scan()).collect()] == [("tenant-a", 1)]


def test_transient_failures_are_retried(data):
    kept, _, _ = data
    kept.jobs.create_or_get(job("file:///x"), NOW)
    slept, calls = [], []

    def attempt():
        calls.append(1)
        if len(calls) < 3:
            raise PipelineError("STORE_ERROR")
        return {"ok": True}

    assert run.run_with_retries(kept, job("file:///x"), attempt, sleep=slept.append) == {"ok": True} and slept == [30, 60]
    calls.clear()
    slept.clear()

    def fails():
        raise TimeoutError("slow")

    with pytest.raises(TimeoutError):
        run.run_with_retries(kept, job("file:///x"), fails, clock=lambda: NOW, sleep=slept.append)
    assert slept == [30, 60, 120] and kept.dead.get("tenant-a/job_1")["attempts"] == 4
    with pytest.raises(PipelineError, match="LEASE_CONFLICT"):
        run.run_with_retries(kept, job("file:///x", "job_9"), lambda: (_ for _ in ()).throw(PipelineError("LEASE_CONFLICT")), sleep=slept.append)
    assert kept.dead.get("tenant-a/job_9") is None


def test_tenants_are_checked_first(data):
    kept, registry, _ = data
    for wrong in ({"tenantId": "A B"}, {"layerId": "../x"}, {"sourceUri": "s3://b/input/tenant-b/f.geojson"}):
        with pytest.raises(PipelineError, match="TENANT_MISMATCH"):
            run.run_job(kept, job("file:///x", f"job_{len(str(wrong))}") | wrong, registry)


def test_leases_and_idempotent_creation(data):
    kept, _, _ = data
    first, new = kept.jobs.create_or_get(job("file:///x"), NOW)
    again, other = kept.jobs.create_or_get(job("file:///x", "job_7", idempotencyKey="key-job_1"), NOW)
    assert new and not other and again["jobId"] == first["jobId"] == "job_1" and kept.jobs.get("job_7") is None
    token = kept.jobs.acquire("job_1", "a", NOW)
    with pytest.raises(PipelineError, match="LEASE_CONFLICT"):
        kept.jobs.acquire("job_1", "b", NOW + timedelta(seconds=899))
    kept.jobs.renew("job_1", token, NOW + timedelta(seconds=500))
    with pytest.raises(PipelineError, match="LEASE_CONFLICT"):
        kept.jobs.acquire("job_1", "b", NOW + timedelta(seconds=1000))
    taken = kept.jobs.acquire("job_1", "b", NOW + timedelta(seconds=1401))
    with pytest.raises(PipelineError, match="LEASE_CONFLICT"):
        kept.jobs.transition("job_1", "UPLOAD_PENDING", "QUEUED", NOW, token)
    with pytest.raises(PipelineError, match="STATE_CONFLICT"):
        kept.jobs.transition("job_1", "UPLOAD_PENDING", "TILING", NOW, taken)
    assert kept.jobs.transition("job_1", "UPLOAD_PENDING", "QUEUED", NOW, taken)["status"] == "QUEUED"
    assert kept.first_seen("sha256:ab", "job_1", NOW) and not kept.first_seen("sha256:ab", "job_1", NOW)


def test_locks_of_the_dead_are_broken(spark, tmp_path):
    files = stores.Files(spark, str(tmp_path))
    files.create("a.lock", json.dumps({"owner": "x", "at": 0}).encode())
    with files.locked("a"):
        with pytest.raises(PipelineError, match="locked"):
            with files.locked("a", wait=0.1):
                pass
    assert not files.exists("a.lock")


def test_scans_leave_out_what_is_malformed(spark, tmp_path):
    kept = stores.Stores(spark, str(tmp_path / "d"))
    assert kept.dead.scan().collect() == [] and stores.read_catalog(spark, str(tmp_path / "none.json")).collect() == []
    kept.jobs.put("a", job("u", "a") | {"createdAt": NOW})
    kept.jobs.put("b", job("u", "b") | {"createdAt": NOW + timedelta(hours=1)})
    kept.jobs.files.write("c.json", b"{oops")
    assert [r.jobId for r in stores.newest_first(kept.jobs.scan(), "createdAt", "jobId").where("jobId is not null").collect()] == ["b", "a"]
    (tmp_path / "layers.json").write_text(json.dumps([{"layerId": "x", "tenantId": "t"}, {"layerId": "y", "tenantId": "t"}]))
    assert [r.layerId for r in stores.read_catalog(spark, str(tmp_path / "layers.json")).collect()] == ["x", "y"]


def test_tile_tree_and_store(spark, tmp_path):
    rows = [(z, x, y, bytearray(f"{z}/{x}/{y}".encode())) for z in range(3) for x in range(2**z) for y in range(2**z)]
    made = spark.createDataFrame(rows, "z int, x long, y long, data binary")
    assert sinks.export_tree(made, f"file://{tmp_path}/tree") == len(rows)
    assert (tmp_path / "tree/2/3/1.pbf").read_bytes() == b"2/3/1" and not list(tmp_path.glob("tree/**/*.tmp"))
    entries = publish.tile_entries(spark, f"{tmp_path}/tree")
    assert entries.count() == len(rows) and entries.where("z = 2").count() == 16
    sinks.write_tiles(made, f"{tmp_path}/store", "v1")
    assert sinks.read_tiles(spark, f"{tmp_path}/store", "v1").count() == len(rows)


def test_collection_writer(spark, tmp_path):
    texts = spark.createDataFrame([("f", json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "id": 3, "geometry": SQUARE, "properties": {"a": "x\"y"}}, {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {}}]}))], "path string, text string")
    read = geojson.scan(texts)
    geojson.write_collection(read, f"{tmp_path}/out")
    again = geojson.read_collection(spark, f"{tmp_path}/out")
    document = json.loads(again.first().text)
    assert document["bbox"] == [1.0, 2.0, 13.41, 52.52] and [f.get("id") for f in document["features"]] == [3, None] and document["features"][0]["properties"] == {"a": 'x"y'}
    assert [(r.ord, r.geom, r.props) for r in geojson.scan(again).collect()] == [(r.ord, r.geom, r.props) for r in read.collect()]
    geojson.write_collection(read.where("false"), f"{tmp_path}/none")
    assert json.loads(geojson.read_collection(spark, f"{tmp_path}/none").first().text) == {"type": "FeatureCollection", "bbox": None, "features": []}


def test_codes_of_exceptions():
    assert [error_code(e) for e in (PipelineError("X"), publish.PublishError("PROMOTION_CONFLICT"), FileNotFoundError(), TimeoutError(), ValueError())] == ["X", "PROMOTION_CONFLICT", "INTERNAL_ERROR", "PROCESSING_TIMEOUT", "PIPELINE_ERROR"]
