import io
import json
import struct
import zipfile
from datetime import datetime, timezone

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tilewright.functions import crs, geometry, mvt, properties, simplify, tilemath
from tilewright.operators import assign, ingest, jobs, publish, tiles
from tilewright.sources import geojson, shapefile

PARCEL = {"type": "Polygon", "coordinates": [[[-73.985, 40.753], [-73.984, 40.753], [-73.984, 40.754], [-73.985, 40.754], [-73.985, 40.753]]]}


def document(*features):
    return json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "id": i + 1, "geometry": g, "properties": p} for i, (g, p) in enumerate(features)]})


def texts(spark, *documents):
    return spark.createDataFrame([(f"f{i}", d) for i, d in enumerate(documents)], "path string, text string")


def test_known_command_streams():
    assert mvt.encode_points([(25, 17)]) == [9, 50, 34]
    assert mvt.encode_lines([[(2, 2), (10, 10)]]) == [9, 4, 4, 10, 16, 16]
    assert len(mvt.encode_rings([[[(0, 0), (10, 0), (10, 10), (0, 10)]]])) == 11
    assert mvt.encode_rings([[[(0, 0), (5, 5)]]]) == []


@given(st.integers(-(2**31), 2**31), st.integers(0, 2**64 - 1))
def test_codes_round_trip(signed, unsigned):
    code = mvt.zigzag(signed)
    assert (code >> 1) ^ -(code & 1) == signed
    assert mvt.read_varint(mvt.varint(unsigned), 0)[0] == unsigned


def test_layer_round_trip_and_errors():
    layer = mvt.Layer("parcel_boundary", 4096)
    layer.add(7, "Point", mvt.encode_points([(1, 2)]), {"a": "x", "b": 10, "c": 10.0, "d": True})
    layer.add(None, "Point", [], {})
    (found,) = mvt.decode(mvt.compress(layer.encode()))
    assert (found["name"], found["version"], found["keys"], found["value_count"]) == ("parcel_boundary", 2, ["a", "b", "c", "d"], 4)
    assert found["features"] == [{"id": 7, "geom_type": 1, "commands": 3, "tags": 4}]
    with pytest.raises(ValueError):
        mvt.decode(b"\x1a\xff")


def test_simplify_keeps_what_is_far():
    line = np.array([[0, 0], [1, 0.001], [2, 0], [3, 5], [4, 0]], float)
    assert simplify.simplify_line(line, 0.1).tolist() == [[0, 0], [2, 0], [3, 5], [4, 0]]
    assert simplify.simplify("Polygon", [[[(0, 0), (0.001, 0), (0.001, 0.001), (0, 0)]]], 0.1) is None


def test_repair(spark):
    ring = lambda *c: [{"x": float(x), "y": float(y)} for x, y in c]
    good, nan = ring((0, 0), (0, 0), (1, 0), (1, 1)), ring((0, 0), (float("nan"), 1), (1, 1))
    cases = [("Polygon", [[good]]), ("Polygon", [[ring((0, 0), (1, 1), (1, 1), (0, 0))]]), ("LineString", [[nan]]), ("Point", [[ring((float("inf"), 0))]]), ("MultiPolygon", [[good], [ring((0, 0))]])]
    df = spark.createDataFrame([(i, {"kind": k, "parts": p}) for i, (k, p) in enumerate(cases)], f"i int, geom {geometry.GEOMETRY}")
    found = {r.i: r.g for r in df.select("i", geometry.repair(F.col("geom")).alias("g")).collect()}
    assert len(found[0].parts[0][0]) == 4 and found[1] is None and len(found[2].parts[0][0]) == 2 and found[3] is None and len(found[4].parts) == 1


def test_properties_stop_at_the_budget(spark):
    props = {"assetId": '"a"', "note": json.dumps("x" * 480), "ownerName": '"o"', "parcelId": '"p"', "zip": "1"}
    row = spark.createDataFrame([(props,)], "p map<string,string>").select(properties.clean(F.col("p")).alias("c"), properties.tile_properties(F.col("p"), "core").alias("k")).first()
    assert set(row.c) == {"assetId", "note", "parcelId", "zip"} and set(row.k) == {"assetId", "parcelId"}
    tight = spark.createDataFrame([(props,)], "p map<string,string>").select(properties.clean(F.col("p"), max_bytes=100).alias("c")).first()
    assert set(tight.c) == {"assetId"}


def test_crs(spark):
    rows = [("WGS84", 'GEOGCS["GCS_WGS_1984"]'), ("WEB_MERCATOR", 'PROJCS["x",GEOGCS["y",AUTHORITY["EPSG","4326"]],AUTHORITY["EPSG","3857"]]'), ("UNKNOWN", None), ("UNSUPPORTED", 'PROJCS["z",AUTHORITY["EPSG","2263"]]'), ("NAD83", "GEOGCS[NAD83]")]
    df = spark.createDataFrame(rows, "want string, wkt string").select("want", crs.detect(F.col("wkt")).alias("got"))
    assert all(r.want == r.got for r in df.collect())


def test_geojson_scan_to_tiles(spark):
    text = document((PARCEL, {"parcelId": "p1", "v": 11.0, "n": 10, "ownerName": "x"}), (None, {}), ({"type": "Point", "coordinates": [0, 0]}, {"assetId": "a"}))
    bad = document(({"type": "Point", "coordinates": [200, 0]}, {}), (PARCEL, {}))
    scanned = geojson.scan(texts(spark, text, bad, "{oops", json.dumps(PARCEL)))
    found = geojson.features(scanned)
    assert {(r.path, r.ord) for r in found.collect()} == {("f0", 0), ("f0", 2), ("f3", 0)}
    first = found.where("path = 'f0' and ord = 0").first()
    assert first.props == {"parcelId": '"p1"', "v": "11.0", "n": "10", "ownerName": '"x"'} and first.id == 1
    one = found.where("path = 'f0'")
    clean = ingest.normalize(one)
    row = ingest.summary(clean, one).first()
    assert (row.features, row.rejected, row.null_island, row.kind, row.error_code) == (2, 0, 1, "MIXED", None)
    config = tiles.TileConfig(layer="parcel_boundary", min_zoom=12, max_zoom=14)
    built = tiles.build(clean.select("ord", "id", "geom", "props"), config).cache()
    layers = tiles.inspect(built).collect()
    assert {r.z for r in layers} == {12, 13, 14} and all(r.version == 2 and "ownerName" not in r["keys"] for r in layers)
    assert tiles.run_stats(built).first().tiles == built.count()
    assert sum(r.tiles for r in tiles.zoom_stats(built).collect()) == built.count()
    again = geojson.scan(texts(spark, *[f'{{"type":"FeatureCollection","features":[{r.value}]}}' for r in geojson.write_text(one).collect()]))
    assert {r.geom.kind for r in again.collect()} == {"Polygon", "Point"}


def test_parcels_meet_the_tiles_of_their_buffered_boxes(spark):
    boxes = [(13.3995, 52.5178, 13.4012, 52.5189), (13.4013, 52.5178, 13.4029, 52.5188), (13.4061, 52.5201, 13.4089, 52.5214)]
    squares = [{"type": "Polygon", "coordinates": [[[a, b], [c, b], [c, d], [a, d], [a, b]]]} for a, b, c, d in boxes]
    found = geojson.features(geojson.scan(texts(spark, document(*[(g, {"parcelId": f"p{i}"}) for i, g in enumerate(squares)]))))
    placed = assign.assign(tiles.prepare(ingest.normalize(found)), 12, 15)
    expected = {}
    for a, b, c, d in boxes:
        (x0, y1), (x1, y0) = tiles.world(a, b), tiles.world(c, d)
        for z in range(12, 16):
            for x in range(int(x0 * 2**z - 1 / 16), int(x1 * 2**z + 1 / 16) + 1):
                for y in range(int(y0 * 2**z - 1 / 16), int(y1 * 2**z + 1 / 16) + 1):
                    expected[z, x, y] = expected.get((z, x, y), 0) + 1
    assert {(r.z, r.x, r.y): r["count"] for r in placed.groupBy("z", "x", "y").count().collect()} == expected and len(expected) > 6


def test_feature_ids_by_their_own_type(spark):
    listed = ['{"type":"Feature","id":%s,"geometry":{"type":"Point","coordinates":[1,2]},"properties":{"id":"abc"}}' % i for i in ("5", '"5"', "-1", "1.5", "18446744073709551615", "null")]
    found = geojson.scan(texts(spark, '{"type":"FeatureCollection","features":[' + ",".join(listed) + "]}")).orderBy("ord").collect()
    assert [None if r.id is None else int(r.id) for r in found] == [5, None, None, None, 18446744073709551615, None]


def test_ladder():
    rows = [{"id": i, "kind": "Point", "parts": [[[(0.0, 0.0)]]], "vertices": 1 + i % 3, "full": {"k": f"{i}" * 50}, "core": {}} for i in range(64)]
    full = tiles.build_tile(4, 8, 8, rows, tiles.TileConfig())
    assert full["instances"] == 64 and not full["mitigated"]
    small = tiles.build_tile(4, 8, 8, rows, tiles.TileConfig(target_bytes=60, hard_bytes=60))
    assert small["mitigated"] and small["dropped"] > 0 and small["instances"] + small["dropped"] == 64
    assert tiles.build_tile(4, 0, 0, rows, tiles.TileConfig()) is None
    with pytest.raises(ValueError):
        tiles.TileConfig(max_zoom=21)


def bundle(with_dbf=True, path="parcels"):
    ring = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0), (0.0, 0.0)]
    body = struct.pack("<i4d2i1i", 5, 0, 0, 1, 1, 1, len(ring), 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    records = [body, struct.pack("<i", 0), body]
    data = b"".join(struct.pack(">2i", i + 1, len(r) // 2) + r for i, r in enumerate(records))
    shp = struct.pack(">i20xi", 9994, (100 + len(data)) // 2) + struct.pack("<2i", 1000, 5) + bytes(64) + data
    names = [(b"NAME", b"C", 8, 0), (b"VALUE", b"N", 6, 2)]
    rows = b"".join(flag + n.ljust(8) + v.rjust(6) for flag, n, v in [(b" ", b"EMPIRE", b"10.5"), (b" ", b"GONE", b"1"), (b" ", b"FLATIRON", b"7")])
    dbf = struct.pack("<4BIHH20x", 3, 0, 0, 0, 3, 32 + 64 + 1, 15) + b"".join(n.ljust(11, b"\0") + k + bytes(4) + bytes([w, d]) + bytes(14) for n, k, w, d in names) + b"\x0d" + rows
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(f"{path}.shp", shp)
        if with_dbf:
            z.writestr(f"{path}.dbf", dbf)
    return out.getvalue()


def test_shapefile(spark):
    found, projection = shapefile.read_bundle(bundle())
    assert [(n, k, v) for n, k, _, v in found] == [(0, "Polygon", {"NAME": "EMPIRE", "VALUE": 10.5}), (2, "Polygon", {"NAME": "FLATIRON", "VALUE": 7.0})]
    assert [v["NAME"] for *_, v in shapefile.read_bundle(bundle(), compat=True)[0]] == ["EMPIRE", "GONE"] and projection is None
    files = spark.createDataFrame([("a", bytearray(bundle())), ("b", bytearray(bundle(False))), ("c", bytearray(bundle(path="../x")))], "path string, content binary")
    rows = shapefile.features(shapefile.scan(files), assume_wgs84=True).collect()
    assert sorted((r.path, r.error_code, r.assumed_crs) for r in rows if r.path != "a") == [("b", "MISSING_SHAPEFILE_COMPONENTS", True), ("c", "INVALID_SHAPEFILE", True)]
    assert sorted(r.id for r in rows if r.path == "a") == [1, 3]
    strict = shapefile.features(shapefile.scan(files.where("path = 'a'"))).first()
    assert strict.error_code == "UNKNOWN_CRS" and strict.geom is None


def test_publish(spark, tmp_path):
    import hashlib

    now, registry = datetime(2024, 1, 2, tzinfo=timezone.utc), publish.Registry(tmp_path)
    raw = [("0/0/0.pbf", b"abc", 0), ("1/0/1.pbf", b"de", 1)]
    entries = spark.createDataFrame([(p, f"sha256:{hashlib.sha256(d).hexdigest()}", len(d), z) for p, d, z in raw], "rel_path string, sha256 string, len long, z int")
    fold = hashlib.sha256(b"".join(p.encode() + b"\0sha256:" + hashlib.sha256(d).hexdigest().encode() + b"\0" + struct.pack("<Q", len(d)) + b"\n" for p, d, _ in raw)).hexdigest()
    manifest = {"tenantId": "tenant-a", "layerId": "l", "tileVersion": "v1", "minZoom": 0, "maxZoom": 1, "tileCount": 2, "aggregateChecksum": f"sha256:{fold}"}
    assert publish.publish(entries, manifest, registry, "me", now, None)["currentTileVersion"] == "v1"
    with pytest.raises(publish.PublishError, match="PROMOTION_CONFLICT"):
        registry.promote("tenant-a", "l", "v2", None, "me", now)
    registry.promote("tenant-a", "l", "v2", "v1", "me", now)
    assert registry.rollback("tenant-a", "l", "v1", {"v1"}, "why", "me", now)["publishStatus"] == "ROLLED_BACK"
    for change in ({"tileCount": 3}, {"maxZoom": 2}, {"aggregateChecksum": "sha256:0"}):
        with pytest.raises(publish.PublishError, match="PUBLISH_VALIDATION_FAILED"):
            publish.verify(entries, manifest | change)
    assert publish.version_stamp(now, "0a0b0c0d") == "2024-01-02T00-00-00Z-0a0b0c0d"


def test_lookup(spark):
    layers = spark.createDataFrame([("t", "l", 0, 2, "old")], "tenant_id string, layer_id string, min_zoom int, max_zoom int, tile_version string")
    pubs = spark.createDataFrame([("t", "l", "v1")], "tenant_id string, layer_id string, current_version string")
    data = spark.createDataFrame([("l", "v1", 1, 0, 1, bytearray(b"x"))], "layer_id string, version string, z int, x int, y int, data binary")
    asked = spark.createDataFrame([("t", "l", 1, 0, 1), ("t", "l", 1, 1, 1), ("t", "l", 3, 0, 0), ("u", "l", 1, 0, 1)], "tenant_id string, layer_id string, z int, x int, y int")
    found = {(r.tenant_id, r.z, r.x): (r.status, r.etag) for r in publish.lookup(asked, layers, pubs, data).collect()}
    assert found == {("t", 1, 0): (200, '"v1/1/0/1"'), ("t", 1, 1): (204, None), ("t", 3, 0): (422, None), ("u", 1, 0): (404, None)}


def test_decisions(spark):
    df = spark.createDataFrame([("FAILED", "STORE_ERROR", 0, False, "REPLAY"), ("FAILED", "INVALID_GEOJSON", 0, False, "NOT_ALLOWED"), ("FAILED", None, 0, False, "NOT_ALLOWED"), ("FAILED", "UNKNOWN_CRS", 3, False, "LIMIT_REACHED"), ("COMPLETED", None, 0, False, "NO_OP"), ("COMPLETED", None, 0, True, "REPLAY"), ("TILING", None, 0, True, "ALREADY_ACTIVE"), (None, None, 0, True, "NOT_FOUND")], "s string, c string, n int, v boolean, want string")
    assert all(r.want == r.got for r in df.select("want", jobs.replay_decision(F.col("s"), F.col("c"), F.col("n"), F.col("v")).alias("got")).collect())
    delays = spark.range(1, 6).select(jobs.retry_delay(F.lit("TRANSIENT"), F.col("id").cast("int")).alias("d")).collect()
    assert [r.d for r in delays] == [30, 60, 120, None, None]


def test_tile_math(spark):
    row = spark.range(1).select(tilemath.zigzag(F.lit(-1).cast("bigint")).alias("a"), tilemath.zigzag(F.lit(25).cast("bigint")).alias("b"), tilemath.world_y(F.lit(90.0)).alias("c"), F.round(tilemath.world_lat(tilemath.world_y(F.lit(40.75))), 9).alias("d")).first()
    assert (row.a, row.b, row.d) == (1, 50, 40.75) and abs(row.c) < 1e-9


def test_sql_names(spark):
    from tilewright.functions import registry

    registry.register(spark)
    layer = mvt.Layer("l", 4096)
    layer.add(1, "Point", mvt.encode_points([(1, 2)]), {"a": 1})
    spark.createDataFrame([(bytearray(layer.encode()), bytearray(bundle()))], "tile binary, zip binary").createOrReplaceTempView("blobs")
    row = spark.sql("select mvt_layers(tile)[0] as l, simplify_line(array(named_struct('x', 0D, 'y', 0D), named_struct('x', 1D, 'y', 0.01D), named_struct('x', 2D, 'y', 0D)), 0.1D) as s from blobs").first()
    assert (row.l.name, row.l.features, row.l["keys"], len(row.s)) == ("l", 1, ["a"], 2)
    found = spark.sql("select f.number, f.attributes from blobs, lateral read_shapefile(zip) f").collect()
    assert [r.number for r in found] == [0, 2]
