"""GeoJSON texts are read once: the plan stays small, and files without features keep their rows."""

import pytest

import __spark_entry__
from tilewright.sources import geojson

TEXTS = {
    "bad": "{",
    "null": None,
    "other": '{"type":"Topology"}',
    "none": '{"type":"FeatureCollection"}',
    "empty": '{"type":"FeatureCollection","features":[]}',
    "skips": '{"type":"FeatureCollection","features":[null,{"type":"Feature","geometry":null},{"type":"Feature","id":7,"geometry":{"type":"Point","coordinates":[1,2]},"properties":{"a":"x\\"y","b":10.0,"c":null,"d":{"e":[1]}}}]}',
    "range": '{"type":"FeatureCollection","features":[{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]}},{"type":"Feature","id":"8","geometry":{"type":"Point","coordinates":[1,200]}}]}',
    "bare": '{"type":"LineString","coordinates":[[0,0],[1,1]]}',
    "one": '{"type":"Feature","geometry":{"type":"Point","coordinates":["a",2]},"properties":{}}',
}


@pytest.mark.parametrize("query", ["read_geojson", "geojson_round_trip"])
def test_plan_is_small(spark, query):
    """4.9 million characters once: filters pushed below the scan repeated the writer for every use of a text."""
    plan = __spark_entry__.queries()[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    assert len(plan.toString()) < 300_000


def test_odd_texts(spark):
    rows = geojson.scan(spark.createDataFrame(list(TEXTS.items()), "path string, text string")).collect()
    found = sorted((r["path"], r["ord"], r["id"], r["geom"] and r["geom"]["kind"], r["props"], r["error_code"]) for r in rows if r["path"] != "skips")
    bad = "INVALID_GEOJSON"
    assert found == [
        ("bad", 0, None, None, None, bad),
        ("bare", 0, None, "LineString", {}, None),
        ("null", 0, None, None, None, bad),
        ("one", 0, None, None, {}, bad),
        ("other", 0, None, None, None, bad),
        ("range", 0, None, "Point", {}, None),
        ("range", 1, None, "Point", {}, bad),
    ]
    (kept,) = [r for r in rows if r["path"] == "skips"]
    assert (kept["ord"], kept["id"], kept["props"]) == (2, 7, {"a": '"x\\"y"', "b": "10.0", "c": "null", "d": '{"e":[1]}'})
