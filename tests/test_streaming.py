from pyspark.sql import functions as F

from tilewright.streaming import events


def run(spark, tmp_path, frame, build, name, mode="append"):
    frame.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    query = build(stream).writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "check")).start()
    query.processAllAvailable()
    query.stop()
    return spark.table(name).collect()


def test_repeats_are_dropped(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "user_id long, kind string").withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    assert len(run(spark, tmp_path, frame, lambda s: events.dedupe_exact(events.with_fingerprint(s, "user_id", "kind")), "exact")) == 2
    assert len(run(spark, tmp_path / "b", frame, lambda s: events.dedupe_within(events.with_fingerprint(s, "user_id", "kind"), "ts", "1 hour"), "bounded")) == 2


def test_job_states(spark, tmp_path):
    rows = [(1, 1, "QUEUED"), (1, 2, "COMPLETED"), (1, 3, "VALIDATING"), (2, 4, "VALIDATING")]
    frame = spark.createDataFrame(rows, "job_id long, event_id long, status string").withColumn("ts", F.timestamp_seconds(F.col("event_id")))
    found = {r.event_id: (r.status, r.version, r.accepted) for r in run(spark, tmp_path, frame, events.job_states, "states")}
    assert found == {1: ("QUEUED", 2, True), 2: ("QUEUED", 2, False), 3: ("VALIDATING", 3, True), 4: ("UPLOAD_PENDING", 1, False)}
