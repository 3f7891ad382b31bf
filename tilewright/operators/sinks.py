"""Tile and record sinks."""

from __future__ import annotations

import posixpath
import uuid

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tiles(tiles: DataFrame, path: str, version: str) -> None:
    """The canonical store: Parquet by version and zoom, so a request reads one folder; a zoom is spread over tasks by tile."""
    tiles.withColumn("version", F.lit(version)).repartition("z", "x", "y").write.mode("append").partitionBy("version", "z").parquet(path)


def read_tiles(spark, path: str, version: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("version") == version)


def export_tree(tiles: DataFrame, root: str) -> int:
    """``root/z/x/y.pbf`` files for a serving tier, written by the executors; how many tiles there were.

    ``root`` is a path or URI (file, s3, gs, hdfs) that all executors reach.  A file is written beside
    its place and moved there, so a task that runs twice leaves the same files.
    """

    def run(batches):
        fs, base = pyarrow.fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (pyarrow.fs.LocalFileSystem(), root)
        made, n = set(), 0
        for batch in batches:
            for z, x, y, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                folder = posixpath.join(base, str(z), str(x))
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                fresh = f"{folder}/{y}.{uuid.uuid4().hex}.tmp"
                with fs.open_output_stream(fresh) as out:
                    out.write(data)
                fs.move(fresh, f"{folder}/{y}.pbf")
                n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return tiles.select("z", "x", "y", "data").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n


def append_records(records: DataFrame, path: str) -> None:
    """Append-only JSON lines, such as audit records."""
    records.write.mode("append").json(path)


def read_records(spark, path: str, schema: str, strict: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)
