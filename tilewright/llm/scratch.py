"""Shared intermediate storage for the corpus operators.

Intermediate results are written as Parquet below ``spark.checkpoint.dir``, the folder that the
driver and every executor share, and read back.  That cuts lineage and survives a lost executor.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one long column that may be broadcast: some 30 MB as a hashed relation.
FEW = 1 << 20


def root(spark: SparkSession) -> str:
    """Shared folder for intermediates: ``spark.checkpoint.dir``, or a temporary one where one machine is all there is."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir is not set; the executors of {master} need a shared folder")
    return f"{tempfile.gettempdir()}/tilewright-checkpoints"


class Scratch:
    """Named intermediate tables of one operator run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{root(spark)}/tilewright-{name}-{uuid.uuid4().hex}"
        path, fs = self._fs(self.base)
        fs.deleteOnExit(path)

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def keep(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        """Write ``df`` and return it as read from storage."""
        df.write.mode("overwrite").option("compression", codec).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete an intermediate that no later step reads."""
        path, fs = self._fs(self.path(name))
        fs.delete(path, True)

    def tidy(self) -> None:
        """Have Spark delete the shuffle files of ended steps, which it does once the driver has collected its garbage."""
        self.spark.range(1).count()  # else the session still holds the last step's plan
        self.spark._jvm.System.gc()


def tasks(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the one size knob the operators scale by."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def few(df: DataFrame, rows: int = FEW) -> DataFrame:
    """``df`` (narrow) marked for broadcast if it has at most so many rows; else Spark shuffles for the join."""
    return F.broadcast(df) if df.count() <= rows else df


def free_names(df: DataFrame, *bases: str) -> list[str]:
    """Column names like ``bases`` that no column of ``df`` has, in any case of letters."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in bases:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def small_batches(spark: SparkSession, rows: int = 256, size: str = "4m") -> None:
    """Bound what a Python worker holds at once, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
