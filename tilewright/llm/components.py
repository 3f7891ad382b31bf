"""Connected components by alternating large-star and small-star steps, in DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: Edges a task: a step over fewer needs no shuffle.
EDGES = 50_000


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``edges`` (a, b).

    Loops and repeated edges are ignored; no edges give no rows.  Each step joins edges with one
    minimum a node, so no neighbourhood is ever gathered in one row or task.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, mark, step = scratch.keep(ordered, f"{name}-0"), None, 0
    while True:
        seen = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if seen == mark:
            break
        mark, step = seen, step + 1
        now = now.coalesce(-(-seen.n // EDGES) or 1)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        now = scratch.keep(after, f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
