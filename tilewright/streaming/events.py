"""Streaming forms of the event operators: exact or bounded deduplication, decisions and dead letters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import properties
from ..operators import jobs


def with_fingerprint(events: DataFrame, *parts: str) -> DataFrame:
    return events.withColumn("fingerprint", properties.fingerprint("event", *[F.col(p) for p in parts]))


def dedupe_within(events: DataFrame, time: str, delay: str) -> DataFrame:
    """First event of each fingerprint; state is kept as long as ``delay``, later repeats pass."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(["fingerprint"])


def dedupe_exact(events: DataFrame) -> DataFrame:
    """First event of each fingerprint for ever; state grows with the distinct fingerprints."""
    return events.dropDuplicates(["fingerprint"])


_STATE = "status string, version long"


def _advance(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    legal = set(jobs.EDGES)
    status, version = state.get if state.exists else ("UPLOAD_PENDING", 1)
    out = []
    for row in sorted((r for b in batches for r in b.itertuples(index=False)), key=lambda r: (r.ts, r.event_id)):
        moved = (status, row.status) in legal
        if moved:
            status, version = row.status, version + 1
        out.append((key[0], row.event_id, status, version, moved))
    state.update((status, version))
    yield pd.DataFrame(out, columns=["job_id", "event_id", "status", "version", "accepted"])


def job_states(events: DataFrame) -> DataFrame:
    """Conditional transitions of each job from ``job_id, event_id, ts, status``; illegal ones are refused."""
    out = "job_id long, event_id long, status string, version long, accepted boolean"
    return events.groupBy("job_id").applyInPandasWithState(_advance, out, _STATE, "append", GroupStateTimeout.NoTimeout)


def counters(events: DataFrame, time: str, delay: str, window: str) -> DataFrame:
    """Events by window and type with a watermark for late ones."""
    return events.withWatermark(time, delay).groupBy(F.window(time, window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
