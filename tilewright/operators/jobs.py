"""Job, event, recovery and tenant operators of the operations plane, over DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import properties

# The job life cycle.
EDGES = (
    ("UPLOAD_PENDING", "QUEUED"),
    *(("QUEUED", s) for s in ("VALIDATING", "FAILED", "CANCELLED")),
    *(("VALIDATING", s) for s in ("NORMALIZING", "FAILED", "CANCELLED")),
    *(("NORMALIZING", s) for s in ("TILING", "FAILED", "CANCELLED")),
    *(("TILING", s) for s in ("PUBLISHING", "FAILED", "CANCELLED")),
    *(("PUBLISHING", s) for s in ("COMPLETED", "FAILED", "CANCELLED")),
    ("FAILED", "QUEUED"),
    ("COMPLETED", "QUEUED"),
)
ACTIVE = ("QUEUED", "VALIDATING", "NORMALIZING", "TILING", "PUBLISHING")
TERMINAL = ("COMPLETED", "FAILED", "CANCELLED")
MAX_ATTEMPTS, DELAYS, MAX_REPLAYS, LEASE_SECONDS = 4, (0, 30, 60, 120), 3, 900


def can_move(now: Column, after: Column) -> Column:
    return F.concat_ws(">", now, after).isin(*[f"{a}>{b}" for a, b in EDGES])


def dashboard_bucket(status: Column) -> Column:
    working = ("VALIDATING", "NORMALIZING", "TILING", "PUBLISHING")
    return F.when(status.isin(*working), "active").otherwise(F.lower(status))


def job_states(jobs: DataFrame) -> DataFrame:
    """Jobs by dashboard bucket."""
    return jobs.groupBy(dashboard_bucket(F.col("status")).alias("bucket")).agg(F.count("*").alias("n"))


def ingest_decision(status: Column, seen: Column) -> Column:
    """What an arriving event does: no job, a repeat, a start, or the acknowledgement of a finished job."""
    return F.when(status.isNull(), "ORPHAN").when(seen, "DUPLICATE").when(status == "UPLOAD_PENDING", "START_RUN").when(status.isin(*ACTIVE), "DUPLICATE").otherwise("TERMINAL_ACK")


def first_events(events: DataFrame, key: str, *order: str) -> DataFrame:
    """The first event of each key, by partial aggregation: a task sends one row a key, however many repeats there are."""
    rest = [c for c in events.columns if c != key]
    first = events.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return first.select(key, "_first.*").select(*events.columns)


def unseen(events: DataFrame, store: DataFrame, key: str) -> DataFrame:
    return events.join(store, key, "left_anti")


def orphans(events: DataFrame, jobs: DataFrame, key: str) -> DataFrame:
    return events.join(jobs, key, "left_anti")


def lease_granted(expires: Column, status: Column, now: Column) -> Column:
    """A runnable job without a live lease."""
    return status.isin("UPLOAD_PENDING", "QUEUED") & (expires.isNull() | (expires <= now))


def retry_delay(error_class: Column, attempt: Column) -> Column:
    """Seconds until the next attempt (counted from 1), null when there is none."""
    steps = F.array(*[F.lit(d) for d in DELAYS])
    return F.when((error_class == "TRANSIENT") & (attempt < MAX_ATTEMPTS), F.element_at(steps, F.least(attempt + 1, F.lit(len(DELAYS)))))


def dead_letters(failures: DataFrame, *order: str) -> DataFrame:
    """The failure of each job that is last in ``order``; lost leases and state conflicts are not failures of the job."""
    real = failures.where(~F.coalesce(F.col("error_code").isin("LEASE_CONFLICT", "STATE_CONFLICT"), F.lit(False)))
    rest = [c for c in failures.columns if c != "job_id"]
    last = real.groupBy("job_id").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return last.select("job_id", "_last.*").select(*failures.columns)


def replay_decision(status: Column, error_code: Column, replays: Column, new_version: Column) -> Column:
    failed = F.when(~properties.replay_eligible(error_code), "NOT_ALLOWED")
    bounded = F.when(replays >= MAX_REPLAYS, "LIMIT_REACHED").otherwise("REPLAY")
    return (
        F.when(status.isNull(), "NOT_FOUND")
        .when((status == "COMPLETED") & ~new_version, "NO_OP")
        .when(status == "CANCELLED", "NOT_ALLOWED")
        .when(~status.isin(*TERMINAL), "ALREADY_ACTIVE")
        .when(status == "FAILED", F.coalesce(failed, bounded))
        .otherwise(bounded)
    )


def tenant_scoped(df: DataFrame, tenant: str) -> DataFrame:
    """The mandatory row filter; a malformed tenant id sees nothing."""
    return df.where((F.col("tenant_id") == tenant) & properties.tenant_id_ok(F.lit(tenant)))


def catalog(layers: DataFrame, tenant: str | None = None, category: str | None = None, market: str | None = None) -> DataFrame:
    """Layers of a tenant and category whose name or a tag contains the market, by layer id."""
    found = layers
    if tenant is not None:
        found = found.where(F.col("tenant_id") == tenant)
    if category is not None:
        found = found.where(F.col("category") == category)
    if market is not None:
        part = market.lower()
        found = found.where(F.lower("name").contains(part) | F.exists("tags", lambda t: F.lower(t).contains(part)))
    return found.orderBy("layer_id")


def audit_query(audit: DataFrame, where: Column | None = None, limit: int = 200) -> DataFrame:
    """Latest audit records first; ``append_seq`` gives the order of writing."""
    found = audit if where is None else audit.where(where)
    return found.orderBy(F.desc("append_seq")).limit(limit)


def version_chain(publications: DataFrame) -> DataFrame:
    """Each publication with the version it replaced."""
    window = Window.partitionBy("layer_id").orderBy("occurred_at", "version")
    return publications.withColumn("previous_version", F.lag("version").over(window))
