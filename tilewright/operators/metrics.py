"""Metric series, histograms and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import properties

RESERVOIR = 4096
SALTS = 64

# Fixed values: (rule, severity, metric or numerator, denominators, threshold).
RULES = (
    ("Tile5xxRateHigh", "P1", "tile_5xx", ("tile_requests",), 0.01),
    ("OriginFailureRateHigh", "P1", "cloudfront_origin_failure_rate", (), 0.01),
    ("DlqMessageReceived", "P2", "dlq_message_count", (), 0.0),
    ("JobFailureRateHigh", "P2", "ingest_jobs_failed", ("ingest_jobs_completed", "ingest_jobs_failed"), 0.05),
    ("NoCompletedJobsWithBacklog", "P2", "jobs_stalled_with_backlog", (), 0.0),
    ("JobDurationHigh", "P3", "ingest_job_duration_seconds.p95", (), 600.0),
    ("TileSizeP95High", "P3", "geospatial_tile_size_bytes.p95", (), 512000.0),
    ("ReplayFailureRateHigh", "P2", "replay_failure_count", ("replay_requested_count",), 0.2),
    ("TenantAuthorizationFailureSpike", "P2", "tenant_authorization_denied", (), 0.0),
    ("LayerStalenessHigh", "P2", "layer_staleness_seconds_max", (), 604800.0),
    ("RollbackOccurred", "P2", "rollbacks_completed", (), 0.0),
    ("CrossTenantDenialSpike", "P2", "tenant_authorization_denied", (), 5.0),
    ("PrivilegedAccessOccurred", "P2", "privileged_access", (), 0.0),
)


def series(samples: DataFrame) -> DataFrame:
    """Sums by canonical series name, from ``name, dims, value``."""
    return samples.groupBy(properties.metric_key(F.col("name"), F.col("dims")).alias("series")).agg(F.sum("value").alias("total"))


def latest(samples: DataFrame, key: str, order: str, keep: int = RESERVOIR) -> DataFrame:
    """The last ``keep`` samples of each series.

    A series is first cut down in SALTS parts, so that no task sorts all samples of a common one.
    """
    salted = samples.withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(SALTS)))
    for by in ((key, "_salt"), (key,)):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(order)))
        salted = salted.withColumn("_rank", rank).where(F.col("_rank") <= keep).drop("_rank")
    return salted.drop("_salt")


def histogram(samples: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """count, sum, avg, min and max over all samples; nearest-rank p50 and p95 over the reservoir.

    The reservoir bounds the array that the percentiles are picked from.
    """
    whole = samples.groupBy(key).agg(F.count(value).alias("count"), F.sum(value).alias("sum"), F.avg(value).alias("avg"), F.min(value).alias("min"), F.max(value).alias("max"))
    ranked = latest(samples.where(F.col(value).isNotNull()), key, order).groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("_v"))
    pick = {f"p{p}": F.element_at("_v", (F.round(F.lit(p) / 100.0 * (F.size("_v") - 1)) + 1).cast("int")) for p in (50, 95)}
    return whole.join(ranked.withColumns(pick).drop("_v"), key, "left")


def resolve(values: DataFrame) -> DataFrame:
    """``metric, value`` from series: variants are summed, p95 and max statistics take the largest."""
    bare = F.regexp_replace("series", r"\{[^}]*\}", "")
    statistic = bare.rlike(r"\.(p95|max)$")
    return values.groupBy(bare.alias("metric")).agg(F.when(F.max(statistic.cast("int")) == 1, F.max("value")).otherwise(F.sum("value")).alias("value"))


def alerts(spark: SparkSession, metrics: DataFrame) -> DataFrame:
    """Every rule with its current value (null without data) and whether it fires; ``metrics`` is ``metric, value``."""
    rules = spark.createDataFrame([(n, s, m, list(d), t) for n, s, m, d, t in RULES], "rule string, severity string, numerator string, denominators array<string>, threshold double")
    top = rules.join(metrics.withColumnRenamed("metric", "numerator"), "numerator", "left")
    below = rules.select("rule", F.explode("denominators").alias("metric")).join(metrics, "metric").groupBy("rule").agg(F.sum("value").alias("below"))
    joined = top.join(below, "rule", "left")
    ratio = F.when(F.col("below") > 0, F.coalesce(F.col("value"), F.lit(0.0)) / F.col("below"))
    current = F.when(F.size("denominators") > 0, ratio).otherwise(F.col("value"))
    return joined.select("rule", "severity", current.alias("current_value"), "threshold", F.coalesce(current > F.col("threshold"), F.lit(False)).alias("triggered"))


def staleness(layers: DataFrame, now) -> DataFrame:
    """Seconds since each layer was generated, none below 0."""
    age = F.unix_timestamp(now) - F.unix_timestamp("generated_at")
    return layers.withColumn("staleness_seconds", F.greatest(F.lit(0), age))
