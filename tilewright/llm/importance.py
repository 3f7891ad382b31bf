"""Operator 1: quality by importance resampling.

Two generative models over words and word pairs, hashed into BUCKETS, are estimated: one from all
texts (raw), one from texts labelled good (target).  A text's log importance is the log ratio of its
probability under the two: the sum over its n-grams of log target / raw.  Gumbel noise, a hash of
``doc_id``, is added to that, and the ``share`` of documents with the largest sums is taken: a sample
without replacement with odds in proportion to importance.

The raw model counts every document.  The target model uses at most TARGET_ROWS labelled rows,
those of smallest hash of ``doc_id``.  The cut between taken and not is found by counting sums in
BINS bins and narrowing to the bin that holds it, so neither rows nor sums go to one task.

Edge cases: null or empty text has no n-grams, the importance of which is lowest, and is never
taken; a null ``doc_id`` gets the noise of a null; rows that repeat a ``doc_id`` are scored one by
one, and rows that tie with the last one taken are taken too; without good labels all importances
are 0; an empty table gives no rows; further columns are ignored by ``importance``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, small_batches
from .words import column_bytes, hash_words, mix64

BUCKETS = 1 << 14
TARGET_ROWS = 20_000
SHARE = 0.85
BINS = 4096
SEED = 17


def _buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """N-gram buckets of texts and how many each text has: its words, then its word pairs."""
    words, at = hash_words(texts, lower=True)
    text = np.repeat(np.arange(len(texts)), np.diff(at))
    together = text[1:] == text[:-1]
    pairs = mix64(words[:-1] * np.uint64(3) + words[1:])[together]
    values = np.concatenate([words, pairs]) >> np.uint64(64 - 14)
    owners = np.concatenate([text, text[1:][together]])
    return values.astype(np.int64), owners


def models(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log target / raw of each bucket."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(TARGET_ROWS)
    flagged = docs.select("doc_id", "text").join(F.broadcast(good.withColumn("good", F.lit(True))), "doc_id", "left").select(F.coalesce("good", F.lit(False)).alias("good"), "text")

    def run(batches):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            values, owners = _buckets(column_bytes(batch.column(1)))
            raw += np.bincount(values, minlength=BUCKETS)
            good = np.array(batch.column(0).to_pylist(), bool)
            target += np.bincount(values[good[owners]], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], ["bucket", "raw", "target"])

    sums = flagged.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for row in sums.collect():  # at most BUCKETS rows
        raw[row.bucket] += row.raw
        target[row.bucket] += row.target
    if target.sum() == BUCKETS:
        return np.zeros(BUCKETS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def importance(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``doc_id, n_ngrams, log_importance`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            values, owners = _buckets(column_bytes(batch.column(1)))
            counts = np.bincount(owners, minlength=n)
            sums = np.bincount(owners, weights=shared.value[values], minlength=n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts.astype(np.int64)), pa.array(sums, pa.float64(), mask=counts == 0)], ["doc_id", "n_ngrams", "log_importance"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, n_ngrams long, log_importance double")


def cut(keys: DataFrame, k: int) -> tuple[int, int] | None:
    """The k-th largest pair (q, tie) of ``keys``, by narrowing bins."""
    low, high = keys.agg(F.min("q"), F.max("q")).first()
    if low is None or k <= 0:
        return None
    while True:
        width = max(1, -(-(high - low + 1) // BINS))
        bins = keys.where(F.col("q").between(low, high)).groupBy(F.floor((F.col("q") - low) / width).alias("bin")).count().collect()  # BINS rows
        for row in sorted(bins, reverse=True):
            if k <= row["count"]:
                low, high, inside = low + row.bin * width, min(high, low + (row.bin + 1) * width - 1), row["count"]
                break
            k -= row["count"]
        if inside <= BINS or width == 1:
            break
    last = keys.where(F.col("q").between(low, high)).orderBy(F.desc("q"), F.desc("tie")).limit(k).agg(F.min(F.struct("q", "tie")).alias("x")).first().x
    return last.q, last.tie


def resample(docs: DataFrame, labels: DataFrame, share: float = SHARE) -> DataFrame:
    """``doc_id, n_ngrams, log_importance, noisy, kept`` of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "importance")
    scored = importance(docs, models(docs, labels))
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    noisy = scored.withColumn("noisy", F.col("log_importance") - F.log(-F.log(uniform)))
    keyed = noisy.withColumn("q", F.floor(F.col("noisy") * float(1 << 32))).withColumn("tie", F.xxhash64("doc_id", F.lit(SEED + 1)))
    keyed = scratch.keep(keyed, "keyed")
    usable = keyed.where("q is not null")
    last = cut(usable.select("q", "tie"), int(round(share * usable.count())))
    taken = F.lit(False) if last is None else F.coalesce((F.col("q") > last[0]) | ((F.col("q") == last[0]) & (F.col("tie") >= last[1])), F.lit(False))
    return keyed.select("doc_id", "n_ngrams", "log_importance", "noisy", taken.alias("kept"))
