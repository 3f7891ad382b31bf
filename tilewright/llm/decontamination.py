"""Operator 3: benchmark decontamination by spaced seeds.

A seed is the hash of the words that a fixed mask selects from SPAN successive words, so a changed
word at an ignored position does not break it.  Seeds of all benchmark items are looked up for
every word of every document.  Around a hit the item is laid over the document on the hit's
diagonal, and the best run of that overlap (a match counts 1, a substitution -1) decides.

Items of fewer than SPAN words have no seed; they are looked up whole, as runs of just their words.

The benchmark is looked up in blocks of at most SEEDS seeds, each broadcast (about 24 bytes a seed)
and met by one pass over the documents, so what is broadcast has a fixed bound however large the
benchmark is: some million words of benchmark a pass.

Edge cases: null or empty texts have no words and never match; items of fewer than LEAST words are
reported like others, but no document is removed for them, as they are part of ordinary text; null
``item_id`` or ``doc_id`` are carried as null; repeated rows give repeated results, and each row is
removed or kept by its own text; without items there are no rows and all documents stay; documents
of any length are read whole; further columns are ignored or kept as they are.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import small_batches
from .words import column_bytes, hash_words, mix64

# The words that each mask looks at, of SPAN.
SPAN = 9
MASKS = ((0, 1, 3, 4, 6, 8), (0, 2, 3, 5, 7, 8), (0, 1, 2, 5, 6, 8), (0, 3, 4, 5, 7, 8))
SEEDS = 1 << 22
#: Words of the shortest item that a document is removed for.
LEAST = 5
#: An overlap counts from so many matching words, or this share of a shorter item.
MATCHING = 12
SHARE = 0.8

_FACTORS = mix64(np.arange(1, SPAN + 1, dtype=np.uint64)) | np.uint64(1)


def seeds(words: np.ndarray, mask: int) -> np.ndarray:
    """Seed at every word that has SPAN words from it on."""
    n = len(words) - SPAN + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, mask + 1, np.uint64)
    for j in MASKS[mask]:
        total += words[j : n + j] * _FACTORS[j]
    return mix64(total)


def runs(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from every word on that has so many."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, len(MASKS) + length, np.uint64)
    for j in range(length):
        total += words[j : n + j] * _FACTORS[j]
    return mix64(total)


class Index:
    """Seeds of a block of items, sorted, with a bit table before the search."""

    BITS = 22

    def __init__(self, items: list[tuple]):
        self.ids = [i for i, _ in items]
        words, self.at = hash_words([(t or "").encode() for _, t in items], lower=True)
        self.words = words
        keys, owners, places = [], [], []
        for k, (a, b) in enumerate(zip(self.at[:-1], self.at[1:], strict=True)):
            for found in [seeds(words[a:b], mask) for mask in range(len(MASKS))] if b - a >= SPAN else [runs(words[a:b], b - a)]:
                keys.append(found)
                owners.append(np.full(len(found), k))
                places.append(np.arange(len(found)))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner, self.place = keys[order], np.concatenate([*owners, np.zeros(0, int)])[order].astype(np.int64), np.concatenate([*places, np.zeros(0, int)])[order].astype(np.int64)
        self.short = sorted({int(n) for n in np.diff(self.at) if 0 < n < SPAN})
        self.bits = np.zeros(1 << self.BITS, bool)
        self.bits[self.keys >> np.uint64(64 - self.BITS)] = True

    def matches(self, words: np.ndarray, at: np.ndarray):
        """(text, item, first word in text, first word in item, words, matching words), the best of each text and item."""
        lines = set()
        for keys, length in [(seeds(words, mask), SPAN) for mask in range(len(MASKS))] + [(runs(words, n), n) for n in self.short]:
            hit = np.flatnonzero(self.bits[keys >> np.uint64(64 - self.BITS)])
            low, high = np.searchsorted(self.keys, keys[hit], "left"), np.searchsorted(self.keys, keys[hit], "right")
            some = high > low
            hit, low, high = hit[some], low[some], high[some]
            text = np.searchsorted(at, hit, "right") - 1
            whole = hit + length <= at[text + 1]
            for pos, doc, a, b in zip(hit[whole], text[whole], low[whole], high[whole], strict=True):
                lines.update((int(doc), int(self.owner[k]), int(pos - at[doc] - self.place[k])) for k in range(a, b))
        best: dict[tuple[int, int], tuple] = {}
        for doc, item, line in lines:
            run = self.overlap(words[at[doc] : at[doc + 1]], self.words[self.at[item] : self.at[item + 1]], line)
            if run and (-run[3], run) < best.get((doc, item), (1,)):
                best[doc, item] = (-run[3], run)
        return [(doc, item, *run) for (doc, item), (_, run) in sorted(best.items())]

    @staticmethod
    def overlap(text: np.ndarray, item: np.ndarray, line: int):
        """Best run of ``item`` laid over ``text`` with its first word at ``line``, if it counts."""
        a, b = max(0, line), min(len(text), line + len(item))
        same = text[a:b] == item[a - line : b - line]
        sums = np.concatenate([[0], np.cumsum(np.where(same, 1, -1))])
        least = np.minimum.accumulate(sums)
        end = int(np.argmax(sums - least))
        start = int(np.flatnonzero(sums[: end + 1] == least[end])[-1])
        matching = int(same[start:end].sum())
        need = min(MATCHING, int(np.ceil(SHARE * len(item))))
        return (a + start, a + start - line, end - start, matching) if matching >= need else None


_OUT = "doc_id long, item {item}, doc_start long, item_start long, n_words long, n_matching long"


def _indexes(docs: DataFrame, benchmark: DataFrame, least: int) -> list:
    """Broadcast indexes of the items of ``least`` words and more, in blocks of about half SEEDS."""
    spark = docs.sparkSession
    words = F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+"))
    usable = benchmark.select("item_id", "text", (words * len(MASKS)).alias("n")).where(words >= least)
    total = usable.agg(F.sum("n").alias("n")).first().n or 0
    n_blocks = max(1, -(-2 * total // SEEDS))
    blocks = []
    for k in range(n_blocks):
        part = usable.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k)
        blocks.append(spark.sparkContext.broadcast(Index([(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()])))  # about SEEDS / 8 words
    return blocks


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, doc_start, item_start, n_words, n_matching``: the best overlap of each document and item."""
    small_batches(docs.sparkSession)
    kind = benchmark.schema["item_id"].dataType.simpleString()
    return reduce(DataFrame.unionByName, [_scan(docs, shared, kind) for shared in _indexes(docs, benchmark, 1)])


def _scan(docs: DataFrame, shared, kind: str) -> DataFrame:
    def run(batches):
        index = shared.value
        for batch in batches:
            words, at = hash_words(column_bytes(batch.column(1)), lower=True)
            found = index.matches(words, at)
            ids = batch.column(0).take(pa.array([f[0] for f in found], pa.int64()))
            rest = [pa.array([f[k] for f in found], pa.int64()) for k in range(1, 6)]
            yield pa.RecordBatch.from_arrays([ids, *rest], ["doc_id", "item", "doc_start", "item_start", "n_words", "n_matching"])

    scanned = docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, _OUT.format(item="long"))
    names = docs.sparkSession.createDataFrame(list(enumerate(shared.value.ids)), f"item long, item_id {kind}")
    return scanned.join(F.broadcast(names), "item").select("doc_id", "item_id", "doc_start", "item_start", "n_words", "n_matching")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item of LEAST words or a long part of one."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")
    for shared in _indexes(docs, benchmark, LEAST):

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                words, bounds = hash_words(column_bytes(batch.column(at)), lower=True)
                stays = np.ones(batch.num_rows, bool)
                stays[[f[0] for f in index.matches(words, bounds)]] = False
                yield batch.filter(pa.array(stays))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
