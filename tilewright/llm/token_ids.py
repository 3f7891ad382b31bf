"""Operator 8: token ids in a byte-aligned, frequency-ranked binary format.

Ids are replaced by their frequency rank over the corpus, so that the commonest take one byte.
A value takes 1 to 4 bytes; its length less one is a 2-bit code in a separate run of control
bytes (four codes a byte).  Decoding is numpy table lookup by control byte, without a loop.

The files are shards in ascending ``doc_id`` order.  A shard is a Parquet file whose rows are
blocks ``(shard, block, doc_ids, lengths, control, data)``; the rank table is stored beside them.
Spark's commit protocol makes the files whole even if an executor is lost while it writes.

Edge cases: null text is empty and encodes to the end id alone; a null ``doc_id`` sorts first;
rows that repeat a ``doc_id`` are separate documents, ordered by their ids; no rows give no shards.
"""

from __future__ import annotations

import itertools
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, small_batches, tasks
from .words import column_bytes, held

BLOCK_TOKENS = 1 << 19
#: Words remembered by a worker, in each of two generations: some 50 MB.
CACHE_WORDS = 300_000
#: Runs of punctuation remembered by a worker.
CACHE_TAILS = 10_000

# --- codec ----------------------------------------------------------------------------------

_CODES = np.array([[(byte >> (2 * k)) & 3 for k in range(4)] for byte in range(256)], dtype=np.int64)
_LENGTHS = _CODES + 1
_GROUP = _LENGTHS.sum(axis=1)
_WITHIN = np.concatenate([np.zeros((256, 1), np.int64), np.cumsum(_LENGTHS, axis=1)[:, :3]], axis=1)
_KEEP = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, dtype="<u4")
    codes = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    padded[: len(values)] = codes
    four = padded.reshape(-1, 4)
    control = four[:, 0] | (four[:, 1] << 2) | (four[:, 2] << 4) | (four[:, 3] << 6)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]]
    return control.tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values that ``encode`` was given."""
    control = np.frombuffer(control, np.uint8)
    if not n:
        return np.zeros(0, np.uint32)
    sizes = _GROUP[control]
    starts = np.cumsum(sizes) - sizes
    at = (starts[:, None] + _WITHIN[control]).reshape(-1)[:n]
    code = _CODES[control].reshape(-1)[:n]
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)]).astype(np.uint32)
    word = raw[at] | raw[at + 1] << np.uint32(8) | raw[at + 2] << np.uint32(16) | raw[at + 3] << np.uint32(24)
    return word & _KEEP[code]


# --- tokenizing -----------------------------------------------------------------------------


def byte_letters() -> list[str]:
    """Byte-level BPE's letter for each byte: printable Latin-1 stands for itself, the rest follow from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = itertools.count(0x100)
    return [chr(b if b in printable else next(others)) for b in range(256)]


class WordTokenizer(dict):
    """Encodes texts with a ``tokenizers`` file whose tokens never cross ASCII white space.

    Maps a word (bytes) to its ids.  Each distinct word is encoded once by the library and
    remembered in two bounded generations.  A word of lower-case letters, perhaps with punctuation
    behind, goes to the library's BPE model at once: the file's normalizer leaves it as it is and
    its splitter parts it there.  Every other word goes through the whole tokenizer.
    """

    PUNCTUATION = ".,;:!?%*&$#|"

    def __init__(self, path: str, width: str = "<u4"):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        ids = np.arange(max(self.tokenizer.get_vocab().values()) + 1).astype(width)
        self.packed = [i.tobytes() for i in ids]
        self.lowers = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str("A") == "a"
        self.letters = dict(enumerate(byte_letters()))
        self.tails: dict[str, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _part(self, text: str) -> bytes:
        mapped = text if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.packed[t.id] for t in self.model.tokenize(mapped)])

    def _tail(self, text: str) -> bytes:
        found = self.tails.get(text)
        if found is None:
            found = self._part(text)
            if len(self.tails) < CACHE_TAILS:
                self.tails[text] = found
        return found

    def __missing__(self, word: bytes) -> bytes:
        found = self.old.get(word)
        if found is None:
            text = word.decode()
            core = text.rstrip(self.PUNCTUATION)
            if self.lowers and core.isalpha() and core == core.lower() and (core.isascii() or unicodedata.is_normalized("NFC", core)):
                found = self[word[: len(core) - len(text)]] + self._tail(text[len(core) :]) if len(core) < len(text) else self._part(core)
            else:
                found = b"".join([self.packed[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])
        if len(self) >= CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found

    def encode(self, text: bytes) -> bytes:
        """Ids as integers of the width asked for."""
        if self.lowers and b"<|" not in text:  # special tokens are matched before lower-casing
            text = text.lower()
        return b"".join(map(self.__getitem__, text.split()))


def word_tokenizer(path: str, width: str) -> WordTokenizer:
    return held((path, width), lambda: WordTokenizer(path, width))


def tokenize(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``doc_id, ids`` with ids as little-endian unsigned 16-bit integers (32-bit for large vocabularies)."""
    from tokenizers import Tokenizer

    width = id_width(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id)
    end = np.array([end_id], width).tobytes()

    def run(batches):
        encoder = word_tokenizer(tokenizer, width)
        for batch in batches:
            ids = [encoder.encode(t) + end for t in column_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, ids binary")


def id_width(vocabulary: int, end_id: int) -> str:
    return "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"


# --- writing and reading --------------------------------------------------------------------


def write(docs: DataFrame, tokenizer: str, end_id: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Tokenize and write; returns the shards and the rank table as read back."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    small_batches(spark)
    vocabulary = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    width = id_width(vocabulary, end_id)
    ids = scratch.keep(tokenize(docs, tokenizer, end_id), "ids")

    def count(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), width), minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counts = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = counts.collect()  # at most one row for each id of the vocabulary
    total = np.zeros(vocabulary, np.int64)
    for row in found:
        total[row.id] = row.n
    by_rank = np.argsort(-total, kind="stable")
    rank = np.empty(vocabulary, np.uint32)
    rank[by_rank] = np.arange(vocabulary, dtype=np.uint32)
    ranks = scratch.keep(spark.createDataFrame([(by_rank.astype("<u4").tobytes(),)], "by_rank binary"), "ranks")

    def pack(batches):
        shard, number = TaskContext.get().partitionId(), itertools.count()

        def block(docs, parts):
            values = np.concatenate(parts)
            control, data = encode(rank[values])
            rows = [[shard], [next(number)], [docs], [[len(p) for p in parts]], [control], [data]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, _BLOCK.types, strict=True)], schema=_BLOCK)

        docs, parts, size = [], [], 0
        for batch in batches:
            for doc, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                docs.append(doc)
                parts.append(np.frombuffer(blob, width))
                size += len(parts[-1])
                if size >= BLOCK_TOKENS:
                    yield block(docs, parts)
                    docs, parts, size = [], [], 0
        if docs:
            yield block(docs, parts)

    ordered = ids.repartitionByRange(tasks(spark), "doc_id").sortWithinPartitions("doc_id", "ids")
    shards = scratch.keep(ordered.mapInArrow(pack, BLOCK_DDL), "shards", codec="none")
    return shards, ranks


_BLOCK = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())])
BLOCK_DDL = "shard int, block int, doc_ids array<long>, lengths array<long>, control binary, data binary"


def starts(shards: DataFrame) -> DataFrame:
    """Ids before each block; the rows collected are one a block, of BLOCK_TOKENS ids or one document."""
    from pyspark.sql import Window

    sizes = shards.select("shard", "block", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    before = sizes.groupBy("shard").agg(F.sum("n").alias("n")).collect()  # one row a shard
    at, rows = 0, []
    for shard, n in sorted((r.shard, r.n) for r in before):
        rows.append((shard, at))
        at += n
    offsets = shards.sparkSession.createDataFrame(rows, "shard int, shard_start long")
    inside = F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n")
    return sizes.withColumn("inside", inside).join(F.broadcast(offsets), "shard").select("shard", "block", (F.col("inside") + F.col("shard_start")).alias("block_start"))


def _opened(shards: DataFrame, ranks: DataFrame, each, schema: str) -> DataFrame:
    """``each`` (document, start, its ids as little-endian unsigned 32-bit integers) over the documents of the files."""
    by_rank = np.frombuffer(ranks.first().by_rank, "<u4")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                values = by_rank[decode(row["control"], row["data"], int(ends[-1]))].astype("<u4")
                first = ends - lengths
                columns = each([values[a:b] for a, b in zip(first, ends, strict=True)])
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(first + row["block_start"]), *columns], names)

    return shards.join(starts(shards), ["shard", "block"]).mapInArrow(run, schema)


def read(shards: DataFrame, ranks: DataFrame) -> DataFrame:
    """Documents of the files: ``doc_id, start, ids`` (ids as little-endian unsigned 32-bit integers)."""
    return _opened(shards, ranks, lambda ids: [pa.array([x.tobytes() for x in ids], pa.binary())], "doc_id long, start long, ids binary")


def digest(shards: DataFrame, ranks: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of the documents of the files; their ids stay in the worker that reads them."""
    described = lambda ids: [pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64())]
    return _opened(shards, ranks, described, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Encode ``docs`` (doc_id, text), write the files, read them back and describe each document."""
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "token-ids")
    shards, ranks = write(docs, tokenizer, end_id, scratch)
    scratch.drop("ids")
    return digest(shards, ranks)
