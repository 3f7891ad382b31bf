"""Operator 2: exact substring deduplication by suffix arrays and their common-prefix interval trees.

What is looked for are byte strings of LENGTH and more that also start in a document with a smaller
``doc_id``.  A suffix of every position of the corpus would be LENGTH times the corpus to sort, so
positions are sifted and grouped first, exactly:

1. Documents are packed into blocks, stored once.  Each LENGTH-byte window has an anchor, its
   SEED-byte gram of least hash; equal windows have equal anchors.
2. Anchor hashes that lie in two documents at least are found by a shuffle of 6 bytes an anchor.
3. Successive windows with one anchor are a frame.  A block sends each distinct frame with a found
   anchor once, with the smallest document that has it there, to the bucket of its anchor.
4. A bucket builds the enhanced suffix array of its frames (suffixes of LENGTH bytes at least, grouped
   by their first LENGTH and sorted by what follows; then the lengths of common prefixes).  Groups that every
   member extends to the left by the same byte are dropped (the group one byte before holds them).
   A stack scan of the others closes the intervals of the tree from the deepest up; each is a
   maximal repeat with all its occurrences, and each frame takes the deepest interval in which
   some document is smaller than its own.
5. The lengths go back to the blocks, which mark the bytes, cut them out and hash the rest.

Since a block sends a frame once, a passage that a third of all documents share is one row a block.

Edge cases: null or empty text has no bytes and nothing removed; a null ``doc_id`` counts as larger
than any other and all nulls as one; rows that repeat a ``doc_id`` are one document for the
comparison and nothing of theirs is removed on each other's account; texts under LENGTH bytes stay;
documents of any length are read whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, small_batches, tasks
from .words import _BYTE, column_bytes, mix64, powers

LENGTH = 50
SEED = 24
SPAN = LENGTH - SEED + 1  # grams in a window
BLOCK_BYTES = 2 << 20
BLOCK_ROWS = 1 << 16
SEGMENT = 1 << 19
NO_ID = np.iinfo(np.int64).max


def buckets(spark) -> int:
    """Four buckets a shuffle partition.  A block sends at most one row a bucket, and at most one a key."""
    return min(1 << 24, 4 * tasks(spark))


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (keys >> np.uint64(40)).astype(np.int64) % n


# --- blocks ---------------------------------------------------------------------------------


def _blocks(docs: DataFrame) -> DataFrame:
    def run(batches):
        task, count = TaskContext.get().partitionId(), 0
        pack = zstandard.ZstdCompressor(level=3)

        def row(ids, texts):
            return pa.RecordBatch.from_arrays([pa.array([(task << 24) + count]), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([pack.compress(b"".join(texts))], pa.large_binary())], ["block", "ids", "lengths", "texts"])

        ids, texts, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), column_bytes(batch.column(1)), strict=True):
                ids.append(doc)
                texts.append(text)
                size += len(text)
                if size >= BLOCK_BYTES or len(ids) == BLOCK_ROWS:
                    yield row(ids, texts)
                    count, ids, texts, size = count + 1, [], [], 0
        if ids:
            yield row(ids, texts)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "block long, ids array<long>, lengths array<long>, texts binary")


class Keyed:
    """What blocks with 64-bit keys share: ``distinct`` keys, ``of`` (key of each item), ``doc`` and ``order``."""

    def buckets(self, n: int) -> np.ndarray:
        return bucket_of(self.distinct, n)

    def shared_here(self) -> np.ndarray:
        """Which distinct keys lie in two documents of the block."""
        low, high = np.full(len(self.distinct), NO_ID), np.full(len(self.distinct), -NO_ID)
        np.minimum.at(low, self.of, self.order[self.doc])
        np.maximum.at(high, self.of, self.order[self.doc])
        return low < high

    def found(self, bits: list[tuple[int, bytes]], n: int) -> np.ndarray:
        """Items whose keys were found in two documents; bits by bucket in the order of ``distinct``."""
        flags, buckets = np.zeros(len(self.distinct), bool), self.buckets(n)
        by_bucket = np.argsort(buckets, kind="stable")
        edges = np.searchsorted(buckets[by_bucket], np.arange(n + 1))
        for bucket, packed in bits:
            mine = by_bucket[edges[bucket] : edges[bucket + 1]]
            flags[mine] = np.unpackbits(np.frombuffer(packed, np.uint8), count=len(mine)).astype(bool)
        return np.flatnonzero(flags[self.of]) if len(self.of) else np.zeros(0, np.int64)


class Block(Keyed):
    """Texts laid end to end, with their frames: (start, windows, document) and anchor hash."""

    def __init__(self, ids: list, lengths: list[int], texts: bytes):
        self.ids = ids
        self.order = np.array([NO_ID if i is None else i for i in ids], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))])
        self.bytes = np.frombuffer(zstandard.ZstdDecompressor().decompress(texts) if lengths else b"", np.uint8)
        parts = [self._frames(a) for a in range(0, max(0, len(self.bytes) - LENGTH + 1), SEGMENT)]
        self.start, self.count, self.anchor = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, t) for k, t in enumerate((np.int64, np.int64, np.uint64)))
        self.doc = np.searchsorted(self.bounds, self.start, "right") - 1
        self.distinct, self.of = np.unique(self.anchor, return_inverse=True)

    def _frames(self, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Frames of the windows that start in [at, at + SEGMENT)."""
        piece = self.bytes[at : at + SEGMENT + LENGTH - 1]
        n = len(piece)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[piece] * powers(n), out=sums[1:])
        grams = mix64((sums[SEED:] - sums[:-SEED]) * powers(n - SEED + 1, True))
        key = (grams & ~np.uint64((1 << 20) - 1)) | np.arange(len(grams), dtype=np.uint64)
        least, width = key, 1
        while 2 * width <= SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < SPAN:
            least = np.minimum(least[: len(least) - (SPAN - width)], least[SPAN - width :])
        begin = np.arange(at, at + len(least))
        text = np.searchsorted(self.bounds, begin, "right") - 1
        inside = begin + LENGTH <= self.bounds[text + 1]
        begin, least, text = begin[inside], least[inside], text[inside]
        if not len(begin):
            return begin.astype(np.int64), begin.astype(np.int64), np.zeros(0, np.uint64)
        place = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
        first = np.flatnonzero(new)
        counts = np.diff(np.concatenate([first, [len(begin)]]))
        return begin[first], counts, grams[place[first]]

    def strings(self, frames: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct frame contents: one frame of each, the content of each frame, its smallest document."""
        lengths = self.count[frames] + LENGTH - 1
        keys = np.zeros(len(frames), np.uint64)
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            for some in np.array_split(rows, max(1, len(rows) // 20_000)):
                grid = self.bytes[self.start[frames[some]][:, None] + np.arange(length)]
                padded = np.zeros((len(some), -(-length // 8) * 8), np.uint8)
                padded[:, :length] = grid
                total = np.full(len(some), length, np.uint64)
                for column in padded.view(np.uint64).T:
                    total = mix64(total + column)
                keys[some] = total
        _, first, of = np.unique(keys, return_index=True, return_inverse=True)
        least = np.full(len(first), NO_ID)
        np.minimum.at(least, of, self.order[self.doc[frames]])
        return frames[first], of, least


def _open(batch) -> Iterator[tuple[int, Block, dict]]:
    for row in batch.to_pylist():
        yield row["block"], Block(row["ids"], row["lengths"], row["texts"]), row


# --- anchors in two documents ---------------------------------------------------------------


def shared_keys(blocks: DataFrame, n: int, opened=_open) -> DataFrame:
    """Bits of each block's keys (``distinct``), by bucket: which lie in two documents."""

    def send(batches):
        for batch in batches:
            for number, block, _ in opened(batch):
                buckets, shared = block.buckets(n), block.shared_here()
                order = np.argsort(buckets, kind="stable")
                edges = np.searchsorted(buckets[order], np.arange(n + 1))
                six = np.ascontiguousarray(block.distinct.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6]
                used = np.flatnonzero(edges[1:] > edges[:-1])
                hashes = [six[order[edges[b] : edges[b + 1]]].tobytes() for b in used]
                flags = [np.packbits(shared[order[edges[b] : edges[b + 1]]]).tobytes() for b in used]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), number)), pa.array(used.astype(np.int32)), pa.array(hashes, pa.binary()), pa.array(flags, pa.binary())], ["block", "bucket", "hashes", "flags"])

    def meet(table: pa.Table) -> pa.Table:
        blobs, flags = table["hashes"].to_pylist(), table["flags"].to_pylist()
        sizes = np.array([len(b) // 6 for b in blobs])
        wide = np.zeros((int(sizes.sum()), 8), np.uint8)
        wide[:, :6] = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
        keys = wide.reshape(-1).view("<u8")
        here = np.concatenate([np.unpackbits(np.frombuffer(f, np.uint8), count=k) for f, k in zip(flags, sizes, strict=True)]).astype(bool)
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        group = np.cumsum(new) - 1
        both = (np.bincount(group) > 1) | (np.bincount(group, weights=here[order]) > 0)
        answer = np.zeros(len(keys), bool)
        answer[order] = both[group]
        ends = np.cumsum(sizes)
        bits = [np.packbits(answer[e - k : e]).tobytes() for e, k in zip(ends, sizes, strict=True)]
        return pa.table({"block": table["block"], "bucket": table["bucket"], "bits": pa.array(bits, pa.binary())})

    sent = blocks.mapInArrow(send, "block long, bucket int, hashes binary, flags binary")
    return sent.groupBy("bucket").applyInArrow(meet, "block long, bucket int, bits binary")


# --- suffix arrays --------------------------------------------------------------------------


def hashed_groups(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``starts`` by the hash of their first LENGTH bytes, without those that are alone, and the start of each group."""
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_BYTE[text] * powers(len(text)), out=sums[1:])
    keys = (sums[starts + LENGTH] - sums[starts]) * powers(len(text), True)[starts]
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys) + 1, bool)
    new[1:-1] = ranked[1:] != ranked[:-1]
    kept = ~(new[1:] & new[:-1])
    return starts[order[kept]], np.flatnonzero(new[:-1][kept])


def suffix_groups(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``starts`` as far as their first LENGTH bytes tell, and the start of each group of equals.

    Only groups of two and more are returned: ``order`` and the index of each group's first member.
    Groups are made by a hash and compared byte by byte; should two strings have one hash, they are
    sorted.  Members are put in order by what follows in ``sort_frames``; no step asks for the groups' order.
    """
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    eight = np.zeros(len(text) + 1, np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | padded[k : k + len(eight)]
    at, first = hashed_groups(text, starts)
    rest = np.ones(len(at), bool)
    rest[first] = False
    rest = np.flatnonzero(rest)
    if all((eight[at[rest] + step] == eight[at[rest - 1] + step]).all() for step in (*range(0, LENGTH - 8, 8), LENGTH - 8)):
        return at, first
    order = np.argsort(eight[at], kind="stable")  # two strings have one hash
    at = at[order]
    group = np.zeros(len(at), np.int64)
    for step in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        key = eight[at + step]
        if step:
            inside = np.lexsort((key, group))
            at, key, group = at[inside], key[inside], group[inside]
        new = np.ones(len(at), bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        group = np.cumsum(new) - 1
        several = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.zeros(0, bool)
        at, group = at[several], group[several]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(at) else np.zeros(0, np.int64)
    return at, first


def common_prefixes(text: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the one before it, LENGTH at least within a group."""
    room = int((ends - at).max(initial=LENGTH)) - LENGTH
    out = np.full(len(at), LENGTH, np.int64)
    if len(at) < 2 or not room:
        return out
    offsets = np.arange(LENGTH, LENGTH + room)
    for a in range(1, len(at), 50_000):
        x, y = at[a - 1 : a + 49_999][: len(at[a : a + 50_000])], at[a : a + 50_000]
        stop = np.minimum(ends[a - 1 : a - 1 + len(x)] - x, ends[a : a + len(y)] - y)
        clip = len(text) - 1
        same = (text[np.minimum(x[:, None] + offsets, clip)] == text[np.minimum(y[:, None] + offsets, clip)]) & (offsets < stop[:, None])
        out[a : a + len(y)] += np.logical_and.accumulate(same, axis=1).sum(axis=1)
    return out


def maximal_repeats(prefix: list[int], first: int, last: int) -> Iterator[tuple[int, int, int]]:
    """Intervals (length, first, last) of a group's tree, the deepest first, by one stack scan."""
    stack: list[tuple[int, int]] = []
    for i in range(first + 1, last + 1):
        left = i - 1
        while stack and stack[-1][0] > prefix[i]:
            length, left = stack.pop()
            yield length, left, i - 1
        if not stack or stack[-1][0] < prefix[i]:
            stack.append((prefix[i], left))
    while stack:
        length, left = stack.pop()
        yield length, left, last


def sort_frames(text: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Left-diverse groups of a bucket's frames: suffix starts, frame of each, group starts, common prefixes.

    A window inside two frames' common run is met at the run's first byte, where what stands before
    differs or a frame begins.
    """
    ends = np.cumsum(lengths)
    begins = ends - lengths
    counts = lengths - LENGTH + 1
    frame = np.repeat(np.arange(len(lengths)), counts)
    starts = begins[frame] + np.arange(len(frame)) - np.repeat(np.cumsum(counts) - counts, counts)
    at, first = suffix_groups(text, starts)
    owner = np.searchsorted(begins, at, "right") - 1
    before = np.where(at > begins[owner], text[np.maximum(at - 1, 0)].astype(np.int64), -1)
    if not len(at):
        return at, owner, first, np.zeros(0, np.int64)
    sizes = np.diff(np.concatenate([first, [len(at)]]))
    low, high = np.minimum.reduceat(before, first), np.maximum.reduceat(before, first)
    diverse = np.repeat((low != high) | (low < 0), sizes)
    at, owner, group = at[diverse], owner[diverse], np.repeat(np.arange(len(first)), sizes)[diverse]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(at) else np.zeros(0, np.int64)
    # within a group suffixes are ordered by what follows LENGTH as well
    room = np.minimum(ends[owner] - at - LENGTH, 32)
    tail = np.zeros((len(at), 32), np.uint8)
    for a in range(0, len(at), 100_000):
        some = slice(a, a + 100_000)
        offsets = np.arange(32)
        grid = text[np.minimum(at[some, None] + LENGTH + offsets, len(text) - 1)].copy()
        grid[offsets >= room[some, None]] = 0
        tail[some] = grid
    keys = np.ascontiguousarray(tail).view(">u8").astype(np.uint64)
    inside = np.lexsort((keys[:, 3], keys[:, 2], keys[:, 1], keys[:, 0], np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(at)]])))))
    at, owner = at[inside], owner[inside]
    return at, owner, first, common_prefixes(text, at, ends[owner])


def covered(text: np.ndarray, lengths: np.ndarray, docs: np.ndarray) -> list[tuple[int, int, int]]:
    """(frame, start, length) of what each frame shares with a frame of a smaller document, from the interval trees."""
    at, owner, first, prefix = sort_frames(text, lengths)
    begins = np.cumsum(lengths) - lengths
    ends = np.concatenate([first[1:], [len(at)]]) if len(first) else first
    low = np.minimum.reduceat(docs[owner], first) if len(first) else first
    high = np.maximum.reduceat(docs[owner], first) if len(first) else first
    prefixes, who, out = prefix.tolist(), docs[owner].tolist(), []
    for a, b in zip(first[low < high].tolist(), ends[low < high].tolist(), strict=True):
        if b - a == 2:
            late = a if who[a] > who[a + 1] else a + 1
            out.append((late, prefixes[a + 1]))
            continue
        open_: list[tuple[int, int, list[int]]] = []  # closed intervals' spans with their smallest document and the members that have it
        for length, x, y in maximal_repeats(prefixes, a, b - 1):
            members, i, inner = [], x, []
            while open_ and open_[-1][0] >= x:
                inner.append(open_.pop())
            for left, right, kept in reversed(inner):
                members += range(i, left)
                members += kept
                i = right + 1
            members += range(i, y + 1)
            least = min(who[m] for m in members)
            out += [(m, length) for m in members if who[m] > least]
            open_.append((x, y, [m for m in members if who[m] == least]))
    if not out:
        return []
    index, length = np.array(out, np.int64).T
    frames = owner[index]
    return list(zip(frames.tolist(), (at[index] - begins[frames]).tolist(), length.tolist(), strict=True))


def _compare(blocks: DataFrame, bits: DataFrame, n: int) -> DataFrame:
    """Covered parts of each block's frames: ``block, bucket, parts``."""

    def send(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for number, block, row in _open(batch):
                frames = block.found([(x["bucket"], x["bits"]) for x in row["bits"]], n)
                first, _, least = block.strings(frames)
                buckets = bucket_of(block.anchor[first], n)
                rows = [[], [], [], [], []]
                for bucket in np.unique(buckets):
                    mine = np.flatnonzero(buckets == bucket)
                    lengths = block.count[first[mine]] + LENGTH - 1
                    text = b"".join(block.bytes[s : s + k].tobytes() for s, k in zip(block.start[first[mine]], lengths, strict=True))
                    for column, value in zip(rows, (number, int(bucket), pack.compress(text), lengths.astype("<u1").tobytes(), least[mine].tobytes()), strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["block", "bucket", "text", "lengths", "docs"])

    def meet(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor()
        text = np.frombuffer(b"".join(unpack.decompress(t) for t in table["text"].to_pylist()), np.uint8)
        blobs = table["lengths"].to_pylist()
        lengths = np.frombuffer(b"".join(blobs), "<u1").astype(np.int64)
        docs = np.frombuffer(b"".join(table["docs"].to_pylist()), np.int64)
        ends = np.cumsum([len(b) for b in blobs])
        parts = np.array(covered(text, lengths, docs), np.int64).reshape(-1, 3)
        row = np.searchsorted(ends, parts[:, 0], "right")
        parts[:, 0] -= (ends - [len(b) for b in blobs])[row]
        return pa.table({"block": table["block"], "bucket": table["bucket"], "parts": pa.array(_split(parts, row, len(blobs)), pa.binary())})

    with_bits = blocks.join(bits.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("bits")), "block")
    sent = with_bits.mapInArrow(send, "block long, bucket int, text binary, lengths binary, docs binary")
    return sent.groupBy("bucket").applyInArrow(meet, "block long, bucket int, parts binary")


def _split(parts: np.ndarray, row: np.ndarray, n: int) -> list[bytes]:
    order = np.argsort(row, kind="stable")
    edges = np.searchsorted(row[order], np.arange(n + 1))
    ranked = parts[order].astype("<u4")
    return [ranked[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]


# --- removal --------------------------------------------------------------------------------


def _mark(block: Block, row: dict, n: int) -> np.ndarray:
    """Which bytes of the block are covered."""
    frames = block.found([(x["bucket"], x["bits"]) for x in row["bits"] or []], n)
    step = np.zeros(len(block.bytes) + 1, np.int64)
    if len(frames):
        first, of, least = block.strings(frames)
        mine = block.order[block.doc[frames]] == least[of]
        late = frames[~mine]  # a smaller document of this block has the whole frame
        np.add.at(step, block.start[late], 1)
        np.add.at(step, block.start[late] + block.count[late] + LENGTH - 1, -1)
        buckets = bucket_of(block.anchor[first], n)
        begin, length, content = [], [], []
        by_bucket = np.argsort(buckets, kind="stable")
        edges = np.searchsorted(buckets[by_bucket], np.arange(n + 1))
        for x in row["parts"] or []:
            parts = np.frombuffer(x["parts"], "<u4").reshape(-1, 3).astype(np.int64)
            content.append(by_bucket[edges[x["bucket"]] : edges[x["bucket"] + 1]][parts[:, 0]])
            begin.append(parts[:, 1])
            length.append(parts[:, 2])
        if content:
            content, begin, length = np.concatenate(content), np.concatenate(begin), np.concatenate(length)
            order = np.argsort(content, kind="stable")
            content, begin, length = content[order], begin[order], length[order]
            own = frames[mine]
            lo, hi = np.searchsorted(content, of[mine], "left"), np.searchsorted(content, of[mine], "right")
            which = np.repeat(np.arange(len(own)), hi - lo)
            part = np.arange(len(which)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
            start = block.start[own[which]] + begin[part]
            np.add.at(step, start, 1)
            np.add.at(step, start + length[part], -1)
    return np.cumsum(step[:-1]) > 0


def _cut(blocks: DataFrame, bits: DataFrame, parts: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for _, block, row in _open(batch):
                gone = _mark(block, row, n)
                rows = [[], [], [], [], []]
                for doc, a, b in zip(block.ids, block.bounds[:-1], block.bounds[1:], strict=True):
                    cut = gone[a:b]
                    begins = int(cut[:1].sum()) + int((cut[1:] & ~cut[:-1]).sum())
                    digest = hashlib.sha256(block.bytes[a:b][~cut].tobytes()).hexdigest()
                    for column, value in zip(rows, (doc, int(b - a), int(cut.sum()), begins, digest), strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, (pa.int64(), *[pa.int64()] * 3, pa.string()), strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    by_block = bits.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("bits"))
    back = parts.where("length(parts) > 0").groupBy("block").agg(F.collect_list(F.struct("bucket", "parts")).alias("parts"))
    known = by_block.join(back, "block", "left")
    return blocks.join(known, "block", "left").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "suffix-dedup")
    n = buckets(spark)
    blocks = scratch.keep(_blocks(docs), "blocks", codec="none")
    bits = scratch.keep(shared_keys(blocks, n), "bits")
    parts = scratch.keep(_compare(blocks, bits, n), "parts")
    return _cut(blocks, bits, parts, n)
