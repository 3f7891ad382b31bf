"""Operator 9: near-duplicate documents by bottom-k sketches of one hash function.

A document's set holds the hashes of its distinct five-word shingles (the whole sequence if it has
fewer words).  Its sketch is the K smallest.  Rows with equal sets form a class, the node of all
that follows.  The INDEXED smallest values of each are keys of inverted lists; a linked pair
(similarity of at least 0.75) shares none of them with a probability of 0.25 ** INDEXED.  Pairs
from the lists are filtered by the union sketch (the K smallest of both: how many are in both) and
confirmed on the full sets.

A list of up to SHORT members gives its pairs.  The members of a longer one first meet its most
typical member, which joins most of a large group of copies at the cost of one pair a member.  That
only saves work.  What then lies in different components is completed without a limit of size:

* two linked sketches have at least SHARED values in common, so they share one of the rarest
  K - SHARED + 1 of each; such lists, counted among the members of long ones, give their pairs if short;
* members of those that are long meet by their full sets.  A linked pair x, y with |x| <= |y| has
  at least 3/7 (|x| + |y|) values in common, so the rarest 1/7 of x and the rarest 1/4 of y share
  one.  These lists are compared in blocks of BLOCK shingles: the smaller sides of one with the larger ones of
  another, all overlaps of the full sets at once, and only links that join two components come out.

Edge cases: null or empty text has no shingles, is linked with nothing and kept; a null ``doc_id``
gets a null component and is kept; rows that repeat a ``doc_id`` are documents of their own (each
gets the component of its own text); an empty table gives no rows; other columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .scratch import Scratch, few, free_names, small_batches, tasks
from .words import column_bytes, hash_words, release, shingles

K = 64
INDEXED = 16
#: Of the K smallest of a union, a pair at similarity 0.75 holds fewer in common once in 10 ** 9.
SHARED = 28
SHORT = 32
WIDTH = 5
BLOCK = 1 << 17
CHUNK = 64
NEAR_SIZE = "4 * na >= 3 * nb and 4 * nb >= 3 * na"


def text_set(words: np.ndarray) -> np.ndarray:
    return np.unique(shingles(words, WIDTH))


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, h1, h2, n, set_key, sketch, heads`` of each row; h1 and h2 tell rows of one id apart by their text."""

    def run(batches):
        release()
        for batch in batches:
            words, at = hash_words(column_bytes(batch.column(3)), lower=True)
            n, keys, sketches, heads = [], [], [], []
            for a, b in zip(at[:-1], at[1:], strict=True):
                values = text_set(words[a:b])
                n.append(len(values))
                keys.append(xxhash.xxh3_128_digest(values.tobytes()))
                sketches.append(values[:K].tobytes())
                heads.append(values[:INDEXED].view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()), pa.array(heads, pa.list_(pa.int64()))], ["doc_id", "h1", "h2", "n", "set_key", "sketch", "heads"])

    return docs.select(F.col("doc_id").cast("long"), *text_key(), F.col("text")).mapInArrow(run, "doc_id long, h1 long, h2 long, n long, set_key binary, sketch binary, heads array<long>")


def text_key() -> list[Column]:
    """Two hashes of the text as columns h1 and h2."""
    return [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), F.col("text")).alias("h2")]


def stack(sketches: list[bytes]) -> np.ndarray:
    """Upper halves of sketches as rows of K values, the largest value standing for none."""
    out = np.full((len(sketches), K), np.iinfo(np.uint32).max, np.uint32)
    for row, blob in zip(out, sketches, strict=True):
        values = np.frombuffer(blob, "<u4")[1::2]
        row[: len(values)] = values
    return out


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two stacks pass the union-sketch estimate, one chance equality allowed for."""
    none = np.iinfo(np.uint32).max
    merged = np.sort(np.concatenate([a, b], axis=1), axis=1)
    twice = np.zeros(merged.shape, bool)
    twice[:, 1:] = (merged[:, 1:] == merged[:, :-1]) & (merged[:, 1:] != none)
    real = merged != none
    place = np.cumsum(real & ~twice, axis=1)  # how many distinct values up to here
    shared = (twice & (place <= K)).sum(axis=1)
    union = place[:, -1]
    return np.where(union < K, (shared + 1) * 4 >= union * 3, shared >= SHARED)


def _against(pairs: DataFrame, blobs: DataFrame, test) -> DataFrame:
    """Pairs (a, b) that pass ``test`` (one blob, list of blobs -> mask) on ``blobs`` (node, blob).

    Pairs of one ``a`` go in chunks of about CHUNK with one copy of its blob each, so a node with
    many partners is spread over tasks, and its blob is not repeated for every pair.
    """
    counted = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    leaders = counted.select(F.col("a").alias("node"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")).join(blobs, "node")
    part = F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk")
    members = pairs.join(counted, "a").select("a", part, F.col("b").alias("node")).join(blobs, "node").select("a", "chunk", F.col("node").alias("b"), "blob")
    both = leaders.select(F.col("node").alias("a"), "chunk", F.lit(None).cast("long").alias("b"), "blob").unionByName(members)
    dealt = both.repartition(tasks(pairs.sparkSession), "a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())

    def run(batches):
        lead = None
        for batch in batches:
            out, waiting, who = [], [], []

            def flush():
                if who:
                    out.extend(p for p, ok in zip(who, test(lead, waiting), strict=True) if ok)  # noqa: B023
                    who.clear()
                    waiting.clear()

            for a, b, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if b is None:
                    flush()
                    lead = blob
                else:
                    who.append((a, b))
                    waiting.append(blob)
            flush()
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _estimate(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs that pass the sketch filter."""

    def test(lead: bytes, others: list[bytes]) -> np.ndarray:
        return alike(np.repeat(stack([lead]), len(others), axis=0), stack(others))

    return _against(pairs, reps.select("node", F.col("sketch").alias("blob")), test)


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets have a similarity of at least 0.75."""

    def test(lead: bytes, others: list[bytes]) -> list[bool]:
        x, passed = np.frombuffer(lead, np.uint64), []
        for blob in others:
            y = np.frombuffer(blob, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            passed.append(100 * common >= 75 * (len(x) + len(y) - common))
        return passed

    return _against(pairs, sets, test)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, blob`` with the full set of each class in ``wanted`` (node, rep, set_key)."""

    def run(batches):
        for batch in batches:
            words, at = hash_words(column_bytes(batch.column(1)), lower=True)
            values = [text_set(words[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([xxhash.xxh3_128_digest(v) for v in values], pa.binary()), pa.array(values, pa.binary())], ["rep", "set_key", "blob"])

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text"))
    hashed = texts.join(few(wanted.select("rep").distinct()), "rep", "left_semi").mapInArrow(run, "rep long, set_key binary, blob binary")
    return hashed.join(wanted, ["rep", "set_key"]).groupBy("node").agg(F.first("blob").alias("blob"))


def _exploded(blobs: DataFrame) -> DataFrame:
    """``node, n, value`` for every value of ``blobs`` (node, n, blob)."""

    def run(batches):
        for batch in batches:
            found = batch.column(2).to_pylist()
            rows = pa.array(np.repeat(np.arange(len(found)), [len(b) // 8 for b in found]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(np.frombuffer(b"".join(found), np.int64))], ["node", "n", "value"])

    return blobs.select("node", "n", "blob").mapInArrow(run, "node long, n long, value long")


def _placed(values: DataFrame, total: Column) -> DataFrame:
    """Adds each value's ``place`` among the ``total`` ones of its node, the rarest first.

    Values that nothing else has are left out; they are the rarest of all, and nothing meets by them.
    """
    sized = values.join(values.groupBy("value").agg(F.count("*").alias("size")).where("size > 1"), "value")
    mine = Window.partitionBy("node")
    place = F.row_number().over(mine.orderBy("size", "value")) - 1 + total - F.count("*").over(mine)
    return sized.withColumn("place", place)


def _labelled(values: DataFrame, labels: DataFrame) -> DataFrame:
    known = values.join(labels, "node", "left")
    return known.withColumn("component", F.coalesce("component", "node"))


def _pairs(lists: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    return tuple(lists.select("value", F.col("node").alias(x), F.col("n").alias(f"n{x}"), *[F.col(c).alias(f"{c}_{x}") for c in columns]) for x in "ab")


def _rare_lists(members: DataFrame, reps: DataFrame, labels: DataFrame) -> DataFrame:
    """``value, node, n, component, size`` of lists over the rarest sketch values that hold two components."""
    values = _exploded(reps.join(members.select("node").distinct(), "node").select("node", "n", F.col("sketch").alias("blob")))
    whole = F.col("n") * 4 < 3 * K  # then a partner's sketch is its whole set too
    total = F.least("n", F.lit(K))
    least = F.when(whole, F.ceil(F.col("n") * 0.75)).otherwise(SHARED)
    known = _labelled(_placed(values, total).where(F.col("place") <= total - least).select("value", "node", "n"), labels)
    lists = known.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).where("low <> high")
    return known.join(lists.select("value", "size"), "value")


def _full_lists(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """``value, node, n, component, index, blocks`` of lists over the rarest full-set values that hold two components."""
    sized = sets.withColumn("n", F.expr("cast(length(blob) div 8 as long)"))
    n = F.col("n")
    index = 7 * F.col("place") <= n
    probe = 4 * F.col("place") <= n
    known = _labelled(_placed(_exploded(sized), n).where(probe).select("value", "node", "n", "place", index.alias("index")), labels)
    lists = known.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min(F.when(F.col("index"), n)).alias("least"), F.max("n").alias("most"))
    # a place is of use if the smallest partner on the other side leaves enough common values behind it
    lists = lists.where("low <> high and least is not null").select("value", "least")
    useful = known.join(lists, "value").where("7 * place <= 7 * n - 3 * (n + least) or index")
    shape = useful.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"), F.ceil(F.sum("n") / BLOCK).alias("blocks"))
    return useful.join(shape.where("low <> high").select("value", "blocks"), "value").select("value", "node", "n", "component", "index", "blocks")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each set on the left has in common with each on the right."""
    counts = np.zeros((len(left), len(right)), np.int64)
    values = [np.concatenate(side) for side in (left, right)]
    who = [np.repeat(np.arange(len(side)), [len(x) for x in side]) for side in (left, right)]
    known, place = np.unique(np.concatenate(values), return_inverse=True)
    at = [place[: len(values[0])], place[len(values[0]) :]]
    n = [np.bincount(x, minlength=len(known)) for x in at]
    work = n[0] * n[1]
    dense = work * 64 > counts.size
    columns = np.flatnonzero(dense)
    for first in range(0, len(columns), 2048):
        number = np.full(len(known), -1)
        number[columns[first : first + 2048]] = np.arange(len(columns[first : first + 2048]))
        sides = []
        for side, x, w in zip((left, right), at, who, strict=True):
            matrix, column = np.zeros((len(side), min(2048, len(columns) - first)), np.float32), number[x]
            matrix[w[column >= 0], column[column >= 0]] = 1
            sides.append(matrix)
        counts += (sides[0] @ sides[1].T).astype(np.int64)
    flat, sparse = counts.reshape(-1), (work > 0) & ~dense
    a, b = (np.flatnonzero(sparse[x]) for x in at)
    a, b = a[np.argsort(at[0][a], kind="stable")], b[np.argsort(at[1][b], kind="stable")]
    starts = np.cumsum(np.where(sparse, n[1], 0)) - np.where(sparse, n[1], 0)
    for first in range(0, len(a), 1 << 16):  # each value's rows on the left meet all of its rows on the right
        some = a[first : first + (1 << 16)]
        times = n[1][at[0][some]]
        inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        right_rows = b[np.repeat(starts[at[0][some]], times) + inside]
        np.add.at(flat, np.repeat(who[0][some], times) * len(right) + who[1][right_rows], 1)
    return counts


def _joining(index: list[tuple], probe: list[tuple]) -> list[tuple[int, int]]:
    """Links between two components, as many as join them, among (node, component, set) rows of two sides."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    if len({c for _, c, _ in index} | {c for _, c, _ in probe}) < 2:
        return []
    common = overlaps([v for *_, v in index], [v for *_, v in probe])
    na, nb = (np.array([len(v) for *_, v in side]) for side in (index, probe))
    found = []
    for i, j in np.argwhere(100 * common >= 75 * (na[:, None] + nb[None, :] - common)).tolist():
        x, y = root(index[i][1]), root(probe[j][1])
        if x != y:
            parent[max(x, y)] = min(x, y)
            found.append((index[i][0], probe[j][0]))
    return found


def _blockwise(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that join components within the lists of ``_full_lists``."""
    block = F.pmod(F.xxhash64("node", "value"), F.col("blocks"))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    known = lists.withColumn("block", block)
    one = known.where("index").select("value", "node", "component", F.lit(0).alias("side"), F.col("block").alias("i"), F.explode(every).alias("j"))
    other = known.select("value", "node", "component", F.lit(1).alias("side"), F.explode(every).alias("i"), F.col("block").alias("j"))
    rows = one.unionByName(other).join(sets, "node").select("value", "i", "j", "side", "node", "component", "blob")
    dealt = rows.repartition(tasks(lists.sparkSession), "value", "i", "j").sortWithinPartitions("value", "i", "j")

    def run(batches):
        key, sides = None, ([], [])

        def links():
            found = _joining(*sides) if sides[0] and sides[1] else []
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for value, i, j, side, node, component, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (value, i, j) != key:
                    yield links()
                    key, sides = (value, i, j), ([], [])
                sides[side].append((node, component, np.frombuffer(blob, np.uint64)))
        yield links()

    return dealt.mapInArrow(run, "a long, b long")


def _components(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, h1, h2, n, set_key) of ``docs`` and classes (set_key, node, rep, component); label is the component's smallest rep."""
    signed = scratch.keep(signatures(docs), "signed")
    some = signed.where("n > 0 and doc_id is not null")
    classes = some.groupBy("set_key", "n").agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"), F.first("heads").alias("heads"))
    reps = scratch.keep(classes.withColumn("node", F.monotonically_increasing_id()), "reps")
    rows = scratch.keep(signed.select("doc_id", "h1", "h2", "n", "set_key"), "rows")
    scratch.drop("signed")
    names = reps.select("node", "rep", "set_key")

    def sets_of(nodes: DataFrame, name: str) -> DataFrame:
        wanted = scratch.keep(names.join(nodes.distinct(), "node", "left_semi"), f"{name}-wanted")
        return scratch.keep(_sets(docs, wanted), name, codec="none")

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))

    index = reps.select("node", "n", F.explode("heads").alias("value"))
    lists = index.groupBy("value").agg(F.count("*").alias("size")).where("size > 1")
    members = scratch.keep(index.join(lists, "value"), "members")
    long_lists = members.where(f"size > {SHORT}")

    # the most typical member of a long list: its values are in the longest lists, as an original's are among its copies
    typical = long_lists.groupBy("node").agg(F.sum("size").alias("typical"))
    leaders = long_lists.join(typical, "node").groupBy("value").agg(F.max(F.struct("typical", "n", "node")).alias("l")).select("value", F.col("l.node").alias("leader"), F.col("l.n").alias("nb"))
    star = long_lists.select("value", "node", F.col("n").alias("na")).join(leaders, "value").where("node <> leader").where(NEAR_SIZE).select(F.col("leader").alias("a"), F.col("node").alias("b"))
    x, y = _pairs(members.where(f"size <= {SHORT}"))
    close = x.join(y, "value").where("a < b").where(NEAR_SIZE).select("a", "b")
    pairs = scratch.keep(_estimate(close.unionByName(star).distinct(), reps), "pairs")

    # one partner of each is confirmed first; then only pairs that would join two components
    sets = sets_of(ends(pairs), "sets")
    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = scratch.keep(_confirm(first, sets), "links-1")
    labels = scratch.keep(components(links, scratch, "components-1"), "labels-1")

    def ends_of(found: DataFrame, labels: DataFrame) -> DataFrame:
        la, lb = labels.select(F.col("node").alias("a"), F.col("component").alias("ca")), labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        return found.join(la, "a", "left").join(lb, "b", "left").select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))

    def joined(labels: DataFrame, found: DataFrame, name: str) -> DataFrame:
        """Labels once more links are known: their components are the nodes now."""
        links = scratch.keep(found, f"links-{name}")
        if links.isEmpty():
            return labels
        top = components(ends_of(links, labels).select(F.col("ca").alias("a"), F.col("cb").alias("b")), scratch, f"components-{name}")
        new = ends(links).distinct().join(labels, "node", "left_anti").withColumn("component", F.col("node"))
        over = top.select(F.col("node").alias("component"), F.col("component").alias("over"))
        return scratch.keep(labels.unionByName(new).join(over, "component", "left").select("node", F.coalesce("over", "component").alias("component")), f"labels-{name}")

    rest = ends_of(pairs.join(first, ["a", "b"], "left_anti"), labels).where("ca <> cb").select("a", "b")
    labels = joined(labels, _confirm(rest, sets), "2")

    rare = scratch.keep(_rare_lists(long_lists, reps, labels), "rare")
    x, y = _pairs(rare.where(f"size <= {SHORT}"), "component")
    late = x.join(y, "value").where("a < b and component_a <> component_b").where(NEAR_SIZE).select("a", "b").distinct()
    late = scratch.keep(_estimate(late, reps), "late")
    hard = rare.where(f"size > {SHORT}").select("node")
    late_sets = sets_of(ends(late).unionByName(hard), "late-sets")
    full = scratch.keep(_full_lists(late_sets.join(hard.distinct(), "node", "left_semi"), labels), "full")
    labels = joined(labels, _confirm(late, late_sets).unionByName(_blockwise(full, late_sets)), "3")

    known = reps.select("set_key", "node", "rep").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = known.groupBy("component").agg(F.min(F.struct("rep", "set_key")).alias("least"))
    return rows, known.join(least, "component").select("set_key", F.col("least.rep").alias("found"), F.col("least.set_key").alias("found_key"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    rows, classes = _components(docs, Scratch(docs.sparkSession, "near-dedup"))
    linked = rows.where("n > 0").join(classes.select("set_key", "found"), "set_key", "left").select("doc_id", "n", "found")
    every = linked.unionByName(rows.where("n = 0").select("doc_id", "n", F.lit(None).cast("long").alias("found")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return every.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def remove_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one of smallest ``doc_id``.

    Rows without a word or an id stay.  Rows that repeat an id go only if their text is a
    near-duplicate too; of rows with one id and one text one stays.  All columns stay as they are.
    """
    small_batches(docs.sparkSession)
    rows, classes = _components(docs, Scratch(docs.sparkSession, "near-dedup"))
    chosen = classes.where("set_key = found_key").select("set_key", F.col("found").alias("doc_id"))
    h1, h2, key = free_names(docs, "h1", "h2", "key")
    stay = rows.where("n > 0").join(chosen, ["set_key", "doc_id"], "left_semi")
    stay = stay.groupBy("set_key", "doc_id").agg(F.min(F.struct("h1", "h2")).alias("h")).select(F.col("doc_id").alias(key), F.col("h.h1").alias(h1), F.col("h.h2").alias(h2))
    hashed = docs.select("*", F.col("doc_id").cast("long").alias(key), *[c.alias(name) for c, name in zip(text_key(), (h1, h2), strict=True)])
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    free = F.col("doc_id").isNull() | wordless
    once = hashed.where(~free).join(stay, [key, h1, h2], "left_semi").dropDuplicates([key, h1, h2])
    return once.select(*docs.columns).unionByName(docs.where(free))
