"""Operator 10: mix sources to target weights by pivotal dependent rounding, in DataFrame expressions only.

Sources share the words of the whole corpus by weight, none above CAP times its own size (the
excess is shared again by weight: a water level).  A document of a source is due target / size
copies: the whole part is certain, the fraction p is rounded.  Rounding pairs two documents and
moves mass p * words at random from one to the other until one of the two is 0 or 1; expectation
and each source's words stay as they are.  Chunks of about FAN documents are paired off in turn,
each leaves one fractional document, and those meet again in chunks: a reduction tree.  What it
leaves is paired with short documents kept back for that.  A long document among short ones may
stay open to the end; what its rounding adds or lacks is then given back by those short documents,
the longest that fit first, and it is rounded the way that leaves less missing.  So a source's words
miss its target by about half a short document.  Randomness is a hash of the pair, so reruns agree.

Rows with one id, source and size are one group of n alike: n * p whole rows are taken for certain,
only the rest of it is rounded, so copies of a row never meet in one chunk.

Edge cases: null text has size 0 and takes 0 words; a null source is a source of its own, ordered
last; null or repeated ``doc_id`` are rows of their own; a corpus without words has targets of 0;
an empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch, free_names, tasks

WEIGHTS = (1, 2, 3)
CAP = 3
FAN = 64
POOL = 512
WORD = "[^\\x20\\x09-\\x0D]+"


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", _size().alias("size"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size, n, target``: one row a source, from sums over all documents."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("n"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighed = sums.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    full = (F.col("source_size") * cap).cast("double")
    by_level = Window.orderBy(full / F.col("w"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total, weight = F.sum("source_size").over(every), F.sum("w").over(every)
    level = (total - F.coalesce(F.sum(full).over(before), F.lit(0.0))) / (weight - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    levels = weighed.withColumn("level", level).withColumn("ratio", full / F.col("w"))
    water = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(every).level
    return levels.select("source", "source_size", "n", F.least(full, F.coalesce(water, F.lit(float("inf"))) * F.col("w")).alias("target"))


#: Rows alike that one task unfolds.
ALIKE = 1 << 16

_START = "named_struct('open', cast(null as struct<doc_id:{id},size:bigint,p:double,rest:{rest}>), 'done', cast(array() as array<struct<doc_id:{id},size:bigint,p:double,rest:{rest}>>))"

#: One pairing: a is the open document, x the next; up and down are the masses that may move to a or from a.
_PAIR = """
aggregate(members, {start}, (acc, m) -> if(acc.open is null, named_struct('open', m.d, 'done', acc.done),
  aggregate(array(named_struct('a', acc.open, 'x', m.d,
      'up', least((1 - acc.open.p) * acc.open.size, m.d.p * m.d.size),
      'down', least(acc.open.p * acc.open.size, (1 - m.d.p) * m.d.size),
      'u', pmod(xxhash64(acc.open.doc_id, acc.open.size, m.d.doc_id, m.d.size, {salt}), 4503599627370496) / 4503599627370496D)),
    acc, (same, t) -> {choose})))
"""


def _choose() -> str:
    document = "named_struct('doc_id', t.{0}.doc_id, 'size', t.{0}.size, 'p', {1}, 'rest', t.{0}.rest)"

    def moved(first: str, second: str, a_done: str) -> str:
        # a_done: a became whole, so x stays open; else x became whole and a stays open
        end = f"if({first} >= 0.5D, 1D, 0D)"
        other = f"if({second} >= 0.5D, 1D, 0D)"
        closed_a = f"named_struct('open', {document.format('x', second)}, 'done', concat(same.done, array({document.format('a', end)})))"
        closed_x = f"named_struct('open', {document.format('a', first)}, 'done', concat(same.done, array({document.format('x', other)})))"
        return f"if({a_done}, {closed_a}, {closed_x})"

    up = moved("(t.a.p + t.up / t.a.size)", "(t.x.p - t.up / t.x.size)", "(1 - t.a.p) * t.a.size <= t.x.p * t.x.size")
    down = moved("(t.a.p - t.down / t.a.size)", "(t.x.p + t.down / t.x.size)", "t.a.p * t.a.size <= (1 - t.x.p) * t.x.size")
    return f"if(t.u * (t.up + t.down) < t.down, {up}, {down})"


#: The documents kept back, longest first: each is turned over if that brings the missing words ``e`` nearer to none.
_GIVE_BACK = """
aggregate(sort_array(transform(r.done, x -> named_struct('by', -x.size, 'h', xxhash64(x.doc_id, x.size), 'd', x))),
  named_struct('e', {e}, 'done', cast(array() as array<struct<doc_id:{id},size:bigint,p:double,rest:{rest}>>)),
  (acc, m) -> if(if(m.d.p < 0.5D, acc.e, -acc.e) * 2 > m.d.size,
    named_struct('e', if(m.d.p < 0.5D, acc.e - m.d.size, acc.e + m.d.size),
      'done', concat(acc.done, array(named_struct('doc_id', m.d.doc_id, 'size', m.d.size, 'p', 1 - m.d.p, 'rest', m.d.rest)))),
    named_struct('e', acc.e, 'done', concat(acc.done, array(m.d)))))
"""


def round_copies(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Round ``p`` of rows ``(source, doc_id, size, p, rest)``, all with 0 < p < 1 and size > 0, to 0 or 1.

    ``doc_id`` and ``size`` tell the rows of a source apart; ``rest`` is handed through.  About POOL
    documents a source of at most its mean size wait until the tree has left one fractional
    document; they take up its fraction, and what rounding the last one adds or lacks.
    """
    types = {"id": docs.schema["doc_id"].dataType.simpleString(), "rest": docs.schema["rest"].dataType.simpleString()}
    fold = F.expr(_PAIR.format(start=_START.format(**types), salt="salt", choose=_choose()))
    member = F.struct((-F.col("size")).alias("by"), F.xxhash64("doc_id", F.lit("order")).alias("h"), F.struct("doc_id", "size", "p", "rest").alias("d"))
    members = F.sort_array(F.collect_list(member)).alias("members")

    def counted(df: DataFrame, *sums) -> DataFrame:
        counts = df.groupBy(F.col("source").alias("_of")).agg(*sums)
        return df.join(counts, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")

    def opened(folded: DataFrame, column: str) -> DataFrame:
        return folded.select("source", F.explode(column).alias("d")).select("source", "d.doc_id", "d.size", "d.p", "d.rest")

    dealt = counted(docs, F.avg("size").alias("mean"), F.ceil(F.count("*") / POOL).alias("every"))
    waits = (F.col("size") <= F.col("mean")) & (F.pmod(F.xxhash64("doc_id", "size", F.lit("pool")), F.col("every")) == 0)
    dealt = scratch.keep(dealt.select("source", "doc_id", "size", "p", "rest", waits.alias("waits")), "dealt")
    ends, left, done, level = [dealt.where("waits").drop("waits")], dealt.where("not waits").drop("waits"), [], 0
    while True:
        level += 1
        chunk = F.pmod(F.xxhash64("doc_id", "size", F.lit(level)), F.col("chunks")).alias("chunk")
        lists = counted(left, F.ceil(F.count("*") / FAN).alias("chunks")).groupBy("source", chunk, "chunks").agg(members)
        folded = scratch.keep(lists.withColumn("salt", F.lit(level)).select("source", "chunks", fold.alias("r")), f"level-{level}")
        done.append(opened(folded, "r.done"))
        rest = folded.select("source", "chunks", "r.open.doc_id", "r.open.size", "r.open.p", "r.open.rest")
        ends.append(rest.where("chunks = 1").drop("chunks"))
        left = rest.where("chunks > 1").drop("chunks")
        if left.isEmpty():
            break
    lists = reduce(DataFrame.unionByName, ends).groupBy("source").agg(members)
    folded = lists.withColumn("salt", F.lit(0)).select("source", fold.alias("r"))
    # the last document is rounded the way that leaves less missing, by its own fraction if both leave the same
    ways = [F.expr(_GIVE_BACK.format(e=f"(r.open.p - {way}D) * r.open.size", **types)).alias(name) for way, name in ((0, "down"), (1, "up"))]
    chance = F.pmod(F.xxhash64("r.open.doc_id", "r.open.size", F.lit("last")), F.lit(1 << 52)) / float(1 << 52)
    more = F.abs("up.e") - F.abs("down.e")
    up = (more < 0) | ((more == 0) & (chance < F.col("r.open.p")))
    both = folded.select("source", "r", *ways).select("source", "r.open", "up", "down", up.cast("double").alias("last"))
    ended = scratch.keep(both.select("source", "open", "last", F.when(F.col("last") == 1, F.col("up.done")).otherwise(F.col("down.done")).alias("done")), "last")
    residual = ended.select("source", "open.doc_id", "open.size", F.col("last").alias("p"), "open.rest")
    return reduce(DataFrame.unionByName, [*done, opened(ended, "done"), residual])


def allot(sized: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, doc_id, size, rows, source_size, target, whole, extra`` of each group of rows alike in ``sized``.

    Every row of a group is taken ``whole`` times, and ``extra`` of them once more.
    """
    goals = scratch.keep(targets(sized, weights, cap).withColumnRenamed("source", "_of"), "targets")
    of_goal = F.col("source").eqNullSafe(F.col("_of"))
    copies = F.when((F.col("source_size") > 0) & (F.col("size") > 0), F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    groups = sized.groupBy("source", "doc_id", "size").agg(F.count("*").alias("rows")).join(goals, of_goal)
    due = groups.withColumn("whole", F.floor(copies + 1e-9)).withColumn("mass", F.col("rows") * F.greatest(copies - F.col("whole"), F.lit(0.0)))
    due = due.withColumn("sure", F.floor(F.col("mass") + 1e-9)).withColumn("p", F.greatest(F.col("mass") - F.col("sure"), F.lit(0.0)))
    due = scratch.keep(due.select("source", "doc_id", "size", "p", F.struct("rows", "whole", "sure").alias("rest")), "due")
    plain = due.where("p <= 1e-9").withColumn("p", F.lit(0.0))
    rounded = plain.unionByName(round_copies(due.where("p > 1e-9"), scratch))
    known = rounded.select("source", "doc_id", "size", "rest.rows", "rest.whole", (F.col("rest.sure") + F.col("p").cast("long")).alias("extra"))
    return known.join(goals, of_goal).select("source", "doc_id", "size", "rows", "source_size", "target", "whole", "extra")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every row of ``docs`` (doc_id, source, text)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    groups = allot(scratch.keep(sizes(docs), "sized"), scratch, weights, cap)
    one = groups.where("rows = 1").withColumn("number", F.lit(0).cast("long"))
    parts = groups.where("rows > 1").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / ALIKE))))
    dealt = parts.repartition(tasks(spark), "doc_id", "size", "part")
    many = dealt.withColumn("number", F.explode(F.sequence(F.col("part") * ALIKE, F.least("rows", (F.col("part") + 1) * ALIKE) - 1))).drop("part")
    n = (F.col("whole") + (F.col("number") < F.col("extra")).cast("long")).alias("copies")
    out = one.unionByName(many).select("doc_id", "source", "size", "source_size", "target", n)
    return out.withColumn("taken", F.col("size") * F.col("copies"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, all columns as they are.

    A null ``source`` is a source of its own; rows with a null or repeated ``doc_id`` are rows of
    their own; rows without words go.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    size, copy, number, *names = free_names(docs, "size", "copy", "number", "of_id", "of_source", "of_size", "rows", "whole", "extra")
    groups = allot(scratch.keep(sizes(docs), "sized"), scratch, weights, cap).where("whole + extra > 0").select("doc_id", "source", "size", "rows", "whole", "extra").toDF(*names)
    of_id, of_source, of_size, rows, whole, extra = names
    sized = docs.withColumn(size, _size()).where(F.col(size) > 0)
    met = sized.join(groups, F.col("doc_id").eqNullSafe(F.col(of_id)) & F.col("source").eqNullSafe(F.col(of_source)) & (F.col(size) == F.col(of_size)))
    alike = Window.partitionBy(of_id, of_source, of_size).orderBy("text")
    one = met.where(F.col(rows) == 1).withColumn(number, F.lit(1))
    many = met.where(F.col(rows) > 1).withColumn(number, F.row_number().over(alike))
    times = F.col(whole).cast("int") + (F.col(number) <= F.col(extra)).cast("int")
    taken = one.unionByName(many).withColumn(copy, times).where(F.col(copy) > 0)
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy)))).select(*docs.columns)
