"""Operator 4: personal data by fixed forms and by bootstrapped contextual extraction.

Fixed forms find e-mail addresses, IPv4 addresses, payment cards and phone numbers.  Other
identifier-like tokens are candidates (instances).  Each instance has lexical patterns: the cue
before it (a word with ``=``, ``:`` or a quote) and its shape.  Seeds, which are the fixed forms in
a cue, known key formats and tokens behind a seed cue, score 1.  In ROUNDS rounds Spark scores the
pattern-instance graph: a pattern's confidence is the mean score of its distinct instances (with
SMOOTHING unscored ones added), an instance's score is the noisy-or of its patterns.  Instances that
reach ACCEPTED give further spans, of kind ``context``; they never overlap or replace fixed ones.

Offsets are code points, ends exclusive.  Edge cases: null or empty text has no spans; a null
``doc_id`` stays null and repeated rows are searched one by one; whole texts of any length are
read in linear time; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, small_batches
from .words import column_bytes

ROUNDS = 4
SMOOTHING = 1.0
ACCEPTED = 0.6
KINDS = ("email", "ip", "card", "phone")

# Cues and key formats that seed the bootstrapping.
SEED_CUES = ("password", "passwd", "pwd", "secret", "token", "ssn", "iban", "passport")
SEED_FORMATS = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abp]-[0-9A-Za-z-]{10,}")

_MAYBE = re.compile(rb"[@0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CANDIDATE = re.compile(r"[A-Za-z0-9_-]{8,}")
_CUE = re.compile(r"([^\W\d_]+)(\s*[=:]\s*[\"'“«]?|\s*[\"'“«])\Z")
_LOCAL_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> list[tuple[int, int]]:
    """From each ``@`` back over the local part and on over the domain: linear in the text."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_LETTERS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            found.append((start, last))
        at = text.find("@", max(at + 1, last))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Fixed forms of a text, by kind and then by start."""
    spans = [("email", a, b) for a, b in emails(text)]
    spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    spans += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if 16 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return spans


def shape(token: str) -> str:
    """Which letters an identifier is made of."""
    if re.fullmatch(r"[0-9a-f]+", token):
        return "hex"
    if re.fullmatch(r"[0-9]+(?:-[0-9]+)*", token):
        return "digits"
    if re.fullmatch(r"[0-9A-Z]+", token):
        return "upper"
    return "lower" if token == token.lower() else "mixed"


def cue(text: str, start: int) -> str | None:
    """The word and separator right before a place."""
    found = _CUE.search(text, max(0, start - 40), start)
    return found and f"{found.group(1).lower()}{''.join(found.group(2).split())}"


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int, str, str | None, str, bool]]:
    """(start, end, instance, cue, shape, seed) of identifier-like tokens, and of fixed forms behind a cue as seeds."""
    found = [(a, b, text[a:b], before, kind, True) for kind, a, b in taken if (before := cue(text, a))]
    covered = np.array(sorted((a, b) for _, a, b in taken), np.int64).reshape(-1, 2)
    reach = np.maximum.accumulate(covered[:, 1]) if len(covered) else covered[:, 1]
    for m in _CANDIDATE.finditer(text):
        token = m.group()
        digits = sum("0" <= c <= "9" for c in token)
        if digits < 2 or (token.isdigit() and digits < 9):
            continue
        k = int(np.searchsorted(covered[:, 0], m.end(), "left"))  # fixed forms that begin before its end
        if k and reach[k - 1] > m.start():
            continue
        before = cue(text, m.start())
        seed = bool(SEED_FORMATS.fullmatch(token)) or bool(before and before.rstrip("=:\"'“«") in SEED_CUES)
        found.append((m.start(), m.end(), token, before, shape(token), seed))
    return found


_CANDIDATES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("instance", pa.string()), ("cue", pa.string()), ("shape", pa.string()), ("seed", pa.bool_())]))
_SEARCHED = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, found array<struct<start:long,end:long,instance:string,cue:string,shape:string,seed:boolean>>"


def _search(batches):
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "found"]
    for batch in batches:
        counts, bases, found = [], [], []
        for raw in column_bytes(batch.column(1)):
            spans, tokens = [], []
            if _MAYBE.search(raw):
                text = raw.decode()
                spans = base_spans(text)
                tokens = candidates(text, spans)
            counts.append([sum(k == kind for k, _, _ in spans) for kind in KINDS])
            bases.append(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
            found.append([dict(zip(("start", "end", "instance", "cue", "shape", "seed"), t, strict=True)) for t in tokens])
        numbers = np.array(counts, np.int64).reshape(-1, 4).T
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in numbers.copy()), pa.array(bases, pa.string()), pa.array(found, _CANDIDATES)], names)


def bootstrap(found: DataFrame, scratch: Scratch) -> DataFrame:
    """``instance, score`` of every instance in ``found`` (instance, cue, shape, seed, fixed)."""
    instances = found.groupBy("instance").agg(F.max("seed").alias("seed"))
    cues = found.where("cue is not null").select("instance", F.concat(F.lit("cue "), "cue").alias("pattern"))
    shapes = found.select("instance", F.concat(F.lit("shape "), "shape").alias("pattern"))
    edges = scratch.keep(cues.unionByName(shapes).distinct(), "edges")
    scores = scratch.keep(instances.select("instance", "seed", F.col("seed").cast("double").alias("score")), "scores-0")
    for step in range(ROUNDS):
        confidence = edges.join(scores, "instance").groupBy("pattern").agg((F.sum("score") / (F.count("*") + SMOOTHING)).alias("confidence"))
        doubt = edges.join(confidence, "pattern").groupBy("instance").agg(F.exp(F.sum(F.log(1.0 - F.least("confidence", F.lit(0.99))))).alias("doubt"))
        better = scores.join(doubt, "instance").select("instance", "seed", F.when(F.col("seed"), F.lit(1.0)).otherwise(1.0 - F.col("doubt")).alias("score"))
        scores = scratch.keep(better, f"scores-{step + 1}")
    return scores


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context`` of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "personal-data")
    searched = docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(_search, _SEARCHED).withColumn("row", F.monotonically_increasing_id())
    searched = scratch.keep(searched, "searched")
    tokens = searched.where(F.size("found") > 0).select("row", F.explode("found").alias("f")).select("row", "f.*")
    accepted = bootstrap(tokens, scratch).where(F.col("score") >= ACCEPTED).select("instance")
    loose = tokens.where(~F.col("shape").isin(*KINDS)).join(accepted, "instance").select("row", "start", "end")
    added = loose.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("more"))
    more = F.array_join(F.transform("more", lambda s: F.concat(F.lit("context:"), s.start.cast("string"), F.lit(":"), s.end.cast("string"))), ",")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(F.col("more").isNotNull(), more))
    joined = searched.drop("found").join(added, "row", "left")
    return joined.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), spans.alias("spans"), F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_context"))


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
