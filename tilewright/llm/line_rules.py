"""Operator 5: quality rules, lines first, in DataFrame expressions only.

Every line is judged by itself: sentence punctuation, shouting, symbols, navigation separators,
boilerplate wording and repeated words.  Lines that fail are removed, and a document that loses
more than LOST of its words, or that fails the base rules, is rejected.

Edge cases: null or empty text has no words and fails the base rules; blank lines are neither
judged nor removed; a null ``doc_id`` stays null; repeated rows are judged one by one; texts of any
length are read whole; an empty table gives no rows; other columns are carried by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
GAP = "[\\x20\\x09-\\x0D]+"
WINDOW = 8
LOST = 0.5

# Wording that marks a line as boilerplate (matched without regard to case).
BOILERPLATE = "(?i)all rights reserved|^(licensed|released|distributed) under |^this work is licensed|^copyright |©|terms of (use|service)|privacy policy|cookie (policy|settings)|^(sign in|sign up|log in|subscribe|click here|skip to|share this|read more|back to top)|enable javascript"
SYMBOLS = "[#*$%&|<>]"
SEPARATORS = "[|»›·•]|\\s>\\s"


def words_of(text: Column) -> Column:
    """Words of a text or line as an array, none for white space."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def line_fails(line: Column) -> Column:
    """Whether a line that has a word is to be removed."""
    n = F.regexp_count(line, F.lit("[^\\x20\\x09-\\x0D]+"))
    shouted = F.regexp_count(line, F.lit("!!"))
    symbols = F.regexp_count(line, F.lit(SYMBOLS))
    separators = F.regexp_count(line, F.lit(SEPARATORS))
    unpunctuated = (n >= 20) & ~line.rlike("[.!?…:;。]")
    repeated = (n >= 6) & (F.size(F.array_distinct(words_of(line))) < 0.4 * n)
    return line.rlike(BOILERPLATE) | ((shouted >= 3) & (shouted >= 0.3 * n)) | ((symbols >= 3) & (symbols >= 0.5 * n)) | ((separators >= 2) & (separators >= 0.25 * n)) | unpunctuated | repeated


def _measured(docs: DataFrame, carried: list[str]) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(*carried, text.alias("_text"), words_of(text).alias("_words"), F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("_lines"))
    hashes = F.transform("_words", lambda w: F.xxhash64(w))
    base = split.select(
        *carried, "_text", "_lines", hashes.alias("_hashes"), F.size("_words").cast("long").alias("n_words"), F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"), (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate("_lines", F.struct(F.lit(0).alias("n"), F.lit(0).alias("words")), lambda a, x: F.when(line_fails(x), F.struct((a.n + 1).alias("n"), (a.words + F.regexp_count(x, F.lit("[^\\x20\\x09-\\x0D]+"))).alias("words"))).otherwise(a)).alias("_removed"),
    )
    windows = F.when(F.size("_hashes") >= WINDOW, F.transform(F.sequence(F.lit(1), F.size("_hashes") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    windowed = base.withColumn("_windows", windows).drop("_hashes")
    ranked = F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    ordered = windowed.withColumn("_ranked", ranked).drop("_windows")
    at = F.transform("_ranked", lambda x, i: F.struct(x.i.alias("i"), ((F.get("_ranked", i - 1).h == x.h) | F.coalesce(F.get("_ranked", i + 1).h == x.h, F.lit(False))).alias("twice")))
    starts = ordered.withColumn("_starts", F.sort_array(F.transform(F.filter(at, lambda x: x.twice), lambda x: x.i))).drop("_ranked")
    covered = F.aggregate("_starts", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, s: F.struct((a.n + s + WINDOW - F.greatest(a.end, s)).alias("n"), (s + WINDOW).alias("end"))).n
    return starts.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_starts")


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id`` with the measures, the base rules and the verdict of every row."""
    found = _measured(docs, ["doc_id"])
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    lost = F.col("_removed.words").cast("long")
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), (~base_failed & (lost <= LOST * F.col("n_words"))).alias("kept"),
        F.col("_removed.n").cast("long").alias("n_lines_removed"), lost.alias("n_words_removed"),
    )


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` without rejected documents and without failing lines; all columns stay."""
    names = docs.columns
    row = docs.select(F.struct("*").alias("_row"), F.col("doc_id"), F.col("text"))
    found = _measured(row, ["_row"]).where("n_words >= 20 and 100 * n_repeat_words <= 30 * n_words").where(F.col("_removed.words") <= LOST * F.col("n_words"))
    kept = F.array_join(F.filter(F.split("_text", "\n"), lambda x: ~(x.rlike("[^\\x20\\x09-\\x0D]") & line_fails(x))), "\n")
    return found.select(*[kept.alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in names])
