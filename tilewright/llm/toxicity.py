"""Operator 7: toxicity by Levenshtein automata over a lexicon trie, with context windows.

The lexicon is learned: words whose occurrences (told apart by their neighbours, so that copies
count once) are nearly all in toxic training documents.  Levenshtein automata of its entries are
intersected with the trie of all of them, and a word of a document is run through the result, made
deterministic state by state as letters come: two changes in entries of eight letters and more, one
in those of four and more, where two swapped letters are one change.  Besides its runs of letters a
token is matched whole, so that digits and masks within it count as changes.  The words around a
match tell quotation from abuse: quote marks around it or a reporting word before it.  A logistic
model turns the counts into a score.

Fitting uses at most FIT_ROWS labelled rows, those of smallest hash of ``doc_id``; of these, two
thirds give the lexicon on which the weights are fitted with the rest, and then all give the final
lexicon.  Lexicon and model are bounded by that and broadcast.  Every text is scored whole.

Edge cases: null or empty text gets the score of a document without matches; a null ``doc_id`` is
not held out and its row is scored; rows that repeat a ``doc_id`` are scored one by one; without
usable labels every score is the share of toxic labels (0 without any); an empty table gives no
rows; label, language, source and id never enter a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, small_batches
from .words import column_bytes, release

FIT_ROWS = 20_000
THRESHOLD = 0.3
LEAST_SEEN = 4
LEAST_SHARE = 0.95
WINDOW = 8
STATES = 20_000
CACHE_WORDS = 100_000

# Quote marks, and words that report what somebody said.
QUOTES = "\"“”„«»‘’‹›"
REPORTING = {"said", "says", "wrote", "writes", "called", "calls", "quoted", "quote", "term", "word", "sagte", "schrieb", "nannte", "zitat", "wort", "dit", "écrit", "appelé", "mot", "dijo", "escribió", "llamó", "palabra"}

_LETTERS = re.compile(r"[^\W\d_]+")
_EDGES = re.compile(r"^\W+|\W+$")


def changes(entry: str) -> int:
    """Changes allowed in an entry of the lexicon."""
    return 2 if len(entry) >= 8 else 1 if len(entry) >= 4 else 0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


class Automaton:
    """The lexicon's trie intersected with Levenshtein automata, made deterministic as words come.

    An item (node, changes, wanted) says that the letters read lead to ``node`` with so many
    changes; ``wanted`` is the letter that must come next where two are swapped, else empty.  A
    state is the set of items that still lead to an entry within its allowance.
    """

    def __init__(self, words):
        self.words = frozenset(words)
        self.children: list[dict[str, int]] = [{}]
        self.allowed: list[int] = [0]  # the most changes that an entry at or below a node allows
        self.entry: list[int] = [-1]  # what the entry that ends at a node allows
        for word in sorted(self.words):
            node, k = 0, changes(word)
            self.allowed[0] = max(self.allowed[0], k)
            for letter in word:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                    self.entry.append(-1)
                node = self.children[node][letter]
                self.allowed[node] = max(self.allowed[node], k)
            self.entry[node] = k
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, State] = {}
        self.start = self.state([(0, 0, "")])

    def state(self, items: list[tuple[int, int, str]]) -> State:
        """The state of ``items`` and of what letters left out lead to."""
        best: dict[tuple[int, str], int] = {}
        while items:
            node, cost, wanted = items.pop()
            if cost > self.allowed[node] or best.get((node, wanted), cost + 1) <= cost:
                continue
            best[node, wanted] = cost
            if not wanted:
                items += [(child, cost + 1, "") for child in self.children[node].values()]
        key = frozenset((node, cost, wanted) for (node, wanted), cost in best.items())
        found = self.states.get(key)
        if found is None:
            ends = [cost for node, cost, wanted in key if not wanted and cost <= self.entry[node]]
            found = self.states[key] = State(self, key, min(ends, default=None))
        return found

    def after(self, state: State, letter: str) -> State:
        items = []
        for node, cost, wanted in state.items_:
            if wanted:
                items += [(node, cost, "")] if letter == wanted else []
                continue
            items.append((node, cost + 1, ""))
            for other, child in self.children[node].items():
                items.append((child, cost + (other != letter), ""))
                if other != letter and letter in self.children[child]:
                    items.append((self.children[child][letter], cost + 1, other))
        return self.state(items)

    def near(self, word: str) -> int | None:
        """Least distance to an entry that allows so many changes, or None."""
        if word in self.words:
            return 0
        if len(self.states) > STATES:
            self._reset()
        state = self.start
        for letter in word:
            state = state[letter]
            if not state.items_:
                return None
        return state.distance


class State(dict):
    """Maps a letter to the next state."""

    __slots__ = ("automaton", "distance", "items_")

    def __init__(self, automaton: Automaton, items: frozenset, distance: int | None):
        self.automaton, self.items_, self.distance = automaton, items, distance

    def __missing__(self, letter: str) -> State:
        found = self[letter] = self.automaton.after(self, letter)
        return found


class Matcher(dict):
    """Maps a white-space token (bytes) to 0 (no match), 1 (an entry) or 2 (a misspelled one)."""

    def __init__(self, lexicon):
        self.automaton = Automaton(lexicon)

    def __missing__(self, token: bytes) -> int:
        found = 0
        text = token.decode().lower()
        for word in (text,) if text.isalpha() else {*_LETTERS.findall(text), _EDGES.sub("", text)}:
            near = self.automaton.near(word)
            if near is not None:
                found = 1 if near == 0 or found == 1 else 2
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[token] = found
        return found


def features(text: bytes, matcher: Matcher) -> tuple[int, int, int, int]:
    """Abusive entries, abusive misspellings, quoted matches, words."""
    words = text.split()
    kinds = list(map(matcher.__getitem__, words))
    plain = misspelled = quoted = 0
    if any(kinds):
        for i, kind in enumerate(kinds):
            if kind:
                if is_quoted(words, i):
                    quoted += 1
                elif kind == 1:
                    plain += 1
                else:
                    misspelled += 1
    return plain, misspelled, quoted, len(words)


def is_quoted(words: list[bytes], i: int) -> bool:
    """Whether the window around word ``i`` marks it as quotation."""
    before = [w.decode() for w in words[max(0, i - WINDOW) : i]]
    here = words[i].decode()
    after = [w.decode() for w in words[i + 1 : i + 1 + WINDOW]]
    opened = bool(here) and here[0] in QUOTES or sum(sum(w.count(q) for q in QUOTES) for w in before) % 2 == 1
    closed = here.rstrip(".,;:!?")[-1:] in QUOTES or any(q in w for w in after for q in QUOTES)
    reported = any(w.strip(".,;:!?" + QUOTES).lower() in REPORTING for w in before[-3:])
    return (opened and closed) or reported


@dataclass
class Model:
    lexicon: tuple[str, ...] = ()
    weights: tuple[float, ...] = (0.0,)
    constant: float | None = field(default=0.0)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(counts), self.constant)
        return 1 / (1 + np.exp(-np.clip(inputs(counts) @ np.array(self.weights), -30, 30)))


def inputs(counts: np.ndarray) -> np.ndarray:
    counts = np.asarray(counts, float).reshape(-1, 4)
    density = 100 * counts[:, :2].sum(axis=1) / np.maximum(counts[:, 3], 1)
    return np.column_stack([np.ones(len(counts)), np.log1p(counts[:, :3]), np.log1p(density)])


#: Where the weights lie without evidence: abuse counts, quotation hardly does.
_PRIOR = np.array([-4.0, 2.0, 1.0, 0.2, 0.5])


def fit_weights(counts: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, drawn to the prior."""
    x, w, pull = inputs(counts), _PRIOR.copy(), np.array([0.01, 0.3, 0.3, 1.0, 0.3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (toxic - p) - pull * (w - _PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), gradient)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def lexicon(rows: DataFrame) -> tuple[str, ...]:
    """Words that mark toxic documents, from rows (text, toxic)."""

    def run(batches):
        for batch in batches:
            words, contexts, toxic = [], [], []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = _LETTERS.findall(text.lower())
                for before, word, after in zip(["", *found[:-1]], found, [*found[1:], ""], strict=True):
                    if len(word) > 3:
                        words.append(word)
                        contexts.append(f"{before} {after}")
                        toxic.append(label)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(contexts, pa.string()), pa.array(toxic, pa.int32())], ["word", "context", "toxic"])

    seen = rows.select("text", F.col("toxic").cast("int")).mapInArrow(run, "word string, context string, toxic int").groupBy("word", F.xxhash64("context").alias("context")).agg(F.max("toxic").alias("toxic"))
    counts = seen.groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    marked = counts.where((F.col("t") >= LEAST_SEEN) & (F.col("t") >= LEAST_SHARE * F.col("n")))
    return tuple(sorted(r.word for r in marked.select("word").collect()))  # bounded by the words of FIT_ROWS rows


def count_features(docs: DataFrame, words: tuple[str, ...], keep: list[str]) -> DataFrame:
    """``keep`` columns with plain, misspelled, quoted and words of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    schema = docs.select(*keep).schema
    for name in ("plain", "misspelled", "quoted", "words"):
        schema = schema.add(name, "long")

    def run(batches):
        release()
        matcher = Matcher(shared.value)
        for batch in batches:
            counts = np.array([features(t, matcher) for t in column_bytes(batch.column(len(keep)))], np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *map(pa.array, counts.T.copy())], [*keep, "plain", "misspelled", "quoted", "words"])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> Model:
    """Lexicon and weights from labelled rows that are not held out."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    chosen = usable.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    texts = docs.select("doc_id", "text").where("text is not null")
    joined = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.greatest(F.least("toxic", F.lit(1)), F.lit(0)).alias("toxic"), (F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)) == 0).alias("late"))
    sample = scratch.keep(joined, "sample")
    total = sample.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    if not total.n or total.t in (0, total.n):
        return Model(constant=float(total.t or 0) / max(total.n, 1))
    early = lexicon(sample.where("not late"))
    counted = count_features(sample.where("late"), early, ["toxic"]).collect()  # at most FIT_ROWS rows of five numbers
    weights = fit_weights(np.array([r[1:] for r in counted]), np.array([r.toxic for r in counted])) if counted else _PRIOR
    return Model(lexicon(sample), tuple(map(float, weights)), None)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` and the match counts of every row."""
    counted = count_features(docs.select(F.col("doc_id").cast("long"), "text"), model.lexicon, ["doc_id"])
    if model.constant is not None:
        value = F.lit(float(model.constant))
    else:
        w = model.weights
        density = 100 * (F.col("plain") + F.col("misspelled")) / F.greatest("words", F.lit(1))
        value = 1 / (1 + F.exp(-(F.lit(w[0]) + w[1] * F.log1p("plain") + w[2] * F.log1p("misspelled") + w[3] * F.log1p("quoted") + w[4] * F.log1p(density))))
    return counted.withColumn("score", value).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the match counts of every row of ``docs``."""
    small_batches(docs.sparkSession)
    model = fit(docs, labels, Scratch(docs.sparkSession, "toxicity"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "plain", "misspelled", "quoted")


def remove_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents predicted toxic; all columns stay."""
    small_batches(docs.sparkSession)
    model = fit(docs, labels, Scratch(docs.sparkSession, "toxicity"))
    shared = docs.sparkSession.sparkContext.broadcast((model.lexicon, model))
    at = docs.columns.index("text")

    def run(batches):
        release()
        matcher = Matcher(shared.value[0])
        for batch in batches:
            counts = np.array([features(t, matcher) for t in column_bytes(batch.column(at))], np.int64)
            yield batch.filter(pa.array(shared.value[1].score(counts) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
