import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size long, block string, rep long, value string, row int"


def frame(spark, rows, parts=3):
    """Documents from (doc_id, text) or (doc_id, text, source), with further columns whose names clash."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, 1, "b", 2, "v", 3) for r in rows]
    return spark.createDataFrame(full, COLUMNS).repartition(parts)


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows, parts=3: frame(spark, rows, parts)


@pytest.fixture(scope="session")
def odd():
    """Null, empty, blank, short, repeated and very long texts; null and repeated ids."""
    rng = random.Random(4)
    long = " ".join(f"w{rng.randrange(3000)}" for _ in range(120_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, long), (7, long), (None, "a null id has text too"), (8, "Été naïve 日本語 \U0001f600"), (9, "same row"), (9, "same row"), (-3, "negative")]


@pytest.fixture(scope="session")
def corpus():
    """Random texts with copies, near copies, shared passages and repeated lines."""
    rng = random.Random(11)
    pool = [f"w{i}" for i in range(4000)]
    text = lambda n: [rng.choice(pool) for _ in range(n)]
    passage, docs = text(70), []
    for i in range(60):
        words = text(rng.randint(1, 160))
        if i % 4 == 0:
            words[len(words) // 2 : len(words) // 2] = passage
        docs.append(words)
    for k in (3, 8, 8, 20, 33):
        docs.append(list(docs[k]))
        near = list(docs[k])
        near[rng.randrange(len(near))] = "changed"
        docs.append(near)
    rows = [(i * 2, " ".join(w).replace(" w7", "\nw7")) for i, w in enumerate(docs)]
    rng.shuffle(rows)
    return rows
