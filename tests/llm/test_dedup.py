import hashlib

import numpy as np
import pytest

from tilewright.llm import chaining, near_dedup, suffix_dedup


def repeats(rows):
    first, out = {}, []
    order = lambda i: float("inf") if i is None else i
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, t in data:
        for p in range(len(t) - 49):
            w = t[p : p + 50]
            first[w] = min(first.get(w, float("inf")), order(i))
    for i, t in data:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < order(i):
                gone[p : p + 50] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment", [100, 1 << 19])
def test_suffix_dedup_is_exact(make, corpus, monkeypatch, segment):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 2000)
    found = [tuple(r) for r in suffix_dedup.remove_repeats(make(corpus)).collect()]
    assert sorted(found, key=str) == repeats(corpus)


def test_suffix_dedup_edges(make, odd):
    assert sorted([tuple(r) for r in suffix_dedup.remove_repeats(make(odd)).collect()], key=str) == repeats(odd)
    assert suffix_dedup.remove_repeats(make([])).collect() == []


def test_interval_tree_gives_all_maximal_repeats():
    # common prefixes of a group of five suffixes, the first entry unused
    assert sorted(suffix_dedup.maximal_repeats([0, 60, 55, 70, 50], 0, 4)) == [(50, 0, 4), (55, 0, 3), (60, 0, 1), (70, 2, 3)]
    text = np.frombuffer((b"x" * 3 + bytes(range(60, 125))) + (b"y" * 3 + bytes(range(60, 125))), np.uint8)
    assert suffix_dedup.covered(text, np.array([68, 68]), np.array([1, 2])) == [(1, 3, 65)]


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))) if words else frozenset()


def classes(rows):
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def found_classes(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()}


def test_near_dedup(make, corpus, odd):
    rows = corpus + [(i + 100_000 if i is not None else i, t) for i, t in odd]
    found = found_classes(make(rows))
    assert found.pop(None) == (2, None, True)
    assert found == classes(rows)
    assert near_dedup.near_duplicates(make([])).collect() == []


def test_near_dedup_long_lists(make, monkeypatch):
    """A large group of near copies and a passage that many unrelated documents share."""
    import random

    monkeypatch.setattr(near_dedup, "SHORT", 8)
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    base, passage, docs = words(150), words(60), []
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(150)] = "edit"
        docs.append(copy)
    for i in range(60):
        own = passage + words(rng.randint(5, 60))
        docs.append(own)
        if i % 4 == 0:
            docs.append([*own[:-1], "twin"])
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)]
    assert found_classes(make(rows)) == classes(rows)


def test_near_dedup_groups_without_short_lists(make):
    """Groups of more than SHORT documents, each near seven others of its group, and all with one passage."""
    passage, docs = [f"p{i}" for i in range(12)], []
    for g in range(3):
        for k in range(128):
            words = passage + [f"g{g}w{i}" for i in range(39)]
            for j in range(7):
                words[16 + 5 * j] = f"g{g}s{j}{k >> j & 1}"
            docs.append((g * 1000 + k, " ".join(words)))
    found = found_classes(make(docs))
    assert found == {i: (47, i // 1000 * 1000, i % 1000 == 0) for i, _ in docs}


def test_near_dedup_large_groups_share_a_block(make):
    """Groups larger than SHORT, near inside and just under the limit to each other."""
    block, docs = [f"c{i}" for i in range(170)], []
    for g in range(8):
        for k in range(36):
            own = [f"g{g}x{i}" for i in range(32)]
            own[k % 27] = f"e{g}_{k}"
            docs.append((g * 1000 + k, " ".join(block + own)))
    found = found_classes(make(docs))
    assert found == classes(docs)
    assert sum(kept for *_, kept in found.values()) == 8


def test_block_overlaps():
    rng = np.random.default_rng(3)
    sides = [[np.unique(rng.integers(0, top, rng.integers(0, 60))).astype(np.uint64) for _ in range(n)] for n, top in ((40, 90), (25, 4000))]
    for left, right in ((sides[0], sides[0]), (sides[0], sides[1]), (sides[1], sides[1])):
        assert near_dedup.overlaps(left, right).tolist() == [[len(np.intersect1d(x, y)) for y in right] for x in left]


def test_removal_keeps_rows_that_only_share_an_id(make):
    words = lambda a: " ".join(f"{a}{i}" for i in range(30))
    rows = [(1, words("a")), (1, words("b")), (1, words("b")), (2, words("a")), (3, words("b") + " more"), (None, words("a")), (None, None), (4, ""), (4, " "), (5, words("c"))]
    docs = make(rows).withColumnRenamed("block", "h1").withColumnRenamed("value", "set_key")
    left = near_dedup.remove_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, (r.text or "")[:2]) for r in left.collect()) == [(0, ""), (0, "a0"), (1, "a0"), (1, "b0"), (4, ""), (4, " "), (5, "c0")]
    assert near_dedup.remove_near_duplicates(make([])).collect() == []


def test_chain_is_the_best_one():
    # the second segment lies off the others' line far away
    segments = [(0, 0, 10), (12, 500, 10), (14, 13, 10), (40, 36, 20)]
    assert chaining.chain(segments)[0] == [0, 2, 3]
    assert sorted(i for path in chaining.chain(segments) for i in path) == [0, 1, 2, 3]


def test_align_passes_substitutions():
    a = np.arange(100)
    b = np.concatenate([np.arange(1000, 1005), a[:50], [777, 778], a[52:]])
    assert chaining.align(a, b, [(10, 15, 20), (60, 65, 20)])[:5] == (0, 100, 5, 105, 98)


def test_lone_seeds_last_if_their_likeness_does():
    """Held against the alignment itself: what it drops cannot reach MATCHING words."""
    rng, n = np.random.default_rng(5), chaining.NEAR_BY
    kept = dropped = 0
    for _ in range(400):
        a = rng.integers(0, 1000, 200)
        b = np.where(rng.random(200) < rng.choice([0, 0.1, 0.6, 0.9]), a, rng.integers(1000, 2000, 200))
        b[100:105] = a[100:105]
        around = lambda x: np.concatenate([x[100 - n : 100][::-1], x[105 : 105 + n]])[None, :].astype("<u2")
        has = np.ones((1, 2 * n), bool)
        (on,) = chaining.runs_on(around(a), has, around(b), has)
        matching = chaining.align(a, b, [(100, 100, 5)])[4]
        assert on or matching < chaining.MATCHING
        kept, dropped = kept + on, dropped + (not on)
    assert kept > 50 and dropped > 50


def test_chaining_finds_fuzzy_passages(make, corpus):
    import random

    rng, rows = random.Random(2), list(corpus)
    planted = [f"p{i}" for i in range(90)]
    rows.append((1001, " ".join([f"a{i}" for i in range(40)] + planted)))
    edited = [w if i % 11 else f"e{i}" for i, w in enumerate(planted)]
    del edited[37]
    rows.append((1003, " ".join(edited + [f"b{i}" for i in range(rng.randint(20, 60))])))
    found = [(r.doc_id, r.source_id, r.start_word, r.end_word, r.n_matching) for r in chaining.passages(make(rows)).collect()]
    (mine,) = [f for f in found if f[0] == 1003]
    assert mine[1] == 1001 and mine[2] <= 2 and mine[3] >= 86 and mine[4] >= 78
    first = {}
    for i, t in sorted(rows):
        words = t.split()
        whole = [p for p in range(len(words) - 49) if first.setdefault(tuple(words[p : p + 50]), i) < i]
        if whole:
            covered = {p for d, _, a, b, _ in found if d == i for p in range(a, b)}
            assert {q for p in whole for q in range(p, p + 50)} <= covered
        elif i not in (1003,) and not any(d == i for d, *_ in found):
            continue
    assert all(s < d for d, s, *_ in found)


def test_chaining_edges(make, odd):
    assert [(r.doc_id, r.source_id) for r in chaining.passages(make(odd)).collect()] == [(7, 6)]
    assert chaining.passages(make([])).collect() == []


def test_chaining_of_null_and_repeated_ids(make):
    words = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    shared, other = words("s", 60), words("t", 60)
    rows = [(None, f"{words('a', 9)} {shared}"), (None, words("n", 80)), (None, f"{shared} {words('b', 20)}"), (4, words("c", 70)), (4, f"{words('d', 30)} {other}"), (4, f"{words('e', 5)} {other}"), (9, other)]
    found = sorted(((r.doc_id, r.source_id, r.end_word - r.start_word, r.n_matching) for r in chaining.passages(make(rows)).collect()), key=str)
    assert found == [(4, 4, 60, 60), (9, 4, 60, 60), (9, 4, 60, 60), (None, None, 60, 60)] or found == [(4, 4, 60, 60), (9, 4, 60, 60), (None, None, 60, 60)]


def test_chaining_extends_without_a_limit(make):
    """Two seeds far apart in a long passage whose other seeds lead to a smaller document."""
    import random

    rng = random.Random(9)
    long = [f"w{rng.randrange(10**6)}" for _ in range(9000)]
    rows = [(1, " ".join(long[:4400])), (2, " ".join(long)), (3, " ".join(["x"] * 3 + long))]
    found = {(r.doc_id, r.source_id): (r.start_word, r.end_word, r.n_matching) for r in chaining.passages(make(rows)).collect()}
    assert found[3, 2] == (3, 9003, 9000) and found[2, 1] == (0, 4400, 4400)


def test_chaining_meets_past_smaller_documents(make):
    """Recall against passages whose seeds mostly stand singly in smaller documents too."""
    import random

    rng, rows, pairs = random.Random(4), [], 30
    fresh = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    passages = [fresh(60) for _ in range(pairs)]
    for p in passages:
        for i in range(0, 55, 6):  # ten words of the passage each, in documents of their own
            rows.append((len(rows), " ".join(fresh(30) + p[i : i + 10] + fresh(30))))
    for p in passages:
        rows += [(len(rows) + k, " ".join(fresh(50) + p + fresh(50))) for k in (0, 1)]
    found = {(r.doc_id, r.source_id) for r in chaining.passages(make(rows)).collect()}
    wanted = {(len(rows) - 1 - 2 * k, len(rows) - 2 - 2 * k) for k in range(pairs)}
    assert len(found & wanted) == pairs and found <= wanted
