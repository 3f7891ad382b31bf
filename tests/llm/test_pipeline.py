from pathlib import Path

import corpus_pipeline

import __spark_entry__

DATA = "/root/testdata/sf0.001"


def test_names_and_stages():
    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 11)} and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_ids"]


def test_stages_by_hand(spark):
    """Each stage against its operator's own decisions on the same rows."""
    from tilewright.llm import decontamination, mixing, near_dedup, toxicity
    from tilewright.llm.scratch import table

    docs, columns = table(spark, DATA, "documents"), None
    for name, stage in corpus_pipeline.STAGES:
        columns = columns or docs.columns
        after = stage(spark, docs, DATA).cache()
        ids = sorted(r.doc_id for r in after.collect())
        if name == "toxicity":
            want = [r.doc_id for r in toxicity.toxicity(docs, table(spark, DATA, "labels")).where("predicted = 0").collect()]
        elif name == "near_dedup":
            want = [r.doc_id for r in near_dedup.near_duplicates(docs).where("kept").collect()]
        elif name == "decontamination":
            gone = {r.doc_id for r in decontamination.leaks(docs, table(spark, DATA, "benchmark")).collect()}
            want = [r.doc_id for r in docs.collect() if r.doc_id not in gone]
        elif name == "mixing":
            want = [r.doc_id for r in mixing.mix(docs).collect() for _ in range(r.copies)]
        else:
            want = [r.doc_id for r in docs.collect()]
        assert ids == sorted(want), name
        assert name == "token_ids" or after.columns == columns
        docs = after
    assert corpus_pipeline.run(spark, DATA).count() == docs.count()


def test_stages_take_odd_rows(spark, make, odd, tmp_path):
    """Null, empty, repeated, very long texts, null and repeated ids, and columns named as the operators' own."""
    words = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    rows = [*odd, (1, words("a", 40)), (1, words("b", 40)), (1, words("b", 40)), (None, words("a", 40)), (None, "grobnik " * 9), (21, words("t", 30)), (None, words("t", 30)), (22, words("t", 30) + " x"), (23, words("c", 25))]
    letters = "abcdefghijklmnopqrst"
    own = lambda i, k: f"{letters[i % 20]}{letters[i // 20]}{letters[k]}ora"
    rows += [(100 + i, " ".join(w for k in range(14) for w in ([own(i, k), "grobnik"] if i % 2 and k % 4 == 1 else [own(i, k)]))) for i in range(40)]
    docs = make(rows).withColumnsRenamed({"block": "copies", "value": "_copy", "row": "set_key", "rep": "kept"})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(100 + i, 1, i % 2) for i in range(40)] + [(None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, words("t", 30)), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    key = lambda r: (r.doc_id, (r.text or "")[:6])
    seen, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path)).cache()
        assert name == "token_ids" or now.columns == docs.columns, name
        seen[name] = [key(r) for r in now.collect()] if name != "token_ids" else [r.doc_id for r in now.collect()]
    assert (None, "grobni") not in seen["toxicity"] and not any(i and i >= 100 and i % 2 for i, _ in seen["toxicity"])
    assert sum(i is not None and i >= 100 for i, _ in seen["toxicity"]) == 20
    near = seen["near_dedup"]
    assert near.count((1, "a0 a1 ")) == near.count((1, "b0 b1 ")) == 1 and (None, "a0 a1 ") in near and (2, "") in near and (7, "w") not in [(i, t[:1]) for i, t in near]
    assert (21, "t0 t1 ") in near and (22, "t0 t1 ") not in near
    assert not any(t == "t0 t1 " for _, t in seen["decontamination"]) and (23, "c0 c1 ") in seen["decontamination"]
    assert set(seen["mixing"]) <= set(seen["decontamination"]) and not any(t in ("", " ") for _, t in seen["mixing"])
    assert len(seen["token_ids"]) == len(seen["mixing"])
    empty = make([])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == [], name


def test_nothing_else_imports_the_subpackage():
    root = Path(__file__).parents[2] / "tilewright"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "llm" not in path.read_text(), path
