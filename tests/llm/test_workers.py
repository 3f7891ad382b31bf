"""What Python workers hold and pass on."""

from corpus_pipeline import tokenizer_path
from tilewright.llm import near_dedup, token_ids, words


def test_ids_are_described_where_they_are_read(make):
    """One Python node: ids do not go to a second worker."""
    found = token_ids.token_ids(make([(1, "a b"), (2, None)]), tokenizer_path())
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert [(r.doc_id, r.start, r.n_tokens) for r in found.orderBy("doc_id").collect()][0][:2] == (1, 0)


def test_workers_hold_one_thing_at_a_time():
    first = words.held("a", lambda: [1])
    assert words.held("a", lambda: [2]) is first
    assert words.held("b", lambda: [3]) == [3] and words.held("a", lambda: [4]) == [4]
    words.release()
    assert words.held("a", lambda: [5]) == [5]


def test_near_dedup_tasks_drop_the_tokenizer(spark, make):
    """A worker that has encoded texts does not keep its word cache while it makes sketches."""
    docs = make([(1, "a b c d e f")], 1)
    token_ids.tokenize(docs, tokenizer_path(), 2).collect()
    near_dedup.signatures(docs).collect()

    def held(_):
        from tilewright.llm import words

        yield len(getattr(words, "_held", {1: 1}))

    assert spark.sparkContext.parallelize([0], 1).mapPartitions(held).collect() == [0]
