import random

import pytest
from pyspark.sql import functions as F

from provenant.operators import lexical_index
from provenant.operators.lexical_index import bounds, build, candidates, topk
from provenant.operators.retrieval import bm25, ranked


def sample(spark, seed, n=400):
    """Two vocabularies with a stop word that nearly every document has."""
    rng, docs = random.Random(seed), []
    for i in range(n):
        lang = rng.choice("xy")
        words = [f"{lang}{min(int(rng.paretovariate(0.7)), 300)}" for _ in range(rng.choice([0, 3, 30, 90]))]
        docs.append((i * 7, " ".join(["the", *words]) if rng.random() < 0.95 else None, lang))
    questions = [(k, " ".join(["The", *(f"{'xy'[k % 2]}{min(int(rng.paretovariate(0.7)), 300)}" for _ in range(5))])) for k in range(25)]
    questions += [(100, None), (101, ""), (102, "unknown words"), (103, "the")]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(questions, "item_id long, text string")


def plain(docs, questions, k):
    return sorted(map(tuple, ranked(bm25(docs, questions).withColumn("score", F.round("score", 6)), "item_id", "doc_id", k).select("item_id", "doc_id", "score", "rank").collect()))


@pytest.mark.parametrize(("k", "cluster", "block"), [(1, (), 16), (5, ("lang",), 16), (50, (), 64), (1000, ("lang",), 8)])
def test_equals_scoring_everything(spark, k, cluster, block):
    docs, questions = sample(spark, k)
    index = build(spark, docs, cluster=cluster, block_docs=block)
    assert sorted(map(tuple, topk(spark, index, questions, k).collect())) == plain(docs, questions, k)


def test_ties_go_to_the_smaller_id(spark):
    docs = spark.createDataFrame([(i, "same text") for i in range(60)], "doc_id long, text string")
    questions = spark.createDataFrame([(1, "text")], "item_id long, text string")
    index = build(spark, docs, block_docs=4)
    assert [r.doc_id for r in topk(spark, index, questions, 7).orderBy("rank").collect()] == [*range(7)]


def test_few_documents_come_out_and_a_stop_word_has_a_row_a_block(spark):
    docs, questions = sample(spark, 3, 3000)
    index = build(spark, docs, cluster=("lang",), block_docs=64)
    blocks = index.postings.select("block").distinct().count()
    assert index.postings.filter("term = 'the'").count() == blocks < 120
    assert index.postings.agg(F.max(F.size("docs"))).first()[0] <= 120
    found, every = candidates(spark, index, questions.filter("item_id < 100"), 10).count(), bm25(docs, questions.filter("item_id < 100")).count()
    assert found < 0.05 * every, (found, every)


def test_bounds_hold_and_prune(spark):
    docs, questions = sample(spark, 5, 1500)
    index = build(spark, docs, cluster=("lang",), block_docs=32)
    limit = {(r["query"], r.block): r.bound for r in bounds(spark, index, questions, "item_id", "text").collect()}
    block = {d: r.block for r in index.postings.select("block", "docs").collect() for d in r.docs}
    for r in bm25(docs, questions).collect():
        assert r.score <= limit[r.item_id, block[r.doc_id]] * (1 + 1e-9)
    assert lexical_index.FIRST_BLOCKS * 10 < len(limit)


def test_text_ids_empty_tables_and_a_kept_index(spark, tmp_path):
    docs = spark.createDataFrame([("a", "one two"), ("b", "two"), ("c", None)], "doc_id string, text string")
    questions = spark.createDataFrame([("q", "two one")], "item_id string, text string")
    index = build(spark, docs, f"file://{tmp_path}/index")
    assert [(r.item_id, r.doc_id, r.rank) for r in topk(spark, index, questions, 2).orderBy("rank").collect()] == [("q", "a", 1), ("q", "b", 2)]
    assert spark.read.parquet(f"{tmp_path}/index").count() == 2
    assert topk(spark, build(spark, docs.limit(0)), questions, 2).count() == 0 and topk(spark, index, questions.limit(0), 2).count() == 0
