import collections
import random
import zlib

import pytest

from provenant.llm.sharding import RESULT, balanced_shards


def holds(rows, out, shards):
    assert len(out) == len(rows)
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in out) == want
    slots = collections.defaultdict(list)
    for r in out:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    counts = [len(slots[j]) for j in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


@pytest.mark.parametrize("hot", [0, 90, 300])
def test_law_slots_and_cut(spark, hot):
    rng = random.Random(hot)
    texts = [f"text {i}" for i in range(150)]
    rows = [(i, rng.choice(texts)) for i in range(300 - hot)] + [(5000 + i, f"alone {i}") for i in range(200)] + [(1000 + i, "hot") for i in range(hot)]
    rows += [(7, "x"), (7, "x"), (None, None), (8, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("text", "text")
    out = balanced_shards(spark, docs, shards=6).collect()
    holds(rows, out, 6)
    pieces = collections.defaultdict(set)
    for r in out:
        pieces[r.text_crc32].add(r.shard)
    copies = collections.Counter(zlib.crc32((t or "").encode()) for _, t in rows)
    least, spread = sum(-(-n // 84) for n in copies.values()), sum(6 * (1 - (5 / 6) ** n) for n in copies.values())
    assert sum(map(len, pieces.values())) <= least + 0.25 * (spread - least) + 3


def test_empty_and_tiny(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, shard string")
    out = balanced_shards(spark, docs)
    assert out.columns == RESULT and out.count() == 0
    holds([(1, "a")], balanced_shards(spark, spark.createDataFrame([(1, "a")], "doc_id long, text string")).collect(), 24)


def test_native(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string")
    assert "Python" not in balanced_shards(spark, docs)._jdf.queryExecution().executedPlan().toString()


def test_query_holds_the_law(spark):
    from provenant.llm.sharding import op9_sharding

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    holds(rows, op9_sharding(spark, "/root/testdata/sf0.001").collect(), 24)


def test_long_texts_ties_and_clashing_names(spark):
    rows = [(i, "x" * 200_000) for i in range(700)] + [(i, f"t{i}") for i in range(300)]
    docs = spark.createDataFrame([(i, t, 9, "a", 1) for i, t in rows], "doc_id long, text string, shard int, law string, h int")
    out = balanced_shards(spark, docs, shards=5)
    assert out.columns == RESULT
    holds(rows, out.collect(), 5)
