import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from provenant.operators import vector_index
from provenant.operators.vector_index import build, candidates, topk


def sample(n, dims=16, clusters=12, spread=0.35, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dims))
    return [(int(i) * 3, (centres[i % clusters] + spread * rng.normal(size=dims)).tolist()) for i in range(n)]


def brute(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = set()
    for q, v in queries:
        v = np.array(v) / np.linalg.norm(v)
        best = sorted((-round(float(s), 6), int(i)) for s, i in zip(x @ v, ids, strict=True))[:k]
        out |= {(q, i, r) for r, (_, i) in enumerate(best, 1)}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize(("lists", "k"), [(None, 5), (7, 1), (1, 20), (40, 600)])
def test_exact_search_equals_brute_force(spark, lists, k):
    rows = sample(500, spread=0.8)
    queries = rows[::25]
    index = build(spark, frame(spark, rows), lists=lists)
    got = {(r["query"], r.id, r["rank"]) for r in topk(spark, index, frame(spark, queries), k, 2, True).collect()}
    assert got == brute(rows, queries, k)


def test_recall_of_the_nearest_lists_and_what_they_read(spark):
    rows = sample(4000)
    queries = rows[::80]
    index = build(spark, frame(spark, rows), sample=1000)
    got = {(r["query"], r.id) for r in topk(spark, index, frame(spark, queries), 10, exact=False).collect()}
    want = {(q, i) for q, i, _ in brute(rows, queries, 10)}
    assert len(got & want) >= 0.9 * len(want)
    assert index.rows.count() == 4000 and len(index.centroids) == 32
    exact = candidates(spark, index, frame(spark, queries), 10, 4, True, "vec_id", "embedding")
    assert exact.count() < 0.2 * 4000 * len(queries)


def test_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    queries = [r for r in rows if r[0] % 50 == 0]
    index = build(spark, vectors)
    got = {(r["query"], r.id) for r in topk(spark, index, vectors.filter("vec_id % 50 = 0"), 10, 14, False).collect()}
    want = {(q, i) for q, i, _ in brute(rows, queries, 10)}
    assert len(got & want) >= 0.9 * len(want), len(got & want) / len(want)


def test_a_common_vector_is_dealt_over_parts(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "PART", 50)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(400)] + [(1000 + i, [float(i % 7), 1.0, -1.0]) for i in range(60)]
    index = build(spark, frame(spark, rows))
    assert index.rows.groupBy("list", "part").count().agg(F.max("count")).first()[0] <= 90
    got = [(r.id, r["rank"]) for r in topk(spark, index, frame(spark, [(7, [2.0, 4.0, 6.0])]), 3, 1, True).orderBy("rank").collect()]
    assert got == [(0, 1), (1, 2), (2, 3)]


def test_null_and_zero_vectors_text_ids_and_empty_tables(spark):
    schema = "vec_id string, embedding array<float>"
    rows = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", None), ("d", [1.0, 1.0]), (None, [1.0, 0.0])], schema)
    index = build(spark, rows)
    queries = spark.createDataFrame([("q", [1.0, 0.1]), ("z", [0.0, 0.0]), ("n", None)], schema)
    assert sorted((r["query"], r.id, r["rank"]) for r in topk(spark, index, queries, 5, 9, True).collect()) == [("q", "a", 1), ("q", "d", 2)]
    assert topk(spark, build(spark, rows.limit(0)), queries, 5, exact=True).count() == 0 and topk(spark, index, queries.limit(0), 5).count() == 0


def test_fitting_is_the_same_every_time():
    x = np.array([v for _, v in sample(200, seed=random.Random(3).randrange(100))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert (vector_index.fitted(x, 8, 5) == vector_index.fitted(x, 8, 5)).all()
