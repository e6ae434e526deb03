import re

import pyarrow as pa
from pyspark.sql import functions as F

from provenant.operators import retrieval
from provenant.operators.vector_index import sampled


def long_words(text):
    return F.regexp_extract_all(text, F.lit("[a-z]{11,}"), F.lit(0))


def test_corpus_is_not_shuffled_for_the_coverage_of_a_few(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"word{i % 7} other{i % 5} identifiers{i % 3}", f"s{i % 4}") for i in range(60)] + [(90, None, "s")], "doc_id long, text string, source string")
    vectors = spark.createDataFrame([(i, [float(i % 9), 1.0]) for i in range(60)], "doc_id long, embedding array<double>")
    spark.createDataFrame([(1, "word1 other2", [1.0, 1.0]), (2, "word3 identifiers1", None)], "item_id long, text string, embedding array<double>").write.parquet(f"{tmp_path}/q")
    found = retrieval.search_all(spark, docs, vectors, spark.read.parquet(f"{tmp_path}/q"), long_words, depth=20, rerank=10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and not re.search(r"Exchange hashpartitioning\(doc_id", plan)
    rows = found.collect()
    assert {r.item_id for r in rows} == {1, 2} and {(r.doc_id % 7, r.doc_id % 5) for r in rows if r.item_id == 1 and r.coverage == 1} == {(1, 2)}


def test_sample_is_the_first_by_hash(spark):
    plain = lambda rows, n: rows.orderBy(F.xxhash64("id"), "id").limit(n).toArrow()
    rows = spark.range(5000).withColumn("vector", F.array(F.col("id").cast("double")))
    for n in (300, 2400, 4000, 6000):
        assert sampled(rows, n).equals(plain(rows, n))
    one_id = spark.range(1000).select(F.lit(7).cast("long").alias("id"))
    assert sampled(one_id, 10).column("id").to_pylist() == [7] * 10
    assert isinstance(sampled(rows.limit(0), 10), pa.Table)
