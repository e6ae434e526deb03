from provenant.operators import lexical_index
from provenant.operators.lexical_index import build


def test_tasks_of_an_index_grow_in_number_and_not_in_size(spark):
    def sizes(n):
        docs = spark.range(n).selectExpr("id AS doc_id", "concat('the word', id % 100) AS text")
        index = build(spark, docs, block_docs=16)
        return index.tasks, index.postings.groupBy("block").count().count()

    (few_tasks, few_blocks), (many_tasks, many_blocks) = sizes(800), sizes(8000)
    assert few_blocks <= lexical_index.BLOCKS_A_TASK * few_tasks and many_blocks <= lexical_index.BLOCKS_A_TASK * many_tasks
    assert many_tasks >= 9 * few_tasks
    long = spark.createDataFrame([(i, "word " * 2000) for i in range(40)], "doc_id long, text string")
    assert build(spark, long, block_chars=50_000).n_blocks == 8


def test_index_rows_of_one_id(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "b a"), (1, "a"), (2, None), (None, "a")], "doc_id long, text string")
    rows = {r.term: [*zip(r.docs, r.tfs, r.sizes, strict=True)] for r in build(spark, docs.filter("doc_id is not null"), block_docs=100).postings.collect()}
    assert rows == {"a": [(1, 1, 1), (1, 2, 2)], "b": [(1, 2, 2)]}
