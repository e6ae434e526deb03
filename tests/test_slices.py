from pyspark.sql import functions as F
from pyspark.sql import types as T

from provenant.operators import discovery, slices


@slices.by_slices(T.LongType())
def rows_seen(values):
    return [len(values)] * len(values)


def test_a_slice_is_bounded_by_rows_and_bytes(spark):
    rows = spark.range(3000, numPartitions=1)
    assert rows.agg(F.max(rows_seen("id"))).first()[0] <= slices.SLICE_ROWS
    long = rows.limit(200).select(F.repeat(F.lit("x"), F.lit(1 << 18)).alias("text"))
    assert long.agg(F.max(rows_seen("text"))).first()[0] <= slices.SLICE_BYTES >> 18


def test_slices_keep_rows_and_nulls_in_place(spark):
    pages = spark.range(1000, numPartitions=1).select(F.col("id").alias("page_id"), F.lit("https://h.example/a/").alias("url"), F.when(F.col("id") % 3 > 0, F.concat(F.lit('<a href="'), F.col("id"), F.lit('">x</a>'))).alias("html"))
    found = {r.page_id: r.resolved for r in discovery.page_references(pages).collect()}
    assert found == {i: f"https://h.example/a/{i}" for i in range(1000) if i % 3}
