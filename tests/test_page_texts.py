import itertools

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from provenant.plans import catalogue
from provenant.sources import captures


def test_rows_without_text_words_or_id_equal_sql(spark, tmp_path):
    rows = list(itertools.product([None, 0, 1, 2, 3, 4, -1, -2], ["", None, " ", "a", "\ufeffa\0\U0001f600", "<meta charset=latin-1>\u00fc\r\n"]))
    ids, texts = zip(*rows, strict=True)
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())}), tmp_path / "documents.parquet")
    got = [tuple(r) for r in catalogue.queries()["page_texts"](spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet')")
    assert sorted(map(str, got)) == sorted(map(str, con.execute(catalogue.oracle_sql()["page_texts"]).fetchall()))


def test_an_empty_body_needs_a_known_text_charset(spark):
    charsets = ["UTF-8", "utf-16", "latin-1", "none-such", "hex", "undefined"]
    rows = spark.createDataFrame([(c, b) for c in charsets for b in (b"", b"ab")], "charset string, body binary")
    found = {(r.charset, bytes(r.body)): r.text for r in rows.select("charset", "body", captures.html_text("body", F.concat(F.lit("text/html; charset="), "charset")).alias("text")).collect()}
    assert [found[c, b""] for c in charsets] == ["", "", "", None, None, None]
    assert [found[c, b"ab"] for c in charsets] == ["ab", "\u6261", "ab", None, None, None]
