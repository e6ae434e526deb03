"""The corpus pipeline: documents in, token ids and what they decode to out, each stage one operator of ``provenant.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provenant.llm.byte_bpe import encode
from provenant.llm.common import written
from provenant.llm.decontaminate import without_contaminated
from provenant.llm.minhash import near_duplicates
from provenant.llm.pii import find_pii
from provenant.llm.quality_rules import quality_rules

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


#: Names that no table of documents has.
ROW, GONE_ID, GONE_TEXT = "__pipeline_row", "__pipeline_gone_id", "__pipeline_gone_text"


def whole_row(docs: DataFrame) -> Column:
    """All columns of a document as one, so that a stage's own columns cannot take their names."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(ROW)


def with_text(rows: DataFrame, docs: DataFrame, changed: Column, text: Column) -> DataFrame:
    """The columns of ``docs`` from :func:`whole_row`, with the new text and its length where it has changed."""
    new = {"text": F.when(changed, text).otherwise(F.col("text")), "n_chars": F.when(changed, F.length(text).cast("long")).otherwise(F.col(ROW)["n_chars"])}
    return rows.select(*(new.get(c, F.col(ROW).getField(c)).alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that failed.

    A null or empty text fails; repeated rows are judged each; an empty table stays empty; columns called like a rule's
    measure are carried through unread.
    """
    judged = quality_rules(docs.select("text", whole_row(docs)))
    # A filter would be pushed below the rules' projection and evaluate them a second time; a generator is not.
    found = F.struct(*(F.col(c) for c in judged.columns))
    judged = judged.select(F.inline(F.filter(F.array(found), lambda r: r["kept"])))
    return with_text(judged, docs, F.col("n_lines_removed") > 0, F.col("clean_text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest doc_id, of each group of near-duplicates: sets of five-word shingles, 0.8 or more.

    The verdict is a row's: of rows that share a doc_id, those with another text stay. Equal rows (a tie) share their
    verdict; null ids, null texts and texts without words stay; an empty table stays empty; other columns are carried
    through unread.
    """
    gone = near_duplicates(spark, docs, shingle_words=5, with_text_digest=True).filter(~F.col("kept"))
    gone = gone.select(F.col("doc_id").alias(GONE_ID), F.col("text_digest").alias(GONE_TEXT))
    same = (docs["doc_id"] == F.col(GONE_ID)) & (F.md5(docs["text"]) == F.col(GONE_TEXT))
    return docs.join(gone, same, "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, not even with a few edits. A null or blank text, or an empty benchmark, matches
    nothing; repeated rows are tested each; an empty table stays empty."""
    return without_contaminated(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by their kind. A null text stays null; repeated rows are searched each; columns called like
    the search's are carried through unread; an empty table stays empty."""
    found = find_pii(docs.select("text", whole_row(docs)))
    return with_text(found, docs, F.col("spans") != "", F.col("masked_text"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) of each document, and the text that they decode to.
    A null text has no ids and decodes to the empty text; null ids and repeated rows come back each; an empty table stays empty."""
    return encode(spark, docs, RANKS, public_tokenizers.PATTERN, with_decoded=True).withColumn("decoded", F.col("decoded").cast("string"))


STAGES = [("quality_rules", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pii", pii), ("byte_bpe", byte_bpe)]

#: Tokenizing and the model's spans are not expressible in SQL; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are written before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
