"""Distinct terms that documents share with questions, without a row for each question and document.

Nearly every document shares a stop word with nearly every question. Documents are dealt into blocks and questions into parts,
and every block meets every part in a task of its own, which counts there and gives back what a ranking can need: a question's
first ``k`` documents of the block by count and by id, and on request all from some count on. A task's size does not follow the
corpus; the number of tasks does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provenant.operators.lexical_index import blocked, numbered
from provenant.operators.retrieval import terms
from provenant.session import written

#: Documents, or characters of theirs, of a block, and questions of a part, about so many.
BLOCK_DOCS, BLOCK_CHARS, PART_QUESTIONS = 16_384, 16 << 20, 4096


def incidence(rows: pa.Table, codes: np.ndarray, n_words: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct ids of ``rows`` in order, and each distinct (word, place of the id) once, by word."""
    ids, place = numbered(rows.column("id"))
    key = np.unique(codes * len(ids) + np.repeat(place, n_words))
    return ids, key // len(ids), key % len(ids)


def meet(docs: pa.Table, questions: pa.Table, k: int, least: int | None) -> pa.Table:
    """(query, doc, score) of a block and a part, rows of (id, words), the words joined by spaces."""
    kinds = questions.schema.field("id").type, docs.schema.field("id").type
    docs, questions = (rows.filter(pc.not_equal(rows.column("words"), "")) for rows in (docs, questions))
    out: tuple[list, list, list] = ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)])
    if len(docs) and len(questions):
        lists = [pc.split_pattern(rows.column("words").combine_chunks(), " ") for rows in (questions, docs)]
        known = lists[0].flatten().dictionary_encode()
        held = pc.index_in(lists[1].flatten(), value_set=known.dictionary)
        used = held.is_valid().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(docs)), lists[1].value_lengths().to_numpy())[used]
        doc_ids, word, doc = incidence(docs, held.drop_null().to_numpy().astype(np.int64), np.bincount(row, minlength=len(docs)))
        begin = np.searchsorted(word, np.arange(len(known.dictionary) + 1))
        query_ids, asked, query = incidence(questions, known.indices.to_numpy().astype(np.int64), lists[0].value_lengths().to_numpy())
        by_query = np.argsort(query, kind="stable")
        for q, own in enumerate(np.split(asked[by_query], np.searchsorted(query[by_query], np.arange(1, len(query_ids))))):
            count = np.bincount(np.concatenate([doc[begin[w] : begin[w + 1]] for w in own.tolist()]), minlength=len(doc_ids))
            hit = np.flatnonzero(count)
            if not len(hit):
                continue
            chosen = np.zeros(len(hit), bool)
            chosen[:k] = True  # by id
            chosen[np.argsort(-count[hit], kind="stable")[:k]] = True  # by count, then id
            if least is not None:
                chosen |= count[hit] >= least
            hit = hit[chosen]
            for column, values in zip(out, (np.full(len(hit), q), hit, count[hit]), strict=True):
                column.append(values)
    else:
        query_ids, doc_ids = pa.array([], kinds[0]), pa.array([], kinds[1])
    q, d, score = (np.concatenate(c) for c in out)
    return pa.table({"query": query_ids.take(pa.array(q)), "doc": doc_ids.take(pa.array(d)), "score": pa.array(score, pa.int64())})


def first_shared(spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int, least: int | None = None, id_col: str = "doc_id", query_id: str = "item_id", text_col: str = "text", block_docs: int = BLOCK_DOCS, part_questions: int = PART_QUESTIONS) -> DataFrame:
    """(query_id, id_col, score): how many distinct terms a question and a document share, written, of every pair that is among
    the question's first ``k`` by score or by id (null first), or has ``least`` or more; and of some further pairs.

    Rows that share an id are one document, or one question, with the terms of all.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter("_text is not null")
    dealt, n_blocks = blocked(spark, rows, [], block_docs, BLOCK_CHARS)
    asking = queries.select(F.col(query_id).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    n_parts = max(1, -(-asking.count() // part_questions))
    words = lambda name: F.concat_ws(" ", terms(F.col(name))).alias("words")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = dealt.select("block", F.col("_id").alias("id"), words("_text"), each(n_parts).alias("part"))
    right = asking.select(F.pmod(F.xxhash64("id"), F.lit(n_parts)).alias("part"), "id", words("text"), each(n_blocks).alias("number")).withColumn("block", F.xxhash64("number"))
    kinds = [rows.schema["id"].dataType.simpleString() for rows in (asking, left)]
    groups = 2 * n_blocks * n_parts  # so that few groups share a task
    left, right = (rows.select("block", "part", "id", "words").repartition(groups, "block", "part").groupBy("block", "part") for rows in (left, right))
    found = left.cogroup(right).applyInArrow(lambda a, b: meet(a.select(["id", "words"]), b.select(["id", "words"]), k, least), f"query {kinds[0]}, doc {kinds[1]}, score long")
    return written(spark, found.select(F.col("query").alias(query_id), F.col("doc").alias(id_col), "score"))
