"""Ranked retrieval: exact vectors, lexical rank, rank fusion, diverse selection, text units."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provenant.operators.slices import by_slices
from provenant.session import written


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def dense_topk(vectors: DataFrame, query: list[float], k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Exact nearest vectors of one query by cosine, ties by id: each task keeps k rows, which are then merged."""
    q = F.array(*(F.lit(float(x)) for x in query))
    return vectors.select(id_col, F.round(cosine(F.col(vec_col), q), 6).alias("score")).orderBy(F.desc("score"), id_col).limit(k)


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def term_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(id_col, F.explode(terms(F.col(text_col))).alias("term")).groupBy(id_col, "term").agg(F.count("*").alias("tf"))


def bm25(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(query, doc, score) for each document that shares a term with a query. Only the queries' terms leave the scan."""
    wanted = queries.select(query_id, F.explode(F.array_distinct(terms(F.col(text_col)))).alias("term"))
    sized = docs.select(id_col, terms(F.col(text_col)).alias("terms")).withColumn("n", F.greatest(F.size("terms"), F.lit(0)))  # a null text has no terms
    stats = sized.agg(F.count("*").alias("n_docs"), F.avg("n").alias("avg_n"))
    tf = sized.select(id_col, "n", F.explode("terms").alias("term")).join(wanted.select("term").distinct(), "term", "left_semi").groupBy(id_col, "n", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    hits = wanted.join(tf, "term").join(df, "term").join(F.broadcast(stats))  # one row
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("n") / F.col("avg_n")))
    return hits.groupBy(query_id, id_col).agg(F.sum(idf * weight).alias("score"))


def ranked(scores: DataFrame, query: str, doc: str, n: int, score: str = "score") -> DataFrame:
    """The first ``n`` of each query by score, ties by document, with ``rank`` from 1."""
    w = W.partitionBy(query).orderBy(F.desc(score), doc)
    return scores.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= n)


def rrf(lists: list[DataFrame], query: str, doc: str, k: int = 60) -> DataFrame:
    """Reciprocal rank fusion of ranked lists (query, doc, rank)."""
    union = lists[0].select(query, doc, "rank")
    for other in lists[1:]:
        union = union.unionByName(other.select(query, doc, "rank"))
    return union.groupBy(query, doc).agg(F.sum(1.0 / (k + F.col("rank"))).alias("score"), F.count("*").alias("n_lists"))


def capped(ranks: DataFrame, query: str, group: str, per_group: int, k: int) -> DataFrame:
    """Of each query's ranking at most ``per_group`` of a group, and ``k`` in all, in rank order."""
    own = F.row_number().over(W.partitionBy(query, group).orderBy("rank"))
    kept = ranks.withColumn("_own", own).filter(F.col("_own") <= per_group).drop("_own")
    return kept.withColumn("position", F.row_number().over(W.partitionBy(query).orderBy("rank")).cast("long")).filter(F.col("position") <= k)


def search(docs: DataFrame, vectors: DataFrame, queries: DataFrame, vector: list[float], depth: int = 50, per_group: int = 3, k: int = 8) -> DataFrame:
    """(item_id, doc_id, source, rank, position): one query (a row of ``queries``, and its vector) over documents that have
    passed the hard filters: lexical, dense and identifier lists, each ``depth`` deep, fused and diversely selected.

    ``docs``: doc_id, text, source. ``vectors``: doc_id, embedding; those of other documents do not count.
    """
    lexical = ranked(bm25(docs, queries).withColumn("score", F.round("score", 6)), "item_id", "doc_id", depth)
    named = ranked(identifier_hits(docs, queries, identifiers), "item_id", "doc_id", depth)
    near = dense_topk(vectors.join(docs.select("doc_id"), "doc_id", "left_semi"), vector, depth, "doc_id")
    near = ranked(queries.select("item_id").join(near), "item_id", "doc_id", depth)  # one query
    fused = rrf([lexical, near, named], "item_id", "doc_id").withColumn("score", F.round("score", 6))
    order = ranked(fused, "item_id", "doc_id", 3 * depth).join(docs.select("doc_id", "source"), "doc_id")
    return capped(order, "item_id", "source", per_group, k).select("item_id", "doc_id", "source", "rank", "position")


def search_all(spark: SparkSession, docs: DataFrame, vectors: DataFrame, questions: DataFrame, identifiers_of: Callable[[Column], Column], depth: int = 50, rerank: int = 30, per_group: int = 3, k: int = 8) -> DataFrame:
    """(item_id, doc_id, source, rank, n_lists, coverage, position) for a set of questions over documents that have passed the
    hard filters.

    ``docs``: doc_id, text, source (other columns are for the filters). ``vectors``: doc_id, embedding. ``questions``: item_id,
    text, embedding. Three lists, each ``depth`` deep, are fused: lexical and dense, from indexes of the filtered documents,
    and by identifiers, which are looked for in the folded text. The first ``rerank`` of the fusion are ordered anew by the
    share of the question's terms that a document has, then by rank, and ``k`` are taken, ``per_group`` of a source at most.
    """
    from provenant.operators import lexical_index, vector_index

    words = lexical_index.topk(spark, lexical_index.build(spark, docs.select("doc_id", "text")), questions, depth)
    held = vectors.join(docs.select("doc_id"), "doc_id", "left_semi")
    near = vector_index.topk(spark, vector_index.build(spark, held, "doc_id"), questions, depth, query_id="item_id")
    near = near.select(F.col("query").alias("item_id"), F.col("id").alias("doc_id"), "rank")
    folded = lambda rows, key: rows.select(key, nfkc_folded("text").alias("text"))
    named = ranked(identifier_hits(folded(docs, "doc_id"), folded(questions, "item_id"), identifiers_of), "item_id", "doc_id", depth)
    fused = rrf([words, near, named], "item_id", "doc_id").withColumn("score", F.round("score", 6))
    # Written, so that its size is known: the corpus is then not shuffled for a few rows, and only their terms are made.
    first = written(spark, ranked(fused, "item_id", "doc_id", rerank).select("item_id", "doc_id", "rank", "n_lists"))
    asked = questions.select("item_id", F.array_distinct(terms(F.col("text"))).alias("asked"))
    rows = first.join(docs.select("doc_id", "source", "text"), "doc_id").join(asked, "item_id")
    held = F.array_distinct(terms(F.col("text")))
    rows = rows.withColumn("coverage", F.round(F.size(F.array_intersect("asked", held)) / F.size("asked"), 6)).drop("asked", "text")
    order = F.row_number().over(W.partitionBy("item_id").orderBy(F.desc("coverage"), "rank")).cast("long")
    chosen = capped(rows.withColumn("fused_rank", F.col("rank")).withColumn("rank", order), "item_id", "source", per_group, k)
    return chosen.select("item_id", "doc_id", "source", F.col("fused_rank").alias("rank"), "n_lists", "coverage", "position")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct texts with their first document and how many have them."""
    return docs.groupBy(F.sha2(text_col, 256).alias("hash")).agg(F.min(id_col).alias("first_doc"), F.count("*").alias("n_docs"))


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines of a text with their character offsets: (id, node, start, end, quote_hash, evidence_id)."""
    lines = docs.select(id_col, F.split(text_col, "\n").alias("lines"))
    lengths = F.transform("lines", lambda x: F.length(x))
    ends = F.aggregate(lengths, F.struct(F.lit(-1).alias("at"), F.array().cast("array<int>").alias("ends")), lambda s, n: F.struct((s["at"] + 1 + n).alias("at"), F.array_append(s["ends"], s["at"] + 1 + n).alias("ends")), lambda s: s["ends"])
    out = lines.withColumn("ends", ends).select(id_col, "ends", F.posexplode("lines").alias("node", "line"))
    out = out.withColumn("end", F.get("ends", F.col("node"))).withColumn("start", F.col("end") - F.length("line")).filter("line <> ''")
    return out.select(id_col, F.col("node").cast("long").alias("node"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.sha2("line", 256).alias("quote_hash"), evidence_id(F.col(id_col), F.col("start"), F.col("end")).alias("evidence_id"))


def quote_hash(text: Column, start: Column, end: Column) -> Column:
    return F.sha2(text.substr(start + 1, end - start), 256)


def evidence_id(layer: Column, start: Column, end: Column) -> Column:
    return F.sha2(F.concat_ws(":", layer.cast("string"), start.cast("string"), end.cast("string")), 256)


def identifiers(text: Column, pattern: str = r"\b[A-Za-z][A-Za-z0-9]*(?:[-/][A-Za-z0-9]+)*[-/][0-9]+\b") -> Column:
    """Distinct identifiers of a text (letters and figures joined by strokes or hyphens, a number last), in upper case, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.upper))


def identifier_hits(docs: DataFrame, queries: DataFrame, pattern_of: Callable[[Column], Column], id_col: str = "doc_id", query_id: str = "item_id") -> DataFrame:
    """(query, doc, score): how many distinct identifiers of the query a document holds; other rows are not made."""
    asked = queries.select(query_id, F.explode(F.array_distinct(pattern_of(F.col("text")))).alias("identifier"))
    held = docs.select(id_col, F.explode(F.array_distinct(pattern_of(F.col("text")))).alias("identifier"))
    return asked.join(held, "identifier").groupBy(query_id, id_col).agg(F.count("*").alias("score"))


def appears_in(docs: DataFrame, by: str, text_col: str = "text") -> DataFrame:
    """(hash, n, appears_in): the distinct values of ``by`` whose rows have the same text."""
    return docs.groupBy(F.sha2(text_col, 256).alias("hash")).agg(F.count("*").alias("n"), F.array_sort(F.collect_set(by)).alias("appears_in"))


def trigrams(text: Column) -> Column:
    padded = F.concat(F.lit("  "), F.lower(text), F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: padded.substr(i, F.lit(3))))


def trigram_similarity(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(trigrams(a), trigrams(b))) / F.size(F.array_union(trigrams(a), trigrams(b)))


def visible(text: Column) -> Column:
    """A derived view without control and zero-width characters; the raw column keeps its offsets."""
    return F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]", "")


@by_slices(T.StringType())
def nfkc_folded(texts: list) -> list:
    return [None if t is None else unicodedata.normalize("NFKC", t).casefold() for t in texts]
