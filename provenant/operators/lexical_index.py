"""Ranked lexical retrieval over an inverted index whose postings lie in blocks, each with the largest weight it holds.

A document belongs to one block, and a term's postings in that block are one row of arrays, so a stop word makes a row for
each block and never one for each document. Blocks hold about ``BLOCK_DOCS`` documents however large the corpus; their
number grows, and that of the tasks with it, each of which handles one block at a time. With ``cluster``, documents of one value share blocks, and questions of another value pass these by.

Search is exact. The sum of the largest weights of a question's terms bounds every score in a block. Each question first
scores the few blocks of the highest bounds; its k-th best score so far is then a threshold that the bounds of all other
blocks must reach. A block is scored by one task for all its questions at once, which gives back the best of each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from provenant.operators.retrieval import terms
from provenant.session import written

BLOCK_DOCS = 1024
#: Characters of a block, about, where its documents are long, and blocks that a task holds, about.
BLOCK_CHARS, BLOCKS_A_TASK = 8 << 20, 4
#: Blocks of each question that are scored for its threshold.
FIRST_BLOCKS = 2
#: Scores are ranked by six digits, so a score that lies below a threshold by less may still tie with it.
MARGIN = 1e-6


@dataclass
class Weight:
    """BM25's weight of a term in a document, without the term's rarity."""

    mean_size: float
    k1: float
    b: float

    def __call__(self, tf, size):
        return tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * size / self.mean_size))


@dataclass
class Index:
    """``postings``: (block, term, top, docs, tfs, sizes); ``docs``, ``tfs`` and ``sizes`` are arrays of equal length, in
    order of the document, and ``top`` is the largest weight in them without the term's rarity."""

    postings: DataFrame
    n_docs: int
    weight: Weight
    n_blocks: int

    @property
    def tasks(self) -> int:
        return -(-self.n_blocks // BLOCKS_A_TASK)


def blocked(spark: SparkSession, docs: DataFrame, cluster: list[str], block_docs: int, block_chars: int) -> tuple[DataFrame, int]:
    """``docs`` (_id, _text and ``cluster``) with ``block``, and about how many blocks there are: each value of ``cluster`` has
    blocks of its own, as many as its documents need by number and by length."""
    counts = docs.groupBy(*cluster).agg(F.ceil(F.greatest(F.count("*") / block_docs, F.sum(F.length("_text")) / block_chars)).alias("_blocks"))
    counts = written(spark, counts)
    n_blocks = max(1, counts.agg(F.sum("_blocks")).first()[0] or 0)
    if cluster:
        out = docs.join(counts, [docs[c].eqNullSafe(counts[c]) for c in cluster], "left").drop(*(counts[c] for c in cluster))
    else:
        out = docs.withColumn("_blocks", F.lit(n_blocks))
    return out.withColumn("block", F.xxhash64(*cluster, F.pmod(F.xxhash64("_id"), F.col("_blocks")))).drop("_blocks"), n_blocks


def numbered(ids: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct ids in order, null first, and the place of each row's id among them."""
    found = ids.combine_chunks().dictionary_encode(null_encoding="encode")
    order = pc.array_sort_indices(found.dictionary, null_placement="at_start").to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return found.dictionary.take(pa.array(order)), place[found.indices.to_numpy()]


def inverted(docs: pa.Table, weight: Weight, schema: pa.Schema) -> pa.Table:
    """The postings of a block of documents (block, doc, words), their words joined by spaces."""
    docs = docs.filter(pc.not_equal(docs.column("words"), ""))
    if not len(docs):
        return schema.empty_table()
    words = pc.split_pattern(docs.column("words").combine_chunks(), " ")
    n_words = words.value_lengths().to_numpy().astype(np.int64)
    vocabulary, word = numbered(pa.chunked_array([words.flatten()]))
    ids, doc = numbered(docs.column("doc"))
    # Rows of one document that are of one size count together.
    entries, entry = np.unique(np.stack([doc, n_words], 1), axis=0, return_inverse=True)
    key, tf = np.unique(word * len(entries) + np.repeat(entry.reshape(-1), n_words), return_counts=True)
    word, (doc, size) = key // len(entries), entries[key % len(entries)].T
    begin = np.searchsorted(word, np.arange(len(vocabulary)))
    offsets = pa.array(np.append(begin, len(word)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, v) for v in (ids.take(pa.array(doc)), pa.array(tf.astype(np.int32)), pa.array(size.astype(np.int32)))]
    top = np.maximum.reduceat(weight(tf.astype(float), size.astype(float)), begin)
    block = np.full(len(vocabulary), docs.column("block")[0].as_py(), np.int64)
    return pa.table([pa.array(block), vocabulary, pa.array(top), *lists], names=schema.names).cast(schema)


def build(spark: SparkSession, docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", cluster: tuple[str, ...] = (), block_docs: int = BLOCK_DOCS, k1: float = 1.2, b: float = 0.75, block_chars: int = BLOCK_CHARS) -> Index:
    """The index of ``docs``, written to ``path`` (or the scratch folder) in one shuffle of the texts by block.

    A null text has no terms but counts as a document; rows that share an id are one document each time they occur.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *cluster)
    stats = rows.agg(F.count("*").alias("n"), F.avg(F.greatest(F.size(terms(F.col("_text"))), F.lit(0))).alias("size")).first()
    weight = Weight(float(stats["size"] or 1.0), k1, b)
    dealt, n_blocks = blocked(spark, rows, list(cluster), block_docs, block_chars)
    index = Index(rows, stats["n"], weight, n_blocks)
    dealt = dealt.select("block", F.col("_id").alias("doc"), F.concat_ws(" ", terms(F.col("_text"))).alias("words")).repartition(index.tasks, "block")
    kind = rows.schema["_id"].dataType
    schema = f"block long, term string, top double, docs array<{kind.simpleString()}>, tfs array<int>, sizes array<int>"
    arrow = pa.schema([("block", pa.int64()), ("term", pa.string()), ("top", pa.float64()), ("docs", pa.list_(to_arrow_type(kind))), ("tfs", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32()))])
    index.postings = written(spark, dealt.groupBy("block").applyInArrow(lambda table: inverted(table, weight, arrow), schema), path)
    return index


def asked(index: Index, queries: DataFrame, query_id: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(query, term, idf) of the distinct terms that the index holds, and (term, block, top) of their blocks."""
    wanted = queries.select(F.col(query_id).alias("query"), F.explode(F.array_distinct(terms(F.col(text_col)))).alias("term")).distinct()
    heads = index.postings.select("term", "block", "top", F.size("docs").alias("n")).join(wanted.select("term").distinct(), "term", "left_semi")
    df = heads.groupBy("term").agg(F.sum("n").alias("df"))
    idf = F.log(1 + (index.n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return wanted.join(df.select("term", idf.alias("idf")), "term"), heads.drop("n")


def scored(index: Index, pairs: DataFrame, k: int) -> DataFrame:
    """(query, doc, score): the best ``k`` of each question in each block, ties included, of ``pairs`` (block, query, least, terms, idfs).

    Scores under ``least`` are left out. One task handles a block, its postings and its questions; no row is made for a
    document that does not come out.
    """
    doc_type, query_type = index.postings.schema["docs"].dataType.elementType, pairs.schema["query"].dataType
    schema = f"query {query_type.simpleString()}, doc {doc_type.simpleString()}, score double"

    def score(questions: pa.Table, postings: pa.Table) -> pa.Table:
        kinds = questions.schema.field("query").type, postings.schema.field("docs").type.value_type
        if not len(questions) or not len(postings):
            return pa.table({"query": pa.array([], kinds[0]), "doc": pa.array([], kinds[1]), "score": pa.array([], pa.float64())})
        place = {t: i for i, t in enumerate(postings.column("term").to_pylist())}
        docs, tfs, sizes = (postings.column(c).combine_chunks() for c in ("docs", "tfs", "sizes"))
        starts = np.concatenate([[0], np.cumsum(docs.value_lengths().to_numpy())])
        ids, column = np.unique(docs.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        weights = weight(tfs.flatten().to_numpy().astype(float), sizes.flatten().to_numpy().astype(float))
        out: tuple[list, list, list] = ([], [], [])
        for q, least, words, idfs in zip(*(questions.column(c).to_pylist() for c in ("query", "least", "terms", "idfs")), strict=True):
            total = np.zeros(len(ids))
            for term, idf in sorted(zip(words, idfs, strict=True)):
                i = place.get(term)
                if i is not None:
                    a, z = starts[i], starts[i + 1]
                    total[column[a:z]] += idf * weights[a:z]
            if len(total) > k:
                least = max(least, np.partition(total, len(total) - k)[len(total) - k] - MARGIN)
            hit = np.flatnonzero((total > 0) & (total >= least))
            out[0].extend([q] * len(hit))
            out[1].extend(ids[hit].tolist())
            out[2].extend(total[hit].tolist())
        return pa.table({"query": pa.array(out[0], kinds[0]), "doc": pa.array(out[1], kinds[1]), "score": pa.array(out[2], pa.float64())})

    weight = index.weight
    words = pairs.select(F.explode("terms").alias("term")).distinct()
    wanted = index.postings.join(words, "term", "left_semi").join(pairs.select("block").distinct(), "block", "left_semi").select("block", "term", "docs", "tfs", "sizes")
    asking, wanted = (rows.repartition(index.tasks, "block") for rows in (pairs, wanted))
    return asking.groupBy(asking["block"]).cogroup(wanted.groupBy(wanted["block"])).applyInArrow(score, schema)


def limits(spark: SparkSession, words: DataFrame, heads: DataFrame) -> DataFrame:
    """(query, block, bound): what no score of a block exceeds."""
    return written(spark, words.join(heads, "term").groupBy("query", "block").agg(F.sum(F.col("idf") * F.col("top")).alias("bound")))


def bounds(spark: SparkSession, index: Index, queries: DataFrame, query_id: str, text_col: str) -> DataFrame:
    return limits(spark, *asked(index, queries, query_id, text_col))


def candidates(spark: SparkSession, index: Index, queries: DataFrame, k: int, query_id: str = "item_id", text_col: str = "text", first_blocks: int = FIRST_BLOCKS) -> DataFrame:
    """(query, doc, score) of all documents that may be among a question's first ``k``."""
    words, heads = asked(index, queries, query_id, text_col)
    words = written(spark, words)
    pairs = limits(spark, words, heads)
    lists = words.groupBy("query").agg(F.collect_list("term").alias("terms"), F.collect_list("idf").alias("idfs"))  # a question's words
    order = F.row_number().over(W.partitionBy("query").orderBy(F.desc("bound"), "block"))
    first = pairs.withColumn("place", order).filter(F.col("place") <= first_blocks)
    begun = written(spark, scored(index, first.select("block", "query", F.lit(0.0).alias("least")).join(lists, "query"), k))
    best = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score")))
    least = begun.withColumn("place", best).filter(F.col("place") == k).select("query", (F.col("score") - MARGIN).alias("least"))
    rest = pairs.join(first.select("query", "block"), ["query", "block"], "left_anti").join(least, "query", "left")
    rest = rest.withColumn("least", F.coalesce("least", F.lit(0.0))).filter(F.col("bound") * (1 + 1e-9) >= F.col("least"))
    return begun.unionByName(scored(index, rest.select("block", "query", "least").join(lists, "query"), k))


def topk(spark: SparkSession, index: Index, queries: DataFrame, k: int, query_id: str = "item_id", text_col: str = "text") -> DataFrame:
    """(query_id, doc_id, score, rank): each question's first ``k`` documents by BM25, as ``retrieval.bm25`` ranks them."""
    found = candidates(spark, index, queries, k, query_id, text_col).withColumn("score", F.round("score", 6))
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "doc")).cast("long")
    out = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return out.select(F.col("query").alias(query_id), F.col("doc").alias("doc_id"), "score", "rank")
