"""Importance resampling towards a target: documents drawn by the likeness of their hashed words and word pairs to a benchmark's.

1. Each task hands its texts to DuckDB, some MB at a time: SQL unnests the words, a window pairs neighbours, and a
   registered function (zlib's CRC-32) puts each n-gram in a bucket. The counts of each document's buckets, and the
   sums over the task, are spilled to Parquet in the shared folder.
2. Spark merges the tasks' sums. A bucket's gain compares its share in the target with its share in the corpus.
3. The spilled counts are scored: the mean gain of a document's features plus noise that follows from its id, so that
   taking the highest scores draws without replacement in proportion to the weights (Gumbel top-k).
4. Ranks come from the histogram of the scores, which are integers within a few ten thousands of each other, and a
   window inside each score. No window runs over the whole table.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from provenant.llm.common import documents, drop_written, few, segments, written
from provenant.llm.shingles import LOWER

SEPARATOR = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
CUT = re.compile(f"[{SEPARATOR}]")
_separators = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
#: Characters of text that one SQL statement sees; a longer text is seen in several.
SLICE_CHARS, PIECE_CHARS = 2 << 20, 1 << 20

#: Words keep their order by piece and place. The word carried over from the piece before is no feature of its own again.
FEATURES = """
WITH words AS (
    SELECT doc, piece, carried, place, word FROM (
        SELECT doc, piece, carried, unnest(list) AS word, generate_subscripts(list, 1) AS place
        FROM (SELECT doc, piece, carried, string_split(translate(text, {upper}, {lower}), ' ') AS list FROM texts))
    WHERE word <> ''),
grams AS (
    SELECT doc, word, carried, lead(word) OVER (PARTITION BY doc ORDER BY piece, place) AS following FROM words),
features AS (
    SELECT doc, word AS feature FROM grams WHERE NOT carried UNION ALL SELECT doc, word || ' ' || following FROM grams WHERE following IS NOT NULL)
SELECT doc, bucket, count(*) AS n FROM (SELECT doc, crc32(feature) % {buckets} AS bucket FROM features) GROUP BY doc, bucket ORDER BY doc, bucket
"""


def quoted(codes: list[int]) -> str:
    """A string of ASCII characters as SQL, control characters by number."""
    return " || ".join(f"'{chr(c)}'" if 32 <= c < 127 and c != ord("'") else f"chr({c})" for c in codes)


def statement(buckets: int) -> str:
    upper, lower = [*range(ord("A"), ord("Z") + 1)], [*range(ord("a"), ord("z") + 1)]
    separators = [c for c in _separators if c != 32]
    return FEATURES.format(upper=quoted(upper + separators), lower=quoted(lower + [32] * len(separators)), buckets=buckets)


def crc32(features: pa.ChunkedArray) -> pa.Array:
    """CRC-32 of UTF-8 strings, for DuckDB."""
    features = features.combine_chunks() if isinstance(features, pa.ChunkedArray) else features
    return pa.array(np.array(list(map(zlib.crc32, features.cast(pa.binary()).to_numpy(zero_copy_only=False))), np.int64))


def last_word(piece: str) -> str:
    """The last word of a piece, in lower case; pieces are cut in front of a separator, so it is whole."""
    return re.split(f"[{SEPARATOR}]", piece.translate(LOWER).rstrip("".join(map(chr, _separators))))[-1]


class Counter:
    """Bucket counts of texts, by DuckDB in one thread."""

    def __init__(self, buckets: int):
        import duckdb
        from duckdb import sqltypes

        self.buckets, self.sql = buckets, statement(buckets)
        self.duck = duckdb.connect(config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
        self.duck.create_function("crc32", crc32, [sqltypes.VARCHAR], sqltypes.BIGINT, type="arrow")

    def counts(self, rows: list[tuple[int, int, bool, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, bucket, count) in order for rows of (document, piece, carried, text)."""
        columns = zip(*rows, strict=True) if rows else ([], [], [], [])
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.string())
        texts = pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc", "piece", "carried", "text"])
        self.duck.register("texts", texts)
        found = self.duck.sql(self.sql).to_arrow_table()
        self.duck.unregister("texts")
        return tuple(found.column(k).to_numpy() for k in ("doc", "bucket", "n"))

    def long_text(self, text: str) -> np.ndarray:
        """Counts of each bucket for one text of any length, a piece at a time."""
        total, carry = np.zeros(self.buckets, np.int64), ""
        for piece in segments(text, CUT, PIECE_CHARS):
            _, bucket, n = self.counts([(0, 0, True, carry), (0, 1, False, piece)])
            carry = last_word(piece) or carry
            total[bucket] += n
        return total


def counted(batches: Iterator[pa.RecordBatch], buckets: int, min_words: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, enough, n_features, buckets, counts) of each row of (doc_id, text), then the task's sums under ``enough`` null."""
    counter = Counter(buckets)
    try:
        yield from counted_by(counter, batches, buckets, min_words)
    finally:
        counter.duck.close()  # the worker lives on; DuckDB's memory does not


def counted_by(counter: Counter, batches: Iterator[pa.RecordBatch], buckets: int, min_words: int) -> Iterator[pa.RecordBatch]:
    sums = np.zeros(buckets, np.int64)
    enough_features = max(2 * min_words - 1, 0)  # so many words, and one pair less
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int16()), pa.list_(pa.int32())]

    def out(ids: pa.Array, doc: np.ndarray, bucket: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        at = np.searchsorted(doc, np.arange(len(ids) + 1))
        each = np.concatenate([[0], np.cumsum(n)])[at]
        features, at = np.diff(each), pa.array(at, pa.int32())
        lists = [pa.ListArray.from_arrays(at, pa.array(v, t)) for v, t in ((bucket, pa.int16()), (n, pa.int32()))]
        return pa.RecordBatch.from_arrays([ids, pa.array(features >= enough_features), pa.array(features, pa.int64()), *lists], SPILL)

    for batch in batches:
        ids, texts = batch.column(0).cast(pa.int64()), batch.column(1)
        start, size, rows = 0, 0, []
        for k in range(len(batch) + 1):
            text = (texts[k].as_py() or "") if k < len(batch) else None
            if text is None or size + len(text) > SLICE_CHARS:
                if k > start:
                    found = counter.counts(rows)
                    sums += np.bincount(found[1], found[2], buckets).astype(np.int64)
                    yield out(ids[start:k], *found)
                start, size, rows = k, 0, []
            if text is None:
                break
            if len(text) > SLICE_CHARS:
                total = counter.long_text(text)
                sums += total
                bucket = np.flatnonzero(total)
                yield out(ids[k : k + 1], np.zeros(len(bucket), np.int64), bucket, total[bucket])
                start = k + 1
                continue
            rows.append((k - start, 0, False, text))
            size += len(text)
    bucket = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((None, None, int(sums.sum()), bucket, sums[bucket]), kinds, strict=True)], SPILL)


SPILL = ["doc_id", "enough", "n_features", "buckets", "counts"]


def bucket_counts(spark: SparkSession, docs: DataFrame, buckets: int, min_words: int) -> DataFrame:
    """The spilled table of ``docs`` (doc_id, text): a row for each document, and one for each task whose ``enough`` is null."""

    if buckets > 1 << 15:
        raise ValueError("bucket numbers are spilled as 16-bit integers")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return counted(batches, buckets, min_words)

    return written(spark, docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, "doc_id long, enough boolean, n_features long, buckets array<short>, counts array<int>"))


def merged(spill: DataFrame, buckets: int) -> np.ndarray:
    """Counts of each bucket over all tasks: ``buckets`` numbers, however large the corpus."""
    sums = spill.filter("enough is null").select(F.explode(F.arrays_zip("buckets", "counts")).alias("x"))
    out = np.zeros(buckets, np.int64)
    for row in sums.groupBy(F.col("x.buckets").alias("bucket")).agg(F.sum("x.counts").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares in the target and in the corpus, floored."""
    buckets, t_all, s_all = len(target), float(target.sum()), float(corpus.sum())
    return np.array([math.floor(1000 * math.log((float(t + 1) * (s_all + buckets)) / (float(s + 1) * (t_all + buckets)))) for t, s in zip(target.tolist(), corpus.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel variate that follows from the id alone; a null id counts as the empty string."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(spill: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """(doc_id, enough, n_features, weight, score) of each document of a spilled table."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, enough, n, buckets, counts in (b.slice(k, 500).columns for b in batches for k in range(0, len(b), 500)):
            sums = np.concatenate([[0], np.cumsum(gain[buckets.flatten().to_numpy()] * counts.flatten().to_numpy())])
            size = np.concatenate([[0], np.cumsum(buckets.value_lengths().to_numpy(zero_copy_only=False))])
            features = n.to_numpy()
            weight = (sums[size[1:]] - sums[size[:-1]]) // np.maximum(features, 1)  # floors down, also below zero
            value = weight + np.array([noise(i, seed) for i in ids.to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([ids, enough, n, pa.array(weight, pa.int64()), pa.array(value, pa.int64())], ["doc_id", "enough", "n_features", "weight", "score"])

    return spill.filter("enough is not null").mapInArrow(score, "doc_id long, enough boolean, n_features long, weight long, score long")


def resampled(spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each row of ``docs`` (doc_id, text) towards the texts of ``target`` (text).

    ``percent`` of the documents with ``min_words`` words or more are drawn; rank counts them from the highest score, and
    is null elsewhere. Defined results: a null or empty text has no words, weight 0 and only its noise as score, and is
    not drawn (with ``min_words`` 0 it may be); a null id takes the noise of the empty string and comes last in a tie;
    repeated rows count and are drawn each; ties go to the smaller id, then the row of fewer features; an empty target
    gives gains by rarity; an empty table gives an empty table; texts of any length are counted whole; further columns of
    either table are not read.
    """
    spill = bucket_counts(spark, docs, buckets, min_words)
    wanted = bucket_counts(spark, target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets, min_words)
    gain = gains(merged(wanted, buckets), merged(spill, buckets))
    scores = written(spark, scored(spill, gain, seed))
    drop_written(spark, spill, wanted)

    # Scores lie within +-1000 * ln(2^64) of the gains and some 26,000 of the noise, so the histogram is bounded.
    each = sorted(((r.score, r.n) for r in scores.filter("enough").groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    quota, ahead, drawn = percent * sum(n for _, n in each) // 100, 0, []
    for score, n in each:
        if ahead >= quota:
            break
        drawn.append((score, ahead))
        ahead += n
    above = few(written(spark, spark.createDataFrame(drawn, "score long, ahead long")))
    least = drawn[-1][0] if drawn else None
    reached = F.col("enough") & (F.col("score") >= least) if drawn else F.lit(False)
    place = F.row_number().over(W.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features"))
    rank = F.col("ahead") + place
    ranks = scores.filter(reached).join(above, "score").withColumn("rank", F.when(rank <= quota, rank).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranks.select(*columns).unionByName(scores.filter(~reached).withColumn("rank", F.lit(None).cast("long")).select(*columns))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text"))
