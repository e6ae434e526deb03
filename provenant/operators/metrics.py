"""Evaluation metrics of rankings, and distributions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def at_k(ranks: DataFrame, grades: DataFrame, k: int, query: str = "query", doc: str = "doc") -> DataFrame:
    """(query, recall, precision, rr, ndcg) of rankings (query, doc, rank) against grades (query, doc, grade)."""
    relevant = grades.filter("grade > 0")
    ideal = relevant.withColumn("i", F.row_number().over(W.partitionBy(query).orderBy(F.desc("grade"), doc)))
    gain = lambda rank: (F.pow(F.lit(2.0), F.col("grade")) - 1) / F.log2(rank + 1)
    wanted = ideal.groupBy(query).agg(F.count("*").alias("n_relevant"), F.sum(F.when(F.col("i") <= k, gain(F.col("i"))).otherwise(0.0)).alias("ideal"))
    hits = ranks.filter(F.col("rank") <= k).join(relevant, [query, doc])
    found = hits.groupBy(query).agg(F.count("*").alias("n"), F.min("rank").alias("first"), F.sum(gain(F.col("rank"))).alias("dcg"))
    out = wanted.join(found, query, "left")
    n = F.coalesce("n", F.lit(0))
    return out.select(
        query,
        F.round(n / F.col("n_relevant"), 6).alias("recall"),
        F.round(n / F.lit(k), 6).alias("precision"),
        F.round(F.coalesce(1.0 / F.col("first"), F.lit(0.0)), 6).alias("rr"),
        F.round(F.coalesce(F.col("dcg") / F.col("ideal"), F.lit(0.0)), 6).alias("ndcg"),
    )


def ratio(rows: DataFrame, by: list[str], hit: str, of: str, name: str) -> DataFrame:
    """count_if(hit) / count_if(of) by key; null where the denominator is none."""
    return rows.groupBy(*by).agg(F.round(F.count_if(F.expr(hit)) / F.nullif(F.count_if(F.expr(of)), F.lit(0)), 6).alias(name))


def percentiles(rows: DataFrame, by: str, value: str, accuracy: int | None = None) -> DataFrame:
    """p50, p95 and p99 by key: exact, from a buffer of the distinct values of a key, or by a sketch of ``accuracy``."""
    p = lambda q: F.round(F.percentile(value, q) if accuracy is None else F.percentile_approx(value, q, accuracy).cast("double"), 6)
    return rows.groupBy(by).agg(p(0.5).alias("p50"), p(0.95).alias("p95"), p(0.99).alias("p99"), F.count("*").alias("n"))


#: Size of a quantile sketch; ranks are off by less than 1 % of the rows, with odds of 99 in 100.
SKETCH = 400


def sketches(rows: DataFrame, by: list[str], value: str, k: int = SKETCH) -> DataFrame:
    """(by, sketch, n): a mergeable KLL sketch of each key's values, to be stored for each run or day and merged when read."""
    return rows.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"), F.count("*").alias("n"))


def sketched_percentiles(stored: DataFrame, by: list[str], k: int = SKETCH) -> DataFrame:
    """(by, p50, p95, p99, n) of stored sketches, however they were split."""
    merged = stored.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n"))
    return merged.select(*by, *(F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(f"p{round(100 * q)}") for q in (0.5, 0.95, 0.99)), "n")


def draw(key: str, sample: int, seed: int) -> str:
    """A number below 2 ** 31 - 1 that follows from a row's key, a sample's number and the seed (SQL of either engine)."""
    x = f"(({key} % 1000003) * 48271 + {(sample * 104729 + seed * 7919) % 2147483647}) % 2147483647"
    for _ in range(3):
        x = f"(({x}) * 69621 + 12345) % 2147483647"
    return f"({x})"


#: Poisson(1) by its cumulative probabilities, as shares of 2 ** 31 - 1.
POISSON = tuple(int(p * 2147483647) for p in (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582, 0.99991676))


def weight(sample: int) -> str:
    """How often a row is in a sample, from its draw in column ``d<sample>``."""
    steps = " ".join(f"WHEN d{sample} <= {limit} THEN {n}" for n, limit in enumerate(POISSON))
    return f"CASE {steps} ELSE {len(POISSON)} END"


def weights(keys: np.ndarray, samples: int, seed: int) -> np.ndarray:
    """:func:`draw` and :func:`weight` of many keys (not negative) for all samples, by key and sample."""
    x = (keys[:, None] % 1000003 * 48271 + (np.arange(samples, dtype=np.int64) * 104729 + seed * 7919) % 2147483647) % 2147483647
    for _ in range(3):
        x = (x * 69621 + 12345) % 2147483647
    return np.searchsorted(np.array(POISSON), x, "left").astype(float)


def bootstrap_mean(rows: DataFrame, key: str, value: str, samples: int, seed: int) -> DataFrame:
    """(mean, low, high): a mean with its 95 % interval by Poisson weights drawn from each row's key.

    A row's weights depend on its key and the samples' numbers only, so the result is the same whatever the partitioning.
    A task adds up the weights of some thousand rows at a time for all samples and sends a row for each sample.
    """

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weighted = np.zeros(samples), np.zeros(samples)
        for batch in batches:
            keys, values = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at in range(0, len(keys), 4096):
                w = weights(keys[at : at + 4096], samples, seed)
                total += w.sum(0)
                weighted += values[at : at + 4096] @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(samples)), pa.array(total), pa.array(weighted)], ["sample", "w", "wv"])

    kept = rows.select(F.col(key).cast("long").alias("key"), F.col(value).cast("double").alias("v")).filter("key is not null and v is not null")
    each = kept.mapInArrow(weigh, "sample long, w double, wv double").groupBy("sample").agg((F.sum("wv") / F.nullif(F.sum("w"), F.lit(0.0))).alias("m"))
    out = each.agg(F.collect_list("m").alias("means")).join(F.broadcast(rows.agg(F.avg(F.col(value).cast("double")).alias("mean"))))  # one row each
    ordered = F.array_sort(F.filter("means", lambda m: m.isNotNull()))
    at = lambda q: F.element_at(ordered, F.greatest(F.ceil(F.size(ordered) * q), F.lit(1)).cast("int"))
    return out.select("mean", at(0.025).alias("low"), at(0.975).alias("high"))


def averages(rows: DataFrame, group: str, value: str) -> DataFrame:
    """(macro, micro): the mean of the groups' means, and that of all rows."""
    means = rows.groupBy(group).agg(F.avg(value).alias("m"), F.sum(value).alias("s"), F.count(value).alias("n"))
    return means.agg(F.round(F.avg("m"), 6).alias("macro"), F.round(F.sum("s") / F.sum("n"), 6).alias("micro"))


def paired_difference(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """(n, difference, wins, losses) over the keys that both sides have."""
    d = a.select(key, F.col(value).alias("x")).join(b.select(key, F.col(value).alias("y")), key).withColumn("d", F.col("x") - F.col("y"))
    return d.agg(F.count("*").alias("n"), F.round(F.avg("d"), 6).alias("difference"), F.count_if(F.col("d") > 0).alias("wins"), F.count_if(F.col("d") < 0).alias("losses"))


def answer_quality(claims: DataFrame, by: str) -> DataFrame:
    """Of claims (answer, answerable, answered, supported, cited, valid, relevant, retrieved), by key: citation precision
    and recall, validity, support, context precision and recall, and how often abstaining was right or missed."""
    share = lambda hit, of: F.round(F.count_if(F.expr(f"({hit}) and ({of})")) / F.nullif(F.count_if(F.expr(of)), F.lit(0)), 6)
    return claims.groupBy(by).agg(
        share("valid and relevant", "cited").alias("citation_precision"), share("cited", "relevant").alias("citation_recall"), share("valid", "cited").alias("citation_validity"),
        share("supported", "answered").alias("claim_support"), share("relevant", "retrieved").alias("context_precision"), share("retrieved", "relevant").alias("context_recall"),
        share("not answered", "not answerable").alias("abstention_rate"), share("not answered", "answerable").alias("wrong_abstention_rate"),
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n"))


def run_status(outcomes: DataFrame, failures: tuple[str, ...]) -> DataFrame:
    failed = F.coalesce(F.bool_or(F.col("outcome").isin(*failures)), F.lit(False))
    return outcomes.groupBy("run").agg(F.when(failed, "COMPLETED_WITH_FAILURES").otherwise("COMPLETED").alias("status"), F.count("*").alias("processed"))


def volume_anomalies(runs: DataFrame, factor: float, history: int) -> DataFrame:
    """Runs (source, seq, n) whose volume is off the mean of the ``history`` runs before by more than ``factor``."""
    before = F.avg("n").over(W.partitionBy("source").orderBy("seq").rowsBetween(-history, -1))
    out = runs.withColumn("usual", F.round(before, 6))
    return out.filter((F.col("n") > F.round(F.col("usual") * factor, 6)) | (F.round(F.col("n") * factor, 6) < F.col("usual")))
