"""The ledger over streams: each result equals the batch one, however the input is split into files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from provenant.operators import responses, versions
from provenant.sources.ledger import OBSERVATIONS, append, read_table


def observation_stream(spark: SparkSession, path: str, files_a_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(OBSERVATIONS).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def location_seen(stream: DataFrame) -> DataFrame:
    """First and last seq of each location; late rows widen the range and never narrow it."""
    return stream.filter("hash is not null").groupBy("doc", "hash", "url").agg(F.min("seq").alias("first_seen"), F.max("seq").alias("last_seen"))


def attempt_audit(stream: DataFrame) -> DataFrame:
    """Stateless: the audit outcome of each attempt (status)."""
    return stream.withColumn("outcome", responses.status_outcome(F.col("status")))


def enqueue(stream: DataFrame, delay: str) -> DataFrame:
    """Jobs (idempotency_key, created_at, ...) once by key; a key is remembered for ``delay``."""
    return stream.withWatermark("created_at", delay).dropDuplicatesWithinWatermark(["idempotency_key"])


def tumbling(stream: DataFrame, when: str, key: str, width: str, delay: str) -> DataFrame:
    """Counts by key and window, final once the watermark passes (an extension of the ledger)."""
    return stream.withWatermark(when, delay).groupBy(F.window(when, width), key).agg(F.count("*").alias("n"))


def sessions(stream: DataFrame, when: str, key: str, gap: str, delay: str) -> DataFrame:
    return stream.withWatermark(when, delay).groupBy(key, F.session_window(when, gap)).agg(F.count("*").alias("n"))


def run_ledger(spark: SparkSession, stream: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Append the observations of a stream to a log, each seq once; a replayed batch adds nothing.

    The outcome of every observation is a function of the log (:func:`ledger_outcomes`), so order of arrival does
    not matter, only seq.
    """

    def write(batch: DataFrame, number: int) -> None:
        append(batch.sparkSession, log, batch, ["seq"], number, order="seq")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ledger_outcomes(spark: SparkSession, log: str) -> DataFrame:
    return versions.outcomes(read_table(spark, log, OBSERVATIONS))
