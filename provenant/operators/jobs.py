"""The job queue as a fold over its event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def json_text(value: Column) -> Column:
    """A string as JSON in ASCII: short escapes, and ``\\u`` with four lower-case digits for everything else."""
    unit = lambda n: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, "0"))
    short = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}

    def one(c: Column) -> Column:
        n = F.ascii(c)
        out = F.when(n > 0xFFFF, F.concat(unit(F.floor((n - 0x10000) / 1024) + 0xD800), unit((n - 0x10000) % 1024 + 0xDC00)))
        for char, escape in short.items():
            out = out.when(c == char, F.lit(escape))
        return out.when((n < 32) | (n > 126), unit(n)).otherwise(c)

    special = value.rlike(r'[^\x20\x21\x23-\x5b\x5d-\x7e]')
    body = F.when(special, F.array_join(F.transform(F.split(value, ""), one), "")).otherwise(value)
    return F.when(value.isNull(), "null").otherwise(F.concat(F.lit('"'), body, F.lit('"')))


def idempotency_key(kind: Column, params: list[str]) -> Column:
    """Hash of the canonical JSON (sorted keys, no blanks, ASCII) of a job's kind and string parameters."""
    inner = [part for c in sorted(params) for part in (F.lit(f'"{c}":'), json_text(F.col(c)), F.lit(","))][:-1]
    return F.sha2(F.concat(F.lit('{"kind":'), json_text(kind), F.lit(',"params":{'), *inner, F.lit("}}")), 256)


def enqueue(jobs: DataFrame, queued: DataFrame) -> DataFrame:
    """Jobs that are new by idempotency key, the first of equal ones."""
    first = jobs.groupBy("idempotency_key").agg(F.min_by(F.struct(*jobs.columns), F.struct("created_at", "job_id")).alias("job")).select("job.*")
    return first.join(queued.select("idempotency_key"), "idempotency_key", "left_anti")


def state_after(events: DataFrame, max_attempts: int) -> DataFrame:
    """(job_id, state, attempts, n_events): the state that a job's events (job_id, seq, kind) lead to.

    CLAIMED counts an attempt; RETRY_SCHEDULED queues again while attempts remain, else the job has failed.
    """
    folded = events.groupBy("job_id").agg(F.max_by("kind", "seq").alias("last"), F.count_if(F.col("kind") == "CLAIMED").alias("attempts"), F.count("*").alias("n_events"))
    state = (
        F.when(F.col("last") == "SUCCEEDED", "SUCCEEDED")
        .when((F.col("last") == "FAILED") | ((F.col("last") == "RETRY_SCHEDULED") & (F.col("attempts") >= max_attempts)), "FAILED")
        .when(F.col("last") == "CLAIMED", "RUNNING")
        .otherwise("QUEUED")
    )
    return folded.select("job_id", state.alias("state"), "attempts", "n_events")


def queue_head(jobs: DataFrame, now, n: int) -> DataFrame:
    """The next jobs to claim: runnable by ``now``, in order of run_after, created_at and id."""
    return jobs.filter((F.col("state") == "QUEUED") & (F.col("run_after") <= now)).orderBy("run_after", "created_at", "job_id").limit(n)


def claimed(jobs: DataFrame, now, worker: str, n: int) -> DataFrame:
    """The head of the queue as the worker takes it: RUNNING, locked by it, with one attempt more."""
    head = queue_head(jobs, now, n)
    return head.withColumns({"state": F.lit("RUNNING"), "locked_by": F.lit(worker), "attempts": F.col("attempts") + 1})


def failed(jobs: DataFrame, failures: DataFrame, most_error: int = 500) -> DataFrame:
    """Running jobs (job_id, locked_by, attempts, max_attempts, run_after) after failures (job_id, worker, error, retry_at).

    Only the worker that holds a job can fail it. It is queued again for ``retry_at`` where that is given and attempts
    remain; otherwise it has failed. The error is cut.
    """
    rows = jobs.filter("state = 'RUNNING'").join(failures, "job_id").filter("locked_by = worker")
    again = F.col("retry_at").isNotNull() & (F.col("attempts") < F.col("max_attempts"))
    return rows.select(
        "job_id", F.when(again, "QUEUED").otherwise("FAILED").alias("state"), "attempts",
        F.when(again, F.col("retry_at")).otherwise(F.col("run_after")).alias("run_after"),
        F.substring("error", 1, most_error).alias("last_error"),
        F.when(again, "RETRY_SCHEDULED").otherwise("FAILED").alias("event"),
    )


def completed_by_locker(events: DataFrame) -> DataFrame:
    """SUCCEEDED events (job_id, seq, kind, worker) of the worker that claimed the job last; others change nothing."""
    w = W.partitionBy("job_id").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    locker = F.last(F.when(F.col("kind") == "CLAIMED", F.col("worker")), ignorenulls=True).over(w)
    return events.withColumn("locker", locker).filter("kind = 'SUCCEEDED' and worker = locker").drop("locker")
