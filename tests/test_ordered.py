import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from provenant.operators import folds, responses
from provenant.operators.folds import AT, COMMANDS, QUEUE, breaker, folded, pacing
from provenant.streaming.ordered import folded_stream, run_to

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
END = START + timedelta(days=40)


def micros(at):
    return int(at.timestamp() * 1_000_000)


def commands(seed, n=120):
    rng, rows = random.Random(seed), []
    for seq in range(n):
        at = START + timedelta(minutes=rng.randrange(600), microseconds=rng.randrange(1000))
        later = micros(at) + rng.choice([-1, 30, 200]) * 60_000_000
        rows.append((rng.randrange(6), seq, at, rng.choice(["ENQUEUE", "CLAIM", "CLAIM", "COMPLETE", "FAIL", "FAIL"]), rng.choice("ab"), rng.choice([None, "e" * 600]), rng.choice([None, later]), rng.choice([None, later]), rng.choice([1, 2, 5])))
    return rows


def plain(rows, until):
    """The queue row by row, as one worker at a database would see it."""
    jobs, out = {}, []

    def tell(job, at, event, detail=None):
        out.append((job, jobs[job]["n"], at, event, detail))
        jobs[job]["n"] += 1

    def ripe(job, upto):
        j = jobs.get(job)
        if j and j["state"] == "QUEUED" and not j["told"] and j["ready"] <= upto:
            j["told"] = True
            tell(job, j["ready"], "RUNNABLE")

    for job, _seq, when, kind, worker, error, run_after, retry_at, most in sorted(rows, key=lambda r: (r[2], r[1])):
        at = micros(when)
        ripe(job, at)
        j = jobs.get(job)
        if kind == "ENQUEUE" and j is None:
            jobs[job] = {"state": "QUEUED", "attempts": 0, "most": most, "ready": max(at, at if run_after is None else run_after), "told": False, "n": 0, "by": None}
            tell(job, at, "ENQUEUED")
        elif j and kind == "CLAIM" and j["state"] == "QUEUED" and j["ready"] <= at:
            j |= {"state": "RUNNING", "attempts": j["attempts"] + 1, "by": worker}
            tell(job, at, "CLAIMED", worker)
        elif j and j["state"] == "RUNNING" and j["by"] == worker and kind == "COMPLETE":
            j["state"] = "SUCCEEDED"
            tell(job, at, "SUCCEEDED")
        elif j and j["state"] == "RUNNING" and j["by"] == worker and kind == "FAIL":
            again = retry_at is not None and j["attempts"] < j["most"]
            j |= {"state": "QUEUED", "ready": max(retry_at, at), "told": False} if again else {"state": "FAILED"}
            tell(job, at, "RETRY_SCHEDULED" if again else "FAILED", (error or "")[:500])
    for job in jobs:
        ripe(job, until)
    return sorted(out)


def shown(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize("seed", range(5))
def test_queue_fold_equals_one_row_at_a_time(spark, seed):
    rows = commands(seed)
    frame = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), COMMANDS)
    assert shown(folded(frame, ["job_id"], "at", ["seq"], QUEUE, micros(END))) == plain(rows, micros(END))


def test_every_kind_of_event_and_refusal():
    rows = [r for seed in range(20) for r in plain(commands(seed), micros(END))]
    assert {r[3] for r in rows} == {"ENQUEUED", "CLAIMED", "SUCCEEDED", "RETRY_SCHEDULED", "FAILED", "RUNNABLE"}
    assert folds.queue_step(None, {"kind": "CLAIM", AT: 1}) == (None, [])


def streamed(spark, tmp_path, frame, schema, keys, when, order, fold, rows_a_file, name="s"):
    """The fold over a stream of files, which come one a batch, and a last row that moves the watermark past all others."""
    source = f"{tmp_path}/{name}-in"
    for k in range(0, len(frame), rows_a_file):
        spark.createDataFrame(frame[k : k + rows_a_file], schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = run_to(spark, folded_stream(stream, keys, when, order, fold, "12 hours"), f"{tmp_path}/{name}-out", f"{tmp_path}/{name}-cp")
    query.awaitTermination(600)
    assert query.exception() is None
    return spark.read.parquet(f"{tmp_path}/{name}-out")


@pytest.mark.parametrize("rows_a_file", [1000, 25])
def test_queue_stream_equals_the_fold(spark, tmp_path, rows_a_file):
    rows = commands(11)
    random.Random(1).shuffle(rows)  # within the delay of twelve hours
    last = (99, 10**6, END + timedelta(hours=12), "CLAIM", None, None, None, None, 1)
    got = streamed(spark, tmp_path, [*rows, last], COMMANDS, ["job_id"], "at", ["seq"], QUEUE, rows_a_file)
    assert shown(got) == plain(rows, micros(END)) and got.filter("event = 'RUNNABLE'").count() > 3


def attempts(seed, n=150):
    rng = random.Random(seed)
    times = sorted(rng.sample(range(600 * 60), n))
    return [(rng.randrange(5), k, START + timedelta(seconds=t), rng.choice([200, 403, 429, 500, 404, 401]), micros(START) + (t + rng.choice([1, 1, 400])) * 1_000_000) for k, t in enumerate(times)]


ATTEMPTS = "run long, seq long, at timestamp, status int, end long"


@pytest.mark.parametrize("rows_a_file", [1000, 30])
def test_breaker_and_pacing_on_a_stream_equal_the_batch_windows(spark, tmp_path, rows_a_file):
    rows = attempts(5)
    frame = spark.createDataFrame(rows, ATTEMPTS)
    want = {(r.run, r.seq, r.outcome == "CIRCUIT_OPEN") for r in responses.before_trip(frame.select("run", "seq", "status"), 3).collect()}
    late = random.Random(2).sample(rows, len(rows))
    last = (77, 10**6, END, 200, None)
    got = streamed(spark, tmp_path, [*late, last], ATTEMPTS, ["run"], "at", ["seq"], breaker(3), rows_a_file)
    assert {(r.run, r.seq, r.tripped) for r in got.collect() if r.run != 77} == want and any(t for *_, t in want)
    assert {(r.run, r.seq, r.tripped) for r in folded(frame, ["run"], "at", ["seq"], breaker(3)).collect()} == want
    seconds = frame.select(F.col("run").alias("host"), "seq", (F.unix_micros("at") / 1e6).alias("start"), (F.col("end") / 1e6).alias("end"))
    want = {(r.host, r.seq) for r in responses.pacing_violations(seconds, 300.0).collect()}
    got = streamed(spark, tmp_path, [*late, last], ATTEMPTS, ["run"], "at", ["seq"], pacing(300_000_000), rows_a_file, "p")
    assert {(r.run, r.seq) for r in got.collect()} == want == {(r.run, r.seq) for r in folded(frame, ["run"], "at", ["seq"], pacing(300_000_000)).collect()} and want


def test_a_hot_key_streams_through_and_empty_tables(spark):
    rows = [(1, k, START + timedelta(seconds=k), "CLAIM" if k else "ENQUEUE", "w", None, None, None, 1) for k in range(30_000)]
    frame = spark.createDataFrame(rows, COMMANDS)
    assert [r.event for r in folded(frame, ["job_id"], "at", ["seq"], QUEUE).orderBy("n").collect()] == ["ENQUEUED", "RUNNABLE", "CLAIMED"]
    assert folded(frame.limit(0), ["job_id"], "at", ["seq"], QUEUE, 5).count() == 0
