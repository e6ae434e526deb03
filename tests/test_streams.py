import hashlib
from datetime import datetime, timedelta, timezone

import pytest

from provenant.operators import responses
from provenant.sources import captures
from provenant.streaming import ledger

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(minutes):
    return START + timedelta(minutes=minutes)


@pytest.fixture
def run(spark, tmp_path):
    """Rows of a stream whose input comes in the given files, one a batch."""

    def go(schema, files, transform, mode="append"):
        for n, rows in enumerate(files):
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/f={n}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        out = transform(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").outputMode(mode).trigger(availableNow=True).start()
        out.awaitTermination(300)
        return spark.read.parquet(f"{tmp_path}/out")

    return go


def test_audit_outcomes_equal_the_batch_ones(spark, run):
    rows = [(i, s) for i, s in enumerate([200, 304, 404, 429, 500, 418])]
    got = {(r.seq, r.outcome) for r in run("seq long, status int", [rows[:2], rows[2:]], ledger.attempt_audit).collect()}
    frame = spark.createDataFrame(rows, "seq long, status int")
    assert got == {(r.seq, r.o) for r in frame.select("seq", responses.status_outcome(frame["status"]).alias("o")).collect()}


def test_jobs_are_enqueued_once_by_key(run):
    files = [[("a", at(0), 1), ("a", at(1), 2), ("b", at(1), 3)], [("a", at(5), 4), ("c", at(6), 5)]]
    got = sorted((r.idempotency_key, r.job_id) for r in run("idempotency_key string, created_at timestamp, job_id long", files, lambda s: ledger.enqueue(s, "1 hour")).collect())
    assert [k for k, _ in got] == ["a", "b", "c"] and got[0][1] in (1, 2)


def test_tumbling_counts_are_final_behind_the_watermark(run):
    files = [[("x", at(1)), ("x", at(59)), ("y", at(61))], [("x", at(58)), ("z", at(600))]]
    got = {(r.key, r.window.start.hour, r.n) for r in run("key string, ts timestamp", files, lambda s: ledger.tumbling(s, "ts", "key", "1 hour", "2 hours")).collect()}
    assert got == {("x", 0, 3), ("y", 1, 1)}  # the last hour is still open


def test_sessions_end_with_a_gap(run):
    files = [[("x", at(0)), ("x", at(20)), ("x", at(90))], [("y", at(900))]]
    got = sorted((r.key, r.n) for r in run("key string, ts timestamp", files, lambda s: ledger.sessions(s, "ts", "key", "30 minutes", "10 minutes")).collect())
    assert got == [("x", 1), ("x", 2)]


def test_files_of_a_folder_with_their_hashes(spark, tmp_path):
    for name, body in (("a.pdf", b"%PDF-1.4 x"), ("b.bin", b"\x00"), ("empty", b"")):
        (tmp_path / name).write_bytes(body)
    got = {(r.path.rsplit("/", 1)[1], bytes(r.body), r.hash) for r in captures.read_files(spark, str(tmp_path)).collect()}
    assert got == {(n, b, hashlib.sha256(b).hexdigest()) for n, b in (("a.pdf", b"%PDF-1.4 x"), ("b.bin", b"\x00"))}
