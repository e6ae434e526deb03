import random

import pytest

from provenant.operators import constraints, jobs, metrics, temporal, versions
from provenant.sources.ledger import OBSERVATIONS, append, put_blobs, read_table
from provenant.streaming import ledger as streams


def log(seed, n=60):
    rng = random.Random(seed)
    return [(i, rng.choice("abc"), rng.choice("uv"), rng.choice([None, "r"]), rng.choice(["h1", "h2", "h3", None]), 1) for i in range(n)]


def sequential(rows):
    """The ledger row by row."""
    known, places, last, first_ref, seen_hash, out = {}, {}, {}, {}, {}, []
    for seq, doc, url, ref, h, _ in rows:
        if h is None:
            at = places.get((doc, url))
            out.append((seq, "UNCHANGED_SKIPPED" if at else "FAILED_PERMANENT", max(at, key=lambda x: known[doc, x]) if at else None, None))
            continue
        first_ref.setdefault(doc, ref)
        alerts = None
        if (doc, h) not in known:
            raised = ["DUPLICATE_BYTES_OTHER_DOCUMENT"] * (h in seen_hash) + ["CONTENT_CHANGED_UNDER_STABLE_REF"] * (doc in last and first_ref[doc] is not None)
            outcome, alerts = "NEW_VERSION", ",".join(raised) or None
            known[doc, h], last[doc] = seq, h
        else:
            outcome = "UNCHANGED_SKIPPED" if h in places.get((doc, url), ()) else "NEW_LOCATION_SAME_VERSION"
        seen_hash.setdefault(h, doc)
        places.setdefault((doc, url), set()).add(h)
        out.append((seq, outcome, h, alerts))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_closed_form_equals_the_sequential_ledger(spark, seed):
    rows = log(seed)
    obs = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), OBSERVATIONS)
    want = sequential(rows)
    assert sorted((r.seq, r.outcome) for r in versions.outcomes(obs).collect()) == [(s, o) for s, o, _, _ in want]
    assert {r.seq: r.alerts for r in versions.alerts(obs).collect()} == {s: a for s, _, _, a in want if a}
    nulls = {r[0] for r in rows if r[4] is None}
    assert {r.seq: r.hash for r in versions.resolved_304(obs).collect()} == {s: h for s, _, h, _ in want if s in nulls and h}
    seen = {}
    for (s, doc, url, *_), (_, _, h, _) in zip(rows, want, strict=True):
        if h:
            seen.setdefault((doc, h, url), [s, s])[1] = s
    assert {(r.doc, r.hash, r.url): [r.first_seen, r.last_seen] for r in versions.location_seen(obs).collect()} == seen


def test_append_is_idempotent_and_keeps_the_first(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.createDataFrame(log(1, 20), OBSERVATIONS)
    assert append(spark, path, rows, ["doc", "hash"], 0, "seq").count() == append(spark, path, rows, ["doc", "hash"], 0, "seq").count()
    n = read_table(spark, path, OBSERVATIONS).count()
    assert append(spark, path, rows, ["doc", "hash"], 1, "seq").count() == 0 and read_table(spark, path, OBSERVATIONS).count() == n
    blobs = spark.createDataFrame([(b"x",), (b"x",), (b"y",)], "body binary")
    assert put_blobs(spark, str(tmp_path / "b"), blobs, 0).count() == 2 and put_blobs(spark, str(tmp_path / "b"), blobs, 1).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    rows = log(7, 80)
    obs = spark.createDataFrame(rows, OBSERVATIONS)
    obs.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = streams.observation_stream(spark, str(tmp_path / "in"), 2)
    for k in range(2):  # the second run finds nothing new
        streams.run_ledger(spark, stream, str(tmp_path / "log"), str(tmp_path / "cp")).awaitTermination(120)
    got = sorted(map(tuple, streams.ledger_outcomes(spark, str(tmp_path / "log")).collect()), key=lambda r: r[0])
    assert got == sorted(map(tuple, versions.outcomes(obs).collect()), key=lambda r: r[0])
    q = streams.location_seen(stream).writeStream.format("memory").queryName("seen").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = obs.filter("hash is not null").groupBy("doc", "hash", "url").agg({"seq": "max"}).collect()
    assert sorted((r.doc, r.hash, r.url, r.last_seen) for r in spark.table("seen").collect()) == sorted(tuple(r) for r in want)


def test_constraints_find_seeded_violations(spark):
    runs = spark.createDataFrame(
        [("1", "s", "LIVE", "RUNNING", None, None, True), ("2", "s", "LIVE", "RUNNING", None, None, True), ("3", "s", "LIVE", "ABORTED", None, 5, True), ("4", "t", "LIVE", "COMPLETED", None, 5, False)],
        "run_id string, source_id string, mode string, status string, abort_reason string, finished_at int, authorised boolean",
    )
    assert [r.source_id for r in constraints.several_running(runs).collect()] == ["s"]
    assert sorted(r.run_id for r in constraints.incoherent_runs(runs).collect()) == ["3", "4"]
    fetches = spark.createDataFrame([("OK", 200, "h", 1, 0.1), ("OK", 200, None, 1, 0.1), ("NOT_MODIFIED", 200, None, 1, 0.1), ("URL_REJECTED", None, None, 0, 0.1)], "outcome string, status int, hash string, attempt int, elapsed double")
    assert constraints.incoherent_fetches(fetches).count() == 3
    keys = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert [(r.a, r.n) for r in constraints.duplicates(keys, ["a", "b"]).collect()] == [(1, 2)]
    assert constraints.not_appended(keys, keys.limit(2)).count() == 1


def test_jobs(spark):
    events = spark.createDataFrame(
        [(1, 1, "ENQUEUED", None), (1, 2, "CLAIMED", "w"), (1, 3, "SUCCEEDED", "w"), (2, 1, "ENQUEUED", None), (2, 2, "CLAIMED", "w"), (2, 3, "RETRY_SCHEDULED", "w"), (3, 1, "CLAIMED", "a"), (3, 2, "SUCCEEDED", "b")],
        "job_id long, seq long, kind string, worker string",
    )
    assert {r.job_id: r.state for r in jobs.state_after(events, 2).collect()} == {1: "SUCCEEDED", 2: "QUEUED", 3: "SUCCEEDED"}
    assert {r.job_id: r.state for r in jobs.state_after(events, 1).collect()}[2] == "FAILED"
    assert [r.job_id for r in jobs.completed_by_locker(events).collect()] == [1]


def test_as_of_join_equals_search(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(4), i, f"v{i}") for i in rng.sample(range(100), 30)]
    points = [(rng.randrange(5), rng.randrange(100)) for _ in range(40)]
    out = temporal.latest_before(spark.createDataFrame(rows, "k int, t int, v string"), spark.createDataFrame(points, "k int, at int"), ["k"], "t", ["v"]).collect()
    best = lambda k, t: max(((x, v) for j, x, v in rows if j == k and x <= t), default=(0, None))[1]
    assert sorted(map(str, ((r.k, r["at"], r.v) for r in out))) == sorted(map(str, ((k, t, best(k, t)) for k, t in points)))


def test_ranking_metrics(spark):
    ranks = spark.createDataFrame([("q", "a", 1), ("q", "b", 2), ("q", "c", 3)], "query string, doc string, rank int")
    grades = spark.createDataFrame([("q", "b", 2), ("q", "d", 1), ("p", "a", 1)], "query string, doc string, grade int")
    out = {r["query"]: r for r in metrics.at_k(ranks, grades, 2).collect()}
    assert (out["q"].recall, out["q"].precision, out["q"].rr) == (0.5, 0.5, 0.5) and out["p"].ndcg == 0
    assert abs(out["q"].ndcg - (3 / 1.5849625) / (3 + 1 / 1.5849625)) < 1e-5
