from provenant.operators import ingest, verification
from provenant.sources.ledger import OBSERVATIONS


def test_one_run(spark):
    candidates = spark.createDataFrame(
        [("a", None, "u1", None, "r"), ("b", None, "u1", None, "r"), ("c", "OUTSIDE_DATE_WINDOW", "u1", None, None), ("d", None, None, None, None), ("e", None, "u1", "HOST_NOT_ALLOWED", None), ("f", None, "u1", None, None), ("g", None, "u1", None, None), ("h", None, "u1", None, None)],
        "document_key string, scope_reason string, document_url string, url_reason string, ref string",
    )
    attempts = spark.createDataFrame(
        [
            ("a", 10, 503, None, None, None, None, 0), ("a", 11, 200, None, None, None, "h1", 5), ("b", 12, 200, None, None, None, "h0", 5), ("f", 13, 304, None, None, None, None, 0),
            ("g", 14, 200, None, None, "PDF_SANITY_FAILED", "h9", 5), ("h", 15, None, "REDIRECT_REJECTED", "REDIRECT_OFF_ALLOWLIST", None, None, 0),
        ],
        "document_key string, seq long, status int, failure string, quarantine string, rejected string, hash string, size long",
    )
    earlier = spark.createDataFrame([(1, "b", "u1", "r", "h0", 5)], OBSERVATIONS)
    got = {r.document_key: (r.outcome, r.reason, r.attempts) for r in ingest.ingest(candidates, attempts, earlier).collect()}
    assert got == {
        "a": ("NEW_VERSION", None, 2), "b": ("UNCHANGED_SKIPPED", None, 1), "c": ("OUT_OF_SCOPE", "OUTSIDE_DATE_WINDOW", 0), "d": ("UNRESOLVED", "NO_ATTACHMENT_URL_IN_MANIFEST", 0),
        "e": ("QUARANTINED", "HOST_NOT_ALLOWED", 0), "f": ("FAILED_PERMANENT", "HTTP_PERMANENT", 1), "g": ("QUARANTINED", "PDF_SANITY_FAILED", 1), "h": ("QUARANTINED", "REDIRECT_OFF_ALLOWLIST", 1),
    }


def test_runs_finish_once(spark):
    events = spark.createDataFrame([("r", 1, "RUNNING"), ("r", 2, "COMPLETED"), ("r", 3, "ABORTED"), ("s", 1, "RUNNING"), ("t", 1, "COMPLETED")], "run_id string, seq int, status string")
    assert {r.run_id: r.status for r in ingest.finished_runs(events).collect()} == {"r": "COMPLETED", "s": "RUNNING"}


def test_disposition(spark):
    states = spark.createDataFrame([(1, "SUPPORTED"), (1, "SUPPORTED"), (2, "SUPPORTED"), (2, "CONTRADICTED"), (3, "INSUFFICIENT_EVIDENCE")], "answer_id int, state string")
    assert {r.answer_id: r.disposition for r in verification.dispositions(states).collect()} == {1: "ANSWERED", 2: "PARTIALLY_ANSWERED", 3: "ABSTAINED"}
