import pytest
from pyspark.sql import functions as F

from provenant.operators import runs
from provenant.operators.planning import SelectionError
from provenant.sources.ledger import OBSERVATIONS

LIMITS = {"circuit_breaker_threshold": 2.0}
MANIFEST = {"ingestion_authorized": True, "review_status": "APPROVED", "reviewed_by": "x", "reviewed_at": "2026-01-01", "crawl_status": "CONFIGURED", "parameters": LIMITS, "contact": "c@example.org"}
CANDIDATES = "document_key string, scope_reason string, document_url string, url_reason string, ref string, page_id long"
ATTEMPTS = "document_key string, seq long, status int, failure string, quarantine string, rejected string, store_error string, hash string, size long"


@pytest.fixture(scope="module")
def given(spark):
    """A has a document, B shows one on its page, C's page shows two, D is refused, E is out of scope, F comes after."""
    candidates = spark.createDataFrame(
        [("A", None, "https://h.example/a", None, "r", None), ("B", None, None, None, None, 2), ("C", None, None, None, None, 3), ("D", None, "https://h.example/d", None, None, None), ("E", "OUTSIDE_DATE_WINDOW", None, None, None, None), ("F", None, "https://h.example/f", None, None, None)],
        CANDIDATES,
    )
    pages = spark.createDataFrame([(2, 200, None, "x"), (3, 200, None, "x")], "page_id long, status int, rejected string, text string")
    found = spark.createDataFrame([(2, 1, 1, "DISCOVERED", "https://h.example/b"), (3, 2, 2, "AMBIGUOUS", None)], "page_id long, n_observed long, n_candidates long, status string, attachment string")
    none = None
    attempts = spark.createDataFrame(
        [("A", 1, 503, none, none, none, none, none, none), ("A", 2, 200, none, none, none, none, "h1", 5), ("B", 3, 200, none, none, none, none, "h1", 5), ("D", 4, 403, none, none, none, none, none, none), ("D", 5, 429, none, none, none, none, none, none), ("F", 6, 200, none, none, none, none, "h2", 5)],
        ATTEMPTS,
    )
    return {"candidates": candidates, "pages": pages, "found": found, "attempts": attempts, "earlier": spark.createDataFrame([], OBSERVATIONS)}


def go(spark, given, keys, mode="LIVE", authorisation="ref", persistent=True, network=False, **changes):
    g = given
    return runs.run(spark, g["candidates"], MANIFEST | changes, keys, mode, authorisation, ["circuit_breaker_threshold"], g["pages"], g["found"], g["attempts"], g["earlier"], persistent, network)


def test_a_run_in_the_callers_order_until_its_breaker_opens(spark, given):
    results, statistics = go(spark, given, ["E", "B", "A", "C", "D", "F"])
    got = {r.document_key: (r.position, r.document_url, r.outcome, r.reason, r.stage, r.attempts) for r in results.collect()}
    assert got == {
        "E": (1, None, "OUT_OF_SCOPE", "OUTSIDE_DATE_WINDOW", "DISCOVERED", 0), "B": (2, "https://h.example/b", "NEW_VERSION", None, "VERSIONED", 1), "A": (3, "https://h.example/a", "NEW_VERSION", None, "VERSIONED", 2),
        "C": (4, None, "UNRESOLVED", "AMBIGUOUS_ATTACHMENT_REFERENCES", "DISCOVERED", 1), "D": (5, "https://h.example/d", "FAILED_TRANSIENT", "CIRCUIT_OPEN", "DISCOVERED", 1),
    }
    s = statistics.collect()
    assert [(r.status, r.abort_reason, r.planned, r.processed, r.outcomes, r.discovery, r.problem) for r in s] == [
        ("ABORTED", "CIRCUIT_OPEN", 6, 5, "FAILED_TRANSIENT=1,NEW_VERSION=2,OUT_OF_SCOPE=1,UNRESOLVED=1", "AMBIGUOUS=1,DISCOVERED=1", None)
    ]
    results, statistics = go(spark, given, ["F", "B"])
    assert {(r.document_key, r.outcome) for r in results.collect()} == {("F", "NEW_VERSION"), ("B", "NEW_VERSION")} and statistics.first().status == "COMPLETED"


def test_refused_runs_send_nothing(spark, given):
    cases = [
        (["A", "A"], {}, "POLICY_VIOLATION", "SELECTION_DUPLICATE_KEY", 0), (["A", "Z"], {}, "POLICY_VIOLATION", "SELECTION_UNKNOWN_KEY", 0), (["A"], {"ingestion_authorized": False}, "GATE_CLOSED", "INGESTION_NOT_AUTHORIZED", 1),
        (["A"], {"parameters": {}}, "POLICY_VIOLATION", "circuit_breaker_threshold", 0), (["A"], {"contact": None}, "POLICY_VIOLATION", "contact", 0), (["A"], {"authorisation": None}, "POLICY_VIOLATION", "authorisation", 0),
    ]
    for keys, changes, reason, problem, planned in cases:
        results, statistics = go(spark, given, keys, **changes)
        row = statistics.first()
        assert results is None and (row.status, row.abort_reason, row.planned, row.processed) == ("ABORTED", reason, planned, 0) and problem in row.problem


def test_a_rehearsal_writes_and_sends_nothing(spark, given):
    for persistent, network in ((True, False), (False, True)):
        with pytest.raises(runs.ModeViolation):
            go(spark, given, ["A"], "DRY_RUN", None, persistent, network)
    results, statistics = go(spark, given, ["A"], "DRY_RUN", None, False, ingestion_authorized=False)
    assert results.count() == 1 and statistics.first().status == "COMPLETED"


def test_a_body_that_the_store_refuses_ends_as_validated(spark, given):
    attempts = given["attempts"].withColumn("store_error", F.when(F.col("document_key") == "F", "BlobStoreError"))
    results, _ = go(spark, given | {"attempts": attempts}, ["F"])
    assert [(r.outcome, r.reason, r.stage) for r in results.collect()] == [("FAILED_PERMANENT", "BlobStoreError", "VALIDATED")]


def test_selections_as_tables(spark, given):
    table = lambda *rows: spark.createDataFrame(rows, "run long, position long, document_key string")
    assert runs.selected(given["candidates"], table((1, 1, "B"), (2, 1, "B"), (1, 2, "A"))).count() == 3
    for rows, code in (([(1, 1, "A"), (1, 2, "A")], "DUPLICATE"), ([(1, 1, "nobody")], "UNKNOWN")):
        with pytest.raises(SelectionError, match=code):
            runs.selected(given["candidates"], table(*rows))
