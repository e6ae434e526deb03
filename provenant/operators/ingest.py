"""One run as one plan: candidates and their captured attempts to outcomes, stages, statistics and a report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provenant.operators import responses, versions

# Stages of a candidate, in order.
STAGES = ("DISCOVERED", "FETCHED", "VALIDATED", "STORED", "VERSIONED")


def final_attempts(attempts: DataFrame) -> DataFrame:
    """The last attempt (document_key, seq, ...) of each candidate and how many there were."""
    last = attempts.groupBy("document_key").agg(F.max_by(F.struct(*[c for c in attempts.columns if c != "document_key"]), "seq").alias("a"), F.count("*").alias("attempts"))
    return last.select("document_key", "a.*", "attempts")


def refused(scope: Column, url: Column, url_reason: Column) -> tuple[Column, Column]:
    """Outcome and reason of candidates for which nothing is sent; null where a request is made."""
    outcome = F.when(scope.isNotNull(), "OUT_OF_SCOPE").when(url.isNull(), "UNRESOLVED").when(url_reason.isNotNull(), "QUARANTINED")
    reason = F.when(scope.isNotNull(), scope).when(url.isNull(), "NO_ATTACHMENT_URL_IN_MANIFEST").when(url_reason.isNotNull(), url_reason)
    return outcome, reason


def ingest(candidates: DataFrame, attempts: DataFrame, earlier: DataFrame) -> DataFrame:
    """(document_key, outcome, reason, stage, attempts) of a run.

    ``candidates``: document_key, scope_reason, document_url, url_reason, ref. ``attempts``: document_key, seq, status,
    failure, quarantine, rejected, hash, size (failure and quarantine as the transport reported them, rejected by the
    response rules), and where it is known store_error, for which the store did not take a valid body: the candidate then
    ends as VALIDATED. (STORED is passed through only; a candidate that the ledger refuses ends its run.) ``earlier``: the
    observation log so far, with smaller seqs. Only stored bodies and 304 answers become observations, so quarantined bytes
    never reach the ledger.
    """
    if "store_error" not in attempts.columns:
        attempts = attempts.withColumn("store_error", F.lit(None).cast("string"))
    rows = candidates.join(final_attempts(attempts), "document_key", "left")
    outcome, reason = refused(F.col("scope_reason"), F.col("document_url"), F.col("url_reason"))
    status = responses.status_outcome(F.col("status"))
    failure = F.coalesce("failure", F.when(status.isin("HTTP_TRANSIENT", "HTTP_PERMANENT"), status))
    rows = rows.withColumn("pre_outcome", outcome).withColumn("pre_reason", reason).withColumn("failed", failure)
    fetched = F.col("pre_outcome").isNull() & F.col("failed").isNull() & F.col("seq").isNotNull()
    unstored = F.col("rejected").isNull() & (F.col("status") == 200) & F.col("store_error").isNotNull()
    admitted = rows.filter(fetched & F.col("rejected").isNull() & ~F.coalesce(unstored, F.lit(False)))
    log = earlier.unionByName(admitted.select("seq", F.col("document_key").alias("doc"), F.col("document_url").alias("url"), "ref", F.when(F.col("status") == 200, F.col("hash")).alias("hash"), "size"))
    known = versions.outcomes(log).select("seq", F.col("outcome").alias("ledger_outcome"), F.col("reason").alias("ledger_reason"))
    # Candidates without a response have no seq: they stay out of the join, where they would all meet in one task.
    none = F.lit(None).cast("string")
    silent = rows.filter("seq is null").withColumns({"ledger_outcome": none, "ledger_reason": none})
    rows = rows.filter("seq is not null").join(known, "seq", "left").unionByName(silent)
    routed = responses.routed(F.col("failed"), F.col("quarantine"))
    final = F.coalesce("pre_outcome", routed, F.when(F.col("rejected").isNotNull(), "QUARANTINED"), F.when(unstored, "FAILED_PERMANENT"), "ledger_outcome", F.lit("FAILED_TRANSIENT"))
    why = F.coalesce("pre_reason", F.when(routed.isNotNull(), F.coalesce("quarantine", "failed")), "rejected", F.when(unstored, F.col("store_error")), "ledger_reason", F.when(F.col("seq").isNull(), "NO_RESPONSE"))
    stage = F.when(F.col("pre_outcome").isNotNull() | F.col("seq").isNull() | routed.isNotNull(), STAGES[0]).when(F.col("rejected").isNotNull() | (F.col("status") == 304), STAGES[1]).when(unstored, STAGES[2]).otherwise(STAGES[4])
    sent = F.when(F.col("pre_outcome").isNull(), F.coalesce("attempts", F.lit(0))).otherwise(0)
    return rows.select("document_key", final.alias("outcome"), why.alias("reason"), stage.alias("stage"), sent.cast("long").alias("attempts"))


def admitted_candidates(spark, candidates: DataFrame, manifest: dict, keys, mode: str, authorisation: str | None, required: list[str]):
    """(status, abort reason, problem, selected candidates) of a run before anything is sent; no candidates where it is refused.

    ``manifest`` has the gate's four fields, ``crawl_status``, ``parameters`` and ``contact``. The selection is checked first,
    then, for a LIVE run, the gate, and then what the run needs.
    """
    from provenant.operators import planning

    try:
        chosen = planning.selected(spark, candidates, keys)
    except planning.SelectionError as error:
        return "ABORTED", "POLICY_VIOLATION", f"candidate selection refused: {error.code}", None
    if mode == "LIVE":
        if closed := planning.closed_gate(manifest):
            return "ABORTED", "GATE_CLOSED", ", ".join(closed), None
        missing = planning.unset_limits(manifest.get("crawl_status"), manifest.get("parameters") or {}, required)
        if missing:
            return "ABORTED", "POLICY_VIOLATION", "required safety parameters are unset: " + ", ".join(missing), None
        if not manifest.get("contact"):
            return "ABORTED", "POLICY_VIOLATION", "the crawler's contact is not set", None
        if not authorisation:
            return "ABORTED", "POLICY_VIOLATION", "a LIVE run needs a recorded authorisation", None
    return "RUNNING", None, None, chosen


def until_trip(results: DataFrame, requests: DataFrame, threshold: int) -> DataFrame:
    """The results of a run (run, document_key, position, outcome, reason) up to the candidate at which its breaker opens.

    ``requests``: run, document_key, seq, status. The candidate whose request trips it has failed with CIRCUIT_OPEN; the
    candidates after it in the caller's order have no result.
    """
    trips = responses.circuit_trips(requests, threshold).join(requests.select("run", F.col("seq").alias("tripped_at"), "document_key"), ["run", "tripped_at"])
    trips = trips.join(results.select("run", "document_key", F.col("position").alias("last")), ["run", "document_key"]).select("run", "last")
    rows = results.join(trips, "run", "left").filter("last is null or position <= last")
    at = F.coalesce(F.col("position") == F.col("last"), F.lit(False))
    return rows.select("run", "document_key", "position", F.when(at, "FAILED_TRANSIENT").otherwise(F.col("outcome")).alias("outcome"), F.when(at, "CIRCUIT_OPEN").otherwise(F.col("reason")).alias("reason"))


def run_outcomes(results: DataFrame) -> DataFrame:
    """(run, status, abort_reason, processed): a run that its breaker stopped is ABORTED, whatever its other results."""
    opened = F.coalesce(F.bool_or(F.col("reason") == "CIRCUIT_OPEN"), F.lit(False))
    failed = F.coalesce(F.bool_or(F.col("outcome").isin(*responses.FAILURES)), F.lit(False))
    status = F.when(opened, "ABORTED").when(failed, "COMPLETED_WITH_FAILURES").otherwise("COMPLETED")
    return results.groupBy("run").agg(status.alias("status"), F.when(opened, "CIRCUIT_OPEN").alias("abort_reason"), F.count("*").alias("processed"))


def detail_outcomes(candidates: DataFrame, found: DataFrame, pages: DataFrame) -> DataFrame:
    """(document_key, document_url, outcome, reason) of candidates that only have a detail page (document_key, page_id).

    ``pages``: page_id, status, rejected, text (null where it cannot be decoded); ``found`` as of
    :func:`discovery.attachments`. Anything but one attachment ends the candidate: nothing further is fetched.
    """
    rows = candidates.join(pages, "page_id", "left").join(found.select("page_id", "n_candidates", "attachment"), "page_id", "left")
    status = responses.status_outcome(F.col("status"))
    reason = (
        F.when(F.col("status").isNull(), "NO_RESPONSE")
        .when(F.col("status") == 304, "HTTP_PERMANENT")
        .when(status != "OK", status)
        .when(F.col("rejected").isNotNull(), F.col("rejected"))
        .when(F.col("text").isNull(), "DETAIL_PAGE_UNDECODABLE")
        .when(F.col("n_candidates") > 1, "AMBIGUOUS_ATTACHMENT_REFERENCES")
        .when(F.col("attachment").isNull(), "NO_VALID_ATTACHMENT_REFERENCES")
    )
    outcome = (
        F.when(reason.isin("NO_RESPONSE", "HTTP_TRANSIENT"), "FAILED_TRANSIENT")
        .when(reason == "HTTP_PERMANENT", "FAILED_PERMANENT")
        .when(reason.isin("DETAIL_PAGE_UNDECODABLE", "AMBIGUOUS_ATTACHMENT_REFERENCES", "NO_VALID_ATTACHMENT_REFERENCES"), "UNRESOLVED")
        .when(reason.isNotNull(), "QUARANTINED")
    )
    return rows.select("document_key", F.when(reason.isNull(), F.col("attachment")).alias("document_url"), outcome.alias("outcome"), reason.alias("reason"))


def run_stats(results: DataFrame) -> DataFrame:
    """(processed, outcomes): counts by outcome in order of name."""
    counts = results.groupBy("outcome").agg(F.count("*").alias("n"))
    line = F.transform(F.sort_array(F.collect_list(F.struct("outcome", "n"))), lambda x: F.concat_ws("=", x["outcome"], x["n"].cast("string")))
    return counts.agg(F.sum("n").alias("processed"), F.array_join(line, ",").alias("outcomes"))


def report_lines(results: DataFrame) -> DataFrame:
    """Lines of a text report: the counts, then each failed candidate."""
    counts = results.groupBy("outcome").agg(F.count("*").alias("n")).select(F.lit(0).alias("part"), "outcome", F.concat_ws(": ", "outcome", F.col("n").cast("string")).alias("line"))
    failed = results.filter(F.col("outcome").isin(*responses.FAILURES)).select(F.lit(1).alias("part"), F.col("document_key").cast("string").alias("outcome"), F.concat_ws(" ", F.col("document_key").cast("string"), "outcome", "reason").alias("line"))
    return counts.unionByName(failed).orderBy("part", "outcome").select("line")


def fetch_requests(attempts: DataFrame, run: str | None = None) -> DataFrame:
    """The audit log, of one run if named, in its total order."""
    rows = attempts if run is None else attempts.filter(F.col("run") == run)
    return rows.orderBy("retrieved_at", "candidate_key", "attempt", "fetch_request_id")


def finished_runs(events: DataFrame) -> DataFrame:
    """(run_id, status): the first finish of a run (run_id, seq, status) that was RUNNING; later ones change nothing."""
    started = events.filter("status = 'RUNNING'").groupBy("run_id").agg(F.min("seq").alias("begun"))
    ended = events.filter("status <> 'RUNNING'").join(started, "run_id").filter("seq > begun").groupBy("run_id").agg(F.min_by("status", "seq").alias("status"))
    return started.select("run_id").join(ended, "run_id", "left").select("run_id", F.coalesce("status", F.lit("RUNNING")).alias("status"))
