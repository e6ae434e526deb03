"""Whole ingestion runs: selection, guards, detail pages, attempts, breaker, ledger, results and statistics as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provenant.operators import ingest, planning, responses


class ModeViolation(ValueError):  # noqa: N818
    """A rehearsal that would write to a lasting log, or send requests."""


def guarded(mode: str, persistent: bool, network: bool) -> None:
    """A DRY_RUN neither writes to a persistent log nor has a source of responses that performs network calls."""
    if mode == "DRY_RUN" and persistent:
        raise ModeViolation("a DRY_RUN must not write to a persistent log")
    if mode == "DRY_RUN" and network:
        raise ModeViolation("a DRY_RUN must not be given responses from the network")


def selected(candidates: DataFrame, selection: DataFrame, key: str = "document_key") -> DataFrame:
    """``candidates`` in the order of ``selection`` (run, position, key), a table of any size; like
    :func:`planning.selected`, a key named twice in a run, or that no candidate has, refuses the whole selection."""
    twice = selection.groupBy("run", key).agg(F.count("*").alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise planning.SelectionError("SELECTION_DUPLICATE_KEY", str(twice[0][key]))
    unknown = selection.join(candidates.select(key), key, "left_anti").orderBy("position").limit(10).collect()
    if unknown:
        raise planning.SelectionError("SELECTION_UNKNOWN_KEY", ", ".join(str(r[key]) for r in unknown))
    return selection.join(candidates, key)


def breaker_stops(requests: DataFrame, threshold: int) -> DataFrame:
    """(run, last): the position of the candidate at whose request (run, position, seq, status) the run's breaker opens."""
    rows = requests.select("run", F.struct("position", "seq").alias("seq"), "status")
    return responses.circuit_trips(rows, threshold).select("run", F.col("tripped_at.position").alias("last"))


def results(chosen: DataFrame, pages: DataFrame, found: DataFrame, attempts: DataFrame, earlier: DataFrame, threshold: int) -> DataFrame:
    """(run, position, document_key, document_url, outcome, reason, stage, attempts) of every candidate that a run came to.

    ``chosen``: run, position, document_key, scope_reason, document_url, url_reason, ref, page_id. A candidate without a URL
    of its own is fetched where its detail page (``pages``: page_id, status, rejected, text; ``found`` as of
    :func:`discovery.attachments`) shows exactly one. ``attempts`` and ``earlier`` are those of :func:`ingest.ingest`. A run
    ends with the candidate at whose request, for a page or a document, its breaker opens; later ones have no result and
    add nothing to the ledger.
    """
    behind = F.col("scope_reason").isNull() & F.col("document_url").isNull() & F.col("page_id").isNotNull()
    details = chosen.filter(behind)
    seen = ingest.detail_outcomes(details.select("document_key", "page_id"), found, pages)
    seen = seen.select("document_key", F.col("document_url").alias("found_url"), F.col("outcome").alias("page_outcome"), F.col("reason").alias("page_reason"))
    rows = chosen.join(seen, "document_key", "left").withColumn("document_url", F.coalesce("document_url", "found_url"))
    sent = F.col("scope_reason").isNull() & F.col("document_url").isNotNull() & F.col("url_reason").isNull()

    asked = details.join(pages.select("page_id", "status"), "page_id").filter("status is not null").select("run", "position", F.lit(-1).cast("long").alias("seq"), "status")
    tried = rows.filter(sent).select("run", "position", "document_key").join(attempts.select("document_key", "seq", "status"), "document_key").filter("status is not null")
    stops = breaker_stops(asked.unionByName(tried.select("run", "position", F.col("seq").cast("long"), "status")), threshold)
    rows = rows.join(stops, "run", "left").filter("last is null or position <= last")
    tripped = F.coalesce(F.col("position") == F.col("last"), F.lit(False))

    ended = tripped | F.col("page_outcome").isNotNull()
    n_pages = F.when(F.col("page_reason") == "NO_RESPONSE", 0).otherwise(1)
    over = rows.filter(ended).select(
        "run", "position", "document_key", "document_url", F.when(tripped, "FAILED_TRANSIENT").otherwise(F.col("page_outcome")).alias("outcome"),
        F.when(tripped, "CIRCUIT_OPEN").otherwise(F.col("page_reason")).alias("reason"), F.lit(ingest.STAGES[0]).alias("stage"), F.when(tripped, 1).otherwise(n_pages).cast("long").alias("attempts"),
    )
    going = rows.filter(~ended)
    made = ingest.ingest(going.select("document_key", "scope_reason", "document_url", "url_reason", "ref"), attempts, earlier)
    going = going.select("run", "position", "document_key", "document_url").join(made, "document_key")
    return over.unionByName(going.select(*over.columns))


def statistics(chosen: DataFrame, results: DataFrame, found: DataFrame) -> DataFrame:
    """(run, status, abort_reason, planned, processed, outcomes, discovery): what a run's record says at its end.

    ``outcomes`` and ``discovery`` are counts by name; the pages' own findings stay in ``found``.
    """

    def counted(rows: DataFrame, name: str, out: str) -> DataFrame:
        each = rows.groupBy("run", F.col(name).alias("name")).agg(F.count("*").alias("n"))
        lines = F.transform(F.sort_array(F.collect_list(F.struct("name", "n"))), lambda x: F.concat_ws("=", x["name"], x["n"].cast("string")))  # a dozen names
        return each.groupBy("run").agg(F.array_join(lines, ",").alias(out))

    planned = chosen.groupBy("run").agg(F.count("*").alias("planned"))
    pages = chosen.filter("scope_reason is null and document_url is null").join(found.select("page_id", F.col("status").alias("found")), "page_id").join(results.select("run", "document_key"), ["run", "document_key"], "left_semi")
    out = planned.join(ingest.run_outcomes(results), "run", "left").join(counted(results, "outcome", "outcomes"), "run", "left").join(counted(pages, "found", "discovery"), "run", "left")
    return out.select("run", "status", "abort_reason", "planned", F.coalesce("processed", F.lit(0)).alias("processed"), F.coalesce("outcomes", F.lit("")).alias("outcomes"), F.coalesce("discovery", F.lit("")).alias("discovery"))


def aborted(spark, reason: str, problem: str, planned: int) -> DataFrame:
    """The statistics of a run that was refused before anything was sent."""
    columns = "run long, status string, abort_reason string, planned long, processed long, outcomes string, discovery string, problem string"
    return spark.createDataFrame([(0, "ABORTED", reason, planned, 0, "", "", problem)], columns)


def run(spark, candidates: DataFrame, manifest: dict, keys, mode: str, authorisation: str | None, required: list[str], pages: DataFrame, found: DataFrame, attempts: DataFrame, earlier: DataFrame, persistent: bool = True, network: bool = False):
    """(results, statistics) of one run over the caller's keys; results are None where the run is refused.

    In this order: the guards of a rehearsal, the selection, the gate and the needs of a LIVE run
    (:func:`ingest.admitted_candidates`), and then the candidates. The breaker's threshold is the manifest's parameter.
    """
    guarded(mode, persistent, network)
    status, reason, problem, chosen = ingest.admitted_candidates(spark, candidates, manifest, keys, mode, authorisation, required)
    if status == "ABORTED":
        return None, aborted(spark, reason, problem, len(keys) if reason == "GATE_CLOSED" else 0)
    chosen = chosen.withColumn("run", F.lit(0).cast("long"))
    made = results(chosen, pages, found, attempts, earlier, int(manifest["parameters"]["circuit_breaker_threshold"]))
    return made, statistics(chosen, made, found).withColumn("problem", F.lit(None).cast("string"))
