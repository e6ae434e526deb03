"""Ledger constraints as queries: each returns the rows that break it, so an intact ledger gives none."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose parent is missing."""
    return child.join(parent.select(*keys), keys, "left_anti")


def duplicates(table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur twice or more; nulls are equal."""
    return table.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def not_appended(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of an append-only table that a later snapshot lost or changed."""
    return old.exceptAll(new)


def location_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Locations whose last_seen went back or whose first_seen changed."""
    both = old.alias("o").join(new.alias("n"), ["version_id", "url"], "left")
    return both.filter("n.last_seen is null or n.last_seen < o.last_seen or n.first_seen <> o.first_seen").select("version_id", "url")


def quarantined(rows: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows whose hash is in quarantine."""
    return rows.join(quarantine.select("hash").distinct(), "hash", "left_semi")


def admitted(rows: DataFrame, quarantine: DataFrame) -> DataFrame:
    return rows.join(quarantine.select("hash").distinct(), "hash", "left_anti")


def not_live(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows that do not belong to a LIVE run."""
    return rows.join(runs.filter("mode = 'LIVE'").select("run_id"), "run_id", "left_anti")


def several_running(runs: DataFrame) -> DataFrame:
    return runs.filter("status = 'RUNNING'").groupBy("source_id").agg(F.count("*").alias("n")).filter("n > 1")


def incoherent_runs(runs: DataFrame) -> DataFrame:
    return runs.filter("not ((status = 'ABORTED') <=> (abort_reason is not null)) or not ((status = 'RUNNING') <=> (finished_at is null)) or (mode = 'LIVE' and status <> 'ABORTED' and not authorised)")


def bad_hashes(rows: DataFrame) -> DataFrame:
    path = F.concat_ws("/", F.substring("hash", 1, 2), F.substring("hash", 3, 2), F.col("hash"))
    return rows.filter(~F.col("hash").rlike(r"\A[0-9a-f]{64}\z") | (F.col("path") != path))


def corrupt_blobs(blobs: DataFrame) -> DataFrame:
    return blobs.filter(F.sha2("body", 256) != F.col("hash"))


def incoherent_fetches(fetches: DataFrame) -> DataFrame:
    return fetches.filter(
        "(outcome = 'OK' and (status is null or status <> 200 or hash is null)) or (outcome = 'NOT_MODIFIED' and (status is null or status <> 304)) or (outcome = 'URL_REJECTED' and status is not null)"
        " or attempt < 1 or isnan(elapsed) or elapsed < 0"
    )


def unlogged_headers(fetches: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    return fetches.filter(F.size(F.array_except(F.map_keys("headers"), F.array(*map(F.lit, allowed)))) > 0)


def incoherent_results(results: DataFrame) -> DataFrame:
    return results.filter("(outcome = 'QUARANTINED') <> (quarantine_id is not null)")


def incoherent_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.filter("(state = 'RUNNING') <> (locked_by is not null)")


def report(violations: dict[str, DataFrame]) -> DataFrame:
    """(name, n) for each named violation query."""
    counts = [v.agg(F.count("*").alias("n")).select(F.lit(k).alias("name"), "n") for k, v in sorted(violations.items())]
    return reduce(DataFrame.unionByName, counts)
