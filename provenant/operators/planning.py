"""Selection, scope, plan, gate and limits of a run."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


# Reviews that keep a source closed.
BLOCKING_REVIEWS = ("BLOCKED", "AMBIGUOUS", "AMBIGUOUS_REQUIRES_REVIEW")


class SelectionError(ValueError):
    """An explicit selection that is refused; ``code`` says why."""

    def __init__(self, code: str, detail: str = ""):
        super().__init__(f"{code}: {detail}" if detail else code)
        self.code = code


def checked_keys(keys) -> list[str]:
    """The keys of an explicit selection; there is no default, and a bare string is no selection."""
    if keys is None:
        raise SelectionError("SELECTION_REQUIRED")
    if isinstance(keys, str | bytes) or not isinstance(keys, Sequence):
        raise SelectionError("SELECTION_NOT_A_SEQUENCE")
    if not keys:
        raise SelectionError("SELECTION_EMPTY")
    if not all(isinstance(k, str) for k in keys):
        raise SelectionError("SELECTION_NON_STRING_KEY")
    if len(set(keys)) < len(keys):
        raise SelectionError("SELECTION_DUPLICATE_KEY")
    return list(keys)


def selected(spark: SparkSession, candidates: DataFrame, keys, key: str = "document_key") -> DataFrame:
    """Candidates in the caller's order, with ``position`` from 1; an unknown key is refused."""
    rows = spark.createDataFrame(list(enumerate(checked_keys(keys), 1)), f"position long, {key} string")
    out = F.broadcast(rows).join(candidates, key, "left")  # as many rows as the caller named
    known = candidates.join(F.broadcast(rows), key, "left_semi").select(key)
    unknown = rows.join(known, key, "left_anti").orderBy("position").limit(10).collect()
    if unknown:
        raise SelectionError("SELECTION_UNKNOWN_KEY", ", ".join(r[key] for r in unknown))
    return out


def scope_reason(tier: Column, kind: Column, listed: Column, kinds: list[str], start, end) -> Column:
    """Why a candidate is out of scope, the first reason; null inside. A missing date or window is inside."""
    outside = F.lit(False) if start is None else F.coalesce(~listed.between(start, end), F.lit(False))
    return F.when(tier == "context_out_of_window", "TIER_CONTEXT_OUT_OF_WINDOW").when(~kind.isin(kinds), "DOCUMENT_TYPE_NOT_IN_SCOPE").when(outside, "OUTSIDE_DATE_WINDOW")


def plan_action(reason: Column, document_url: Column, canonical_url: Column) -> Column:
    return F.when(reason.isNotNull(), "OUT_OF_SCOPE").when(document_url.isNotNull(), "FETCH_ATTACHMENT").when(canonical_url.isNotNull(), "FETCH_DETAIL_THEN_DISCOVER").otherwise("UNRESOLVED")


def gate_reasons() -> Column:
    """Why a source may not be fetched, over its manifest row; empty means open."""
    return F.array_compact(F.array(
        F.when(~F.col("ingestion_authorized"), "INGESTION_NOT_AUTHORIZED"),
        F.when(F.col("review_status").isin(*BLOCKING_REVIEWS), "ACCESS_REVIEW_BLOCKED"),
        F.when(F.coalesce(F.trim("reviewed_by"), F.lit("")) == "", "NO_REVIEWER"),
        F.when(F.col("reviewed_at").isNull(), "NO_REVIEW_TIME"),
    ))


def closed_gate(manifest: dict) -> list[str]:
    """:func:`gate_reasons` for one manifest on the driver."""
    found = {
        "INGESTION_NOT_AUTHORIZED": manifest.get("ingestion_authorized") is not True,
        "ACCESS_REVIEW_BLOCKED": manifest.get("review_status") in BLOCKING_REVIEWS,
        "NO_REVIEWER": not str(manifest.get("reviewed_by") or "").strip(),
        "NO_REVIEW_TIME": manifest.get("reviewed_at") is None,
    }
    return [reason for reason, holds in found.items() if holds]


def unset_limits(status: str | None, parameters: dict, required: list[str]) -> list[str]:
    """What keeps a crawl from being configured: its status, then the missing parameters by name."""
    return ([] if status == "CONFIGURED" else ["crawl.status"]) + sorted(k for k in required if parameters.get(k) is None)


def limit_problems(status: Column, parameters: Column, required: list[str]) -> Column:
    """:func:`unset_limits` as a column over a map of numbers, and parameters that are not positive or contradict each other."""
    unset = F.array_compact(F.array(F.when(F.coalesce(status, F.lit("")) != "CONFIGURED", "crawl.status")))
    bad = F.transform(F.filter(F.map_entries(parameters), lambda e: F.isnan(e["value"]) | (e["value"] <= 0) | (e["value"] == float("inf"))), lambda e: e["key"])
    order = F.array_compact(F.array(F.when(parameters["backoff_max"] < parameters["backoff_base"], "backoff_max < backoff_base")))
    return F.concat(unset, missing_limits(parameters, required), F.array_sort(bad), order)


def missing_limits(parameters: Column, required: list[str]) -> Column:
    return F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.map_keys(parameters)))


def numbered(candidates: DataFrame, key: str) -> DataFrame:
    """Position of each candidate by key, from 1; for a manifest's candidates, a bounded list."""
    return candidates.withColumn("position", F.row_number().over(W.orderBy(key)).cast("long"))


def check_number(name: str, value, whole: bool = False) -> float:
    import math

    if isinstance(value, bool) or not isinstance(value, int | float) or not math.isfinite(value) or value <= 0 or whole and value != int(value):
        raise ValueError(f"{name} must be a positive {'whole ' if whole else ''}number")
    return value


def exact_hosts(hosts: list[str]) -> list[str]:
    """Host allow-list of a manifest: lower-case names only, no wildcard, address or repetition."""
    for h in hosts:
        if h != h.lower() or not re.fullmatch(r"[a-z0-9]([a-z0-9-]*[a-z0-9])?(\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)+", h) or h.rsplit(".", 1)[1].isdigit():
            raise ValueError(f"not an exact host name: {h!r}")
    if len(set(hosts)) < len(hosts):
        raise ValueError("a host is listed twice")
    return hosts
