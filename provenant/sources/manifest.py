"""Source manifests: strict YAML read on the driver, candidates as a DataFrame with a fixed schema.

One loader refuses, while it builds the document, whatever a reviewed file must not have; tables of fields (name, kind,
whether it must be there) say what the sections hold.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from provenant.operators.planning import check_number, exact_hosts

try:
    import yaml
except ImportError:  # manifests then cannot be read; everything else works
    yaml = None

CANDIDATES = T.StructType([
    T.StructField("document_key", T.StringType(), False), T.StructField("tier", T.StringType(), False), T.StructField("title", T.StringType(), False),
    T.StructField("document_type", T.StringType(), False), T.StructField("entry_index", T.IntegerType(), False), T.StructField("canonical_url", T.StringType()),
    T.StructField("document_url", T.StringType()), T.StructField("source_reference", T.StringType()), T.StructField("listing_date", T.DateType()),
    T.StructField("listing_page_url", T.StringType()), T.StructField("sampled", T.BooleanType()), T.StructField("resolution_status", T.StringType()),
    T.StructField("status_labels", T.ArrayType(T.StructType([T.StructField("field", T.StringType()), T.StructField("label", T.StringType())]))),
])

# Status labels, reviews, and the parameters that a crawl needs; those that are whole numbers apart.
LABELS = ("VERIFIED", "OBSERVED", "INFERRED", "UNVERIFIED")
REVIEWS = ("APPROVED_FOR_RECONNAISSANCE", "BLOCKED", "AMBIGUOUS_REQUIRES_REVIEW")
SECONDS = ("min_delay_seconds", "connect_timeout_seconds", "read_timeout_seconds", "total_timeout_seconds", "backoff_base_seconds", "backoff_max_seconds", "candidate_deadline_seconds", "max_expansion_ratio")
WHOLE = ("max_bytes_listing", "max_bytes_detail_page", "max_bytes_attachment", "max_url_length", "max_redirects", "max_attempts", "circuit_breaker_threshold", "pdf_eof_tail_bytes")
PURPOSES = ("listing", "detail", "attachment")


class ManifestError(ValueError):
    """A manifest that cannot be read or is not acceptable."""


if yaml is not None:

    class StrictLoader(yaml.SafeLoader):
        """Plain data only: every node is written out where it stands, and every key of a mapping once."""

        def compose_node(self, parent, index):
            if self.check_event(yaml.AliasEvent) or getattr(self.peek_event(), "anchor", None):
                raise ManifestError("a node is named or repeated by name")
            return super().compose_node(parent, index)

        def construct_mapping(self, node, deep=False):
            named = [(k.tag, k.value) for k, _ in node.value if isinstance(k, yaml.ScalarNode)]
            if len(named) < len(node.value) or any(tag.endswith(":merge") for tag, _ in named):
                raise ManifestError("a mapping has a merge or a key that is not a scalar")
            if len({value for _, value in named}) < len(named):
                raise ManifestError("a mapping has a key twice")
            return super().construct_mapping(node, deep)


# --- kinds of fields ------------------------------------------------------------------------------------------

Kind = Callable[[Any], Any]


def require(holds: bool, what: str, value: Any = None) -> None:
    if not holds:
        raise ManifestError(f"{what}: {value!r}")


def text(value: Any) -> str:
    require(isinstance(value, str) and value.strip() != "" and value.isprintable(), "expected a line of text", value)
    return value


def matching(pattern: str, what: str) -> Kind:
    def kind(value: Any) -> str:
        require(re.fullmatch(pattern, text(value)) is not None, f"expected {what}", value)
        return value

    return kind


def one_of(*allowed: Any) -> Kind:
    def kind(value: Any) -> Any:
        require(any(value is a or (value == a and type(value) is type(a)) for a in allowed), f"expected one of {allowed}", value)
        return value

    return kind


def day(value: Any) -> datetime.date:
    """A calendar day, written bare or as text; a time of day is too much."""
    if isinstance(value, str) and len(value) == 10:
        try:
            value = datetime.datetime.strptime(value, "%Y-%m-%d").date()
        except ValueError:
            value = None
    require(type(value) is datetime.date, "expected a day as YYYY-MM-DD", value)
    return value


def list_of(kind: Kind, least: int = 0) -> Kind:
    def of(value: Any) -> list:
        require(isinstance(value, list) and len(value) >= least, f"expected a list of {least} or more", value)
        return [kind(v) for v in value]

    return of


def number(name: str, whole: bool) -> Kind:
    return lambda value: check_number(name, value, whole)


def section(*fields: tuple[str, Kind, bool], closed: bool = False) -> Kind:
    """A mapping with fields (name, kind, needed); an absent or empty one that is not needed is None."""

    def of(value: Any) -> dict[str, Any]:
        require(isinstance(value, dict), "expected a mapping", value)
        unknown = set(value) - {name for name, *_ in fields}
        require(not (closed and unknown), "unknown keys", sorted(map(str, unknown)))
        out = {}
        for name, kind, needed in fields:
            require(not needed or value.get(name) is not None, "missing field", name)
            out[name] = None if value.get(name) is None else kind(value[name])
        return out

    return of


BOOLEAN = one_of(True, False)
CRAWL = [("status", text, True), ("user_agent_contact", matching("env:[A-Z][A-Z0-9_]{0,63}", "env:<VARIABLE>"), True)]
CRAWL += [(name, number(name, False), False) for name in SECONDS] + [(name, number(name, True), False) for name in WHOLE]
HTTPS = matching("https://.+", "an https URL")
MANIFEST = [
    ("manifest_version", text, True), ("source_id", text, True), ("authority", text, True),
    ("domain", section(("jurisdiction", text, True), ("regulator", text, True), ("corpus", text, True)), True),
    ("access_review", section(("status", one_of(*REVIEWS), True), ("reviewed_by", str, False), ("reviewed_at", str, False), ("open_items", list_of(text), False)), True),
    ("ingestion_authorized", BOOLEAN, True), ("allowed_hosts", list_of(text, 1), True),
    ("allowed_url_policy", section(("schemes", one_of(["https"]), True), ("allowed_methods", list_of(one_of("GET", "HEAD"), 1), True), ("path_prefixes", section(*((p, list_of(text), True) for p in PURPOSES), closed=True), True)), True),
    ("listing_urls", list_of(section(("url", HTTPS, True))), False), ("document_types", list_of(text), True),
    ("bounded_date_window", section(("from", day, True), ("to", day, True)), False), ("crawl", section(*CRAWL, closed=True), True),
]
CANDIDATE = section(
    ("document_key", matching("[A-Za-z0-9][A-Za-z0-9._-]{0,127}", "a document key"), True), *((name, text, True) for name in ("tier", "title", "document_type")),
    *((name, text, False) for name in ("canonical_url", "document_url", "source_reference", "listing_page_url", "resolution_status")), ("listing_date", day, False), ("sampled", BOOLEAN, False),
)


@dataclass(frozen=True)
class Manifest:
    source_id: str
    manifest_hash: str
    allowed_hosts: tuple[str, ...]
    parameters: dict[str, float]
    content: dict[str, Any]
    candidates: tuple[dict[str, Any], ...]

    def candidates_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.candidates), CANDIDATES)

    def candidate_key(self, document_key: str) -> str:
        """The identity of a document across runs."""
        return f"{self.source_id}/{document_key}"


def load_manifest(path: str | Path, complete: bool = False) -> Manifest:
    try:
        return parse_manifest(Path(path).read_bytes(), complete)
    except OSError as error:
        raise ManifestError(f"cannot read {path}: {error}") from error


def parse_manifest(raw: bytes, complete: bool = False) -> Manifest:
    """A manifest from UTF-8 YAML; its hash is that of the bytes.

    ``complete``: every section of the reviewed format must be there and valid. Otherwise a draft will do: a source, hosts,
    crawl parameters and candidates.
    """
    if yaml is None:
        raise ManifestError("reading a manifest needs PyYAML")
    try:
        content = yaml.load(raw.decode("utf-8"), StrictLoader)  # noqa: S506 - a safe loader
    except ManifestError:
        raise
    except (ValueError, yaml.YAMLError) as error:  # not UTF-8, not YAML, or a day that is none
        raise ManifestError(f"not a UTF-8 YAML document: {error}") from error
    require(isinstance(content, dict), "expected a mapping", content)
    draft = [("source_id", text, True), ("allowed_hosts", list_of(text), False), ("crawl", section(("parameters", dict, False)), False)]
    try:
        fields = section(*(MANIFEST if complete else draft))(content)
        hosts = exact_hosts(fields["allowed_hosts"] or [])
        crawl = fields["crawl"] or {}
        parameters = {k: crawl[k] for k in SECONDS + WHOLE if crawl.get(k) is not None} if complete else {k: check_number(k, v) for k, v in (crawl.get("parameters") or {}).items()}
        slowest, first = (parameters.get(f"backoff_{k}_seconds") for k in ("max", "base"))
        require(slowest is None or first is None or slowest >= first, "backoff_max_seconds is below backoff_base_seconds", slowest)
    except ManifestError:
        raise
    except ValueError as error:
        raise ManifestError(str(error)) from error
    entries = content.get("candidate_documents", content.get("candidates")) or []
    return Manifest(fields["source_id"], hashlib.sha256(raw).hexdigest(), tuple(hosts), parameters, fields if complete else content, candidates(entries))


def candidates(entries: list[dict[str, Any]]) -> tuple[dict[str, Any], ...]:
    """Typed candidates in order of their key; a repeated key is refused; ``*_status`` labels are kept as they are."""
    out = {}
    for i, entry in enumerate(list_of(lambda e: e)(entries)):
        row = CANDIDATE(entry) | {"entry_index": i}
        marks = sorted((k, v) for k, v in entry.items() if k.endswith("_status") and k != "resolution_status")
        row |= {"sampled": bool(row["sampled"]), "status_labels": [{"field": k, "label": one_of(*LABELS)(v)} for k, v in marks]}
        require(out.setdefault(row["document_key"], row) is row, "a document key is listed twice", row["document_key"])
    return tuple(out[k] for k in sorted(out))
