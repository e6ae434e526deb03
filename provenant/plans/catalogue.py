"""Every registered query of the ledger and its query side, with the SQL that gives the same rows.

The driver's tables play the ledger's parts: documents are observations (a text under 200 characters stands for a
304 answer), labels.toxic marks quarantined content, events are attempts, jobs and runs, orders are candidates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from provenant.operators import constraints, discovery, graph, ingest, jobs, lexical_index, metrics, planning, policy, responses, retrieval, shared_terms, temporal, verification, versions
from provenant.session import written

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name, with its SQL."""

    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- version ledger -------------------------------------------------------------------------------------------


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_observations(table(spark, sf_dir, "documents"))


def as_observations(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("seq"),
        F.col("source").alias("doc"),
        F.concat(F.lit("https://docs.example/"), "lang").alias("url"),
        F.when(F.col("n_chars") % 5 != 0, F.col("lang")).alias("ref"),
        F.when(F.col("n_chars") >= 200, F.sha2("text", 256)).alias("hash"),
        F.col("n_chars").alias("size"),
    )


OBS = """obs AS (SELECT doc_id AS seq, source AS doc, 'https://docs.example/' || lang AS url, CASE WHEN n_chars % 5 <> 0 THEN lang END AS ref,
 CASE WHEN n_chars >= 200 THEN sha256(text) END AS hash, n_chars AS size FROM documents)"""
FIRSTS = f"""{OBS}, body AS (SELECT * FROM obs WHERE hash IS NOT NULL),
 vf AS (SELECT doc, hash, min(seq) AS first_version FROM body GROUP BY doc, hash),
 lf AS (SELECT doc, hash, url, min(seq) AS first_location FROM body GROUP BY doc, hash, url),
 hf AS (SELECT hash, min(seq) AS first_hash FROM body GROUP BY hash),
 uf AS (SELECT doc, url, min(seq) AS first_at_url FROM body GROUP BY doc, url)"""
OUTCOMES = f"""{FIRSTS}, outcomes AS (SELECT o.seq, o.doc, o.url, o.hash,
 CASE WHEN o.hash IS NULL AND uf.first_at_url < o.seq THEN 'UNCHANGED_SKIPPED' WHEN o.hash IS NULL THEN 'FAILED_PERMANENT' WHEN o.seq = vf.first_version THEN 'NEW_VERSION'
 WHEN o.seq = lf.first_location THEN 'NEW_LOCATION_SAME_VERSION' ELSE 'UNCHANGED_SKIPPED' END AS outcome,
 CASE WHEN o.hash IS NULL AND uf.first_at_url < o.seq THEN 'NOT_MODIFIED' WHEN o.hash IS NULL THEN 'HTTP_PERMANENT' END AS reason
 FROM obs o LEFT JOIN vf ON o.doc = vf.doc AND o.hash = vf.hash LEFT JOIN lf ON o.doc = lf.doc AND o.hash = lf.hash AND o.url = lf.url LEFT JOIN uf ON o.doc = uf.doc AND o.url = uf.url)"""
VERSIONS = f"""{FIRSTS}, versions AS (SELECT v.doc, row_number() OVER (PARTITION BY v.doc ORDER BY v.first_version) AS version_no, v.first_version AS seq, v.hash,
 lag(v.hash) OVER (PARTITION BY v.doc ORDER BY v.first_version) AS previous_hash, hf.first_hash FROM vf v JOIN hf ON v.hash = hf.hash)"""
RESOLVED = f"""{FIRSTS}, cand AS (SELECT o.seq, o.doc, o.url, l.hash, row_number() OVER (PARTITION BY o.seq ORDER BY v.first_version DESC) AS rn
 FROM obs o JOIN lf l ON o.doc = l.doc AND o.url = l.url AND l.first_location < o.seq JOIN vf v ON l.doc = v.doc AND l.hash = v.hash WHERE o.hash IS NULL),
 resolved AS (SELECT seq, doc, url, hash FROM cand WHERE rn = 1)"""


@query(f"WITH {OUTCOMES} SELECT * FROM outcomes")
def ledger_outcomes(spark, sf_dir):
    return versions.outcomes(observations(spark, sf_dir))


@query(f"WITH {OUTCOMES} SELECT outcome, count(*) AS n FROM outcomes GROUP BY outcome")
def ledger_outcome_counts(spark, sf_dir):
    return metrics.outcome_counts(versions.outcomes(observations(spark, sf_dir)))


@query(f"""WITH {VERSIONS}, fw AS (SELECT doc, ref FROM (SELECT doc, ref, row_number() OVER (PARTITION BY doc ORDER BY seq) AS rn FROM body) t WHERE rn = 1),
 raised AS (SELECT v.seq, v.doc, CASE WHEN v.seq > v.first_hash THEN 'DUPLICATE_BYTES_OTHER_DOCUMENT' END AS a,
 CASE WHEN v.previous_hash IS NOT NULL AND fw.ref IS NOT NULL THEN 'CONTENT_CHANGED_UNDER_STABLE_REF' END AS b FROM versions v JOIN fw ON v.doc = fw.doc)
 SELECT seq, doc, CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a ELSE a || ',' || b END AS alerts FROM raised WHERE a IS NOT NULL OR b IS NOT NULL""")
def ledger_alerts(spark, sf_dir):
    return versions.alerts(observations(spark, sf_dir))


@query(f"WITH {VERSIONS} SELECT doc, version_no, seq, hash, previous_hash FROM versions")
def ledger_versions(spark, sf_dir):
    return versions.versions(observations(spark, sf_dir)).drop("first_hash")


@query(f"""WITH {VERSIONS}, last AS (SELECT doc, max(seq) AS seq, count(*) AS n_versions FROM versions GROUP BY doc)
 SELECT l.doc, v.hash, l.seq, l.n_versions FROM last l JOIN versions v ON l.doc = v.doc AND l.seq = v.seq""")
def ledger_versions_latest(spark, sf_dir):
    return versions.latest_versions(observations(spark, sf_dir))


@query(f"WITH {VERSIONS} SELECT doc, string_agg(substr(hash, 1, 12), ',' ORDER BY seq) AS hashes FROM versions GROUP BY doc")
def ledger_hash_history(spark, sf_dir):
    return versions.hash_history(observations(spark, sf_dir))


@query(f"WITH {RESOLVED} SELECT seq, doc, hash FROM resolved")
def ledger_resolved_304(spark, sf_dir):
    return versions.resolved_304(observations(spark, sf_dir)).select("seq", "doc", "hash")


@query(f"""WITH {RESOLVED}, seen AS (SELECT doc, hash, url, seq FROM body UNION ALL SELECT doc, hash, url, seq FROM resolved),
 last AS (SELECT doc, hash, url, max(seq) AS last_seen FROM seen GROUP BY doc, hash, url)
 SELECT lf.doc, lf.hash, lf.url, lf.first_location AS first_seen, last.last_seen FROM lf JOIN last ON lf.doc = last.doc AND lf.hash = last.hash AND lf.url = last.url""")
def ledger_location_seen(spark, sf_dir):
    return versions.location_seen(observations(spark, sf_dir))


ARTIFACTS = f"""{FIRSTS}, arts AS (SELECT b.hash, b.size, b.doc AS first_doc, c.n_seen, substr(b.hash, 1, 2) || '/' || substr(b.hash, 3, 2) || '/' || b.hash AS path
 FROM body b JOIN hf ON b.hash = hf.hash AND b.seq = hf.first_hash JOIN (SELECT hash, count(*) AS n_seen FROM body GROUP BY hash) c ON b.hash = c.hash)"""


@query(f"WITH {ARTIFACTS} SELECT hash, size, first_doc, n_seen FROM arts")
def raw_artifacts(spark, sf_dir):
    return versions.artifacts(observations(spark, sf_dir)).drop("path")


@query(f"WITH {ARTIFACTS} SELECT hash, path FROM arts")
def artifact_paths(spark, sf_dir):
    return versions.artifacts(observations(spark, sf_dir)).select("hash", "path")


@query(f"WITH {ARTIFACTS} SELECT vf.doc, vf.hash, arts.first_doc FROM vf JOIN arts ON vf.hash = arts.hash WHERE vf.doc <> arts.first_doc")
def duplicate_bytes_documents(spark, sf_dir):
    return versions.duplicate_documents(observations(spark, sf_dir))


@query(f"""WITH {VERSIONS}, last AS (SELECT doc, max(seq) AS seq FROM versions GROUP BY doc), dg AS (SELECT sha256(l.doc || '=' || v.hash) AS h FROM last l JOIN versions v ON l.doc = v.doc AND l.seq = v.seq)
 SELECT sha256('{"0" * 64}:' || count(*) || ':' || {" || ':' || ".join(f"sum(('0x' || substr(h, {k}, 15))::BIGINT)" for k in (1, 16, 31, 46))}) AS snapshot_id FROM dg""")
def snapshot_id(spark, sf_dir):
    return versions.snapshot_id(observations(spark, sf_dir), "0" * 64)


@query("""WITH old AS (SELECT lang, source, doc_id FROM documents WHERE lang = 'en'), fresh AS (SELECT lang, source, min(doc_id) AS doc_id FROM documents GROUP BY lang, source)
 SELECT * FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.source = f.source AND o.lang IS NOT DISTINCT FROM f.lang)""")
def insert_if_absent(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", "source", "doc_id")
    return versions.insert_if_absent(docs, docs.filter("lang = 'en'").select(F.col("lang"), "source").distinct(), ["lang", "source"], "doc_id")


# --- constraints ----------------------------------------------------------------------------------------------


def quarantine(spark, sf_dir):
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").alias("seq"))
    return observations(spark, sf_dir).join(toxic, "seq").select("hash").filter("hash is not null")


QUARANTINE = f"{OBS}, q AS (SELECT DISTINCT hash FROM obs JOIN labels ON obs.seq = labels.doc_id WHERE toxic = 1 AND hash IS NOT NULL)"


@query(f"WITH {QUARANTINE} SELECT seq, doc, hash FROM obs WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.hash = obs.hash)")
def admit_not_quarantined(spark, sf_dir):
    return constraints.admitted(observations(spark, sf_dir), quarantine(spark, sf_dir)).select("seq", "doc", "hash")


@query(f"WITH {QUARANTINE} SELECT seq, doc, hash FROM obs WHERE EXISTS (SELECT 1 FROM q WHERE q.hash = obs.hash)")
def quarantine_violations(spark, sf_dir):
    return constraints.quarantined(observations(spark, sf_dir), quarantine(spark, sf_dir)).select("seq", "doc", "hash")


@query("SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def orphan_refs(spark, sf_dir):
    return constraints.orphans(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), ["doc_id"])


@query(f"WITH {OBS} SELECT doc, hash, count(*) AS n FROM obs GROUP BY doc, hash HAVING count(*) > 1")
def unique_violations(spark, sf_dir):
    return constraints.duplicates(observations(spark, sf_dir), ["doc", "hash"])


def runs(spark, sf_dir):
    """Events as runs: an error is an abort, a view is still running."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("run_id"), F.col("user_id").alias("source_id"),
        F.when(F.col("value") > 20, "LIVE").otherwise("DRY_RUN").alias("mode"),
        F.when(F.col("event_type") == "error", "ABORTED").when(F.col("event_type") == "view", "RUNNING").otherwise("COMPLETED").alias("status"),
        F.when((F.col("event_type") == "error") & (F.col("value") < 50), "INTERNAL_ERROR").alias("abort_reason"),
        F.when(F.col("event_type") != "view", F.col("event_id")).alias("finished_at"),
        (F.col("value") < 90).alias("authorised"),
    )


RUNS = """runs AS (SELECT event_id AS run_id, user_id AS source_id, CASE WHEN value > 20 THEN 'LIVE' ELSE 'DRY_RUN' END AS mode,
 CASE event_type WHEN 'error' THEN 'ABORTED' WHEN 'view' THEN 'RUNNING' ELSE 'COMPLETED' END AS status, CASE WHEN event_type = 'error' AND value < 50 THEN 'INTERNAL_ERROR' END AS abort_reason,
 CASE WHEN event_type <> 'view' THEN event_id END AS finished_at, value < 90 AS authorised FROM events)"""


@query(f"""WITH {RUNS} SELECT run_id, status FROM runs WHERE (status = 'ABORTED') <> (abort_reason IS NOT NULL) OR (status = 'RUNNING') <> (finished_at IS NULL)
 OR (mode = 'LIVE' AND status <> 'ABORTED' AND NOT authorised)""")
def incoherent_runs(spark, sf_dir):
    return constraints.incoherent_runs(runs(spark, sf_dir)).select("run_id", "status")


@query(f"WITH {RUNS} SELECT source_id, count(*) AS n FROM runs WHERE status = 'RUNNING' GROUP BY source_id HAVING count(*) > 1")
def several_running(spark, sf_dir):
    return constraints.several_running(runs(spark, sf_dir))


@query(f"WITH {RUNS} SELECT e.event_id AS run_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.run_id = e.event_id AND r.mode = 'LIVE')")
def not_live(spark, sf_dir):
    return constraints.not_live(table(spark, sf_dir, "events").select(F.col("event_id").alias("run_id")), runs(spark, sf_dir))


@query(f"WITH {ARTIFACTS} SELECT 'bad_hashes' AS name, count(*) AS n FROM arts WHERE NOT regexp_full_match(hash, '[0-9a-f]{{64}}') UNION ALL SELECT 'orphan_versions', count(*) FROM vf WHERE NOT EXISTS (SELECT 1 FROM arts WHERE arts.hash = vf.hash)")
def constraint_report(spark, sf_dir):
    obs = observations(spark, sf_dir)
    arts = versions.artifacts(obs)
    return constraints.report({"bad_hashes": constraints.bad_hashes(arts), "orphan_versions": constraints.orphans(versions.versions(obs), arts, ["hash"])})


TABLES = ("documents", "labels", "pages", "events", "orders", "lineitem", "customer")


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in TABLES))
def table_counts(spark, sf_dir):
    return constraints.report({t: table(spark, sf_dir, t) for t in TABLES})


# --- URL policy and log hygiene -------------------------------------------------------------------------------

HOSTS = ["thther.example.org", "blog.tionsh.example.net", "m.ththth.example.net"]
PREFIXES = ["/en/", "/de"]
REST = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^#]*)', 1)"
URL_PARTS = f"""parts AS (SELECT page_id, url, regexp_extract({REST}, '^([^/?]*)', 1) AS authority, CASE WHEN regexp_extract({REST}, '^[^/?]*([^?]*)', 1) = '' THEN '/'
 ELSE regexp_extract({REST}, '^[^/?]*([^?]*)', 1) END AS path, regexp_extract({REST}, '^[^?]*\\?(.*)$', 1) AS query FROM pages),
 hosted AS (SELECT *, lower(regexp_replace(regexp_replace(authority, ':[0-9]*$', ''), '\\.+$', '')) AS host FROM parts)"""
URL_REASONS = f"""{URL_PARTS}, reasons AS (SELECT page_id, url, CASE WHEN url IS NULL OR url = '' OR length(url) > 60 THEN 'MANIFEST_SCOPE_MISMATCH'
 WHEN regexp_matches(url, '[\\x00-\\x20\\x7f\\\\]') THEN 'MANIFEST_SCOPE_MISMATCH' WHEN NOT starts_with(lower(url), 'https://') THEN 'SCHEME_NOT_HTTPS'
 WHEN authority LIKE '%@%' OR host = '' OR host NOT IN ('{"', '".join(HOSTS)}') THEN 'HOST_NOT_ALLOWED'
 WHEN regexp_matches(path, '^/web/?$') AND query LIKE '%file=%' THEN 'VIEWER_WRAPPER_URL'
 WHEN path LIKE '%//%' OR regexp_matches(path, '(^|/)\\.\\.?(/|$)') THEN 'MANIFEST_SCOPE_MISMATCH'
 WHEN NOT (starts_with(path, '/en/') OR path = '/de' OR starts_with(path, '/de/')) THEN 'MANIFEST_SCOPE_MISMATCH' WHEN query <> '' THEN 'MANIFEST_SCOPE_MISMATCH' END AS reason FROM hosted)"""


def url_reasons(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", policy.url_reason(F.col("url"), HOSTS, PREFIXES, 60).alias("reason"))


@query(f"WITH {URL_REASONS} SELECT page_id, url, reason FROM reasons")
def url_policy_reason(spark, sf_dir):
    return url_reasons(spark, sf_dir)


@query(f"WITH {URL_REASONS} SELECT coalesce(reason, 'OK') AS reason, count(*) AS n FROM reasons GROUP BY 1")
def url_policy_counts(spark, sf_dir):
    return url_reasons(spark, sf_dir).groupBy(F.coalesce("reason", F.lit("OK")).alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT page_id, lower(regexp_extract(url, '^([a-z]+)://', 1)) || '://' || lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) || regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS shown FROM pages")
def url_log_safe(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", policy.log_url(F.col("url")).alias("shown"))


@query(f"WITH {URL_PARTS} SELECT page_id, 'https://' || host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url FROM hosted")
def url_normalised(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", policy.normalised_url(F.col("url")).alias("url"))


@query("SELECT conv_id, turn, CASE WHEN length(t) <= 120 THEN t ELSE substr(t, 1, 119) || '…' END AS shown FROM (SELECT conv_id, turn, replace(replace(text, 'the', '[REDACTED]'), chr(10), '\\x0a') AS t FROM conversations) x")
def neutralized_text(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", policy.neutralised(F.col("text"), 120, ["the"]).alias("shown"))


@query("SELECT user_id, n, CASE WHEN n BETWEEN 167772160 AND 184549375 OR n BETWEEN 3232235520 AND 3232301055 THEN false ELSE true END AS public FROM (SELECT DISTINCT user_id, (CASE WHEN user_id % 2 = 0 THEN 10 ELSE 192 END)::BIGINT * 16777216 + (CASE WHEN user_id % 3 = 0 THEN 168 ELSE 1 END)::BIGINT * 65536 + 512 + user_id % 256 AS n FROM events) t")
def address_public(spark, sf_dir):
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    a = F.concat_ws(".", F.when(F.col("user_id") % 2 == 0, "10").otherwise("192"), F.when(F.col("user_id") % 3 == 0, "168").otherwise("1"), F.lit("2"), (F.col("user_id") % 256).cast("string"))
    return users.select("user_id", policy.v4_number(a).alias("n"), policy.public_v4(a).alias("public"))


# --- discovery ------------------------------------------------------------------------------------------------

# On these pages a double-quoted pattern finds the same references as a tokenizer.
REFS = """refs AS (SELECT page_id, url, generate_subscripts(r, 1) - 1 AS pos, unnest(r) AS raw FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS r FROM pages) t),
 full_refs AS (SELECT *, CASE WHEN raw LIKE 'http%' THEN raw ELSE regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || raw END AS resolved FROM refs)"""


@query(f"WITH {REFS} SELECT page_id, pos, raw FROM refs")
def page_references(spark, sf_dir):
    return discovery.page_references(table(spark, sf_dir, "pages")).select("page_id", "pos", "raw")


@query(f"WITH {REFS} SELECT page_id, resolved, min(pos) AS first_pos, count(*) AS n_refs, string_agg(raw, ' ' ORDER BY pos) AS raws FROM full_refs GROUP BY page_id, resolved")
def reference_groups(spark, sf_dir):
    refs = discovery.page_references(table(spark, sf_dir, "pages"))
    return discovery.reference_groups(refs).select("page_id", "resolved", "first_pos", "n_refs", F.array_join(F.transform("raws", lambda r: r["raw"]), " ").alias("raws"))


@query(f"""WITH {REFS}, ok AS (SELECT page_id, count(DISTINCT resolved) AS n FROM full_refs WHERE regexp_matches(resolved, '^https://({'|'.join(HOSTS)})(/|$)') AND length(resolved) <= 200 AND NOT regexp_matches(resolved, '[\\x00-\\x20\\x7f-\\x9f\\\\]')
 AND NOT regexp_matches(resolved, '\\?[^#]') AND NOT regexp_matches(substr(resolved, 9), '//') AND NOT regexp_matches(regexp_replace(resolved, '[?#].*$', ''), '[^\\x00-\\x7f]') GROUP BY page_id)
 SELECT p.page_id, coalesce(n, 0) AS n_candidates, CASE WHEN n IS NULL THEN 'UNRESOLVED' WHEN n = 1 THEN 'DISCOVERED' ELSE 'AMBIGUOUS' END AS status FROM pages p LEFT JOIN ok ON p.page_id = ok.page_id""")
def discovery_status(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    ok = F.col("resolved").startswith("https://") & (policy.url_reason(F.col("resolved"), HOSTS, ["/"], 200).isNull())
    return discovery.discovery_status(pages, discovery.page_references(pages), ok)


# --- attempts, pacing, breaker --------------------------------------------------------------------------------

STATUS = "CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 404 WHEN 'error' THEN 429 WHEN 'signup' THEN 403 ELSE 500 END"
ATTEMPTS = f"attempts AS (SELECT event_id AS seq, user_id AS run, user_id % 7 AS candidate, {STATUS} AS status, epoch_us(ts) / 1000000.0 AS start FROM events)"


def attempts(spark, sf_dir):
    status = F.when(F.col("event_type") == "view", 200).when(F.col("event_type") == "click", 404).when(F.col("event_type") == "error", 429).when(F.col("event_type") == "signup", 403).otherwise(500)
    start = (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("start")
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("user_id").alias("run"), (F.col("user_id") % 7).alias("candidate"), status.alias("status"), start)


@query(f"WITH {ATTEMPTS} SELECT seq, status, CASE WHEN status = 200 THEN 'OK' WHEN status = 304 THEN 'NOT_MODIFIED' WHEN status = 429 OR status >= 500 THEN 'HTTP_TRANSIENT' ELSE 'HTTP_PERMANENT' END AS outcome FROM attempts")
def attempt_status_map(spark, sf_dir):
    return attempts(spark, sf_dir).select("seq", "status", responses.status_outcome(F.col("status")).alias("outcome"))


@query(f"WITH {ATTEMPTS} SELECT seq, run, row_number() OVER (PARTITION BY run, candidate ORDER BY seq) AS attempt FROM attempts")
def attempt_order(spark, sf_dir):
    return responses.attempt_numbers(attempts(spark, sf_dir)).select("seq", "run", "attempt")


STREAKS = f"""{ATTEMPTS}, isl AS (SELECT *, sum(CASE WHEN status = 200 THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM attempts),
 streaks AS (SELECT *, sum(CASE WHEN status IN (401, 403, 429) THEN 1 ELSE 0 END) OVER (PARTITION BY run, island ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS refusals FROM isl),
 trips AS (SELECT run, min(seq) AS tripped_at FROM streaks WHERE status IN (401, 403, 429) AND refusals >= 4 GROUP BY run)"""


@query(f"WITH {STREAKS} SELECT seq, run, island::BIGINT AS island, refusals::BIGINT AS refusals FROM streaks")
def refusal_streaks(spark, sf_dir):
    return responses.refusal_streaks(attempts(spark, sf_dir)).select("seq", "run", "island", "refusals")


@query(f"WITH {STREAKS} SELECT run, tripped_at FROM trips")
def circuit_trip(spark, sf_dir):
    return responses.circuit_trips(attempts(spark, sf_dir), 4)


@query(f"""WITH {STREAKS} SELECT a.seq, a.run, CASE WHEN a.seq = t.tripped_at THEN 'CIRCUIT_OPEN' WHEN status = 200 THEN 'OK' WHEN status = 429 OR status >= 500 THEN 'HTTP_TRANSIENT' ELSE 'HTTP_PERMANENT' END AS outcome
 FROM attempts a LEFT JOIN trips t ON a.run = t.run WHERE t.tripped_at IS NULL OR a.seq <= t.tripped_at""")
def attempts_before_trip(spark, sf_dir):
    return responses.before_trip(attempts(spark, sf_dir), 4).select("seq", "run", "outcome")


@query(f"WITH {ATTEMPTS}, w AS (SELECT seq, run, start - lag(start) OVER (PARTITION BY run ORDER BY start, seq) AS since FROM attempts) SELECT seq, run FROM w WHERE since < 3600")
def pacing_violations(spark, sf_dir):
    rows = attempts(spark, sf_dir).select(F.col("run").alias("host"), "seq", "start", F.col("start").alias("end"))
    return responses.pacing_violations(rows, 3600).select("seq", F.col("host").alias("run"))


@query(f"WITH {ATTEMPTS}, n AS (SELECT seq, row_number() OVER (PARTITION BY run, candidate ORDER BY seq) AS attempt FROM attempts) SELECT seq, attempt, least(60.0, 1.5 * pow(2.0, attempt - 1))::DOUBLE AS ceiling FROM n")
def backoff_ceiling(spark, sf_dir):
    return responses.attempt_numbers(attempts(spark, sf_dir)).select("seq", "attempt", responses.backoff_ceiling(F.col("attempt"), 1.5, 60.0).alias("ceiling"))


@query("SELECT event_id, CASE WHEN k % 3 = 0 THEN k::DOUBLE END AS seconds FROM (SELECT event_id, regexp_extract(props, '[0-9]+')::BIGINT AS k FROM events) t")
def retry_after(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts", F.get_json_object("props", "$.k").alias("k"))
    value = F.when(F.col("k").cast("long") % 3 == 0, F.col("k")).otherwise(F.concat("k", F.lit("s")))
    return e.select("event_id", responses.retry_after_seconds(value, F.col("ts").cast("timestamp")).alias("seconds"))


@query("SELECT page_id, CASE WHEN regexp_matches(lower(substr(ltrim(html), 1, 64)), '^(<!doctype html|<html|<head|<body)') THEN 'text/html' ELSE 'application/octet-stream' END AS sniffed FROM pages")
def media_sniff(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", responses.sniffed_type(F.encode("html", "UTF-8")).alias("sniffed"))


@query("""SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'CONTENT_TYPE_MISMATCH' WHEN octet_length(encode(html)) > 20000 THEN 'SIZE_EXCEEDED' WHEN page_id % 4 = 1 THEN 'MAGIC_BYTES_MISMATCH' END AS reason FROM pages""")
def first_rejection(spark, sf_dir):
    kind = F.col("page_id") % 4
    content_type = F.when(kind == 0, "image/png").when(kind == 1, "Application/PDF; x=1").otherwise("text/HTML; charset=utf-8")
    purpose = F.when(kind == 1, "ATTACHMENT").otherwise("DETAIL_PAGE")
    rows = table(spark, sf_dir, "pages").select("page_id", content_type.alias("ct"), purpose.alias("purpose"), F.encode("html", "UTF-8").alias("body"))
    return rows.select("page_id", responses.rejection(F.col("ct"), F.col("body"), F.col("purpose"), 20000, 64).alias("reason"))


# --- planning and queue ---------------------------------------------------------------------------------------

SCOPE = """scoped AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'TIER_CONTEXT_OUT_OF_WINDOW' WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW') THEN 'DOCUMENT_TYPE_NOT_IN_SCOPE'
 WHEN NOT o_orderdate BETWEEN DATE '1995-01-01' AND DATE '1997-12-31' THEN 'OUTSIDE_DATE_WINDOW' END AS reason, o_totalprice FROM orders)"""


def scoped(spark, sf_dir):
    tier = F.when(F.col("o_orderstatus") == "P", "context_out_of_window").otherwise("primary")
    start, end = (F.lit(d).cast("date").cast("timestamp_ntz") for d in ("1995-01-01", "1997-12-31"))
    reason = planning.scope_reason(tier, F.col("o_orderpriority"), F.col("o_orderdate"), ["1-URGENT", "2-HIGH", "5-LOW"], start, end)
    return table(spark, sf_dir, "orders").select("o_orderkey", reason.alias("reason"), "o_totalprice")


@query(f"WITH {SCOPE} SELECT o_orderkey, reason FROM scoped")
def scope_reason(spark, sf_dir):
    return scoped(spark, sf_dir).drop("o_totalprice")


@query(f"""WITH {SCOPE} SELECT action, count(*) AS n FROM (SELECT CASE WHEN reason IS NOT NULL THEN 'OUT_OF_SCOPE' WHEN o_totalprice > 300000 THEN 'FETCH_ATTACHMENT' WHEN o_totalprice > 100000 THEN 'FETCH_DETAIL_THEN_DISCOVER'
 ELSE 'UNRESOLVED' END AS action FROM scoped) t GROUP BY action""")
def plan_actions(spark, sf_dir):
    link = lambda least: F.when(F.col("o_totalprice") > least, "url")
    action = planning.plan_action(F.col("reason"), link(300000), link(100000))
    return scoped(spark, sf_dir).groupBy(action.alias("action")).agg(F.count("*").alias("n"))


SELECTION = ["src7", "src1", "src12"]


@query("SELECT s.position, d.source, min(d.doc_id) AS first_doc, count(*) AS n FROM documents d JOIN (VALUES (1, 'src7'), (2, 'src1'), (3, 'src12')) s(position, source) ON d.source = s.source GROUP BY s.position, d.source")
def selection_order(spark, sf_dir):
    candidates = table(spark, sf_dir, "documents").groupBy("source").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n"))
    return planning.selected(spark, candidates, SELECTION, "source").select(F.col("position").cast("int").alias("position"), "source", "first_doc", "n")


KIND = "CASE event_type WHEN 'signup' THEN 'ENQUEUED' WHEN 'click' THEN 'CLAIMED' WHEN 'view' THEN 'CLAIMED' WHEN 'purchase' THEN 'SUCCEEDED' ELSE 'RETRY_SCHEDULED' END"


@query(f"""WITH ev AS (SELECT user_id AS job_id, event_id AS seq, {KIND} AS kind FROM events), f AS (SELECT job_id, max(seq) AS m, count(*) FILTER (WHERE kind = 'CLAIMED') AS attempts, count(*) AS n_events FROM ev GROUP BY job_id)
 SELECT f.job_id, CASE WHEN kind = 'SUCCEEDED' THEN 'SUCCEEDED' WHEN kind = 'RETRY_SCHEDULED' AND attempts >= 30 THEN 'FAILED' WHEN kind = 'CLAIMED' THEN 'RUNNING' ELSE 'QUEUED' END AS state, attempts, n_events
 FROM f JOIN ev ON f.job_id = ev.job_id AND f.m = ev.seq""")
def job_state_fold(spark, sf_dir):
    kind = F.when(F.col("event_type") == "signup", "ENQUEUED").when(F.col("event_type").isin("click", "view"), "CLAIMED").when(F.col("event_type") == "purchase", "SUCCEEDED").otherwise("RETRY_SCHEDULED")
    return jobs.state_after(table(spark, sf_dir, "events").select(F.col("user_id").alias("job_id"), F.col("event_id").alias("seq"), kind.alias("kind")), 30)


@query("SELECT o_orderkey AS job_id FROM orders WHERE o_orderstatus = 'O' AND o_orderdate <= DATE '1996-06-01' ORDER BY o_orderdate, o_custkey, o_orderkey LIMIT 20")
def queue_head(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("job_id"), F.col("o_orderdate").alias("run_after"), F.col("o_custkey").alias("created_at"), F.when(F.col("o_orderstatus") == "O", "QUEUED").otherwise("SUCCEEDED").alias("state"))
    return jobs.queue_head(o, F.lit("1996-06-01").cast("timestamp_ntz"), 20).select("job_id")


# --- a whole run ----------------------------------------------------------------------------------------------

CANDIDATE_ROWS = """c AS (SELECT doc_id, source, lang, n_chars, text, CASE WHEN lang = 'es' THEN 'DOCUMENT_TYPE_NOT_IN_SCOPE' END AS scope_reason, CASE WHEN n_chars % 7 <> 0 THEN 'https://docs.example/' || lang END AS document_url,
 CASE WHEN source = 'src3' THEN 'HOST_NOT_ALLOWED' END AS url_reason, CASE n_chars % 11 WHEN 0 THEN 304 WHEN 1 THEN 503 WHEN 2 THEN 404 ELSE 200 END AS status, CASE WHEN n_chars % 13 = 0 THEN 'PDF_SANITY_FAILED' END AS rejected FROM documents),
 pre AS (SELECT *, CASE WHEN scope_reason IS NOT NULL THEN 'OUT_OF_SCOPE' WHEN document_url IS NULL THEN 'UNRESOLVED' WHEN url_reason IS NOT NULL THEN 'QUARANTINED' END AS pre,
 CASE WHEN scope_reason IS NOT NULL THEN scope_reason WHEN document_url IS NULL THEN 'NO_ATTACHMENT_URL_IN_MANIFEST' ELSE url_reason END AS pre_reason FROM c),
 res AS (SELECT doc_id AS document_key, CASE WHEN pre IS NOT NULL THEN pre WHEN status = 503 THEN 'FAILED_TRANSIENT' WHEN status = 404 THEN 'FAILED_PERMANENT' WHEN rejected IS NOT NULL THEN 'QUARANTINED' WHEN status = 304 THEN 'FAILED_PERMANENT' ELSE 'NEW_VERSION' END AS outcome,
 CASE WHEN pre IS NOT NULL THEN pre_reason WHEN status = 503 THEN 'HTTP_TRANSIENT' WHEN status = 404 THEN 'HTTP_PERMANENT' WHEN rejected IS NOT NULL THEN rejected WHEN status = 304 THEN 'HTTP_PERMANENT' END AS reason,
 CASE WHEN pre IS NOT NULL OR status IN (503, 404) THEN 'DISCOVERED' WHEN rejected IS NOT NULL OR status = 304 THEN 'FETCHED' ELSE 'VERSIONED' END AS stage, CASE WHEN pre IS NULL THEN 1 ELSE 0 END AS attempts FROM pre)"""


def run_results(spark, sf_dir):
    """Every document is a candidate of one first run, with one captured attempt."""
    d = table(spark, sf_dir, "documents")
    candidates = d.select(
        F.col("doc_id").alias("document_key"), F.when(F.col("lang") == "es", "DOCUMENT_TYPE_NOT_IN_SCOPE").alias("scope_reason"), F.when(F.col("n_chars") % 7 != 0, F.concat(F.lit("https://docs.example/"), "lang")).alias("document_url"),
        F.when(F.col("source") == "src3", "HOST_NOT_ALLOWED").alias("url_reason"), F.col("lang").alias("ref"),
    )
    k, none = F.col("n_chars") % 11, F.lit(None).cast("string")
    status = F.when(k == 0, 304).when(k == 1, 503).when(k == 2, 404).otherwise(200)
    captured = d.select(
        F.col("doc_id").alias("document_key"), F.col("doc_id").alias("seq"), status.alias("status"), none.alias("failure"), none.alias("quarantine"),
        F.when(F.col("n_chars") % 13 == 0, "PDF_SANITY_FAILED").alias("rejected"), F.sha2("text", 256).alias("hash"), F.col("n_chars").alias("size"),
    )
    earlier = observations(spark, sf_dir).limit(0).withColumn("doc", F.lit(0).cast("long"))
    return ingest.ingest(candidates, captured, earlier)


@query(f"WITH {CANDIDATE_ROWS} SELECT document_key, outcome, reason, stage, attempts FROM res")
def ingest_results(spark, sf_dir):
    return run_results(spark, sf_dir)


@query(f"WITH {CANDIDATE_ROWS}, g AS (SELECT outcome, count(*) AS n FROM res GROUP BY outcome) SELECT sum(n)::BIGINT AS processed, string_agg(outcome || '=' || n, ',' ORDER BY outcome) AS outcomes FROM g")
def ingest_stats(spark, sf_dir):
    return ingest.run_stats(run_results(spark, sf_dir))


@query(f"WITH {CANDIDATE_ROWS} SELECT outcome || ': ' || count(*) AS line FROM res GROUP BY outcome UNION ALL SELECT document_key || ' ' || outcome || ' ' || reason FROM res WHERE outcome IN ('FAILED_TRANSIENT', 'FAILED_PERMANENT', 'QUARANTINED')")
def ingest_report(spark, sf_dir):
    return ingest.report_lines(run_results(spark, sf_dir))


@query("""WITH q AS (SELECT d.doc_id, d.source, CASE l.quality WHEN 1 THEN 'SUPPORTS' ELSE 'CONTRADICTS' END AS stance, d.n_chars > 300 AS quoted, d.lang <> 'fr' AS dated, d.lang = 'en' AS in_force FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
 v AS (SELECT source, count(*) FILTER (WHERE quoted AND in_force AND stance = 'CONTRADICTS') AS c, count(*) FILTER (WHERE quoted AND in_force AND stance = 'SUPPORTS') AS s, count(*) FILTER (WHERE quoted AND NOT dated) AS u FROM q GROUP BY source)
 SELECT k.source AS claim_id, CASE WHEN c > 0 THEN 'CONTRADICTED' WHEN s > 0 THEN 'SUPPORTED' WHEN u > 0 THEN 'TEMPORALLY_AMBIGUOUS' ELSE 'INSUFFICIENT_EVIDENCE' END AS state FROM (SELECT DISTINCT source FROM documents) k LEFT JOIN v ON k.source = v.source""")
def claim_states(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    claims = d.select(F.col("source").alias("claim_id")).distinct()
    labels = table(spark, sf_dir, "labels")
    citations = d.join(labels, "doc_id").select(F.col("source").alias("claim_id"), F.col("doc_id").alias("evidence_id"), F.lit(10).alias("as_of"), F.when(F.col("quality") == 1, "SUPPORTS").otherwise("CONTRADICTS").alias("stance"))
    quote = F.when(F.col("n_chars") > 300, F.sha2(F.substring("text", 6, 20), 256)).otherwise("none")
    start = F.when(F.col("lang") == "en", 1).when(F.col("lang") != "fr", 50)
    evidence = d.select(F.col("doc_id").alias("evidence_id"), F.col("doc_id").alias("layer_id"), F.lit(5).alias("start"), F.lit(25).alias("end"), quote.alias("quote_hash"), start.alias("valid_from"), F.lit(None).cast("int").alias("valid_to"))
    checked = verification.checked_citations(citations, evidence, d.select(F.col("doc_id").alias("layer_id"), "text"))
    return verification.claim_states(claims, checked)


# --- as-of, graph ---------------------------------------------------------------------------------------------


@query("""WITH i AS (SELECT l_orderkey, min(l_shipdate) AS effective, max(l_shipdate) AS expiry, min(CASE WHEN l_returnflag = 'R' THEN l_shipdate + INTERVAL 30 DAY END) AS withdrawn FROM lineitem GROUP BY l_orderkey)
 SELECT l_orderkey, CASE WHEN effective IS NULL THEN 'UNKNOWN' WHEN effective > TIMESTAMP '1996-01-01' THEN 'NOT_YET_EFFECTIVE' WHEN least(expiry, withdrawn) > TIMESTAMP '1996-01-01' THEN 'IN_FORCE'
 WHEN least(expiry, withdrawn) = withdrawn THEN 'WITHDRAWN' ELSE 'EXPIRED' END AS state FROM i""")
def asof_state(spark, sf_dir):
    returned = F.min(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate") + F.expr("interval 30 days")))
    i = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("effective"), F.max("l_shipdate").alias("expiry"), returned.alias("withdrawn"))
    x, none = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit(None).cast("timestamp_ntz")
    return i.select("l_orderkey", temporal.state_at(x, F.col("effective"), F.col("expiry"), F.col("withdrawn"), none).alias("state"))


@query("""SELECT e.event_id, (SELECT max(o.event_id) FROM events o WHERE o.user_id = e.user_id AND o.event_type = 'signup' AND o.event_id <= e.event_id) AS last_signup FROM events e WHERE e.event_type = 'purchase'""")
def asof_join(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    points = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("at"))
    rows = e.filter("event_type = 'signup'").select("user_id", "event_id", F.col("event_id").alias("last_signup"))
    return temporal.latest_before(rows, points, ["user_id"], "event_id", ["last_signup"]).select(F.col("at").alias("event_id"), "last_signup")


@query("""WITH o AS (SELECT source, max(sha256(text)) AS h FROM documents WHERE lang = 'en' GROUP BY source), n AS (SELECT source, max(sha256(text)) AS h FROM documents WHERE lang IN ('en', 'de') GROUP BY source)
 SELECT coalesce(o.source, n.source) AS source, CASE WHEN o.h IS NULL THEN 'ADDED' WHEN n.h IS NULL THEN 'REMOVED' ELSE 'MODIFIED' END AS change FROM o FULL OUTER JOIN n ON o.source = n.source WHERE o.h IS DISTINCT FROM n.h""")
def version_diff(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", "lang", F.sha2("text", 256).alias("h"))
    side = lambda langs: d.filter(F.col("lang").isin(*langs)).groupBy("source").agg(F.max("h").alias("h"))
    return temporal.version_diff(side(["en"]), side(["en", "de"]), "source", "h")


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS src, l_suppkey + 1 + l_linenumber AS dst FROM lineitem WHERE l_returnflag = 'A'), c AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY dst) AS rn, count(*) OVER (PARTITION BY src) AS m FROM e),
 w(root, node, depth) AS (SELECT DISTINCT s_suppkey, s_suppkey, 0 FROM supplier UNION ALL SELECT w.root, c.dst, w.depth + 1 FROM w JOIN c ON w.node = c.src WHERE c.rn <= 3 AND w.depth < 3)
 SELECT root, node, min(depth)::BIGINT AS depth FROM w GROUP BY root, node""")
def bounded_traversal(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    edges = li.select(F.col("l_suppkey").alias("src"), (F.col("l_suppkey") + 1 + F.col("l_linenumber")).alias("dst"), F.when(F.col("l_returnflag") == "A", "VERIFIED").otherwise("OBSERVED").alias("state"))
    roots = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("root"))
    return graph.reachable(edges, roots, 3, 3).drop("truncated")


# --- retrieval and metrics ------------------------------------------------------------------------------------

QUERY_VECTOR = [1.0 if i % 3 == 0 else -0.5 for i in range(64)]


@query(f"SELECT vec_id, score FROM (SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], {QUERY_VECTOR}::DOUBLE[]), 6) AS score FROM embeddings) t ORDER BY score DESC, vec_id LIMIT 50")
def dense_topk(spark, sf_dir):
    return retrieval.dense_topk(table(spark, sf_dir, "embeddings"), QUERY_VECTOR, 50)


TERMS = "unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> ''))"
BM25 = f"""dt AS (SELECT doc_id, {TERMS} AS term FROM documents), qt AS (SELECT DISTINCT item_id, {TERMS} AS term FROM benchmark), dl AS (SELECT doc_id, count(*) AS n FROM dt GROUP BY doc_id),
 st AS (SELECT (SELECT count(*) FROM documents) AS n_docs, (SELECT sum(n) FROM dl) / (SELECT count(*) FROM documents) AS avg_n), tf AS (SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY doc_id, term), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
 sc AS (SELECT item_id, tf.doc_id, sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / avg_n))) AS score FROM qt JOIN tf ON qt.term = tf.term JOIN df ON df.term = tf.term JOIN dl ON dl.doc_id = tf.doc_id CROSS JOIN st GROUP BY item_id, tf.doc_id),
 lex AS (SELECT item_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM sc)"""


@query(f"WITH {BM25} SELECT item_id, doc_id, score, rank FROM lex WHERE rank <= 50")
def lexical_topk(spark, sf_dir):
    """The index has blocks of one language each, so that a question passes by those of the others."""
    index = lexical_index.build(spark, table(spark, sf_dir, "documents"), cluster=("lang",))
    return lexical_index.topk(spark, index, table(spark, sf_dir, "benchmark"), 50)


OVERLAP = f"""dw AS (SELECT DISTINCT doc_id, {TERMS} AS term FROM documents), qw AS (SELECT DISTINCT item_id, {TERMS} AS term FROM benchmark),
 ov AS (SELECT item_id, doc_id, count(*) AS score FROM qw JOIN dw ON qw.term = dw.term GROUP BY item_id, doc_id),
 ra AS (SELECT item_id, doc_id, rank FROM (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM ov) t WHERE rank <= 50),
 rb AS (SELECT item_id, doc_id, rank FROM (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY doc_id) AS rank FROM ov) t WHERE rank <= 50),
 fused AS (SELECT item_id, doc_id, round(sum(1.0 / (60 + rank))::DOUBLE, 6) AS score, count(*) AS n_lists FROM (SELECT * FROM ra UNION ALL SELECT * FROM rb) t GROUP BY item_id, doc_id)"""


def overlap(spark, sf_dir, least=None):
    """Distinct shared terms of a query and a document, for the fusion queries: the pairs that are among the query's first 50 by
    score or by id, and all of ``least`` or more."""
    return shared_terms.first_shared(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50, least)


def fused(spark, sf_dir, scores=None):
    scores = overlap(spark, sf_dir) if scores is None else scores
    by_score = retrieval.ranked(scores, "item_id", "doc_id", 50)
    by_id = retrieval.ranked(scores.withColumn("score", F.lit(0)), "item_id", "doc_id", 50)
    return retrieval.rrf([by_score, by_id], "item_id", "doc_id").withColumn("score", F.round("score", 6))


@query(f"WITH {OVERLAP} SELECT item_id, doc_id, score, n_lists FROM fused")
def rrf_fused(spark, sf_dir):
    return fused(spark, sf_dir)


CAPPED = f"""{OVERLAP}, fr AS (SELECT f.item_id, f.doc_id, d.source, row_number() OVER (PARTITION BY f.item_id ORDER BY f.score DESC, f.doc_id) AS rank FROM fused f JOIN documents d ON f.doc_id = d.doc_id),
 oc AS (SELECT *, row_number() OVER (PARTITION BY item_id, source ORDER BY rank) AS own FROM fr),
 chosen AS (SELECT item_id, doc_id, source, rank, position FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY rank) AS position FROM oc WHERE own <= 3) t WHERE position <= 8)"""


def chosen(spark, sf_dir, scores=None):
    ranks = retrieval.ranked(fused(spark, sf_dir, scores), "item_id", "doc_id", 1 << 30)
    ranks = ranks.join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return retrieval.capped(ranks, "item_id", "source", 3, 8)


@query(f"WITH {CAPPED} SELECT item_id, doc_id, source, rank, position FROM chosen")
def capped_select(spark, sf_dir):
    return chosen(spark, sf_dir).select("item_id", "doc_id", "source", "rank", "position")


METRICS = f"""{CAPPED}, gr AS (SELECT q.item_id, l.doc_id, l.quality + 1 - l.toxic AS grade FROM (SELECT DISTINCT item_id FROM ov) q JOIN ov ON q.item_id = ov.item_id JOIN labels l ON ov.doc_id = l.doc_id WHERE l.quality + 1 - l.toxic > 0 AND ov.score >= 12),
 ideal AS (SELECT item_id, count(*) AS nr, sum(CASE WHEN i <= 8 THEN (pow(2, grade) - 1) / log2(i + 1) ELSE 0 END) AS ideal FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY grade DESC, doc_id) AS i FROM gr) t GROUP BY item_id),
 hit AS (SELECT c.item_id, count(*) AS n, min(position) AS first, sum((pow(2, grade) - 1) / log2(position + 1)) AS dcg FROM chosen c JOIN gr ON c.item_id = gr.item_id AND c.doc_id = gr.doc_id GROUP BY c.item_id)"""


@query(f"""WITH {METRICS} SELECT ideal.item_id, round(coalesce(n, 0) / nr::DOUBLE, 6) AS recall, round(coalesce(n, 0) / 8.0::DOUBLE, 6) AS precision, round(coalesce(1.0 / first, 0)::DOUBLE, 6) AS rr, round(coalesce(dcg / ideal, 0), 6) AS ndcg
 FROM ideal LEFT JOIN hit ON ideal.item_id = hit.item_id""")
def ranking_metrics(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") + 1 - F.col("toxic")).alias("grade"))
    scores = overlap(spark, sf_dir, 12)
    grades = scores.filter("score >= 12").join(labels, "doc_id").filter("grade > 0").select("item_id", "doc_id", "grade")
    ranks = chosen(spark, sf_dir, scores).select("item_id", "doc_id", F.col("position").alias("rank"))
    return metrics.at_k(ranks, grades, 8, "item_id", "doc_id")


@query("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, count(*) AS n FROM events GROUP BY event_type")
def latency_percentiles(spark, sf_dir):
    return metrics.percentiles(table(spark, sf_dir, "events"), "event_type", "value")


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 6) AS mean FROM events GROUP BY event_type")
def cost_by_route(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.round(F.avg("value"), 6).alias("mean"))


WEIGHTED = ", ".join(f"sum(({metrics.weight(i)}) * value) / nullif(sum({metrics.weight(i)}), 0)" for i in range(200))
DRAWN = ", ".join(f"{metrics.draw('event_id', i, 7)} AS d{i}" for i in range(200))


@query(f"WITH d AS (SELECT value, {DRAWN} FROM events), m AS (SELECT avg(value) AS mean, list_sort([{WEIGHTED}]) AS means FROM d) SELECT round(mean, 6) AS mean, round(means[5], 6) AS low, round(means[195], 6) AS high FROM m")
def bootstrap_value(spark, sf_dir):
    return metrics.bootstrap_mean(table(spark, sf_dir, "events"), "event_id", "value", 200, 7)


@query("SELECT user_id, round(count(*) FILTER (WHERE event_type = 'error') / nullif(count(*) FILTER (WHERE event_type IN ('error', 'view')), 0)::DOUBLE, 6) AS rate FROM events GROUP BY user_id")
def failure_rate(spark, sf_dir):
    return metrics.ratio(table(spark, sf_dir, "events"), ["user_id"], "event_type = 'error'", "event_type in ('error', 'view')", "rate")


@query(f"WITH {OUTCOMES} SELECT doc AS run, CASE WHEN bool_or(outcome IN ('FAILED_TRANSIENT', 'FAILED_PERMANENT', 'QUARANTINED')) THEN 'COMPLETED_WITH_FAILURES' ELSE 'COMPLETED' END AS status, count(*) AS processed FROM outcomes GROUP BY doc")
def run_status(spark, sf_dir):
    return metrics.run_status(versions.outcomes(observations(spark, sf_dir)).withColumnRenamed("doc", "run"), responses.FAILURES)


@query("""WITH d AS (SELECT event_type AS source, date_diff('day', TIMESTAMP '2024-01-01', ts) AS seq, count(*) AS n FROM events GROUP BY 1, 2), w AS (SELECT *, round(avg(n) OVER (PARTITION BY source ORDER BY seq ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS usual FROM d)
 SELECT source, seq::BIGINT AS seq, n, usual FROM w WHERE n > round(usual * 1.2, 6) OR round(n * 1.2, 6) < usual""")
def volume_anomalies(spark, sf_dir):
    day = F.datediff(F.col("ts"), F.lit("2024-01-01").cast("date")).cast("long")
    daily = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source"), day.alias("seq")).agg(F.count("*").alias("n"))
    return metrics.volume_anomalies(daily, 1.2, 5)


@query("SELECT sha256(text) AS hash, min(doc_id) AS first_doc, count(*) AS n_docs FROM documents GROUP BY 1")
def exact_duplicate_groups(spark, sf_dir):
    return retrieval.exact_groups(table(spark, sf_dir, "documents"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS node FROM documents),
 o AS (SELECT *, (sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY node))::BIGINT - 1 AS stop FROM l)
 SELECT doc_id, node, stop - length(line) AS start, stop AS "end", sha256(line) AS quote_hash, sha256(doc_id || ':' || (stop - length(line)) || ':' || stop) AS evidence_id FROM o WHERE line <> ''""")
def text_chunks(spark, sf_dir):
    return retrieval.chunks(table(spark, sf_dir, "documents"))


@query("SELECT doc_id, sha256(substr(text, 6, 20)) AS quote_hash FROM documents")
def quote_hashes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", retrieval.quote_hash(F.col("text"), F.lit(5), F.lit(25)).alias("quote_hash"))


# --- windows over events: an extension, not a capability of the reference ---------------------------------------


@query("SELECT (epoch_us(ts) // 3600000000)::BIGINT AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_tumbling(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return e.select(F.floor(F.unix_micros(F.col("window.start").cast("timestamp")) / F.lit(3600000000)).cast("long").alias("hour"), "event_type", "n", "total")


@query("""WITH s AS (SELECT user_id, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < 7200000000 THEN 0 ELSE 1 END AS fresh FROM events),
 g AS (SELECT user_id, t, sum(fresh) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS no FROM s) SELECT user_id, min(t) AS start_us, count(*) AS n FROM g GROUP BY user_id, no""")
def events_session(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "2 hours").alias("s")).agg(F.count("*").alias("n"))
    return e.select("user_id", F.unix_micros(F.col("s.start").cast("timestamp")).alias("start_us"), "n")
