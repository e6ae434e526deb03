"""More registered queries with their SQL: the store, audits, gates, retries, discovery, the queue, evaluation.

Fixed tables of cases (addresses, hosts) are stated with the answer that each must have.
"""

from __future__ import annotations

import uuid
import zlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provenant.operators import constraints, discovery, graph, ingest, jobs, metrics, planning, policy, responses, retrieval, temporal, verification, versions
from provenant.plans.catalogue import ATTEMPTS, BM25, HOSTS, OBS, QUERY_VECTOR, REFS, STREAKS, attempts, observations, query, table
from provenant.session import run_dir
from provenant.sources import captures, ledger, manifest

# --- sources and the store ------------------------------------------------------------------------------------


@query("""SELECT 'N-' || n_nationkey AS document_key, n_name AS title, 24 - row_number() OVER (ORDER BY n_nationkey) + 1 AS entry_index, '2026-01-' || lpad((n_nationkey % 28 + 1)::VARCHAR, 2, '0') AS listed,
 n_regionkey = 1 AS sampled, 'nations/N-' || n_nationkey AS candidate_key, 'url_status=OBSERVED' AS labels FROM nation""")
def manifest_candidates(spark, sf_dir):
    """The nations as the entries of a manifest, last first; reading puts them in order of their key."""
    lines = ["source_id: nations", "allowed_hosts: [docs.example]", "candidate_documents:"]
    for r in table(spark, sf_dir, "nation").orderBy(F.desc("n_nationkey")).collect():  # a table of 25 rows
        lines.append(f"- {{document_key: N-{r.n_nationkey}, tier: primary, title: {r.n_name!r}, document_type: circular, listing_date: 2026-01-{r.n_nationkey % 28 + 1:02d}, sampled: {str(r.n_regionkey == 1).lower()}, url_status: OBSERVED}}")
    read = manifest.parse_manifest("\n".join(lines).encode())
    labels = F.array_join(F.transform("status_labels", lambda x: F.concat_ws("=", x["field"], x["label"])), ",")
    return read.candidates_frame(spark).select("document_key", "title", F.col("entry_index").cast("long").alias("entry_index"), F.col("listing_date").cast("string").alias("listed"), "sampled", F.concat(F.lit(read.candidate_key("")), "document_key").alias("candidate_key"), labels.alias("labels"))


@F.pandas_udf(T.BinaryType())
def packed(bodies: pd.Series) -> pd.Series:
    return bodies.map(lambda b: zlib.compress(bytes(b)), na_action="ignore")


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 2 OR octet_length(encode(text)) > 20000 THEN NULL ELSE sha256(text) END AS hash,
 CASE WHEN doc_id % 3 = 2 THEN 'CONTENT_TYPE_MISMATCH' WHEN octet_length(encode(text)) > 20000 THEN 'SIZE_EXCEEDED' END AS problem FROM documents""")
def decoded_responses(spark, sf_dir):
    body, k = F.encode("text", "UTF-8"), F.col("doc_id") % 3
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(k == 0, "identity").when(k == 1, "deflate").otherwise("br").alias("encoding"), F.when(k == 1, packed(body)).otherwise(body).alias("wire"))
    return captures.decoded_bodies(rows, 20000).select("doc_id", "hash", "problem")


@query("SELECT doc_id, CASE WHEN doc_id % 3 <> 1 THEN sha256(text) END AS text_hash FROM documents")
def page_texts(spark, sf_dir):
    k = F.col("doc_id") % 3
    kind = F.when(k == 0, "text/html; charset=UTF-8").when(k != 1, "text/html").otherwise("text/html; charset=none-such")  # that of a row without id too
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(captures.html_text(F.encode("text", "UTF-8"), kind), 256).alias("text_hash"))


@query("SELECT doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM documents e WHERE e.lang = 'en' AND e.text = d.text)")
def stored_bodies(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("hash"))
    return ledger.stored(rows, rows.filter("lang = 'en'")).select("doc_id")


@query("""WITH o AS (SELECT url, sha256(html) AS h FROM pages WHERE page_id % 4 <> 0), n AS (SELECT url, CASE WHEN page_id % 4 = 2 THEN sha256(html || 'x') ELSE sha256(html) END AS h FROM pages WHERE page_id % 4 <> 1)
 SELECT coalesce(o.url, n.url) AS canonical_url, CASE WHEN o.url IS NULL THEN 'ADDED' WHEN n.url IS NULL THEN 'REMOVED' ELSE 'MODIFIED' END AS change FROM o FULL JOIN n ON o.url = n.url WHERE o.h IS NULL OR n.h IS NULL OR o.h <> n.h""")
def listing_changes(spark, sf_dir):
    pages, k = table(spark, sf_dir, "pages"), F.col("page_id") % 4
    old = pages.filter(k != 0).select(F.col("url").alias("canonical_url"), F.sha2("html", 256).alias("hash"))
    new = pages.filter(k != 1).select(F.col("url").alias("canonical_url"), F.sha2(F.when(k == 2, F.concat("html", F.lit("x"))).otherwise(F.col("html")), 256).alias("hash"))
    return ledger.listing_diff(old, new)


@query("""SELECT doc_id, sha256('{"lang":"' || lang || '","source":"' || source || '"}') AS id FROM documents""")
def natural_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", ledger.natural_id("lang", "source").alias("id"))


@query("""WITH i AS (SELECT event_id, lpad(lower(to_hex(epoch_us(ts) // 1000)), 12, '0') AS t, sha256('{"event_id":"' || event_id || '"}') AS h FROM events)
 SELECT event_id, substr(t, 1, 8) || '-' || substr(t, 9, 4) || '-7' || substr(h, 1, 3) || '-' || substr('89ab', (('0x' || substr(h, 4, 1))::INTEGER % 4) + 1, 1) || substr(h, 5, 3) || '-' || substr(h, 8, 12) AS id FROM i""")
def time_ordered_ids(spark, sf_dir):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", ledger.time_ordered_id(millis, "event_id").alias("id"))


@query("SELECT source AS doc, lang AS url, min(doc_id) AS first_seen, max(doc_id) AS last_seen FROM documents GROUP BY source, lang")
def locations_merged(spark, sf_dir):
    def half(k):
        rows = table(spark, sf_dir, "documents").filter(F.col("doc_id") % 2 == k)
        return rows.groupBy(F.col("source").alias("doc"), F.col("lang").alias("url")).agg(F.min("doc_id").alias("first_seen"), F.max("doc_id").alias("last_seen"))

    return versions.upsert_last_seen(half(0), half(1), ["doc", "url"])


def fresh_folder(spark) -> str:
    return f"{run_dir(spark)}/{uuid.uuid4().hex}"


@query("SELECT source AS doc, lang AS url, min(doc_id) AS seq FROM documents GROUP BY source, lang")
def ledger_appended(spark, sf_dir):
    """Two batches, the second with everything again, and once more as a retry: each key has one row."""
    rows, path = table(spark, sf_dir, "documents").select(F.col("source").alias("doc"), F.col("lang").alias("url"), F.col("doc_id").alias("seq")), fresh_folder(spark)
    ledger.append(spark, path, rows.filter("url = 'en'"), ["doc", "url"], 1, "seq")
    for _ in range(2):
        ledger.append(spark, path, rows, ["doc", "url"], 2, "seq")
    return ledger.read_table(spark, path, rows.schema)


@query(f"WITH {ATTEMPTS} SELECT seq, status, CASE WHEN status = 200 THEN 'OK' WHEN status = 429 OR status >= 500 THEN 'HTTP_TRANSIENT' ELSE 'HTTP_PERMANENT' END AS outcome FROM attempts")
def audit_appended(spark, sf_dir):
    rows = attempts(spark, sf_dir).select("seq", "status", responses.status_outcome(F.col("status")).alias("outcome"), F.lit("h").alias("hash"), F.lit(1).alias("attempt"), F.lit(0.5).alias("elapsed"))
    return ledger.append_audit(spark, fresh_folder(spark), rows, ["seq"], 1, constraints.incoherent_fetches(rows).select("seq")).select("seq", "status", "outcome")


@query("SELECT DISTINCT sha256(text) AS hash, substr(sha256(text), 1, 2) AS prefix, octet_length(encode(text)) AS size FROM documents")
def blobs_stored(spark, sf_dir):
    bodies, path = table(spark, sf_dir, "documents").select("lang", F.encode("text", "UTF-8").alias("body")), fresh_folder(spark)
    ledger.put_blobs(spark, path, bodies.filter("lang = 'en'").select("body"), 1)
    ledger.put_blobs(spark, path, bodies.select("body"), 2)
    return ledger.read_table(spark, path, ledger.BLOBS).select("hash", "prefix", F.octet_length("body").cast("long").alias("size"))


@query("SELECT DISTINCT sha256(d.text) AS hash FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic = 1")
def blobs_quarantined(spark, sf_dir):
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    bodies = table(spark, sf_dir, "documents").join(toxic, "doc_id").select(F.encode("text", "UTF-8").alias("body"))
    return ledger.put_quarantined(spark, fresh_folder(spark), fresh_folder(spark), bodies, 1).select("hash")


@query("""WITH a AS (SELECT n_nationkey AS version, n_name AS c FROM nation WHERE n_nationkey % 5 <> 0), f AS (SELECT n_nationkey AS version, CASE WHEN n_nationkey % 7 = 0 THEN 'x' ELSE n_name END AS c FROM nation WHERE n_nationkey % 6 <> 0)
 SELECT coalesce(a.version, f.version)::BIGINT AS version, CASE WHEN a.c IS NULL THEN 'PENDING' WHEN f.c IS NULL THEN 'MISSING' WHEN a.c <> f.c THEN 'CHANGED' ELSE 'APPLIED' END AS state FROM a FULL JOIN f ON a.version = f.version""")
def schema_drift(spark, sf_dir):
    n, k = table(spark, sf_dir, "nation"), F.col("n_nationkey")
    applied = n.filter(k % 5 != 0).select(k.cast("long").alias("version"), F.col("n_name").alias("checksum"))
    files = n.filter(k % 6 != 0).select(k.cast("long").alias("version"), F.when(k % 7 == 0, "x").otherwise(F.col("n_name")).alias("checksum"))
    return ledger.schema_drift(applied, files)


LOCATED = "SELECT doc_id AS version_id, source AS doc, 'https://docs.example/' || lang AS url, CASE WHEN n_chars % 3 <> 0 THEN 'e' || n_chars END AS etag, doc_id // 10 AS retrieved_at FROM documents"


@query(f"SELECT doc, url, etag, NULL::VARCHAR AS last_modified FROM (SELECT *, row_number() OVER (PARTITION BY doc, url ORDER BY retrieved_at DESC, version_id DESC) AS rn FROM ({LOCATED}) t) u WHERE rn = 1 AND etag IS NOT NULL")
def location_validators(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("url", F.concat(F.lit("https://docs.example/"), "lang"))
    etag = F.when(F.col("n_chars") % 3 != 0, F.concat(F.lit("e"), F.col("n_chars").cast("string")))
    located = d.select(F.col("doc_id").alias("version_id"), "url", F.create_map(F.lit("etag"), etag).alias("http_meta"))
    made = d.select(F.col("doc_id").alias("version_id"), F.col("source").alias("doc"), F.floor(F.col("doc_id") / 10).alias("retrieved_at"))
    return versions.validators(located, made, d.select(F.col("source").alias("doc"), "url").distinct())


# --- gates, limits, addresses ---------------------------------------------------------------------------------


@query("""SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus <> 'O' THEN 'INGESTION_NOT_AUTHORIZED' END, CASE WHEN o_orderpriority = '1-URGENT' THEN 'ACCESS_REVIEW_BLOCKED' END,
 CASE WHEN o_custkey % 3 = 0 THEN 'NO_REVIEWER' END, CASE WHEN o_orderkey % 5 = 0 THEN 'NO_REVIEW_TIME' END) AS reasons FROM orders""")
def gate_closed(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "O").alias("ingestion_authorized"), F.when(F.col("o_orderpriority") == "1-URGENT", "BLOCKED").otherwise("DONE").alias("review_status"),
        F.when(F.col("o_custkey") % 3 == 0, " ").otherwise("someone").alias("reviewed_by"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate")).alias("reviewed_at"),
    )
    return rows.select("o_orderkey", F.array_join(planning.gate_reasons(), ",").alias("reasons"))


@query("""SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus = 'F' THEN 'crawl.status' END, CASE WHEN o_custkey % 4 = 0 THEN 'min_delay' END, CASE WHEN o_orderkey % 7 = 0 THEN 'backoff_max' END,
 CASE WHEN o_orderkey % 7 < 1 + o_custkey % 5 THEN 'backoff_max < backoff_base' END) AS problems FROM orders""")
def limit_problems(spark, sf_dir):
    number = lambda c: c.cast("double")
    named = F.create_map(F.lit("backoff_base"), number(1 + F.col("o_custkey") % 5), F.lit("backoff_max"), number(F.col("o_orderkey") % 7))
    parameters = F.when(F.col("o_custkey") % 4 == 0, named).otherwise(F.map_concat(named, F.create_map(F.lit("min_delay"), F.lit(1.0))))
    status = F.when(F.col("o_orderstatus") == "F", "DRAFT").otherwise("CONFIGURED")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"), parameters.alias("parameters"))
    problems = planning.limit_problems(F.col("status"), F.col("parameters"), ["backoff_base", "backoff_max", "min_delay"])
    return rows.select("o_orderkey", F.array_join(problems, ",").alias("problems"))


# Addresses and whether they are public.
ADDRESSES = [
    ("8.8.8.8", True), ("1.1.1.1", True), ("93.184.216.34", True), ("2606:4700:4700::1111", True), ("2a00:1450:4001:81b::200e", True),
    ("10.0.0.1", False), ("172.16.5.4", False), ("192.168.1.1", False), ("127.0.0.1", False), ("0.0.0.0", False), ("169.254.169.254", False), ("100.64.0.1", False),
    ("192.0.0.1", False), ("192.0.2.1", False), ("198.18.0.1", False), ("198.51.100.1", False), ("203.0.113.1", False), ("224.0.0.1", False), ("240.0.0.1", False), ("255.255.255.255", False),
    ("::", False), ("::1", False), ("fe80::1", False), ("fc00::1", False), ("fd00:ec2::254", False), ("::ffff:8.8.8.8", False), ("::ffff:10.0.0.1", False), ("::8.8.8.8", False), ("::10.0.0.1", False),
    ("64:ff9b::808:808", False), ("64:ff9b:1::1", False), ("2002:808:808::1", False), ("2001:db8::1", False), ("2001::1", False), ("100::1", False), ("fec0::1", False), ("ff02::1", False), ("fe80::1%eth0", False),
    ("1.2.3", False), ("1.2.3.256", False), ("01.2.3.4", False), ("", False), ("no address", False),
]
ADDRESS_ROWS = "addresses(n, address, public) AS (VALUES " + ", ".join(f"({n}, '{a}', {str(p).lower()})" for n, (a, p) in enumerate(ADDRESSES)) + ")"


def one_of(cases, n):
    """The case that a row's number picks, from a short list of constants."""
    return F.get(F.array(*map(F.lit, cases)), (n % len(cases)).cast("int"))


@query(f"WITH {ADDRESS_ROWS} SELECT c_custkey, address, public FROM customer JOIN addresses ON n = c_custkey % {len(ADDRESSES)}")
def address_cases(spark, sf_dir):
    """Each customer has one of the addresses."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", one_of([a for a, _ in ADDRESSES], F.col("c_custkey")).alias("address"))
    return rows.select("c_custkey", "address", policy.public_address("address").alias("public"))


@query(f"WITH {ADDRESS_ROWS}, u AS (SELECT DISTINCT user_id FROM events) SELECT u.user_id, (CASE WHEN a.n = b.n THEN 1 ELSE 2 END)::BIGINT AS n_answers, a.public AND b.public AS public FROM u JOIN addresses a ON a.n = u.user_id % {len(ADDRESSES)} JOIN addresses b ON b.n = (u.user_id * 7 + 3) % {len(ADDRESSES)}")
def answer_sets(spark, sf_dir):
    """Two answers for every host, the first one twice: all must be public."""
    all_of = F.array(*(F.lit(a) for a, _ in ADDRESSES))
    pick = lambda n: F.get(all_of, (n % len(ADDRESSES)).cast("int"))
    rows = table(spark, sf_dir, "events").select("user_id").distinct()
    rows = rows.withColumn("answers", F.array(pick(F.col("user_id")), pick(F.col("user_id") * 7 + 3), pick(F.col("user_id"))))
    return rows.select("user_id", F.size(F.array_distinct("answers")).cast("long").alias("n_answers"), policy.answers_public(F.col("answers")).alias("public"))


# Hosts, whether they are written as an address, and their ASCII form.
HOST_CASES = [
    ("127.0.0.1", True, "127.0.0.1"), ("2130706433", True, "2130706433"), ("0x7f.1", True, "0x7f.1"), ("0177.0.0.1", True, "0177.0.0.1"), ("1.2.3", True, "1.2.3"), ("[::1]", True, "[::1]"),
    ("docs.example", False, "docs.example"), ("1.2.3.example", False, "1.2.3.example"), ("a0x7f", False, "a0x7f"), ("bücher.example", False, "xn--bcher-kva.example"), ("straße.example", False, "strasse.example"), ("1.2.3.4.5", False, "1.2.3.4.5"),
]


HOST_ROWS = "hosts(n, host, literal, ascii) AS (VALUES " + ", ".join(f"({n}, '{h}', {str(v).lower()}, '{a}')" for n, (h, v, a) in enumerate(HOST_CASES)) + ")"


@query(f"WITH {HOST_ROWS} SELECT page_id, host, literal, ascii FROM pages JOIN hosts ON n = page_id % {len(HOST_CASES)}")
def host_cases(spark, sf_dir):
    """Each page is said to come from one of the hosts."""
    rows = table(spark, sf_dir, "pages").select("page_id", one_of([h for h, *_ in HOST_CASES], F.col("page_id")).alias("host"))
    return rows.select("page_id", "host", policy.ip_literal(F.col("host")).alias("literal"), policy.ascii_host(F.col("host")).alias("ascii"))


@query("""WITH h AS (SELECT page_id, page_id % 5 AS k, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host FROM pages)
 SELECT page_id, CASE k WHEN 1 THEN 'xn--bcher-kva.' WHEN 2 THEN 'xn--e1afmkfd.' WHEN 3 THEN 'strasse.' ELSE '' END || CASE WHEN k = 4 THEN '' ELSE host END AS ascii FROM h""")
def hosts_ascii(spark, sf_dir):
    """The hosts of the pages as they are and under names in other letters; one label of 64 letters has no ASCII form."""
    host = policy.host_of(policy.url_parts(F.col("url"))["authority"])
    name = one_of(["", "bücher.", "пример.", "straße.", "é" * 64 + "."], F.col("page_id"))
    return table(spark, sf_dir, "pages").select("page_id", policy.ascii_host(F.concat(name, host)).alias("ascii"))


@query("SELECT doc_id, CASE doc_id % 6 WHEN 1 THEN 'MAGIC_BYTES_MISMATCH' WHEN 2 THEN 'PDF_SANITY_FAILED' WHEN 3 THEN 'PDF_SANITY_FAILED' WHEN 5 THEN 'CONTENT_TYPE_MISMATCH' END AS reason FROM documents")
def pdf_rejections(spark, sf_dir):
    """Documents as bodies of PDF files: whole, without the first or the last mark, active, only seemingly so, mistyped."""
    k = F.col("doc_id") % 6
    head, tail = F.when(k == 1, "PDF ").otherwise("%PDF-1.4 "), F.when(k == 2, " end").otherwise(" %%EOF")
    middle = F.when(k == 3, "/JavaScript ").when(k == 4, "/JavaScripts ").otherwise(" ")
    body = F.encode(F.concat(head, F.sha2("text", 256), middle, tail), "UTF-8")
    kind = F.when(k == 5, "text/html").otherwise("application/pdf; x=1")
    rows = table(spark, sf_dir, "documents").select("doc_id", kind.alias("kind"), body.alias("body"))
    return rows.select("doc_id", responses.rejection(F.col("kind"), F.col("body"), F.lit("ATTACHMENT"), 4096, 64).alias("reason"))


@query("""SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'HTTP_PERMANENT' WHEN doc_id % 7 <> 1 AND n_chars > 5000 THEN 'SIZE_EXCEEDED' WHEN n_chars > 5000 THEN 'SIZE_EXCEEDED'
 WHEN n_chars / (1 + doc_id % 900) > 20 THEN 'SIZE_EXCEEDED' WHEN doc_id % 7 <> 1 AND 1 + doc_id % 900 < n_chars THEN 'PDF_SANITY_FAILED' END AS reason FROM documents""")
def size_guards(spark, sf_dir):
    declared = F.when(F.col("doc_id") % 7 == 0, "1e3").when(F.col("doc_id") % 7 != 1, F.col("n_chars").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", responses.size_problem(declared, F.col("n_chars"), 1 + F.col("doc_id") % 900, 5000, 20.0).alias("reason"))


@query("SELECT doc_id, 'content-type=' || lang || ',etag=' || source || '\\x0a' AS logged FROM documents")
def headers_logged(spark, sf_dir):
    headers = F.create_map(F.lit("ETag"), F.concat("source", F.lit("\n")), F.lit("Set-Cookie"), F.lit("s"), F.lit("Content-Type"), F.col("lang"))
    shown = F.transform(F.map_entries(policy.safe_headers(headers)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(shown, ",").alias("logged"))


@query("SELECT doc_id FROM documents WHERE doc_id % 6 = 0")
def headers_unlogged(spark, sf_dir):
    plain = F.create_map(F.lit("etag"), F.col("source"))
    headers = F.when(F.col("doc_id") % 6 == 0, F.create_map(F.lit("etag"), F.col("source"), F.lit("cookie"), F.lit("x"))).otherwise(plain)
    return constraints.unlogged_headers(table(spark, sf_dir, "documents").select("doc_id", headers.alias("headers")), policy.LOGGED_HEADERS).select("doc_id")


@query("SELECT event_id, CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'SCHEME_NOT_HTTPS' WHEN event_type = 'error' AND event_id % 3 = 1 THEN 'HOST_NOT_ALLOWED' WHEN event_type = 'error' THEN 'REDIRECT_OFF_ALLOWLIST' END AS reason FROM events")
def redirect_reasons(spark, sf_dir):
    k = F.col("event_id") % 3
    reason = F.when(F.col("event_type") == "error", F.when(k == 0, policy.SCHEME).otherwise(policy.HOST))
    return table(spark, sf_dir, "events").select("event_id", policy.redirect_reason(reason, F.when(k == 1, 0).otherwise(2)).alias("reason"))


@query("SELECT user_id, CASE WHEN count(DISTINCT event_type) < count(*) THEN 'REDIRECT_LOOP' WHEN count(*) > 4 THEN 'TOO_MANY_REDIRECTS' END AS problem FROM (SELECT user_id, event_id, event_type FROM events) t GROUP BY user_id")
def redirect_problems(spark, sf_dir):
    """A user's event types in order as the hops of one captured chain."""
    chain = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: x["event_type"])
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(chain.alias("chain"))
    return rows.select("user_id", responses.redirect_problem(F.col("chain"), 3).alias("problem"))


@query("""SELECT event_id, round(greatest((user_id % 10) / 10.0 * least(60.0, 1.5 * pow(2.0, event_id % 6)), 2.0, CASE WHEN event_id % 4 = 0 THEN event_id % 50 ELSE 0 END), 6) AS seconds FROM events""")
def backoff_waits(spark, sf_dir):
    after = F.when(F.col("event_id") % 4 == 0, (F.col("event_id") % 50).cast("double"))
    return table(spark, sf_dir, "events").select("event_id", F.round(responses.backoff_seconds(F.col("event_id") % 6 + 1, F.col("user_id") % 10 / 10, 1.5, 60, 2, after), 6).alias("seconds"))


@query(f"WITH {ATTEMPTS}, n AS (SELECT seq, run, row_number() OVER (PARTITION BY run, candidate ORDER BY seq) AS attempt FROM attempts) SELECT seq, attempt FROM n WHERE (attempt - 1) * 3 < 20")
def attempts_in_time(spark, sf_dir):
    rows = responses.attempt_numbers(attempts(spark, sf_dir)).withColumns({"elapsed": F.lit(1.0), "wait": F.lit(2.0)})
    return responses.within_deadline(rows, 20.0).select("seq", "attempt")


# --- constraints over snapshots -------------------------------------------------------------------------------


@query("SELECT doc_id, source FROM documents EXCEPT ALL SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'x' ELSE source END FROM documents WHERE doc_id % 9 <> 0")
def rows_lost(spark, sf_dir):
    old = table(spark, sf_dir, "documents").select("doc_id", "source")
    new = old.filter("doc_id % 9 <> 0").withColumn("source", F.when(F.col("doc_id") % 10 == 0, "x").otherwise(F.col("source")))
    return constraints.not_appended(old, new)


@query("SELECT doc_id AS version_id, lang AS url FROM documents WHERE n_chars % 11 = 0 OR n_chars % 10 < 5 OR n_chars % 7 = 0")
def location_changes(spark, sf_dir):
    d, n = table(spark, sf_dir, "documents"), F.col("n_chars")
    key = [F.col("doc_id").alias("version_id"), F.col("lang").alias("url")]
    old = d.select(*key, F.col("doc_id").alias("first_seen"), (F.col("doc_id") + 5).alias("last_seen"))
    new = d.filter(n % 11 != 0).select(*key, F.when(n % 7 == 0, F.col("doc_id") + 1).otherwise(F.col("doc_id")).alias("first_seen"), (F.col("doc_id") + n % 10).alias("last_seen"))
    return constraints.location_changes(old, new)


@query("""WITH f AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'OK' WHEN 'click' THEN 'NOT_MODIFIED' WHEN 'error' THEN 'URL_REJECTED' ELSE 'HTTP_TRANSIENT' END AS outcome, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 200 ELSE 304 END AS status,
 CASE WHEN event_id % 3 <> 0 THEN 'h' END AS hash, event_id % 4 AS attempt FROM events)
 SELECT event_id FROM f WHERE (outcome = 'OK' AND (status IS NULL OR status <> 200 OR hash IS NULL)) OR (outcome = 'NOT_MODIFIED' AND (status IS NULL OR status <> 304)) OR (outcome = 'URL_REJECTED' AND status IS NOT NULL) OR attempt < 1""")
def fetches_incoherent(spark, sf_dir):
    kind, k = F.col("event_type"), F.col("event_id")
    rows = table(spark, sf_dir, "events").select(
        k, F.when(kind == "view", "OK").when(kind == "click", "NOT_MODIFIED").when(kind == "error", "URL_REJECTED").otherwise("HTTP_TRANSIENT").alias("outcome"),
        F.when(k % 5 != 0, F.when(k % 2 == 0, 200).otherwise(304)).alias("status"), F.when(k % 3 != 0, "h").alias("hash"), (k % 4).alias("attempt"), F.col("value").alias("elapsed"),
    )
    return constraints.incoherent_fetches(rows).select("event_id")


@query("SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'P') <> (o_custkey % 2 = 0)")
def results_incoherent(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "QUARANTINED").otherwise("NEW_VERSION").alias("outcome"), F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey")).alias("quarantine_id"))
    return constraints.incoherent_results(rows).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'O') <> (o_custkey % 2 = 0)")
def jobs_incoherent(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("QUEUED").alias("state"), F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey")).alias("locked_by"))
    return constraints.incoherent_jobs(rows).select("o_orderkey")


@query(f"WITH {OBS} SELECT seq FROM obs WHERE hash IS NOT NULL AND seq % 8 = 0")
def blobs_corrupt(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.sha2("text", 256).alias("hash"), F.encode(F.when(F.col("doc_id") % 8 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")), "UTF-8").alias("body"))
    return constraints.corrupt_blobs(rows).join(observations(spark, sf_dir).filter("hash is not null").select("seq"), "seq", "left_semi").select("seq")


# --- discovery behind viewers ---------------------------------------------------------------------------------

ESCAPES = [("%", "%25"), ("&", "%26"), ("#", "%23"), ("+", "%2B"), (":", "%3A"), ("/", "%2F"), ("?", "%3F"), ("=", "%3D")]


def escaped(column):
    for a, b in ESCAPES:
        column = F.replace(column, F.lit(a), F.lit(b))
    return column


@query("""SELECT page_id, CASE WHEN page_id % 6 IN (0, 4) THEN url END AS embedded, CASE page_id % 6 WHEN 1 THEN 'VIEWER_FILE_REPEATED' WHEN 2 THEN 'VIEWER_FILE_MISSING' WHEN 3 THEN 'MALFORMED_PERCENT_ENCODING' WHEN 5 THEN 'MALFORMED_PERCENT_ENCODING' END AS problem FROM pages""")
def viewer_urls(spark, sf_dir):
    k, file = F.col("page_id") % 6, escaped(F.col("url"))
    tail = F.when(k == 0, F.concat(F.lit("file="), file)).when(k == 1, "file=a&x=1&file=b").when(k == 2, "x=1&file=").when(k == 3, "file=%zz").when(k == 4, F.concat(F.lit("a=%20&fil%65="), file, F.lit("&b#c"))).otherwise("file=a%ff")
    rows = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("https://h.example/web/?"), tail).alias("viewer"))
    inner, problem = discovery.embedded(F.col("viewer"))
    return rows.select("page_id", inner.alias("embedded"), problem.alias("problem"))


def viewer_pages(spark, sf_dir):
    """The pages, said to lie at one URL, and behind their own links a direct link, one behind a viewer, two that differ, a
    viewer in a viewer, or none."""
    host, k = f"https://{HOSTS[0]}", F.col("page_id") % 5
    inner = f"https%3A%2F%2F{HOSTS[0]}%2Fen%2Fa.pdf"
    more = (
        F.when(k == 0, '<a href="/en/a.pdf">a</a><a href="https://other.example/en/a.pdf">no</a>')
        .when(k == 1, f'<iframe src="/web/?file={inner}"></iframe><a href="/en/a.pdf#page=2">a</a>')
        .when(k == 2, f'<a href="/web/?file={inner}">a</a><a href="/en/b.pdf">b</a>')
        .when(k == 3, f'<a href="/web/?file=https%3A%2F%2F{HOSTS[0]}%2Fweb%2F%3Ffile%3Da">a</a>')
        .otherwise("<p>none</p>")
    )
    return table(spark, sf_dir, "pages").select("page_id", F.lit(host + "/en/page").alias("url"), F.concat("html", more).alias("html"))


def viewer_attachments(spark, sf_dir):
    pages = viewer_pages(spark, sf_dir)
    judged = discovery.judged_references(discovery.page_references(pages), lambda url: policy.url_reason(url, HOSTS, ["/en/"], 200))
    return pages, judged, discovery.attachments(pages, judged)


# The pages' own links by the policy, and what the added ones come to.
VIEWED = f"""{REFS}, own AS (SELECT page_id, pos, CASE WHEN raw LIKE 'http%' THEN raw ELSE 'https://{HOSTS[0]}' || raw END AS resolved FROM refs),
 cut AS (SELECT *, regexp_extract(resolved, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS authority, regexp_extract(resolved, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(resolved, '^[^?#]*\\?([^#]*)', 1) AS query FROM own),
 judged AS (SELECT page_id, pos, regexp_replace(resolved, '#.*$', '') AS target, CASE WHEN length(resolved) > 200 OR regexp_matches(resolved, '[\\x00-\\x20\\x7f-\\x9f\\\\]') THEN 'MANIFEST_SCOPE_MISMATCH' WHEN NOT starts_with(lower(resolved), 'https://') THEN 'SCHEME_NOT_HTTPS'
 WHEN authority LIKE '%@%' OR lower(authority) NOT IN ('{"', '".join(HOSTS)}') THEN 'HOST_NOT_ALLOWED' WHEN regexp_matches(path, '[^\\x00-\\x7f]') OR path LIKE '%//%' OR regexp_matches(path, '(^|/)\\.\\.?(/|$)') OR NOT starts_with(path, '/en/') OR query <> '' THEN 'MANIFEST_SCOPE_MISMATCH' END AS reason FROM cut),
 n AS (SELECT p.page_id, p.page_id % 5 AS k, count(j.pos) AS n_own FROM pages p LEFT JOIN judged j ON p.page_id = j.page_id GROUP BY 1, 2),
 fit AS (SELECT page_id, target FROM judged WHERE reason IS NULL UNION SELECT page_id, 'https://{HOSTS[0]}/en/a.pdf' FROM n WHERE k < 3 UNION SELECT page_id, 'https://{HOSTS[0]}/en/b.pdf' FROM n WHERE k = 2),
 found AS (SELECT n.page_id, n_own + CASE k WHEN 3 THEN 1 WHEN 4 THEN 0 ELSE 2 END AS n_observed, count(fit.target) AS n_candidates, CASE WHEN count(fit.target) = 1 THEN min(fit.target) END AS attachment FROM n LEFT JOIN fit ON n.page_id = fit.page_id GROUP BY n.page_id, n_own, k)"""


@query(f"WITH {VIEWED} SELECT page_id, n_observed::BIGINT AS n_observed, n_candidates, CASE n_candidates WHEN 0 THEN 'UNRESOLVED' WHEN 1 THEN 'DISCOVERED' ELSE 'AMBIGUOUS' END AS status, attachment FROM found")
def wrapped_discovery(spark, sf_dir):
    return viewer_attachments(spark, sf_dir)[2]


@query(f"""WITH {VIEWED} SELECT page_id, pos, reason, false AS via_viewer FROM judged WHERE reason IS NOT NULL
 UNION ALL SELECT page_id, n_own + CASE k WHEN 0 THEN 1 ELSE 0 END, CASE k WHEN 0 THEN 'HOST_NOT_ALLOWED' ELSE 'VIEWER_WRAPPER_URL' END, k = 3 FROM n WHERE k IN (0, 3)""")
def rejected_references(spark, sf_dir):
    return viewer_attachments(spark, sf_dir)[1].filter("reason is not null").select("page_id", "pos", "reason", "via_viewer")


@query(f"""WITH {VIEWED}, r AS (SELECT page_id, attachment, CASE page_id % 7 WHEN 0 THEN 'NO_RESPONSE' WHEN 1 THEN 'HTTP_PERMANENT' WHEN 2 THEN 'HTTP_TRANSIENT' WHEN 3 THEN 'SIZE_EXCEEDED' WHEN 4 THEN 'DETAIL_PAGE_UNDECODABLE'
 ELSE CASE WHEN n_candidates > 1 THEN 'AMBIGUOUS_ATTACHMENT_REFERENCES' WHEN n_candidates = 0 THEN 'NO_VALID_ATTACHMENT_REFERENCES' END END AS reason FROM found)
 SELECT page_id AS document_key, CASE WHEN reason IS NULL THEN attachment END AS document_url, CASE WHEN reason IN ('NO_RESPONSE', 'HTTP_TRANSIENT') THEN 'FAILED_TRANSIENT' WHEN reason = 'HTTP_PERMANENT' THEN 'FAILED_PERMANENT'
 WHEN reason = 'SIZE_EXCEEDED' THEN 'QUARANTINED' WHEN reason IS NOT NULL THEN 'UNRESOLVED' END AS outcome, reason FROM r""")
def detail_pages(spark, sf_dir):
    pages, _, found = viewer_attachments(spark, sf_dir)
    s = F.col("page_id") % 7
    captured = pages.filter(s != 0).select("page_id", F.when(s == 1, 304).when(s == 2, 503).otherwise(200).alias("status"), F.when(s == 3, "SIZE_EXCEEDED").alias("rejected"), F.when(s != 4, F.col("html")).alias("text"))
    return ingest.detail_outcomes(pages.select(F.col("page_id").alias("document_key"), "page_id"), found, captured)


@query(f"WITH {REFS} SELECT page_id, string_agg(raw, ' ' ORDER BY pos) AS shown, count(*) AS n_shown FROM refs WHERE pos < 10 GROUP BY page_id")
def discovery_audit(spark, sf_dir):
    refs = discovery.page_references(table(spark, sf_dir, "pages")).groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "raw"))), lambda r: r["raw"]).alias("raws"))
    shown = discovery.bounded_audit(F.col("raws"))
    return refs.select("page_id", F.array_join(shown, " ").alias("shown"), F.size(shown).cast("long").alias("n_shown"))


# --- runs and the queue ---------------------------------------------------------------------------------------


@query(f"""WITH {STREAKS}, r AS (SELECT a.run, a.seq, t.tripped_at, CASE WHEN a.seq = t.tripped_at THEN 'FAILED_TRANSIENT' WHEN status = 200 THEN 'NEW_VERSION' WHEN status = 429 OR status >= 500 THEN 'FAILED_TRANSIENT' ELSE 'FAILED_PERMANENT' END AS outcome
 FROM attempts a LEFT JOIN trips t ON a.run = t.run WHERE t.tripped_at IS NULL OR a.seq <= t.tripped_at)
 SELECT run, CASE WHEN max(tripped_at) IS NOT NULL THEN 'ABORTED' WHEN bool_or(outcome <> 'NEW_VERSION') THEN 'COMPLETED_WITH_FAILURES' ELSE 'COMPLETED' END AS status, CASE WHEN max(tripped_at) IS NOT NULL THEN 'CIRCUIT_OPEN' END AS abort_reason, count(*) AS processed FROM r GROUP BY run""")
def run_outcome(spark, sf_dir):
    """Every attempt is a candidate of its run; a run ends with the one at which its breaker opens."""
    rows = attempts(spark, sf_dir).withColumn("document_key", F.col("seq"))
    status = responses.status_outcome(F.col("status"))
    outcome = F.when(status == "OK", "NEW_VERSION").when(status == "HTTP_TRANSIENT", "FAILED_TRANSIENT").otherwise("FAILED_PERMANENT")
    results = rows.select("run", "document_key", F.col("seq").alias("position"), outcome.alias("outcome"), F.when(status != "OK", status).alias("reason"))
    return ingest.run_outcomes(ingest.until_trip(results, rows.select("run", "document_key", "seq", "status"), TRIP))


TRIP = 4


@query("""WITH e AS (SELECT user_id AS run_id, event_id AS seq, CASE event_type WHEN 'signup' THEN 'RUNNING' WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'ABORTED' END AS status FROM events), s AS (SELECT run_id, min(seq) AS begun FROM e WHERE status = 'RUNNING' GROUP BY run_id),
 f AS (SELECT e.run_id, e.status, row_number() OVER (PARTITION BY e.run_id ORDER BY e.seq) AS rn FROM e JOIN s ON e.run_id = s.run_id WHERE e.status <> 'RUNNING' AND e.seq > s.begun) SELECT s.run_id, coalesce(f.status, 'RUNNING') AS status FROM s LEFT JOIN f ON s.run_id = f.run_id AND f.rn = 1""")
def runs_finished(spark, sf_dir):
    kind = F.col("event_type")
    status = F.when(kind == "signup", "RUNNING").when(kind == "purchase", "COMPLETED").when(kind == "error", "ABORTED")
    return ingest.finished_runs(table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"), status.alias("status")))


@query(f"WITH {ATTEMPTS} SELECT seq AS fetch_request_id, status FROM attempts WHERE run = 7")
def fetch_log(spark, sf_dir):
    rows = attempts(spark, sf_dir).select("run", F.col("start").alias("retrieved_at"), F.col("candidate").alias("candidate_key"), F.lit(1).alias("attempt"), F.col("seq").alias("fetch_request_id"), "status")
    return ingest.fetch_requests(rows, 7).select("fetch_request_id", "status")


JSON_TEXT = """list_transform(string_split(text, ''), lambda c: CASE WHEN c = '"' THEN '\\"' WHEN c = '\\' THEN '\\\\' WHEN c = chr(10) THEN '\\n' WHEN c = chr(13) THEN '\\r' WHEN c = chr(9) THEN '\\t' WHEN unicode(c) < 32 OR unicode(c) > 126 THEN '\\u' || lpad(lower(to_hex(unicode(c))), 4, '0') ELSE c END)"""


@query(f"""SELECT conv_id, turn, sha256('{{"kind":"' || role || '","params":{{"conv":"' || conv_id || '","text":"' || array_to_string({JSON_TEXT}, '') || '"}}}}') AS key FROM conversations""")
def idempotency_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("conv", F.col("conv_id").cast("string"))
    return rows.select("conv_id", "turn", jobs.idempotency_key(F.col("role"), ["text", "conv"]).alias("key"))


@query("SELECT min(doc_id) AS job_id, source AS idempotency_key FROM documents d WHERE NOT EXISTS (SELECT 1 FROM documents e WHERE e.source = d.source AND e.n_chars > 20000) GROUP BY source")
def jobs_enqueued(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    fresh = d.select(F.col("doc_id").alias("job_id"), F.col("source").alias("idempotency_key"), F.lit(0).alias("created_at"))
    return jobs.enqueue(fresh, d.filter("n_chars > 20000").select(F.col("source").alias("idempotency_key"))).select("job_id", "idempotency_key")


def queued(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("job_id"), F.when(F.col("o_orderstatus") == "O", "QUEUED").otherwise("RUNNING").alias("state"), F.col("o_orderdate").alias("run_after"), F.col("o_custkey").alias("created_at"),
        (F.col("o_orderkey") % 4).alias("attempts"), F.lit(3).alias("max_attempts"), (F.col("o_custkey") % 3).alias("locked_by"),
    )


@query("SELECT o_orderkey AS job_id, 'RUNNING' AS state, 'w' AS locked_by, o_orderkey % 4 + 1 AS attempts FROM orders WHERE o_orderstatus = 'O' AND o_orderdate <= DATE '1996-06-01' ORDER BY o_orderdate, o_custkey, o_orderkey LIMIT 20")
def jobs_claimed(spark, sf_dir):
    return jobs.claimed(queued(spark, sf_dir), F.lit("1996-06-01").cast("timestamp_ntz"), "w", 20).select("job_id", "state", "locked_by", "attempts")


@query("""SELECT o_orderkey AS job_id, CASE WHEN again THEN 'QUEUED' ELSE 'FAILED' END AS state, attempts, length(error)::BIGINT AS n_error, CASE WHEN again THEN 'RETRY_SCHEDULED' ELSE 'FAILED' END AS event, CASE WHEN again THEN DATE '2000-01-01' ELSE o_orderdate::DATE END::VARCHAR AS run_day
 FROM (SELECT *, o_orderkey % 4 AS attempts, repeat('e', 500) AS error, o_orderkey % 5 <> 0 AND o_orderkey % 4 < 3 AS again FROM orders WHERE o_orderstatus <> 'O' AND o_custkey % 3 = 1) t""")
def jobs_failed(spark, sf_dir):
    rows = queued(spark, sf_dir)
    failures = rows.select("job_id", F.lit(1).alias("worker"), F.repeat(F.lit("e"), F.lit(700)).alias("error"), F.when(F.col("job_id") % 5 != 0, F.lit("2000-01-01").cast("timestamp_ntz")).alias("retry_at"))
    out = jobs.failed(rows, failures)
    return out.select("job_id", "state", "attempts", F.length("last_error").cast("long").alias("n_error"), "event", F.col("run_after").cast("date").cast("string").alias("run_day"))


@query("""WITH e AS (SELECT user_id, event_id, event_type, event_id % 3 AS worker FROM events WHERE event_type IN ('view', 'purchase')), l AS (SELECT *, last_value(CASE WHEN event_type = 'view' THEN worker END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS locker FROM e)
 SELECT user_id AS job_id, event_id AS seq, worker FROM l WHERE event_type = 'purchase' AND worker = locker""")
def jobs_completed(spark, sf_dir):
    rows = table(spark, sf_dir, "events").filter("event_type in ('view', 'purchase')")
    rows = rows.select(F.col("user_id").alias("job_id"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "view", "CLAIMED").otherwise("SUCCEEDED").alias("kind"), (F.col("event_id") % 3).alias("worker"))
    return jobs.completed_by_locker(rows).select("job_id", "seq", "worker")


# --- time, graph, retrieval, evaluation -----------------------------------------------------------------------


@query("""WITH v AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate::DATE END AS f, CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate::DATE + 300 END AS e, CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate::DATE + 200 END AS w, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE + 250 END AS s,
 o_orderkey % 2 = 0 AS p, CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate::DATE + 100 END AS a, o_orderkey % 11 = 0 AS c, DATE '1997-06-01' AS x FROM orders), t AS (SELECT *, CASE WHEN NOT p THEN s END AS sw, least(e, w, CASE WHEN NOT p THEN s END) AS stop FROM v)
 SELECT o_orderkey, CASE WHEN f IS NULL THEN 'UNKNOWN_EFFECTIVE_DATE' WHEN f > x THEN 'ISSUED_NOT_EFFECTIVE' WHEN stop <= x AND stop = w THEN 'WITHDRAWN' WHEN stop <= x AND stop = sw THEN 'SUPERSEDED' WHEN stop <= x THEN 'EXPIRED' WHEN c THEN 'CONFLICTED'
 WHEN p AND s <= x THEN 'PARTIALLY_SUPERSEDED' WHEN a <= x THEN 'IN_FORCE_AMENDED' ELSE 'IN_FORCE' END AS state FROM t""")
def temporal_states(spark, sf_dir):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    after = lambda n, days: F.when(k % n == 0, F.date_add(day, days))
    state = temporal.resolved_state(F.lit("1997-06-01").cast("date"), F.when(k % 9 != 0, day), after(4, 300), after(5, 200), after(3, 250), k % 2 == 0, after(7, 100), k % 11 == 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", state.alias("state"))


@query("SELECT e.event_id, o.event_id AS version FROM events e JOIN events o ON e.user_id = o.user_id AND o.event_type = 'signup' AND o.event_id <= e.event_id AND (o.event_id % 4 = 0 OR e.event_id < o.event_id + 2000) WHERE e.event_type = 'purchase'")
def versions_applicable(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    intervals = e.filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("version"), F.col("event_id").alias("start"), F.when(F.col("event_id") % 4 != 0, F.col("event_id") + 2000).alias("end"))
    return temporal.applicable(intervals, e.filter("event_type = 'purchase'").select("user_id", "event_id", F.col("event_id").alias("at")), ["user_id"]).select("event_id", "version")


@query("""WITH f AS (SELECT DISTINCT l_orderkey AS root, l_linenumber::BIGINT AS depth, l_partkey AS node, l_returnflag = 'R' AS cut FROM lineitem), n AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY depth, node) AS rn, bool_or(cut) OVER (PARTITION BY root) OR count(*) OVER (PARTITION BY root) > 4 AS truncated FROM f)
 SELECT root, node, depth, truncated FROM n WHERE rn <= 4""")
def traversal_cap(spark, sf_dir):
    found = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("root"), F.col("l_partkey").alias("node"), F.col("l_linenumber").cast("long").alias("depth"), (F.col("l_returnflag") == "R").alias("truncated")).distinct()
    return graph.bounded(found, 4)


@query("SELECT d.doc_id FROM documents d WHERE lang = 'en' AND n_chars BETWEEN 200 AND 2000 AND EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def hard_filters(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("version_id", F.col("doc_id"))
    good = table(spark, sf_dir, "labels").filter("quality = 1").select(F.col("doc_id").alias("version_id"))
    return verification.hard_filtered(docs, good, lang="en", n_chars=(200, 2000)).select("doc_id")


IDENTIFIERS = "unnest(list_distinct(list_transform(regexp_extract_all({0}, '\\b[A-Za-z][A-Za-z0-9]*(?:[-/][A-Za-z0-9]+)*[-/][0-9]+\\b'), lambda x: upper(x))))"
NUMBERED = "{0} || ' see circ-a' || {1} % 7 || '/' || {1} % 20 || ', x-' || {1} % 50 || '; no 12 or y-'"


@query(f"""WITH q AS (SELECT item_id, {IDENTIFIERS.format(NUMBERED.format("text", "item_id"))} AS identifier FROM benchmark), d AS (SELECT doc_id, {IDENTIFIERS.format(NUMBERED.format("text", "doc_id"))} AS identifier FROM documents)
 SELECT item_id, doc_id, count(*) AS score FROM q JOIN d ON q.identifier = d.identifier GROUP BY item_id, doc_id""")
def identifier_lists(spark, sf_dir):
    """Identifiers of queries and documents: those of their texts, and numbers of circulars put behind these, in either case."""
    name = lambda key: F.concat(F.lit("see circ-a"), (key % 7).cast("string"), F.lit("/"), (key % 20).cast("string"), F.lit(", x-"), (key % 50).cast("string"), F.lit("; no 12 or y-"))
    queries = table(spark, sf_dir, "benchmark").select("item_id", F.concat_ws(" ", "text", name(F.col("item_id"))).alias("text"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(" ", "text", F.upper(name(F.col("doc_id")))).alias("text"))
    return retrieval.identifier_hits(docs, queries, retrieval.identifiers)


SEARCH = f"""fdocs AS (SELECT d.* FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic = 0), one AS (SELECT item_id, text FROM benchmark WHERE item_id = (SELECT min(item_id) FROM benchmark)),
 {BM25.replace("FROM documents", "FROM fdocs").replace("FROM benchmark", "FROM one")}, vec AS (SELECT item_id, vec_id AS doc_id, row_number() OVER (PARTITION BY item_id ORDER BY round(list_cosine_similarity(embedding::DOUBLE[], {QUERY_VECTOR}::DOUBLE[]), 6) DESC, vec_id) AS rank
 FROM embeddings JOIN one ON true WHERE vec_id IN (SELECT doc_id FROM fdocs)),
 fu AS (SELECT item_id, doc_id, round(sum(1.0 / (60 + rank))::DOUBLE, 6) AS score FROM (SELECT item_id, doc_id, rank FROM lex WHERE rank <= 50 UNION ALL SELECT item_id, doc_id, rank FROM vec WHERE rank <= 50) t GROUP BY item_id, doc_id),
 fr AS (SELECT f.item_id, f.doc_id, d.source, row_number() OVER (PARTITION BY f.item_id ORDER BY f.score DESC, f.doc_id) AS rank FROM fu f JOIN fdocs d ON f.doc_id = d.doc_id), oc AS (SELECT *, row_number() OVER (PARTITION BY item_id, source ORDER BY rank) AS own FROM fr)"""


@query(f"WITH {SEARCH} SELECT item_id, doc_id, source, rank, position FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY rank) AS position FROM oc WHERE own <= 3) t WHERE position <= 8")
def search_one(spark, sf_dir):
    """One question over documents that passed the filter; the benchmark's texts name no identifier, so that list is empty."""
    clean = table(spark, sf_dir, "labels").filter("toxic = 0").select("doc_id")
    docs = table(spark, sf_dir, "documents").join(clean, "doc_id").select("doc_id", "text", "source")
    questions = table(spark, sf_dir, "benchmark")
    first = questions.join(F.broadcast(questions.agg(F.min("item_id").alias("item_id"))), "item_id").select("item_id", "text")
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id")
    return retrieval.search(docs, vectors, first, QUERY_VECTOR)


@query("""WITH p AS (SELECT n_name, r_name, '  ' || lower(n_name) || ' ' AS a, '  ' || lower(r_name) || ' ' AS b FROM nation JOIN region ON n_regionkey = r_regionkey),
 t AS (SELECT n_name, r_name, list_distinct(list_transform(range(1, length(a) - 1), lambda i: substr(a, i, 3))) AS x, list_distinct(list_transform(range(1, length(b) - 1), lambda i: substr(b, i, 3))) AS y FROM p)
 SELECT n_name, r_name, round(len(list_intersect(x, y)) / (len(x) + len(y) - len(list_intersect(x, y))), 6) AS similarity FROM t""")
def name_similarity(spark, sf_dir):
    pairs = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # five rows
    return pairs.select("n_name", "r_name", F.round(retrieval.trigram_similarity(F.col("n_name"), F.col("r_name")), 6).alias("similarity"))


@query("SELECT doc_id, sha256(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f\\x{200b}-\\x{200f}\\x{202a}-\\x{202e}\\x{2060}-\\x{2064}\\x{feff}]', '', 'g') || lang) AS shown FROM documents")
def visible_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(retrieval.visible(F.concat("text", F.lit("\u200b\x07"), "lang")), 256).alias("shown"))


@query("SELECT sha256(text) AS hash, count(*) AS n, string_agg(DISTINCT source, ',' ORDER BY source) AS appears_in FROM documents GROUP BY sha256(text)")
def appears_in_versions(spark, sf_dir):
    out = retrieval.appears_in(table(spark, sf_dir, "documents"), "source")
    return out.select("hash", "n", F.array_join("appears_in", ",").alias("appears_in"))


STATES = ("CONTRADICTED", "INSUFFICIENT_EVIDENCE", "TEMPORALLY_AMBIGUOUS", "PARTIALLY_SUPPORTED", "SUPPORTED")
STATE_LIST = "[" + ", ".join(f"'{s}'" for s in STATES) + "]"


@query(f"SELECT doc_id, {STATE_LIST}[least(doc_id % 5, n_chars % 5) + 1] AS state FROM documents")
def verdicts_lowered(spark, sf_dir):
    pick = lambda n: F.get(F.array(*map(F.lit, STATES)), (n % 5).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", verification.lowered(pick(F.col("doc_id")), pick(F.col("n_chars"))).alias("state"))


@query("SELECT lang AS answer_id, CASE WHEN count(*) FILTER (WHERE doc_id % 5 = 4) = count(*) THEN 'ANSWERED' WHEN count(*) FILTER (WHERE doc_id % 5 >= 3) > 0 THEN 'PARTIALLY_ANSWERED' ELSE 'ABSTAINED' END AS disposition FROM documents GROUP BY lang")
def answer_dispositions(spark, sf_dir):
    pick = F.get(F.array(*map(F.lit, STATES)), (F.col("doc_id") % 5).cast("int"))
    return verification.dispositions(table(spark, sf_dir, "documents").select(F.col("lang").alias("answer_id"), pick.alias("state")))


@query("SELECT round((SELECT avg(m) FROM (SELECT avg(value) AS m FROM events GROUP BY user_id) t), 6) AS macro, round((SELECT avg(value) FROM events), 6) AS micro")
def macro_and_micro(spark, sf_dir):
    return metrics.averages(table(spark, sf_dir, "events"), "user_id", "value")


@query("""WITH a AS (SELECT user_id, count(*) AS x FROM events WHERE event_type = 'view' GROUP BY 1), b AS (SELECT user_id, count(*) AS y FROM events WHERE event_type = 'click' GROUP BY 1)
 SELECT count(*) AS n, round(avg(x - y), 6) AS difference, count(*) FILTER (WHERE x > y) AS wins, count(*) FILTER (WHERE x < y) AS losses FROM a JOIN b ON a.user_id = b.user_id""")
def paired_differences(spark, sf_dir):
    count = lambda kind: table(spark, sf_dir, "events").filter(F.col("event_type") == kind).groupBy("user_id").agg(F.count("*").alias("n"))
    return metrics.paired_difference(count("view"), count("click"), "user_id", "n")


def share(hit, of):
    return f"round(count(*) FILTER (WHERE ({hit}) AND ({of})) / nullif(count(*) FILTER (WHERE {of}), 0)::DOUBLE, 6)"


@query(f"""WITH c AS (SELECT user_id AS answer, event_id % 2 = 0 AS answerable, event_id % 3 <> 0 AS answered, event_id % 5 <> 0 AS supported, event_id % 7 <> 0 AS cited, event_id % 4 <> 0 AS valid, event_id % 6 <> 0 AS relevant, event_id % 9 <> 0 AS retrieved FROM events)
 SELECT answer, {share("valid AND relevant", "cited")} AS citation_precision, {share("cited", "relevant")} AS citation_recall, {share("valid", "cited")} AS citation_validity, {share("supported", "answered")} AS claim_support, {share("relevant", "retrieved")} AS context_precision,
 {share("retrieved", "relevant")} AS context_recall, {share("NOT answered", "NOT answerable")} AS abstention_rate, {share("NOT answered", "answerable")} AS wrong_abstention_rate FROM c GROUP BY answer""")
def answer_quality(spark, sf_dir):
    k = F.col("event_id")
    flags = {"answered": 3, "supported": 5, "cited": 7, "valid": 4, "relevant": 6, "retrieved": 9}
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("answer"), (k % 2 == 0).alias("answerable"), *((k % n != 0).alias(name) for name, n in flags.items()))
    return metrics.answer_quality(rows, "answer")
