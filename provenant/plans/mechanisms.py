"""Registered queries of the operators that keep structures of their own: indexes, commit logs, state, interval buckets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from provenant.operators import discovery, folds, fuzzy, graph, metrics, policy, responses, retrieval, runs, vector_index, verification, versions
from provenant.plans.catalogue import BM25, FIRSTS, HOSTS, OUTCOMES, REFS, STREAKS, as_observations, observations, query, table
from provenant.session import run_dir, written
from provenant.sources import commits
from provenant.streaming import ledger as streaming_ledger
from provenant.streaming import ordered


def fresh_folder(spark) -> str:
    return f"{run_dir(spark)}/{uuid.uuid4().hex}"


# --- commit log -----------------------------------------------------------------------------------------------

LANGS = ("en", "de", "fr", "es")


def committed(spark, sf_dir) -> str:
    """A log of the observations by language: versions and locations of a language in one commit, each tried twice."""
    root = fresh_folder(spark)
    for lang in LANGS:
        own = observations(spark, sf_dir).filter(F.col("hash").isNotNull() & F.col("url").endswith(lang))
        tables = {
            "versions": versions.first_seen(own, ["doc", "hash"], "seq").withColumn(commits.BUCKET, commits.bucket(["doc", "hash"], 8)),
            "locations": versions.first_seen(own, ["doc", "hash", "url"], "seq").withColumn(commits.BUCKET, commits.bucket(["doc", "hash", "url"], 8)),
        }
        tables["versions"] = commits.fresh(spark, root, "versions", tables["versions"], ["doc", "hash"], commits.BUCKET)
        for _ in range(2):
            commits.commit(spark, root, lang, tables, dict.fromkeys(tables, commits.BUCKET))
    return root


PLACES = "(VALUES (1, 'en'), (2, 'de'), (3, 'fr'), (4, 'es')) c(version, token)"
OWN = f"own AS (SELECT b.*, c.version, c.token FROM body b JOIN {PLACES} ON ends_with(b.url, c.token)), nv AS (SELECT doc, hash, min(version) AS version FROM own GROUP BY doc, hash)"


@query(f"""WITH {FIRSTS}, {OWN} SELECT c.version::BIGINT AS version, c.token, 'versions' AS name, (SELECT count(*) FROM nv WHERE nv.version = c.version) AS n_rows, 0::BIGINT AS n_removed FROM {PLACES}
 UNION ALL SELECT c.version, c.token, 'locations', (SELECT count(*) FROM (SELECT DISTINCT doc, hash, url FROM own WHERE own.version = c.version) t), 0 FROM {PLACES}""")
def commit_history(spark, sf_dir):
    return commits.history(spark, committed(spark, sf_dir))


@query(f"WITH {FIRSTS}, {OWN} SELECT doc, hash, (SELECT min(seq) FROM own o WHERE o.doc = nv.doc AND o.hash = nv.hash AND o.version = nv.version) AS seq FROM nv WHERE version <= 2")
def versions_at_commit(spark, sf_dir):
    """The versions as the second commit left them, read after the fourth."""
    return commits.read(spark, committed(spark, sf_dir), "versions", version=2)


# --- folds, in batches and on streams -------------------------------------------------------------------------

# A stream tells what lies before its watermark: the last time, in milliseconds, less the delay of an hour.
MARK = "((SELECT max(epoch_us(ts)) FROM events) // 1000 * 1000 - 3600000000)"
QUEUE_EVENTS = f"""WITH RECURSIVE c AS (SELECT user_id AS job_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, epoch_us(ts) AS "at", 'w' || event_id % 2 AS worker,
 CASE event_type WHEN 'signup' THEN 'ENQUEUE' WHEN 'purchase' THEN 'ENQUEUE' WHEN 'click' THEN 'CLAIM' WHEN 'view' THEN 'CLAIM' ELSE CASE WHEN event_id % 5 = 0 THEN 'COMPLETE' ELSE 'FAIL' END END AS kind,
 CASE WHEN value > 10 THEN epoch_us(ts) + event_id % 7 * 3600000000 END AS retry_at, CASE WHEN event_type = 'purchase' THEN epoch_us(ts) + 7200000000 END AS run_after, event_type AS error FROM events WHERE epoch_us(ts) <= {MARK}),
 s AS (SELECT job_id, 0 AS i, NULL::VARCHAR AS status, 0 AS attempts, 0::BIGINT AS ready, NULL::VARCHAR AS holder, false AS told, 0 AS n, NULL::BIGINT AS ripe, NULL::VARCHAR AS act, 0::BIGINT AS "at", NULL::VARCHAR AS detail FROM (SELECT DISTINCT job_id FROM c) t
 UNION ALL SELECT job_id, i, CASE act WHEN 'ENQUEUED' THEN 'QUEUED' WHEN 'CLAIMED' THEN 'RUNNING' WHEN 'RETRY_SCHEDULED' THEN 'QUEUED' WHEN 'SUCCEEDED' THEN 'SUCCEEDED' WHEN 'FAILED' THEN 'FAILED' ELSE status END, CASE WHEN act = 'CLAIMED' THEN attempts + 1 ELSE attempts END,
 CASE act WHEN 'ENQUEUED' THEN greatest(coalesce(run_after, "at"), "at") WHEN 'RETRY_SCHEDULED' THEN greatest(retry_at, "at") ELSE ready END, CASE WHEN act = 'CLAIMED' THEN worker WHEN act IS NOT NULL THEN NULL ELSE holder END,
 CASE WHEN act IN ('ENQUEUED', 'RETRY_SCHEDULED') THEN false ELSE told OR ripe IS NOT NULL END, n + CASE WHEN ripe IS NULL THEN 0 ELSE 1 END + CASE WHEN act IS NULL THEN 0 ELSE 1 END, ripe, act, "at", CASE WHEN act = 'CLAIMED' THEN worker WHEN act IN ('RETRY_SCHEDULED', 'FAILED') THEN error END
 FROM (SELECT s.job_id, c.i, s.status, s.attempts, s.ready, s.holder, s.told, s.n, c."at", c.worker, c.retry_at, c.run_after, c.error, CASE WHEN s.status = 'QUEUED' AND NOT s.told AND s.ready <= c."at" THEN s.ready END AS ripe,
 CASE WHEN s.status IS NULL AND kind = 'ENQUEUE' THEN 'ENQUEUED' WHEN s.status = 'QUEUED' AND kind = 'CLAIM' AND s.ready <= c."at" THEN 'CLAIMED' WHEN s.status = 'RUNNING' AND s.holder = c.worker AND kind = 'COMPLETE' THEN 'SUCCEEDED'
 WHEN s.status = 'RUNNING' AND s.holder = c.worker AND kind = 'FAIL' THEN CASE WHEN c.retry_at IS NOT NULL AND s.attempts < 3 THEN 'RETRY_SCHEDULED' ELSE 'FAILED' END END AS act FROM s JOIN c ON s.job_id = c.job_id AND c.i = s.i + 1) t)
 SELECT job_id, (n - CASE WHEN act IS NULL THEN 1 ELSE 2 END)::BIGINT AS n, ripe AS "at", 'RUNNABLE' AS event, NULL::VARCHAR AS detail FROM s WHERE ripe IS NOT NULL
 UNION ALL SELECT job_id, n - 1, "at", act, detail FROM s WHERE act IS NOT NULL
 UNION ALL SELECT job_id, n, ready, 'RUNNABLE', NULL FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY i DESC) AS last FROM s) t WHERE last = 1 AND status = 'QUEUED' AND NOT told AND ready <= {MARK}"""


def commands(events):
    """Events as commands to a queue: a job for each user, two workers, three attempts."""
    at, k, hour = F.unix_micros(F.col("ts").cast("timestamp")), F.col("event_id"), 3_600_000_000
    kind = F.when(F.col("event_type").isin("signup", "purchase"), "ENQUEUE").when(F.col("event_type").isin("click", "view"), "CLAIM").otherwise(F.when(k % 5 == 0, "COMPLETE").otherwise("FAIL"))
    return events.select(
        F.col("user_id").alias("job_id"), k.alias("seq"), F.col("ts").cast("timestamp").alias("at"), kind.alias("kind"), F.concat(F.lit("w"), (k % 2).cast("string")).alias("worker"), F.col("event_type").alias("error"),
        F.when(F.col("event_type") == "purchase", at + 2 * hour).alias("run_after"), F.when(F.col("value") > 10, at + k % 7 * hour).alias("retry_at"), F.lit(3).alias("max_attempts"),
    )


def mark(spark, sf_dir) -> int:
    last = table(spark, sf_dir, "events").agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()[0]
    return last // 1000 * 1000 - 3_600_000_000


def streamed(spark, rows, keys, when, fold):
    out = fresh_folder(spark)
    ordered.run_to(spark, ordered.folded_stream(rows, keys, when, ["seq"], fold, "1 hour"), out, fresh_folder(spark)).awaitTermination()
    return spark.read.parquet(out)


def table_stream(spark, sf_dir, name):
    """The table's files as a stream; a table of a single file is found in its folder."""
    file = f"{name}.parquet"
    rows = spark.readStream.schema(table(spark, sf_dir, name).schema)
    single = commits.Files(spark, f"{sf_dir}/{file}").names("") == [file]
    return rows.option("pathGlobFilter", file).parquet(sf_dir) if single else rows.parquet(f"{sf_dir}/{file}")


@query(QUEUE_EVENTS)
def queue_events(spark, sf_dir):
    """Every event that a queue's commands lead to, folded in one pass: the log that the queue appends."""
    rows, upto = commands(table(spark, sf_dir, "events")), mark(spark, sf_dir)
    return folds.folded(rows.filter(F.unix_micros("at") <= upto), ["job_id"], "at", ["seq"], folds.QUEUE, upto)


@query(QUEUE_EVENTS)
def queue_events_streamed(spark, sf_dir):
    """The same from a stream, by state and timers."""
    return streamed(spark, commands(table_stream(spark, sf_dir, "events")), ["job_id"], "at", folds.QUEUE)


@query(f"WITH {STREAKS.replace('FROM events', f'FROM events WHERE epoch_us(ts) <= {MARK}', 1)} SELECT a.run, a.seq, a.seq = t.tripped_at AS tripped FROM attempts a LEFT JOIN trips t ON a.run = t.run WHERE t.tripped_at IS NULL OR a.seq <= t.tripped_at".replace("a.seq = t.tripped_at AS", "coalesce(a.seq = t.tripped_at, false) AS"))
def breaker_streamed(spark, sf_dir):
    rows = table_stream(spark, sf_dir, "events").select("*", F.col("ts").cast("timestamp").alias("at"))
    status = F.when(F.col("event_type") == "view", 200).when(F.col("event_type") == "click", 404).when(F.col("event_type") == "error", 429).when(F.col("event_type") == "signup", 403).otherwise(500)
    rows = rows.select(F.col("user_id").alias("run"), F.col("event_id").alias("seq"), "at", status.alias("status"))
    return streamed(spark, rows, ["run"], "at", folds.breaker(4)).select("run", "seq", "tripped")


@query(f"WITH a AS (SELECT user_id AS host, event_id AS seq, epoch_us(ts) AS start FROM events WHERE epoch_us(ts) <= {MARK}), w AS (SELECT host, seq, start - lag(start) OVER (PARTITION BY host ORDER BY start, seq) AS since FROM a) SELECT host, seq, since FROM w WHERE since < 3600000000")
def pacing_streamed(spark, sf_dir):
    rows = table_stream(spark, sf_dir, "events").select(F.col("user_id").alias("host"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("at"))
    return streamed(spark, rows.withColumn("end", F.lit(None).cast("long")), ["host"], "at", folds.pacing(3_600_000_000))


@query(f"WITH {OUTCOMES} SELECT * FROM outcomes")
def ledger_streamed(spark, sf_dir):
    """The observations of a stream appended to a commit log, and the outcomes that follow from the log."""
    log = fresh_folder(spark)
    stream = as_observations(table_stream(spark, sf_dir, "documents"))
    streaming_ledger.run_ledger(spark, stream, log, fresh_folder(spark)).awaitTermination()
    return streaming_ledger.ledger_outcomes(spark, log)


# --- vector index ---------------------------------------------------------------------------------------------


@query("""WITH s AS (SELECT q.vec_id AS query, e.vec_id AS id, round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) AS score FROM embeddings q JOIN embeddings e ON q.vec_id % 50 = 0)
 SELECT query, id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM s) t WHERE rank <= 10""")
def dense_topk_many(spark, sf_dir):
    """Every row whose id 50 divides asks for its ten nearest, exactly."""
    vectors = table(spark, sf_dir, "embeddings")
    return vector_index.topk(spark, vector_index.build(spark, vectors), vectors.filter("vec_id % 50 = 0"), 10, exact=True)


# --- fuzzy lookup, redirect chains, sketches --------------------------------------------------------------------

GRAMS = "list_distinct(list_transform(range(1, length('  ' || lower({0}) || ' ') - 1), lambda i: substr('  ' || lower({0}) || ' ', i, 3)))"


@query(f"""WITH n AS (SELECT p_partkey AS id, p_name || ' ' || p_type || ' ' || p_brand || ' ' || p_partkey AS name FROM part), q AS (SELECT id AS query, substr(name, 1, 3) || substr(name, 5) AS name FROM n WHERE id % 50 = 0),
 a AS (SELECT id, {GRAMS.format('name')} AS x FROM n), b AS (SELECT query, {GRAMS.format('name')} AS y FROM q), s AS (SELECT query, id, len(list_intersect(x, y)) / (len(x) + len(y) - len(list_intersect(x, y)))::DOUBLE AS similarity FROM a, b)
 SELECT query, id, round(similarity, 6) AS similarity FROM s WHERE similarity >= 0.7 - 1e-9""")
def fuzzy_lookup(spark, sf_dir):
    """Parts by a description that lacks a letter, for every part whose key 50 divides."""
    name = F.concat_ws(" ", "p_name", "p_type", "p_brand", F.col("p_partkey").cast("string"))
    names = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), name.alias("name"))
    asked = names.filter("id % 50 = 0").select(F.col("id").alias("query"), F.concat(F.col("name").substr(1, 3), F.expr("substr(name, 5)")).alias("name"))
    return fuzzy.lookup(fuzzy.build(spark, names, 0.7), asked).select("query", "id", F.round("similarity", 6).alias("similarity"))


@query("""WITH RECURSIVE hop AS (SELECT 'u' || user_id AS src, min('u' || (user_id + event_id % 40)) AS dst FROM events WHERE event_type = 'click' AND event_id % 40 <> 0 GROUP BY user_id),
 walk AS (SELECT DISTINCT 'u' || user_id AS url, 'u' || user_id AS final, ['u' || user_id] AS path, NULL::VARCHAR AS problem FROM events
 UNION ALL SELECT w.url, h.dst, list_append(w.path, h.dst), CASE WHEN len(w.path) > 5 THEN 'TOO_MANY_REDIRECTS' WHEN list_contains(w.path, h.dst) THEN 'REDIRECT_LOOP' END FROM walk w JOIN hop h ON w.final = h.src WHERE w.problem IS NULL)
 SELECT url, final, array_to_string(path, ' ') AS path, (len(path) - 1)::INT AS hops, problem FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY len(path) DESC) AS rn FROM walk) t WHERE rn = 1""")
def redirect_chains(spark, sf_dir):
    """Users as URLs, a click as a redirect to another user."""
    e, name = table(spark, sf_dir, "events"), lambda c: F.concat(F.lit("u"), c.cast("string"))
    step = F.col("event_id") % 40
    edges = e.filter((F.col("event_type") == "click") & (step != 0)).select(name(F.col("user_id")).alias("src"), name(F.col("user_id") + step).alias("dst"))
    out = responses.redirect_chains(e.select(name(F.col("user_id")).alias("url")), edges, 5)
    return out.select("url", "final", F.array_join("path", " ").alias("path"), "hops", "problem")


@query("SELECT event_type, count(*) AS n, true AS p50_near, true AS p95_near, true AS p99_near FROM events GROUP BY event_type")
def latency_sketches(spark, sf_dir):
    """A sketch for each day, merged over the days: the rank of each quantile lies within 1.5 % of the rows of the asked one."""
    e = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"), "value")
    stored = written(spark, metrics.sketches(e, ["event_type", "day"], "value"))
    found = metrics.sketched_percentiles(stored, ["event_type"])
    ranks = e.join(F.broadcast(found), "event_type").groupBy("event_type", "n")  # a row for each type
    near = lambda q: (F.abs(F.count_if(F.col("value") <= F.col(f"p{round(100 * q)}")) / F.col("n") - q) <= 0.015 + 1 / F.col("n")).alias(f"p{round(100 * q)}_near")
    return ranks.agg(*(near(q) for q in (0.5, 0.95, 0.99))).select("event_type", "n", "p50_near", "p95_near", "p99_near")


# --- whole runs -----------------------------------------------------------------------------------------------

RUN_RESULTS = f"""{REFS}, c AS (SELECT page_id, page_id % 25 AS run, 1000000 - page_id AS position, CASE WHEN page_id % 13 = 0 THEN 'DOCUMENT_TYPE_NOT_IN_SCOPE' END AS scope, CASE WHEN page_id % 4 = 0 THEN 'https://docs.example/' || page_id END AS own,
 CASE WHEN page_id % 24 = 0 THEN 'HOST_NOT_ALLOWED' END AS bad, CASE WHEN page_id % 17 = 0 THEN NULL WHEN page_id % 9 = 0 THEN 503 WHEN page_id % 9 = 1 THEN 404 WHEN page_id % 9 = 2 THEN 429 ELSE 200 END AS page_status, page_id % 19 = 0 AS page_bad,
 CASE page_id % 7 WHEN 0 THEN 503 WHEN 1 THEN 403 ELSE 200 END AS status FROM pages),
 fine AS (SELECT page_id, regexp_replace(resolved, '#.*$', '') AS target FROM full_refs WHERE regexp_matches(resolved, '^https://({'|'.join(HOSTS)})(/|$)') AND length(resolved) <= 200 AND NOT regexp_matches(resolved, '[\\x00-\\x20\\x7f-\\x9f\\\\]')
 AND NOT regexp_matches(resolved, '\\?[^#]') AND NOT regexp_matches(substr(resolved, 9), '//') AND NOT regexp_matches(regexp_replace(resolved, '[?#].*$', ''), '[^\\x00-\\x7f]')),
 ok AS (SELECT page_id, count(DISTINCT target) AS n, min(target) AS target FROM fine GROUP BY page_id),
 d AS (SELECT c.*, coalesce(n, 0) AS n, scope IS NULL AND own IS NULL AS behind, CASE WHEN scope IS NOT NULL OR own IS NOT NULL THEN NULL WHEN page_status IS NULL THEN 'NO_RESPONSE' WHEN page_status IN (503, 429) THEN 'HTTP_TRANSIENT' WHEN page_status = 404 THEN 'HTTP_PERMANENT' WHEN page_bad THEN 'SIZE_EXCEEDED'
 WHEN n > 1 THEN 'AMBIGUOUS_ATTACHMENT_REFERENCES' WHEN n IS NULL THEN 'NO_VALID_ATTACHMENT_REFERENCES' END AS page_reason, ok.target FROM c LEFT JOIN ok ON c.page_id = ok.page_id),
 u AS (SELECT *, coalesce(own, CASE WHEN behind AND page_reason IS NULL THEN target END) AS url FROM d),
 q AS (SELECT run, position, -1 AS seq, page_status AS status FROM u WHERE behind AND page_status IS NOT NULL UNION ALL SELECT run, position, page_id, status FROM u WHERE scope IS NULL AND url IS NOT NULL AND bad IS NULL),
 i AS (SELECT *, sum(CASE WHEN status = 200 THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY position, seq) AS island FROM q), k AS (SELECT *, sum(CASE WHEN status IN (403, 429) THEN 1 ELSE 0 END) OVER (PARTITION BY run, island ORDER BY position, seq) AS refusals FROM i),
 stops AS (SELECT run, min(position) AS last FROM k WHERE status IN (403, 429) AND refusals >= 2 GROUP BY run),
 r AS (SELECT u.run, u.position, u.page_id AS document_key, u.url AS document_url,
 CASE WHEN u.position = s.last THEN 'FAILED_TRANSIENT' WHEN page_reason IN ('NO_RESPONSE', 'HTTP_TRANSIENT') THEN 'FAILED_TRANSIENT' WHEN page_reason = 'HTTP_PERMANENT' THEN 'FAILED_PERMANENT' WHEN page_reason = 'SIZE_EXCEEDED' THEN 'QUARANTINED' WHEN page_reason IS NOT NULL THEN 'UNRESOLVED'
 WHEN scope IS NOT NULL THEN 'OUT_OF_SCOPE' WHEN bad IS NOT NULL THEN 'QUARANTINED' WHEN status = 503 THEN 'FAILED_TRANSIENT' WHEN status = 403 THEN 'FAILED_PERMANENT' WHEN page_id % 11 = 3 THEN 'QUARANTINED' WHEN page_id % 29 = 5 THEN 'FAILED_PERMANENT' WHEN page_id % 12 = 4 THEN 'UNCHANGED_SKIPPED' ELSE 'NEW_VERSION' END AS outcome,
 CASE WHEN u.position = s.last THEN 'CIRCUIT_OPEN' WHEN page_reason IS NOT NULL THEN page_reason WHEN scope IS NOT NULL THEN scope WHEN bad IS NOT NULL THEN bad WHEN status = 503 THEN 'HTTP_TRANSIENT' WHEN status = 403 THEN 'HTTP_PERMANENT' WHEN page_id % 11 = 3 THEN 'PDF_SANITY_FAILED' WHEN page_id % 29 = 5 THEN 'BlobStoreError' END AS reason,
 CASE WHEN u.position = s.last OR page_reason IS NOT NULL OR scope IS NOT NULL OR bad IS NOT NULL OR status <> 200 THEN 'DISCOVERED' WHEN page_id % 11 = 3 THEN 'FETCHED' WHEN page_id % 29 = 5 THEN 'VALIDATED' ELSE 'VERSIONED' END AS stage,
 CASE WHEN u.position = s.last THEN 1 WHEN page_reason = 'NO_RESPONSE' THEN 0 WHEN page_reason IS NOT NULL THEN 1 WHEN scope IS NOT NULL OR bad IS NOT NULL THEN 0 ELSE 1 END::BIGINT AS attempts, behind, n FROM u LEFT JOIN stops s ON u.run = s.run WHERE s.last IS NULL OR u.position <= s.last)"""


def page_runs(spark, sf_dir):
    """Twenty-five runs over the pages, last page first; a page in four has a document of its own, the others show theirs (chosen, found, results)."""
    pages, k = table(spark, sf_dir, "pages"), F.col("page_id")
    own = F.when(k % 4 == 0, F.concat(F.lit("https://docs.example/"), k.cast("string")))
    candidates = pages.select(
        k.alias("document_key"), F.when(k % 13 == 0, "DOCUMENT_TYPE_NOT_IN_SCOPE").alias("scope_reason"), own.alias("document_url"), F.when(k % 24 == 0, "HOST_NOT_ALLOWED").alias("url_reason"), F.lit(None).cast("string").alias("ref"), "page_id",
    )
    chosen = runs.selected(candidates, pages.select((k % 25).alias("run"), (1_000_000 - k).alias("position"), k.alias("document_key")))
    status = F.when(k % 9 == 0, 503).when(k % 9 == 1, 404).when(k % 9 == 2, 429).otherwise(200)
    captured = pages.filter(k % 17 != 0).select("page_id", status.alias("status"), F.when(k % 19 == 0, "SIZE_EXCEEDED").alias("rejected"), F.col("html").alias("text"))
    judged = discovery.judged_references(discovery.page_references(pages), lambda url: policy.url_reason(url, HOSTS, ["/"], 200))
    found, none, digest = discovery.attachments(pages, judged), F.lit(None).cast("string"), F.sha2("html", 256)
    attempts = pages.select(
        k.alias("document_key"), k.alias("seq"), F.when(k % 7 == 0, 503).when(k % 7 == 1, 403).otherwise(200).alias("status"), none.alias("failure"), none.alias("quarantine"),
        F.when(k % 11 == 3, "PDF_SANITY_FAILED").alias("rejected"), F.when(k % 29 == 5, "BlobStoreError").alias("store_error"), digest.alias("hash"), F.length("html").cast("long").alias("size"),
    )
    earlier = pages.filter(k % 12 == 4).select((k - 10**9).alias("seq"), k.alias("doc"), own.alias("url"), none.alias("ref"), digest.alias("hash"), F.length("html").cast("long").alias("size"))
    return chosen, found, runs.results(chosen, captured, found, attempts, earlier, 2)


@query(f"WITH {RUN_RESULTS} SELECT run, position, document_key, document_url, outcome, reason, stage, attempts FROM r")
def run_complete(spark, sf_dir):
    return page_runs(spark, sf_dir)[2]


@query(f"""WITH {RUN_RESULTS}, o AS (SELECT run, string_agg(outcome || '=' || n, ',' ORDER BY outcome) AS outcomes, sum(n)::BIGINT AS processed FROM (SELECT run, outcome, count(*) AS n FROM r GROUP BY 1, 2) t GROUP BY run),
 f AS (SELECT run, string_agg(found || '=' || n, ',' ORDER BY found) AS discovery FROM (SELECT run, CASE WHEN n = 0 THEN 'UNRESOLVED' WHEN n = 1 THEN 'DISCOVERED' ELSE 'AMBIGUOUS' END AS found, count(*) AS n FROM r WHERE behind GROUP BY 1, 2) t GROUP BY run)
 SELECT p.run, CASE WHEN bool_or(r.reason = 'CIRCUIT_OPEN') THEN 'ABORTED' WHEN bool_or(r.outcome IN ('FAILED_TRANSIENT', 'FAILED_PERMANENT', 'QUARANTINED')) THEN 'COMPLETED_WITH_FAILURES' ELSE 'COMPLETED' END AS status, CASE WHEN bool_or(r.reason = 'CIRCUIT_OPEN') THEN 'CIRCUIT_OPEN' END AS abort_reason,
 p.planned, o.processed, o.outcomes, coalesce(any_value(f.discovery), '') AS discovery FROM (SELECT run, count(*) AS planned FROM c GROUP BY run) p JOIN o ON p.run = o.run JOIN r ON r.run = p.run LEFT JOIN f ON f.run = p.run GROUP BY p.run, p.planned, o.processed, o.outcomes""")
def run_statistics(spark, sf_dir):
    chosen, found, results = page_runs(spark, sf_dir)
    return runs.statistics(chosen, written(spark, results), found)


# --- retrieval over a set of questions ------------------------------------------------------------------------

WORDS = "list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> ''))"
LONG_WORDS = "list_distinct(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[a-z]{11,}'))"
SEARCH_ALL = f"""fdocs AS (SELECT d.* FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic = 0 AND n_chars BETWEEN 100 AND 20000), {BM25.replace("FROM documents", "FROM fdocs")},
 vec AS (SELECT b.item_id, e.vec_id AS doc_id, row_number() OVER (PARTITION BY b.item_id ORDER BY round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) DESC, e.vec_id) AS rank FROM benchmark b JOIN embeddings q ON q.vec_id = b.item_id JOIN embeddings e ON e.vec_id IN (SELECT doc_id FROM fdocs)),
 ids AS (SELECT a.item_id, h.doc_id, count(*) AS score FROM (SELECT item_id, unnest({LONG_WORDS}) AS w FROM benchmark) a JOIN (SELECT doc_id, unnest({LONG_WORDS}) AS w FROM fdocs) h ON a.w = h.w GROUP BY 1, 2),
 idr AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM ids),
 fu AS (SELECT item_id, doc_id, round(sum(1.0 / (60 + rank))::DOUBLE, 6) AS score, count(*) AS n_lists FROM (SELECT item_id, doc_id, rank FROM lex WHERE rank <= 50 UNION ALL SELECT item_id, doc_id, rank FROM vec WHERE rank <= 50 UNION ALL SELECT item_id, doc_id, rank FROM idr WHERE rank <= 50) t GROUP BY item_id, doc_id),
 fr AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM fu), cov AS (SELECT fr.item_id, fr.doc_id, d.source, rank, n_lists, round(len(list_intersect({WORDS.replace('text', 'b.text')}, {WORDS.replace('text', 'd.text')})) / len({WORDS.replace('text', 'b.text')})::DOUBLE, 6) AS coverage FROM fr JOIN fdocs d ON fr.doc_id = d.doc_id JOIN benchmark b ON b.item_id = fr.item_id WHERE rank <= 30),
 ord AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY coverage DESC, rank) AS o FROM cov), own AS (SELECT *, row_number() OVER (PARTITION BY item_id, source ORDER BY o) AS n FROM ord)"""


@query(f"WITH {SEARCH_ALL} SELECT item_id, doc_id, source, rank, n_lists, coverage, position FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY o) AS position FROM own WHERE n <= 3) t WHERE position <= 8")
def search_all(spark, sf_dir):
    """Every item of the benchmark asks, with the vector of its number; its long words are its identifiers."""
    clean = table(spark, sf_dir, "labels").filter("toxic = 0").select(F.col("doc_id").alias("version_id"))
    docs = verification.hard_filtered(table(spark, sf_dir, "documents").withColumn("version_id", F.col("doc_id")), clean, n_chars=(100, 20000)).select("doc_id", "text", "source")
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    questions = table(spark, sf_dir, "benchmark").join(vectors.withColumnRenamed("doc_id", "item_id"), "item_id", "left")
    long_words = lambda text: F.regexp_extract_all(text, F.lit("[a-z]{11,}"), F.lit(0))
    return retrieval.search_all(spark, docs, vectors, questions, long_words)


# --- traversal with its cap on nodes --------------------------------------------------------------------------


def level_sql(n: int) -> str:
    return f"""s{n} AS (SELECT DISTINCT p.root, e.dst AS node FROM l{n - 1} p JOIN c e ON p.node = e.src WHERE NOT EXISTS (SELECT 1 FROM seen{n - 1} x WHERE x.root = p.root AND x.node = e.dst)),
 r{n} AS (SELECT s.root, s.node, row_number() OVER (PARTITION BY s.root ORDER BY s.node) AS rn, count(*) OVER (PARTITION BY s.root) AS m, 6 - x.k AS room FROM s{n} s JOIN (SELECT root, count(*) AS k FROM seen{n - 1} GROUP BY root) x ON s.root = x.root),
 l{n} AS (SELECT root, node FROM r{n} WHERE rn <= room), seen{n} AS (SELECT * FROM seen{n - 1} UNION ALL SELECT root, node, {n} FROM l{n})"""


@query(f"""WITH e AS (SELECT DISTINCT l_suppkey AS src, l_suppkey + 1 + l_linenumber AS dst FROM lineitem WHERE l_returnflag = 'A'), c AS (SELECT src, dst, m > 3 AS cut FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY dst) AS rn, count(*) OVER (PARTITION BY src) AS m FROM e) t WHERE rn <= 3),
 l0 AS (SELECT s_suppkey AS root, s_suppkey AS node FROM supplier), seen0 AS (SELECT root, node, 0 AS depth FROM l0), {level_sql(1)}, {level_sql(2)}, {level_sql(3)},
 flags AS (SELECT root FROM r1 WHERE m > room UNION SELECT root FROM r2 WHERE m > room UNION SELECT root FROM r3 WHERE m > room UNION SELECT l.root FROM (SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3) l JOIN c ON c.dst = l.node AND c.cut
 JOIN seen3 f ON f.root = l.root AND f.node = c.src JOIN seen3 t ON t.root = l.root AND t.node = l.node AND t.depth = f.depth + 1)
 SELECT root, node, depth::BIGINT AS depth, root IN (SELECT root FROM flags) AS truncated FROM seen3""")
def traversal_capped(spark, sf_dir):
    """Six nodes of a root at most, however many its edges lead to."""
    li = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'A'")
    edges = li.select(F.col("l_suppkey").alias("src"), (F.col("l_suppkey") + 1 + F.col("l_linenumber")).alias("dst"))
    return graph.reachable(edges, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("root")), 3, 3, False, 6)
