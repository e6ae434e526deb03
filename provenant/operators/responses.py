"""Captured responses: validation, status mapping, retries, pacing and the circuit breaker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Token names that make a PDF active, media types, statuses that refuse and that reset the breaker.
ACTIVE_TOKENS = ("Encrypt", "JavaScript", "JS", "Launch", "OpenAction", "EmbeddedFile")
PDF_TYPES, HTML_TYPES = ("application/pdf",), ("text/html", "application/xhtml+xml")
REFUSALS, RESETS = (401, 403, 429), (200, 304, 301, 302, 303, 307, 308)
RETRYABLE = ("HTTP_TRANSIENT", "TIMEOUT", "TLS_ERROR")
FAILURES = ("FAILED_TRANSIENT", "FAILED_PERMANENT", "QUARANTINED")


def media_type(content_type: Column) -> Column:
    return F.lower(F.trim(F.coalesce(F.split(content_type, ";")[0], F.lit(""))))


def latin(body: Column) -> Column:
    """Bytes as characters one to one."""
    return F.decode(body, "ISO-8859-1")


def sniffed_type(body: Column) -> Column:
    """Coarse media type of the first bytes."""
    head = F.lower(F.substring(F.regexp_replace(latin(F.substring(body, 1, 4096)), r"^[ \t\n\r\x0b\x0c]+", ""), 1, 64))
    html = head.startswith("<!doctype html") | head.startswith("<html") | head.startswith("<head") | head.startswith("<body")
    return F.when(latin(F.substring(body, 1, 5)) == "%PDF-", "application/pdf").when(html, "text/html").otherwise("application/octet-stream")


def rejection(content_type: Column, body: Column, purpose: Column, max_bytes: int, eof_tail: int) -> Column:
    """Null for an acceptable response, else the reason of the first check that fails."""
    attachment = purpose == "ATTACHMENT"
    expected = F.when(attachment, media_type(content_type).isin(*PDF_TYPES)).otherwise(media_type(content_type).isin(*HTML_TYPES))
    tail = latin(F.substring(body, -eof_tail, eof_tail))
    active = latin(body).rlike(rf"/(?:{'|'.join(ACTIVE_TOKENS)})(?![A-Za-z0-9#])")
    return (
        F.when(~expected, "CONTENT_TYPE_MISMATCH")
        .when(F.octet_length(body) > max_bytes, "SIZE_EXCEEDED")
        .when(attachment & (latin(F.substring(body, 1, 5)) != "%PDF-"), "MAGIC_BYTES_MISMATCH")
        .when(attachment & ~tail.contains("%%EOF"), "PDF_SANITY_FAILED")
        .when(attachment & active, "PDF_SANITY_FAILED")
    )


def status_outcome(status: Column) -> Column:
    return F.when(status == 200, "OK").when(status == 304, "NOT_MODIFIED").when((status == 429) | (status >= 500), "HTTP_TRANSIENT").otherwise("HTTP_PERMANENT")


def is_refusal(status: Column) -> Column:
    return status.isin(*REFUSALS)


def resets_breaker(status: Column) -> Column:
    return status.isin(*RESETS)


def size_problem(declared: Column, body_size: Column, wire_size: Column, max_bytes: int, max_ratio: float) -> Column:
    """Reason for a size guard that trips, in order: malformed or large declaration, large body, expansion, truncation."""
    number = F.when(declared.rlike(r"\A[0-9]{1,18}\z"), declared.cast("long"))
    return (
        F.when(declared.isNotNull() & number.isNull(), "HTTP_PERMANENT")
        .when(number > max_bytes, "SIZE_EXCEEDED")
        .when(body_size > max_bytes, "SIZE_EXCEEDED")
        .when((wire_size > 0) & (body_size / wire_size > max_ratio), "SIZE_EXCEEDED")
        .when(number.isNotNull() & (wire_size < number), "PDF_SANITY_FAILED")
    )


def retry_after_seconds(value: Column, now: Column) -> Column:
    """Seconds to wait: up to 12 digits, or an HTTP date; never negative; null for anything else."""
    when = F.try_to_timestamp(F.regexp_extract(value, r"^[A-Za-z]{3}, (\d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) GMT$", 1), F.lit("dd MMM yyyy HH:mm:ss"))
    until = F.greatest(F.lit(0.0), F.unix_micros(when) / 1e6 - F.unix_micros(now) / 1e6)
    return F.when(value.rlike(r"\A[0-9]{1,12}\z"), value.try_cast("double")).when(when.isNotNull(), until)


def backoff_ceiling(attempt: Column, base: float, cap: float) -> Column:
    return F.least(F.lit(float(cap)), F.lit(float(base)) * F.pow(F.lit(2.0), attempt - 1))


def backoff_seconds(attempt: Column, drawn: Column, base: float, cap: float, min_delay: float, retry_after: Column) -> Column:
    """Seconds to wait before the next attempt: a share ``drawn`` of the ceiling, no less than the delay or Retry-After."""
    return F.greatest(drawn * backoff_ceiling(attempt, base, cap), F.lit(float(min_delay)), F.coalesce(retry_after, F.lit(0.0)))


def within_deadline(attempts: DataFrame, deadline: float) -> DataFrame:
    """Attempts (run, candidate, attempt, elapsed, wait) that begin before the candidate's deadline has passed."""
    before = W.partitionBy("run", "candidate").orderBy("attempt").rowsBetween(W.unboundedPreceding, -1)
    return attempts.withColumn("begins", F.coalesce(F.sum(F.col("elapsed") + F.col("wait")).over(before), F.lit(0.0))).filter(F.col("begins") < deadline)


def routed(failure: Column, quarantine: Column) -> Column:
    """Outcome of a failed fetch."""
    return F.when(quarantine.isNotNull(), "QUARANTINED").when(failure.isin(*RETRYABLE), "FAILED_TRANSIENT").when(failure.isNotNull(), "FAILED_PERMANENT")


def attempt_numbers(attempts: DataFrame) -> DataFrame:
    """``attempts`` (run, candidate, seq, ...) with the attempt number of each candidate."""
    return attempts.withColumn("attempt", F.row_number().over(W.partitionBy("run", "candidate").orderBy("seq")).cast("long"))


def refusal_streaks(attempts: DataFrame) -> DataFrame:
    """``attempts`` (run, seq, status) with the count of refusals since the last reset of its run."""
    run = W.partitionBy("run").orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    out = attempts.withColumn("island", F.sum(F.when(resets_breaker(F.col("status")), 1).otherwise(0)).over(run).cast("long"))
    streak = W.partitionBy("run", "island").orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    return out.withColumn("refusals", F.sum(F.when(is_refusal(F.col("status")), 1).otherwise(0)).over(streak).cast("long"))


def circuit_trips(attempts: DataFrame, threshold: int) -> DataFrame:
    """(run, tripped_at): the first attempt at which a run's refusals reach the threshold."""
    return refusal_streaks(attempts).filter(is_refusal(F.col("status")) & (F.col("refusals") >= threshold)).groupBy("run").agg(F.min("seq").alias("tripped_at"))


def before_trip(attempts: DataFrame, threshold: int) -> DataFrame:
    """Attempts that a run still made; the one that trips is the last, with outcome CIRCUIT_OPEN."""
    out = attempts.join(circuit_trips(attempts, threshold), "run", "left").filter("tripped_at is null or seq <= tripped_at")
    return out.withColumn("outcome", F.when(F.col("seq") == F.col("tripped_at"), "CIRCUIT_OPEN").otherwise(status_outcome(F.col("status")))).drop("tripped_at")


def pacing_violations(requests: DataFrame, min_delay: float) -> DataFrame:
    """Requests (host, seq, start, end in seconds) that begin too soon after, or during, the one before at the host."""
    w = W.partitionBy("host").orderBy("start", "seq")
    out = requests.withColumn("since", F.col("start") - F.lag("start").over(w)).withColumn("overlaps", F.lag("end").over(w) > F.col("start"))
    return out.filter((F.col("since") < min_delay) | F.col("overlaps"))


def redirect_problem(chain: Column, max_redirects: int) -> Column:
    """For a captured chain of URLs: a loop, or too many hops."""
    loop = F.size(F.array_distinct(chain)) < F.size(chain)
    return F.when(loop, "REDIRECT_LOOP").when(F.size(chain) - 1 > max_redirects, "TOO_MANY_REDIRECTS")


def redirect_chains(starts: DataFrame, edges: DataFrame, max_redirects: int) -> DataFrame:
    """(url, final, path, hops, problem): where requests (url) lead along redirects (src, dst), one for each src.

    The walk is a recursive query that carries its path. It ends where no redirect is known; at a URL that it has seen
    (REDIRECT_LOOP); or with more than ``max_redirects`` hops (TOO_MANY_REDIRECTS), which is told first. So no walk is longer
    than that, whatever the redirects are.
    """
    spark = starts.sparkSession
    walks = spark.sql(
        f"""WITH RECURSIVE walk(url, final, path, problem) AS (
        SELECT url, url, array(url), CAST(NULL AS STRING) FROM {{starts}}
        UNION ALL
        SELECT w.url, e.dst, array_append(w.path, e.dst),
            CASE WHEN size(w.path) > {int(max_redirects)} THEN 'TOO_MANY_REDIRECTS' WHEN array_contains(w.path, e.dst) THEN 'REDIRECT_LOOP' END
        FROM walk w JOIN {{edges}} e ON w.final = e.src WHERE w.problem IS NULL)
        SELECT * FROM walk""",
        starts=starts.filter("url is not null").select("url").distinct(),
        edges=edges.groupBy("src").agg(F.min("dst").alias("dst")).filter("dst is not null"),
    )
    last = walks.groupBy("url").agg(F.max_by(F.struct("final", "path", "problem"), F.size("path")).alias("w"))
    return last.select("url", "w.final", "w.path", (F.size("w.path") - 1).alias("hops"), "w.problem")
