"""The version ledger over an observation log (seq, doc, url, ref, hash, size); a null hash is a 304 answer.

Sequential ledger rules in closed form: the first row of (doc, hash) makes a version, the first row of
(doc, hash, url) a location, every other row changes nothing. "First" is a minimum per key, aggregated before the
shuffle and joined back, so one hash that holds a large share of the log is no hot window; AQE splits the skewed side of
the joins. What follows an order inside a document or URL goes by stretches of that order (:mod:`provenant.operators.ranks`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provenant.operators import ranks

NEW, MOVED, SAME = "NEW_VERSION", "NEW_LOCATION_SAME_VERSION", "UNCHANGED_SKIPPED"
FAILED = "FAILED_PERMANENT"


def first_seen(obs: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Smallest seq for each key, over the rows with a body."""
    return obs.filter("hash is not null").groupBy(*keys).agg(F.min("seq").alias(name))


def known_locations(obs: DataFrame) -> DataFrame:
    """First row with a body at each (doc, url): from then on a 304 there has a version to point to."""
    return first_seen(obs, ["doc", "url"], "first_at_url")


def outcomes(obs: DataFrame) -> DataFrame:
    """(seq, doc, url, hash, outcome, reason) of every observation.

    Rows with a body meet the first row of their (doc, hash) and (doc, hash, url), 304 answers the first body at their URL;
    so a 304 has no part in a join on the hash that it lacks.
    """
    body = obs.filter("hash is not null").select("seq", "doc", "url", "hash")
    for keys, name in ((["doc", "hash"], "first_version"), (["doc", "hash", "url"], "first_location")):
        body = body.join(first_seen(obs, keys, name), keys, "left")
    outcome = F.when(F.col("seq") == F.col("first_version"), NEW).when(F.col("seq") == F.col("first_location"), MOVED).otherwise(SAME)
    body = body.select("seq", "doc", "url", "hash", outcome.alias("outcome"), F.lit(None).cast("string").alias("reason"))
    answers = obs.filter("hash is null").select("seq", "doc", "url", "hash").join(known_locations(obs), ["doc", "url"], "left")
    known = F.coalesce(F.col("first_at_url") < F.col("seq"), F.lit(False))
    answers = answers.select("seq", "doc", "url", "hash", F.when(known, SAME).otherwise(FAILED).alias("outcome"), F.when(known, "NOT_MODIFIED").otherwise("HTTP_PERMANENT").alias("reason"))
    return body.unionByName(answers)


def versions(obs: DataFrame) -> DataFrame:
    """(doc, version_no, seq, hash, previous_hash, first_hash): new versions only, numbered in order of creation.

    ``first_hash`` is the first row of any document with these bytes. A document of many versions is numbered by stretches.
    """
    new = first_seen(obs, ["doc", "hash"], "seq").join(first_seen(obs, ["hash"], "first_hash"), "hash")
    out = ranks.numbered(new, ["doc"], "seq", "hash", "version_no", "previous_hash")
    return out.select("doc", "version_no", "seq", "hash", "previous_hash", "first_hash")


def alerts(obs: DataFrame) -> DataFrame:
    """(seq, doc, alerts): DUPLICATE_BYTES_OTHER_DOCUMENT first, then CONTENT_CHANGED_UNDER_STABLE_REF."""
    first_writer = obs.filter("hash is not null").groupBy("doc").agg(F.min_by("ref", "seq").alias("first_ref"))
    out = versions(obs).join(first_writer, "doc")
    duplicate = F.when(F.col("seq") > F.col("first_hash"), "DUPLICATE_BYTES_OTHER_DOCUMENT")
    changed = F.when(F.col("previous_hash").isNotNull() & F.col("first_ref").isNotNull(), "CONTENT_CHANGED_UNDER_STABLE_REF")
    raised = F.array_compact(F.array(duplicate, changed))
    return out.filter(F.size(raised) > 0).select("seq", "doc", F.array_join(raised, ",").alias("alerts"))


def resolved_304(obs: DataFrame) -> DataFrame:
    """(seq, doc, url, hash): the version a 304 stands for, the last created among those already seen at its URL.

    Places and 304 answers of a URL lie in one order, along which the last created version so far is carried; no pairs of
    answers and versions are made, and a URL of many of both is handled by stretches.
    """
    located = first_seen(obs, ["doc", "url", "hash"], "seq").join(first_seen(obs, ["doc", "hash"], "created"), ["doc", "hash"])
    located = located.select("doc", "url", "seq", F.struct("created", "hash").alias("place"))
    asked = obs.filter("hash is null").select("doc", "url", "seq", F.lit(None).cast(located.schema["place"].dataType).alias("place"))
    carried = ranks.running_max(located.unionByName(asked), ["doc", "url"], "seq", "place", "last")
    return carried.filter("place is null and last is not null").select("seq", "doc", "url", F.col("last.hash").alias("hash"))


def latest_versions(obs: DataFrame) -> DataFrame:
    return versions(obs).groupBy("doc").agg(F.max_by("hash", "seq").alias("hash"), F.max("seq").alias("seq"), F.count("*").alias("n_versions"))


def hash_history(obs: DataFrame) -> DataFrame:
    history = F.sort_array(F.collect_list(F.struct("seq", "hash")))
    return versions(obs).groupBy("doc").agg(F.array_join(F.transform(history, lambda v: F.substring(v["hash"], 1, 12)), ",").alias("hashes"))


def location_seen(obs: DataFrame) -> DataFrame:
    """(doc, hash, url, first_seen, last_seen): 304 answers move last_seen too; late rows never move it back."""
    full = obs.filter("hash is not null").select("seq", "doc", "hash", "url")
    again = resolved_304(obs).select("seq", "doc", "hash", "url")
    first = full.groupBy("doc", "hash", "url").agg(F.min("seq").alias("first_seen"))
    last = full.unionByName(again).groupBy("doc", "hash", "url").agg(F.max("seq").alias("last_seen"))
    return first.join(last, ["doc", "hash", "url"])


def fan_out_path(hash_: Column) -> Column:
    return F.concat_ws("/", F.substring(hash_, 1, 2), F.substring(hash_, 3, 2), hash_)


def artifacts(obs: DataFrame) -> DataFrame:
    """One row for each distinct body: its hash, size, first document and place in the store."""
    out = obs.filter("hash is not null").groupBy("hash").agg(F.min_by("size", "seq").alias("size"), F.min_by("doc", "seq").alias("first_doc"), F.count("*").alias("n_seen"))
    return out.withColumn("path", fan_out_path(F.col("hash")))


def duplicate_documents(obs: DataFrame) -> DataFrame:
    """(doc, hash, first_doc): documents whose bytes another document had first."""
    own = first_seen(obs, ["doc", "hash"], "seq")
    first = obs.filter("hash is not null").groupBy("hash").agg(F.min_by("doc", "seq").alias("first_doc"))
    return own.join(first, "hash").filter("doc <> first_doc").select("doc", "hash", "first_doc")


def insert_if_absent(new: DataFrame, existing: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of ``new`` whose key is not there yet, the first by ``order`` of each key; null keys are equal."""
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*new.columns), order).alias("row")).select("row.*")
    condition = [first[k].eqNullSafe(existing[k]) for k in keys]
    return first.join(existing, condition, "left_anti")


def upsert_last_seen(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Union of two location tables with first_seen minimal and last_seen maximal."""
    return existing.unionByName(new).groupBy(*keys).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def snapshot_id(obs: DataFrame, manifest_hash: str) -> DataFrame:
    """One id of a corpus: a hash over the manifest's hash, the number of documents and the sums of four parts of each
    document's digest (its key and latest version). Sums combine in any order, so no task holds more than four numbers."""
    digest = F.sha2(F.concat_ws("=", "doc", "hash"), 256)
    parts = [F.conv(F.substring(digest, k, 15), 16, 10).cast("decimal(20,0)") for k in (1, 16, 31, 46)]
    sums = latest_versions(obs).agg(F.count("*").cast("string").alias("n"), *(F.coalesce(F.sum(p).cast("string"), F.lit("0")).alias(f"p{i}") for i, p in enumerate(parts)))
    return sums.select(F.sha2(F.concat_ws(":", F.lit(manifest_hash), "n", "p0", "p1", "p2", "p3"), 256).alias("snapshot_id"))


def validators(locations: DataFrame, versions: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc, url, etag, last_modified) to ask again with, for ``asked`` (doc, url): of the versions located there the one
    retrieved last, ties by the larger id; none where it has neither.

    ``locations``: version_id, url, http_meta (a map). ``versions``: version_id, doc, retrieved_at.
    """
    rows = asked.join(locations, "url").join(versions, ["version_id", "doc"])
    last = rows.groupBy("doc", "url").agg(F.max_by("http_meta", F.struct("retrieved_at", "version_id")).alias("meta"))
    last = last.select("doc", "url", F.col("meta")["etag"].alias("etag"), F.col("meta")["last_modified"].alias("last_modified"))
    return last.filter("coalesce(etag, '') <> '' or coalesce(last_modified, '') <> ''")
