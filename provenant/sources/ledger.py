"""Ledger tables as append-only Parquet: fixed schemas, deterministic ids, idempotent appends, content-addressed blobs.

A table is a commit log (:mod:`provenant.sources.commits`): a batch is visible as a whole or not at all, a batch that is
written again adds nothing, and of two writers of the same version one is refused. Rows are partitioned by their key, so
that an append reads the keys of the partitions that it touches and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provenant.sources import commits
from provenant.sources.commits import ConflictError

OBSERVATIONS = T.StructType([T.StructField("seq", T.LongType()), *(T.StructField(n, T.StringType()) for n in ("doc", "url", "ref", "hash")), T.StructField("size", T.LongType())])
LOCATIONS = T.StructType([*(T.StructField(n, T.StringType()) for n in ("doc", "hash", "url")), *(T.StructField(n, T.LongType()) for n in ("first_seen", "last_seen"))])
BLOBS = T.StructType([T.StructField("hash", T.StringType()), T.StructField("body", T.BinaryType()), T.StructField("prefix", T.StringType())])
SCHEMA_VERSION = 1


def natural_id(*columns: str) -> Column:
    """An id that follows from the natural key, so that a second run makes the same one."""
    return F.sha2(F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in columns))), 256)


#: The one table of a folder, and the buckets of keys that it is partitioned by.
ROWS, BUCKETS = "rows", 64


def read_table(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The rows of a ledger table; no rows where it does not exist yet."""
    return commits.read(spark, path, ROWS, version, schema=schema)


def append(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], batch: int, order: str | None = None, by: str | None = None) -> DataFrame:
    """Append the rows whose key is new, the first by ``order`` of equal keys, as batch ``batch``; returns them.

    ``by`` is a column that follows from the key; without one, rows are partitioned by a hash of the key.
    """
    columns, by = rows.columns, by or commits.BUCKET
    now = commits.state(spark, path)
    if str(batch) not in now.tokens:
        rows = rows.withColumn(by, commits.bucket(keys, BUCKETS)) if by == commits.BUCKET else rows
        fresh = commits.fresh(spark, path, ROWS, rows, keys, by, order)
        commits.commit(spark, path, str(batch), {ROWS: fresh}, {ROWS: by}, now.version)
    return commits.added(spark, path, ROWS, str(batch)).select(*columns)


def append_audit(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], batch: int, violations: DataFrame) -> DataFrame:
    """Append audit rows, unless some of them break a rule (``violations``) or repeat a key of this batch."""
    broken = violations.unionByName(rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*keys), allowMissingColumns=True)
    if found := broken.limit(1).collect():
        raise ConflictError(f"audit rows are refused, for example {found[0].asDict()}")
    return append(spark, path, rows, keys, batch)


def put_blobs(spark: SparkSession, path: str, bodies: DataFrame, batch: int) -> DataFrame:
    """Store bodies (body) once by their hash, in folders by its first two digits.

    Stored bodies of the same hash must have it; those of other hashes, and folders of other digits, are not read.
    """
    rows = bodies.select(F.sha2("body", 256).alias("hash"), "body").withColumn("prefix", F.substring("hash", 1, 2))
    touched = [r.prefix for r in rows.select("prefix").distinct().collect()]  # 256 at most
    again = commits.read(spark, path, ROWS, values=touched, schema=BLOBS).join(rows.select("hash").distinct(), "hash", "left_semi")
    if found := again.filter(F.sha2("body", 256) != F.col("hash")).select("hash").limit(1).collect():
        raise ConflictError(f"the stored bytes of {found[0]['hash']} are not those of their hash")
    return append(spark, path, rows, ["hash"], batch, order="hash", by="prefix")


def put_quarantined(spark: SparkSession, path: str, quarantine: str, bodies: DataFrame, batch: int) -> DataFrame:
    """Store bodies that were refused, in a store of their own that neither holds nor lies in the other."""
    a, b = (p.rstrip("/") + "/" for p in (path, quarantine))
    if a.startswith(b) or b.startswith(a):
        raise ConflictError("the stores of admitted and refused bodies must be apart")
    return put_blobs(spark, quarantine, bodies, batch)


def stored(rows: DataFrame, blobs: DataFrame) -> DataFrame:
    """Rows whose hash the store holds."""
    return rows.join(blobs.select("hash"), "hash", "left_semi")


def schema_drift(applied: DataFrame, files: DataFrame) -> DataFrame:
    """(version, state) of schema versions (version, checksum): PENDING, MISSING, CHANGED or APPLIED."""
    a, f = applied.select("version", F.col("checksum").alias("was")), files.select("version", F.col("checksum").alias("is"))
    state = F.when(F.col("was").isNull(), "PENDING").when(F.col("is").isNull(), "MISSING").when(F.col("was") != F.col("is"), "CHANGED").otherwise("APPLIED")
    return a.join(f, "version", "full_outer").select("version", state.alias("state"))


def time_ordered_id(millis: Column, *columns: str) -> Column:
    """A UUID of version 7 whose random part follows from the natural key: ordered by time, the same in every run."""
    h = natural_id(*columns)
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 4, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    t = F.lpad(F.lower(F.hex(millis)), 12, "0")
    return F.concat_ws("-", F.substring(t, 1, 8), F.substring(t, 9, 4), F.concat(F.lit("7"), F.substring(h, 1, 3)), F.concat(variant, F.substring(h, 5, 3)), F.substring(h, 8, 12))


def listing_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(canonical_url, change) between two listings (canonical_url, hash)."""
    from provenant.operators.temporal import version_diff

    return version_diff(old, new, "canonical_url", "hash")
