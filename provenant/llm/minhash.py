"""Near-duplicates by b-bit MinHash.

1. A document's shingle set gives 128 minima. Four at a time make 32 band keys; the low four bits of each are the
   packed signature (64 bytes). Equal sets are one class, for which its smallest doc_id stands.
2. Candidates: in every band, a class is paired with the smallest class of its key (a star, not all pairs). The
   signatures' equal nibbles, corrected for chance collisions, estimate the similarity. Pairs of at least
   ``NEAR`` join a candidate group; members below ``FAR`` meet again under the next smallest class, ``LEVELS``
   times; what a key still holds then joins the group of its smallest class whatever the estimate. By the
   triangle inequality of the Jaccard distance, two classes that share a band and link then lie in one group as long
   as their two estimates do not err by more than 0.15 between them (FAR - NEAR - 0.2), three standard errors of one; a
   link of similarity 0.8 shares 13 of the 32 keys on average, and one of them is enough.
3. Links are confirmed on full sets inside a group, block by block: first inside each block and against a few
   members of the whole group, then only between blocks whose members are not all connected yet. These blocks are cut
   by set size, and two are compared only where their sizes admit a link. A task returns a spanning forest of its
   links, never all pairs.
4. Components of the confirmed links.

With 32 bands of 4, a link of similarity 0.8 shares no band with probability 5e-8.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provenant.llm.common import documents, drop_written, few, written
from provenant.llm.components import connected
from provenant.llm.shingles import mixed, shingle_sets

BANDS, ROWS, BITS = 32, 4, 4
HASHES = BANDS * ROWS
NEAR, FAR, LEVELS = 0.35, 0.7, 3
#: Classes in a block of exact comparisons, and members of the whole group that each block is compared with first.
BLOCK, PIVOTS = 512, 32
_seeds = np.random.default_rng(20_240_101).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest of each of the hash functions over a set."""
    out = np.full(HASHES, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096]
        np.minimum(out, ((part[None, :] * _seeds[:, None]) >> np.uint64(32)).min(1), out=out)
    return out


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of the minima, as signed 64-bit words."""
    nibbles = (mixed(low) >> np.uint64(60)).reshape(-1, 64 // BITS)
    return (nibbles << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(1, dtype=np.uint64).view(np.int64)


def estimate(a: str, b: str):
    """Estimated similarity of two signature columns: equal nibbles, less those that chance makes equal."""
    differing = F.lit(0)
    for k in range(HASHES * BITS // 64):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x1111111111111111))
        differing = differing + F.bit_count(x)
    chance = 1 / (1 << BITS)
    return ((1 - differing / HASHES) - chance) / (1 - chance)


def signatures(docs: DataFrame, shingle_words: int, with_text_digest: bool = False) -> DataFrame:
    """(doc_id, n_shingles, digest, signature, bands) of each row, and the MD5 of its text where asked for."""
    schema = "doc_id long, n_shingles long, digest binary, signature array<long>, bands array<long>" + ", text_digest string" * with_text_digest
    band_number = np.arange(BANDS, dtype=np.uint64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, sigs, bands = [], [], [], []
            for s in shingle_sets(batch.column(1), shingle_words):
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                if not len(s):
                    sigs.append(None)
                    bands.append(None)
                    continue
                low = minima(s)
                keys = band_number.copy()
                for row in low.reshape(BANDS, ROWS).T:
                    keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + row)
                sigs.append(packed(low))
                bands.append(keys.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64())), *batch.columns[2:]],
                ["doc_id", "n_shingles", "digest", "signature", "bands", *batch.schema.names[2:]],
            )

    return docs.select("doc_id", "text", *[F.md5("text").alias("text_digest")] * with_text_digest).mapInArrow(sign, schema)


def distinct_sets(real: DataFrame, *keys: str) -> DataFrame:
    """(keys, node, signature, bands) of each set of ``real``: node is the smallest doc_id that has it. Equal ``keys`` are
    equal sets, and so are their signatures and bands."""
    return real.groupBy(*keys).agg(F.min("doc_id").alias("node"), *[F.first(c).alias(c) for c in ("signature", "bands")])


def candidate_groups(spark: SparkSession, classes: DataFrame) -> DataFrame:
    """(node, label): candidate groups of ``classes`` (node, signature, bands), a written table.

    A level is one written table: a row for each pair of a class and a hub, with the keys that they share (one of each
    band at most), which the next level takes up again.
    """
    members = classes.select("node", F.explode("bands").alias("key"))
    sigs = classes.select("node", "signature")
    levels, near = [], []
    for level in range(LEVELS + 1):
        hubs = members.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
        pairs = members.join(hubs, "key").filter("node <> hub")
        if level < LEVELS:
            pairs = pairs.groupBy("node", "hub").agg(F.collect_set("key").alias("keys")).join(sigs, "node")
            pairs = pairs.join(sigs.select(F.col("node").alias("hub"), F.col("signature").alias("other")), "hub")
            pairs = pairs.select("node", "hub", "keys", estimate("signature", "other").alias("similar"))
        else:
            pairs = pairs.select("node", "hub").distinct()
        pairs = written(spark, pairs)
        levels.append(pairs)
        if not pairs.limit(1).count():
            break
        near.append((pairs.filter(F.col("similar") >= NEAR) if level < LEVELS else pairs).select(F.col("node").alias("a"), F.col("hub").alias("b")))
        if level < LEVELS:
            members = pairs.filter(F.col("similar") < FAR).select("node", F.explode("keys").alias("key"))
    groups = connected(spark, functools.reduce(DataFrame.unionByName, near)) if near else spark.createDataFrame([], "node long, label long")
    drop_written(spark, *levels)
    return groups


class Union:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets: products of 0/1 matrices over the hashes that both sides hold."""
    a, b = np.concatenate(left), np.concatenate(right)
    columns = np.intersect1d(a, b)
    row_a, row_b = np.repeat(np.arange(len(left)), list(map(len, left))), np.repeat(np.arange(len(right)), list(map(len, right)))
    out = np.zeros((len(left), len(right)), np.float32)
    at_a, at_b = np.searchsorted(columns, a), np.searchsorted(columns, b)
    in_a, in_b = (at_a < len(columns)), (at_b < len(columns))
    in_a[in_a] = columns[at_a[in_a]] == a[in_a]
    in_b[in_b] = columns[at_b[in_b]] == b[in_b]
    at_a, row_a, at_b, row_b = at_a[in_a], row_a[in_a], at_b[in_b], row_b[in_b]
    width = 4096
    order_a, order_b = np.argsort(at_a // width, kind="stable"), np.argsort(at_b // width, kind="stable")
    at_a, row_a, at_b, row_b = at_a[order_a], row_a[order_a], at_b[order_b], row_b[order_b]
    for start in range(0, len(columns), width):
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        lo, hi = np.searchsorted(at_a // width, [start // width, start // width + 1])
        x[row_a[lo:hi], at_a[lo:hi] - start] = 1
        lo, hi = np.searchsorted(at_b // width, [start // width, start // width + 1])
        y[row_b[lo:hi], at_b[lo:hi] - start] = 1
        out += x @ y.T
    return out


def forest(left: pa.Table, right: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between the rows of two tables (node, label, shingles); equal labels are connected."""
    nodes = left.column("node").to_pylist() + right.column("node").to_pylist()
    labels = left.column("label").to_pylist() + right.column("label").to_pylist()
    union, first, edges = Union(len(nodes)), {}, []
    for i, label in enumerate(labels):
        union.join(first.setdefault(label, i), i)
    sets = lambda t: [np.frombuffer(x.as_py(), np.uint64) for x in t.column("shingles")]
    a, b = sets(left), sets(right)
    for lo in range(0, len(a), 256):  # parts of bounded size
        part = a[lo : lo + 256]
        for lo_b in range(0, len(b), 256):
            other = b[lo_b : lo_b + 256]
            both = shared_counts(part, other)
            size = np.array(list(map(len, part)))[:, None] + np.array(list(map(len, other)))[None, :]
            for i, j in zip(*np.nonzero((both > 0) & (100 * both >= percent * (size - both))), strict=True):
                if union.join(lo + int(i), len(a) + lo_b + int(j)):
                    edges.append((nodes[lo + int(i)], nodes[len(a) + lo_b + int(j)]))
    return edges


def exact_links(left: DataFrame, right: DataFrame | None, percent: int) -> DataFrame:
    """Edges (a, b) that connect what is linked between the rows of both tables of the same job, or within ``left`` alone."""

    def compare(x: pa.Table, y: pa.Table) -> pa.Table:
        found = forest(x, y, percent) if len(x) and len(y) else []
        return pa.table({"a": pa.array([p for p, _ in found], pa.int64()), "b": pa.array([q for _, q in found], pa.int64())})

    def within(x: pa.Table) -> pa.Table:
        return compare(x, x)

    left, right = (t and t.select("job", "node", "label", "shingles").toDF("job", "node", "label", "shingles") for t in (left, right))
    if right is None:
        return left.groupBy("job").applyInArrow(within, "a long, b long")
    return left.groupBy(left["job"]).cogroup(right.groupBy(right["job"])).applyInArrow(compare, "a long, b long")


def confirmed_components(spark: SparkSession, sets: DataFrame, percent: int) -> DataFrame:
    """(node, label) of the linked ones of ``sets`` (node, label, shingles), where label is the candidate group at first.

    A node that no link confirms is in no row.
    """
    # Only the sizes of groups of several blocks are joined: they are few, and a hot group's sets stay where they are.
    sizes = sets.groupBy(F.col("label").alias("grp")).agg(F.count("*").alias("m")).filter(F.col("m") > BLOCK)
    sizes = written(spark, sizes.withColumn("blocks", F.ceil(F.col("m") / BLOCK)))
    several = sizes.limit(1).count() > 0
    blocked = sets.withColumnRenamed("label", "grp").withColumn("label", F.col("node"))
    blocked = blocked.join(few(sizes), "grp", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))) if several else blocked.withColumn("blocks", F.lit(1))
    blocked = blocked.withColumn("blk", F.pmod(F.xxhash64("node"), "blocks"))
    cols = ["node", "label", "shingles"]
    job = F.xxhash64("grp", "blk").alias("job")
    edges = exact_links(blocked.select(job, *cols), None, percent)
    if several:
        parts = blocked.filter("blocks > 1")
        pivots = parts.filter(F.pmod(F.xxhash64("node", F.lit(1)), "m") < PIVOTS).withColumn("blk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        edges = edges.unionByName(exact_links(parts.select(job, *cols), pivots.select(job, *cols), percent))
    edges = written(spark, edges)
    labels = connected(spark, edges)

    if not several:
        drop_written(spark, edges, sizes)
        return labels

    # Groups of several blocks: compare what is not connected yet. A block holds sets of about one size (a band is as
    # wide as the sizes of a link may differ), of one large label or of many small ones.
    size = F.expr("octet_length(shingles) div 8")
    band = F.floor(F.log(size) / max(math.log(100 / percent), 0.05))
    big = blocked.filter("blocks > 1").select("grp", "node", "shingles", band.alias("band"))
    big = big.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    counts = big.groupBy("grp", "band", "label").agg(F.count("*").alias("m"))
    counts = written(spark, counts)
    large = counts.filter(F.col("m") > BLOCK // 2).select("grp", "band", "label", F.col("label").alias("large"), F.ceil(F.col("m") / BLOCK).alias("parts"))
    rest = counts.filter(F.col("m") <= BLOCK // 2).groupBy("grp", "band").agg(F.sum("m").alias("rest"))
    big = big.join(few(large), ["grp", "band", "label"], "left").join(few(rest), ["grp", "band"], "left")
    place = F.when(F.col("large").isNull(), F.pmod(F.xxhash64("label"), F.ceil((F.col("rest") + 1) / BLOCK))).otherwise(F.lit(-1))
    part = F.when(F.col("large").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("node", F.lit(2)), "parts"))
    big = written(spark, big.withColumn("blk", F.xxhash64("large", "band", place, part)).select("grp", "node", "shingles", "label", "large", "blk"))
    blocks = big.groupBy("grp", "blk", "large").agg(F.min(size).alias("least"), F.max(size).alias("most"))
    other = blocks.select("grp", *[F.col(c).alias(f"{c}2") for c in ("blk", "large", "least", "most")])
    can_link = (100 * F.col("most") >= percent * F.col("least2")) & (100 * F.col("most2") >= percent * F.col("least"))
    jobs = blocks.join(other, "grp").filter((F.col("blk") <= F.col("blk2")) & can_link & ~F.coalesce(F.col("large") == F.col("large2"), F.lit(False)))
    jobs = jobs.select("grp", "blk", "blk2", F.xxhash64("grp", "blk", "blk2").alias("job"))
    left = big.join(jobs.select("grp", "blk", "job"), ["grp", "blk"]).select("job", *cols)
    right = big.join(jobs.select("grp", F.col("blk2").alias("blk"), "job"), ["grp", "blk"]).select("job", *cols)
    more = written(spark, exact_links(left, right, percent).unionByName(edges))
    drop_written(spark, edges, sizes, counts, big, labels)
    found = connected(spark, more)
    drop_written(spark, more)
    return found


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle_words: int = 5, percent: int = 80, with_text_digest: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text).

    Defined results: a null, empty or blank text has an empty set and links to nothing, so it is kept; a null
    doc_id has no component and is kept; rows that share a doc_id are one document in the links and one row each
    in the result; the smallest doc_id of a component is kept, so ties cannot arise; further columns are not read;
    an empty table gives an empty table; a text's set is made of the whole text. ``with_text_digest`` adds the MD5 of
    each row's text, which tells the rows of a repeated doc_id apart.
    """
    signed = written(spark, signatures(docs, shingle_words, with_text_digest))
    real = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = written(spark, distinct_sets(real, "digest", "n_shingles"))
    groups = candidate_groups(spark, classes)

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column(2), shingle_words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], ["node", "label", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(groups, "node").select("node", "label", "text")
    sets = written(spark, texts.mapInArrow(to_sets, "node long, label long, shingles binary").filter(F.octet_length("shingles") > 0))
    labels = confirmed_components(spark, sets, percent)
    drop_written(spark, sets)
    found = classes.select("digest", "n_shingles", "node").join(labels, "node", "left").select("digest", "n_shingles", F.coalesce("label", "node").alias("component_id"))
    more = ["text_digest"] * with_text_digest
    out = signed.select("doc_id", "n_shingles", "digest", *more).join(found, ["digest", "n_shingles"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), *more).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, documents(spark, sf_dir), shingle_words=2)  # the query's contract
