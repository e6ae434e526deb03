"""MinHash fingerprints of documents, their likeness, and classes of near-duplicates.

A fingerprint holds a byte for each of 128 universal hash permutations of the 32-bit numbers (``a * x + b`` with odd a): the
minimum over the shingles' hashes, folded to a byte. Equal bytes, less those that chance makes equal, estimate the
Jaccard similarity; the standard error is below 0.045.

Near-duplicates: four minima at a time are a band's key. Spark joins the documents of a band's key as stars around the
smallest, and similarity is verified on the full shingle sets (:func:`near_classes`).

The text that follows a document in the order of ids (:func:`with_next`): ids alone are range-partitioned to find where
parts begin. Texts then go to their part once, packed, and the first document of a part also to the part before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provenant.llm.blocks import NO_ID, squeeze, unsqueeze
from provenant.llm.common import documents, drop_written, few, written
from provenant.llm.minhash import BANDS, ROWS, candidate_groups, confirmed_components, distinct_sets, packed
from provenant.llm.shingles import MIX, mixed, shingle_sets, text_bytes

PERMUTATIONS = 128
#: Text of a part of the id order, about; the driver and each worker hold 12 bytes for each part (300 MB at 100 TB).
PART_BYTES = 4 << 20
_random = np.random.default_rng(12)
_a = _random.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_b = _random.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each permutation over a set of 64-bit hashes."""
    x = (mixed(shingles) >> np.uint64(32)).astype(np.uint32)
    out = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(out, (x[None, at : at + 2048] * _a[:, None] + _b[:, None]).min(1), out=out)
    return out


def folded(low: np.ndarray) -> np.ndarray:
    """A byte of each minimum."""
    return ((low.astype(np.uint64) * MIX) >> np.uint64(56)).astype(np.uint8)


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Estimated similarity of two fingerprints, 0 to 1; None is the fingerprint of a text without words."""
    if a is None or b is None:
        return float(a is b)
    equal = float((a == b).mean())
    return max(0.0, (equal - 1 / 256) / (1 - 1 / 256))


def band_keys(low: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in low.astype(np.uint64).reshape(BANDS, ROWS).T:
        keys = mixed(keys * MIX + row)
    return keys.view(np.int64)


@dataclass
class Signed:
    """What is known of the shingle sets of some texts, in order; minima are None where a text has no words."""

    low: list[np.ndarray | None]
    sizes: list[int]
    digests: list[bytes]

    @classmethod
    def of(cls, texts: pa.Array, shingle_words: int) -> Signed:
        out = cls([], [], [])
        for s in shingle_sets(texts, shingle_words):
            out.low.append(minima(s) if len(s) else None)
            out.sizes.append(len(s))
            out.digests.append(xxhash.xxh3_128_digest(s.tobytes()))
        return out

    def prints(self) -> list[np.ndarray | None]:
        return [None if x is None else folded(x) for x in self.low]


def as_hex(p: np.ndarray | None) -> str:
    return "" if p is None else p.tobytes().hex()


SIGNED = "n_shingles long, digest binary, signature array<long>, bands array<long>"


def signed_columns(signed: Signed) -> list[pa.Array]:
    longs = pa.list_(pa.int64())
    return [
        pa.array(signed.sizes, pa.int64()), pa.array(signed.digests, pa.binary()),
        pa.array([None if x is None else packed(x.astype(np.uint64)) for x in signed.low], longs), pa.array([None if x is None else band_keys(x) for x in signed.low], longs),
    ]


def fingerprints(docs: DataFrame, shingle_words: int = 5) -> DataFrame:
    """(doc_id, fingerprint, n_shingles, digest, signature, bands) of each row of ``docs`` (doc_id, text), in one scan.

    Defined results: a null, empty or blank text has the empty fingerprint; a text of fewer words than a shingle is one
    shingle; A-Z count as a-z; equal texts have equal fingerprints; repeated rows and null ids come back each; texts are
    taken whole; further columns are not read; an empty table gives an empty table.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = Signed.of(batch.column(1), shingle_words)
            columns = [batch.column(0), pa.array(map(as_hex, signed.prints()), pa.string()), *signed_columns(signed)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fingerprint", "n_shingles", "digest", "signature", "bands"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(sign, f"doc_id long, fingerprint string, {SIGNED}")


def near_classes(spark: SparkSession, docs: DataFrame, signed: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, digest, class_id) of the documents that are near a smaller one: class_id is the smallest id reachable by links.

    ``signed`` is a written table with the columns of :func:`fingerprints`. Equal sets are one class with the smallest id
    as its representative; representatives that share a band's key become candidates, and their similarity is verified on
    full sets. Documents without words or id are in no class.
    """
    real = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = written(spark, distinct_sets(real, "digest"))
    groups = candidate_groups(spark, classes)

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column(2), shingle_words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], ["node", "label", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(few(groups), "node").select("node", "label", "text")
    sets = written(spark, texts.mapInArrow(to_sets, "node long, label long, shingles binary").filter(F.octet_length("shingles") > 0))
    labels = confirmed_components(spark, sets, percent)
    found = classes.select("digest", "node").join(labels, "node", "left").select("digest", F.coalesce("label", "node").alias("class_id"))
    found = written(spark, real.select("doc_id", "digest").distinct().join(found, "digest").filter("class_id <> doc_id"))
    drop_written(spark, classes, sets)
    return found


@dataclass
class Parts:
    """Parts of the id order: the smallest id of each, and into how many pieces its rows are dealt (more than one only
    where they share one id). Null ids are a part of their own at the end, where there are any."""

    firsts: np.ndarray
    pieces: np.ndarray
    null_pieces: int

    def count(self) -> int:
        return len(self.firsts) + (self.null_pieces > 0)


def id_parts(spark: SparkSession, docs: DataFrame, part_bytes: int) -> Parts:
    """Parts of about ``part_bytes`` of text, from the ids alone."""
    n, n_bytes = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    rows = max(1, n * part_bytes // max(n_bytes, 1))  # of a part
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    known = ids.filter("doc_id is not null")

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(range(-seen % rows, len(batch), rows), pa.int64()))], ["doc_id"])
            seen += len(batch)

    even = known.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(starts, "doc_id long")
    hot = known.groupBy("doc_id").agg(F.count("*").alias("n")).filter(F.col("n") > rows)  # n / rows of them at most
    even, hot = (x.select("doc_id").toArrow().column(0).to_numpy() for x in (even, hot))
    bounds = np.unique(np.concatenate([even, hot, hot[hot < NO_ID] + 1]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.searchsorted(bounds, batch.column(0).to_numpy(), "right")
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), batch.column(0)], ["part", "doc_id"])

    placed = known.mapInArrow(place, "part long, doc_id long").groupBy("part").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n"))
    placed = placed.toArrow().sort_by("a")
    a, b, n = (placed.column(c).to_numpy() for c in ("a", "b", "n"))
    nulls = ids.filter("doc_id is null").count()
    return Parts(a, np.where(a == b, -(-n // rows), 1).astype(np.int32), -(-nulls // rows))


OWN, NEXT = 0, 1


def with_next(spark: SparkSession, docs: DataFrame, answer, schema: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """``answer(ids, texts, next_texts)`` for the rows of ``docs`` (doc_id, text), a part at a time, as an Arrow table.

    The next text is that of the next greater id, of the first id after the last one; null ids come last, as one id. Where
    rows share an id, the smallest of their texts (as bytes) is the next text for the id before, and all have the same.
    """
    parts = id_parts(spark, docs, part_bytes)
    shared = spark.sparkContext.broadcast(parts)  # 12 bytes for each part

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, dealt = shared.value, 0
        n, last = len(parts.firsts), parts.count() - 1
        pieces = np.append(parts.pieces, parts.null_pieces)
        for batch in batches:
            ids = batch.column(0)
            null = ~ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
            data, offsets = text_bytes(batch.column(1))
            text = lambda i: data[offsets[i] : offsets[i + 1]].tobytes()  # noqa: B023, E731
            part = np.where(null, n, np.searchsorted(parts.firsts, ids, "right") - 1)
            piece = (np.arange(len(ids)) + dealt) % pieces[part]
            dealt += len(ids)
            goes: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
            for i, key in enumerate(zip(part.tolist(), piece.tolist(), strict=True)):
                goes.setdefault(key, ([], []))[OWN].append(i)
            # The smallest text of a part's first id, for all pieces of the part before.
            first: dict[int, int] = {}
            for i in np.flatnonzero(null | (ids == parts.firsts[np.minimum(part, n - 1)] if n else null)).tolist():
                p = int(part[i])
                if p not in first or text(i) < text(first[p]):
                    first[p] = i
            for p, i in first.items():
                before = p - 1 if p else last
                for k in range(int(pieces[before])):
                    goes.setdefault((before, k), ([], []))[NEXT].append(i)
            for (p, k), (own, following) in goes.items():
                rows = np.array(own + following, np.int64)
                sizes = np.diff(offsets)[rows]
                payload = squeeze(ids[rows], null[rows].astype("u1"), np.repeat([OWN, NEXT], [len(own), len(following)]).astype("u1"), sizes, b"".join(text(i) for i in rows.tolist()))
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([k], pa.int64()), pa.array([payload], pa.binary())], ["part", "piece", "payload"])

    def join(table: pa.Table) -> pa.Table:
        rows = []
        for payload in table.column("payload"):
            ids, null, kind, sizes, data = unsqueeze(payload.as_py(), "<i8", "u1", "u1", "<i8", "b")
            ends = np.cumsum(sizes)
            rows += [(k, x, i, data[e - s : e]) for k, x, i, s, e in zip(kind.tolist(), null.tolist(), ids.tolist(), sizes.tolist(), ends.tolist(), strict=True)]
        rows.sort(key=lambda r: r[:3])
        own = [r[1:] for r in rows if r[0] == OWN]
        following = min((r[3] for r in rows if r[0] == NEXT), default=b"")
        after: list[bytes] = [b""] * len(own)
        smallest = following
        for k in range(len(own) - 1, -1, -1):  # from the last; rows of one id stand together
            after[k] = smallest if k == len(own) - 1 or own[k][:2] != own[k + 1][:2] else after[k + 1]
            here = own[k][2]
            least = min(least, here) if k < len(own) - 1 and own[k][:2] == own[k + 1][:2] else here
            if not k or own[k - 1][:2] != own[k][:2]:
                smallest = least
        return answer(pa.array([None if x else i for x, i, _ in own], pa.int64()), [t for *_, t in own], after)

    packed_rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(deal, "part long, piece long, payload binary")
    return packed_rows.groupBy("part", "piece").applyInArrow(join, schema)


EDITED = "doc_id long, n_chars long, edited_sha256 string, print binary, edited_print binary, near_edited double, near_next double, " + SIGNED


def edited_fingerprints(spark: SparkSession, docs: DataFrame, shingle_words: int = 5, part_bytes: int = PART_BYTES) -> DataFrame:
    """What :data:`EDITED` lists for each row of ``docs``: its fingerprint, that of its edited text, and two likenesses.

    The edited text keeps the first half of the code points (the larger one); the rest gives way to the first as many of
    the next text, see :func:`with_next`. A null text is empty; two texts without words are alike (1).
    """

    def answer(ids: pa.Array, texts: list[bytes], after: list[bytes]) -> pa.Table:
        edited, lengths = [], []
        for text, following in zip(texts, after, strict=True):
            whole = text.decode()
            n = len(whole)
            lengths.append(n)
            edited.append((whole[: n - n // 2] + following[: 4 * (n // 2)].decode(errors="ignore")[: n // 2]).encode())
        own, other = (Signed.of(pa.array(t, pa.large_binary()), shingle_words) for t in (texts, edited))
        prints, edited_prints = own.prints(), other.prints()
        known = {t: p for t, p in zip(texts, prints, strict=True)}
        missing = list({t for t in after if t not in known})
        known |= dict(zip(missing, Signed.of(pa.array(missing, pa.large_binary()), shingle_words).prints(), strict=True))
        columns = [
            ids, pa.array(lengths, pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in edited], pa.string()),
            *(pa.array([b"" if p is None else p.tobytes() for p in x], pa.binary()) for x in (prints, edited_prints)),
            *(pa.array(map(likeness, prints, x), pa.float64()) for x in (edited_prints, [known[t] for t in after])), *signed_columns(own),
        ]
        return pa.table(columns, [f.split()[0] for f in EDITED.split(", ")])

    return with_next(spark, docs, answer, EDITED, part_bytes)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract's columns, and n_shingles and class_id: the smallest doc_id that verified links of near-duplicates reach."""
    docs = documents(spark, sf_dir)
    signed = written(spark, edited_fingerprints(spark, docs))
    near = few(near_classes(spark, docs, signed))
    out = signed.join(near, ["doc_id", "digest"], "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    prints = [F.lower(F.hex(c)).alias(n) for c, n in (("print", "fingerprint"), ("edited_print", "edited_fingerprint"))]
    return out.select("doc_id", "n_chars", "edited_sha256", *prints, "near_edited", "near_next", "n_shingles", "class_id")
