"""Blocks of documents and the exchange of distinct keys between them.

Some operators need, for every key of a corpus (a word, a k-mer), one fact that depends on all documents. A row
per occurrence would shuffle many times the input. Here a scan task packs some MB of documents into a *block*
and sends each key that the block holds once, packed with the others that go to the same bucket. A bucket
decides about its keys and answers each block in the order in which that block listed them.

* A bucket sees a key once per block at most, however often it occurs, so a hot key is no hot group.
* Buckets grow in number with the input (:func:`bucket_count`), not in size.
* Blocks are written to the shared folder first, so every later pass sees the same ones, and a lost executor
  costs a re-read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provenant.llm.common import written
from provenant.llm.shingles import text_bytes

#: Stands for a null doc_id where documents are ordered: it counts as the largest id there is. ``Docs.valid`` tells them apart.
NO_ID = np.iinfo(np.int64).max


@dataclass
class Docs:
    """The documents of a block: ids, their UTF-8 texts end to end, and which ids are not null."""

    ids: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    valid: np.ndarray

    def doc_ids(self) -> list[int | None]:
        return [i if v else None for i, v in zip(self.ids.tolist(), self.valid.tolist(), strict=True)]

    def texts(self) -> Iterator[bytes]:
        raw = self.data.tobytes()
        for a, b in zip(self.offsets[:-1], self.offsets[1:], strict=True):
            yield raw[a:b]


def squeeze(*arrays: np.ndarray | bytes, level: int = 3) -> bytes:
    """Arrays as one compressed binary."""
    parts = [a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes() for a in arrays]
    head = struct.pack(f"<I{len(parts)}Q", len(parts), *map(len, parts))
    return zstandard.ZstdCompressor(level=level).compress(head + b"".join(parts))


def unsqueeze(blob: bytes, *types: str) -> list:
    """The arrays of :func:`squeeze`; type ``b`` stands for bytes."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    (n,) = struct.unpack_from("<I", raw)
    sizes, at, out = struct.unpack_from(f"<{n}Q", raw, 4), 4 + 8 * n, []
    for size, kind in zip(sizes, types, strict=True):
        part = raw[at : at + size]
        out.append(part if kind == "b" else np.frombuffer(part, kind))
        at += size
    return out


def blocks_of(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[Docs]:
    """Arrow batches of (doc_id, text) cut into blocks of about ``block_bytes``, one document at least."""
    for batch in batches:
        ids = batch.column(0).cast(pa.int64())
        valid = ids.is_valid().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
        data, offsets = text_bytes(batch.column(1))
        start = 0
        while start < len(ids):
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + block_bytes, "right")) - 1)
            yield Docs(ids[start:end], data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start], valid[start:end])
            start = end


def packed_block(block: Docs) -> bytes:
    return squeeze(block.ids, block.offsets, block.data, block.valid.astype("u1"))


def unpacked_block(payload: bytes) -> Docs:
    ids, offsets, data, valid = unsqueeze(payload, "<i8", "<i8", "u1", "u1")
    return Docs(ids, data, offsets, valid.astype(bool))


def written_blocks(spark: SparkSession, docs: DataFrame, block_bytes: int) -> DataFrame:
    """Table (block, raw_bytes, payload) of the rows of ``docs`` (doc_id, text)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = block_ids()
        for block in blocks_of(batches, block_bytes):
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (next(ids), len(block.data), packed_block(block))], ["block", "raw_bytes", "payload"])

    return written(spark, docs.select("doc_id", "text").mapInArrow(pack, "block long, raw_bytes long, payload binary"))


#: What a block asks a bucket.
REQUEST = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("request", pa.binary())])


def block_ids() -> Iterator[int]:
    """Ids that no other task of the same scan gives, the same in each attempt of a task."""
    first = TaskContext.get().partitionId() << 32
    while True:
        yield first
        first += 1


def bucket_count(raw_bytes: int, bucket_bytes: int = 16 << 20) -> int:
    """Buckets for so much text: each stays about as large however much there is."""
    return max(16, -(-raw_bytes // bucket_bytes))


def by_bucket(buckets: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of the items by bucket, and where each bucket starts in it."""
    order = np.argsort(buckets, kind="stable")
    return order, np.searchsorted(buckets[order], np.arange(n_buckets + 1))


def exchange(requests: DataFrame, n_buckets: int, answer) -> DataFrame:
    """Answers (block, bucket, reply) of ``answer(list of blobs) -> list of replies`` to (bucket, block, request)."""

    def one_bucket(table: pa.Table) -> pa.Table:
        blocks = table.column("block")
        replies = answer([x.as_py() for x in table.column("request")])
        keep = [i for i, x in enumerate(replies) if x is not None]
        return pa.table({
            "block": blocks.take(pa.array(keep, pa.int64())),
            "bucket": table.column("bucket").take(pa.array(keep, pa.int64())),
            "reply": pa.array([replies[i] for i in keep], pa.binary()),
        })

    return requests.groupBy("bucket").applyInArrow(one_bucket, "block long, bucket int, reply binary")


def raw_bytes(blocks: DataFrame) -> int:
    """Text bytes of a table of blocks (one number, from a column of their table)."""
    return blocks.agg(F.coalesce(F.sum("raw_bytes"), F.lit(0))).first()[0]


def planes(values: np.ndarray, width: int = 4) -> list[np.ndarray]:
    """Unsigned numbers as planes of bytes: where most are small, the upper planes compress to little."""
    return list(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)


def unplaned(parts: list[np.ndarray]) -> np.ndarray:
    width = len(parts)
    return np.stack(parts, 1).reshape(-1).view(f"<u{width}").astype(np.int64 if width < 8 else np.uint64)
