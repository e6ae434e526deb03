"""Captured responses: content decoding and hashing of bodies, the read side of blobs."""

from __future__ import annotations

import hashlib
import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provenant.operators.slices import by_slices

CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9._:-]{1,40})", re.IGNORECASE)
DECODED = T.StructType([T.StructField("body", T.BinaryType()), T.StructField("hash", T.StringType()), T.StructField("problem", T.StringType())])


def decoded(encoding: str | None, wire: bytes | None, max_bytes: int) -> tuple[bytes | None, str | None, str | None]:
    """(body, hash, problem) of a body as it was sent; never more than ``max_bytes`` are expanded."""
    kind = (encoding or "identity").strip().lower()
    if wire is None or kind not in ("identity", "gzip", "x-gzip", "deflate"):
        return None, None, None if wire is None else "CONTENT_TYPE_MISMATCH"
    if kind == "identity":
        body = wire
    else:
        body = None
        for bits in (31,) if "gzip" in kind else (15, -15):
            stream = zlib.decompressobj(bits)
            try:
                body = stream.decompress(wire, max_bytes + 1)
            except zlib.error:
                continue
            if len(body) <= max_bytes and not stream.eof:
                return None, None, "PDF_SANITY_FAILED"
            break
        if body is None:
            return None, None, "PDF_SANITY_FAILED"
    if len(body) > max_bytes:
        return None, None, "SIZE_EXCEEDED"
    return body, hashlib.sha256(body).hexdigest(), None


def decoded_bodies(responses: DataFrame, max_bytes: int) -> DataFrame:
    """``responses`` (encoding, wire) with body, hash and problem."""

    @by_slices(DECODED)
    def decode(encodings: list, wires: list) -> list:
        return [dict(zip(DECODED.names, decoded(e, w, max_bytes), strict=True)) for e, w in zip(encodings, wires, strict=True)]

    out = responses.withColumn("_decoded", decode("encoding", "wire"))
    return out.select(*responses.columns, "_decoded.*")


@by_slices(T.StringType())
def html_text(bodies: list, content_types: list) -> list:
    """Text of a page in its declared charset, UTF-8 if none; null where it cannot be decoded strictly."""

    def one(body, kind):
        declared = CHARSET.search(kind or "")
        charset = declared[1] if declared else "utf-8"
        try:
            if body == b"":
                "".encode(charset)  # bytes.decode does not look up the charset of an empty body
            return body.decode(charset) if body is not None else None
        except (LookupError, UnicodeError):
            return None

    return [one(b, k) for b, k in zip(bodies, content_types, strict=True)]


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder as (path, body, hash). The scan passes over files without a byte: an empty answer has no body to read."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("content").alias("body"), F.sha2("content", 256).alias("hash"))
