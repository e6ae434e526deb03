"""Byte-level BPE by a global shuffle of distinct words.

1. Each block of documents is cut into pre-tokens. The block keeps them exploded as positions: for every
   position the number of its word in the block's own list of distinct words.
2. Each block sends its distinct words to buckets by hash; a bucket encodes every word once, for all blocks.
3. The ids come back to the block and are joined to the positions, in order, per document.

Decoding joins each id, by its position, to the token-byte table, a broadcast one: it is as large as the vocabulary and
no larger (``MOST_RANK_BYTES``). No text is shuffled, only word numbers and distinct words.

The pre-token pattern is that of the rank file. Newer Unicode versions call some code points letters or digits
that the tokenizer library treats as other characters; for texts that hold such code points the library's own
class is measured and used (see :class:`Splitter`).
"""

from __future__ import annotations

import base64
import unicodedata
import zlib
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provenant.llm.blocks import REQUEST, block_ids, blocks_of, bucket_count, by_bucket, exchange, planes, raw_bytes, squeeze, unplaned, unsqueeze
from provenant.llm.common import documents, segments, written

#: Larger blocks hold fewer distinct words in all: less to shuffle.
BLOCK_BYTES = 16 << 20
LEVEL = 9


#: A larger rank file is refused: its tokens are broadcast.
MOST_RANK_BYTES = 64 << 20


class Vocabulary:
    """Tokens and ranks of a rank file, read on the driver; workers build what they need of it once."""

    def __init__(self, rank_file: str):
        with open(rank_file, "rb") as file:
            raw = file.read(MOST_RANK_BYTES + 1)
        if len(raw) > MOST_RANK_BYTES:
            raise ValueError(f"{rank_file} is larger than {MOST_RANK_BYTES} bytes")
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}

    @cached_property
    def pieces(self):
        """The library's encoding of a text that is one pre-token."""
        import tiktoken

        return tiktoken.Encoding("pieces", pat_str="(?s:.+)", mergeable_ranks=self.ranks, special_tokens={})

    def encode(self, word: bytes) -> list[int]:
        return self.pieces.encode_ordinary(word.decode())

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The token-byte table: ids in order, where each one's bytes begin, and the bytes end to end."""
        order = sorted((rank, token) for token, rank in self.ranks.items())
        sizes = np.fromiter((len(t) for _, t in order), np.int64, len(order))
        return np.fromiter((r for r, _ in order), np.int64, len(order)), np.append(0, np.cumsum(sizes)), np.frombuffer(b"".join(t for _, t in order), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of each id by position: a join of (position, id) with the token-byte table; an unknown id is an error."""
        known, begin, data = self.table
        at = np.searchsorted(known, ids)
        if len(ids) and (at.max() >= len(known) or (known[at] != ids).any()):
            raise ValueError("an id that is not in the vocabulary")
        out, part = [], 1 << 18
        for k in range(0, len(at), part):
            row = at[k : k + part]
            size = begin[row + 1] - begin[row]
            out.append(data[np.arange(int(size.sum())) + np.repeat(begin[row] - np.cumsum(size) + size, size)].tobytes())
        return b"".join(out)


@lru_cache(maxsize=4)
def library(rank_file: str, pattern: str):
    """The tokenizer library's own encoding, for comparison."""
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=Vocabulary(rank_file).ranks, special_tokens={})


class Splitter:
    """Pre-tokens of a text, as the tokenizer library splits it."""

    #: Below this code point all Unicode versions in question agree.
    AGREED = regex.compile("[Ԁ-\U0010ffff]")
    CUT = regex.compile(r"(?<=\S)\s")

    def __init__(self, pattern: str):
        self.pattern, self.plain, self._late = pattern, regex.compile(pattern), None

    def late(self):
        """(finder, pattern) for code points that only a newer Unicode version assigns."""
        if self._late is None:
            newer = regex.compile(r"[\p{L}\p{N}]")
            points = [c for c in range(0x500, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn" and newer.match(chr(c))]
            other = "".join(chr(c) for c in points if not self.joins(chr(c), "a") and not self.joins(chr(c), "1"))
            known = f"[{regex.escape(other)}]" if other else r"[^\s\S]"
            exact = self.pattern.replace(r"[^\s\p{L}\p{N}]", f"(?:[^\\s\\p{{L}}\\p{{N}}]|{known})")
            exact = exact.replace(r"\p{L}+", rf"(?:(?!{known})\p{{L}})+").replace(r"\p{N}+", rf"(?:(?!{known})\p{{N}})+")
            self._late = regex.compile(known), regex.compile(exact)
        return self._late

    def joins(self, c: str, n: str) -> bool:
        """Whether the library keeps ``c`` and ``n`` in one pre-token."""
        if not hasattr(self, "_probes"):
            import tiktoken

            self._probes = {}
            for end in "a1":
                ranks = {bytes([i]): i for i in range(256)}
                ranks |= {bytes([i]) + end.encode(): 256 + i - 0x80 for i in range(0x80, 0xC0)}
                self._probes[end] = tiktoken.Encoding("probe", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return self._probes[n].encode_ordinary(c + n)[-1] >= 256

    def __call__(self, text: str) -> list[str]:
        use = self.plain
        if self.AGREED.search(text):
            finder, exact = self.late()
            use = exact if finder.search(text) else use
        return use.findall(text)


@lru_cache(maxsize=4)
def splitter(pattern: str) -> Splitter:
    return Splitter(pattern)


class Numbers(dict):
    """Numbers the distinct words in the order of their first use."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def escaped(codes: np.ndarray) -> list[np.ndarray]:
    """A byte for each position, and planes of what does not fit in it: frequent words take a byte and no more."""
    return [np.minimum(codes, 255).astype(np.uint8), *planes(codes[codes >= 255] - 255)]


def unescaped(first: np.ndarray, *rest: np.ndarray) -> np.ndarray:
    codes = first.astype(np.int64)
    codes[first == 255] += unplaned(list(rest))
    return codes


def packed_words(words: list[bytes]) -> list[np.ndarray | bytes]:
    return [np.fromiter(map(len, words), "<u4", len(words)), b"".join(words)]


def cut_words(lengths: np.ndarray, data: bytes) -> list[bytes]:
    ends = np.cumsum(lengths, dtype=np.int64)
    return [data[b - n : b] for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]


def packed_blocks(spark: SparkSession, docs: DataFrame, pattern: str) -> DataFrame:
    """Table (block, raw_bytes, payload, words): positions of a block, and its distinct words by number."""

    def pack(batches):
        split, ids = splitter(pattern), block_ids()
        for block in blocks_of(batches, BLOCK_BYTES):
            numbers, codes, counts = Numbers(), [], []
            number = numbers.__getitem__
            for raw in block.texts():
                text, n = raw.decode(), 0
                for part in segments(text, Splitter.CUT) if len(text) > 1 << 20 else (text,):
                    found = np.fromiter(map(number, split(part)), np.uint32)
                    codes.append(found)
                    n += len(found)
                counts.append(n)
            codes = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
            # Frequent words get small numbers, and a word of one use is only marked (0): those come in order, last.
            uses = np.bincount(codes, minlength=len(numbers))
            order, repeated = np.argsort(-uses, kind="stable"), int((uses > 1).sum())
            renumber = np.zeros(len(order), np.uint32)
            renumber[order[:repeated]] = np.arange(1, repeated + 1, dtype=np.uint32)
            listed = list(numbers)
            encoded = [listed[i].encode() for i in order]
            words = squeeze(*packed_words(encoded), level=LEVEL)
            payload = squeeze(block.ids, block.valid.astype("u1"), np.array(counts, "<u4"), np.array([repeated], "<i8"), *escaped(renumber[codes]), level=LEVEL)
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (next(ids), len(block.data), payload, words)], ["block", "raw_bytes", "payload", "words"])

    return written(spark, docs.select("doc_id", "text").mapInArrow(pack, "block long, raw_bytes long, payload binary, words binary"))


def bucket_numbers(words: list[bytes], n_buckets: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) % n_buckets for w in words), np.int64, len(words))


def encode(spark: SparkSession, docs: DataFrame, rank_file: str, pattern: str, with_decoded: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) for each row of ``docs`` (doc_id, text): ids as little-endian unsigned 32-bit integers.

    ``with_decoded`` adds the bytes that the ids decode to, as :func:`decode` would, without another Python step. The
    library's pre-token pattern decides what a word is; a word is encoded as a text of its own.

    Defined results: a null or empty text has no ids; a null doc_id stays null; repeated rows come back each;
    further columns of ``docs`` are not read; an empty table gives an empty table; a long text is cut into
    pre-tokens in segments but encoded whole.
    """
    shared = spark.sparkContext.broadcast(Vocabulary(rank_file))
    blocks = packed_blocks(spark, docs, pattern)
    n_buckets = bucket_count(raw_bytes(blocks))

    def ask(batches):
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = cut_words(*unsqueeze(blob, "<u4", "b"))
                order, starts = by_bucket(bucket_numbers(words, n_buckets), n_buckets)
                rows = []
                for k in range(n_buckets):
                    if starts[k] < starts[k + 1]:
                        numbers = order[starts[k] : starts[k + 1]]
                        own = packed_words([words[i] for i in numbers])
                        rows.append((k, block, squeeze(np.diff(numbers, prepend=0).astype("<u4"), *own, level=LEVEL)))
                yield pa.RecordBatch.from_pylist([dict(zip(("bucket", "block", "request"), r, strict=True)) for r in rows], schema=REQUEST)

    def answer(requests: list[bytes]) -> list[bytes]:
        encode_word, known, replies = shared.value.encode, {}, []
        for request in requests:
            found = []
            steps, *own = unsqueeze(request, "<u4", "<u4", "b")
            for word in cut_words(*own):
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = np.array(encode_word(word), "<u4").tobytes()
                found.append(ids)
            lengths = np.fromiter((len(x) // 4 for x in found), "<u4", len(found))
            replies.append(squeeze(steps, lengths, *planes(np.frombuffer(b"".join(found), "<u4")), level=LEVEL))
        return replies

    def assemble(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out_ids, out_n, out, plain = [], [], [], []
        words, parts = [], []
        for reply in right.column("reply").to_pylist():
            steps, lengths, *ids = unsqueeze(reply, *["<u4"] * 2, *["u1"] * 4)
            words.append((np.cumsum(steps, dtype=np.int64), lengths.astype(np.int64)))
            parts.append(unplaned(ids).astype("<u4"))
        table = np.concatenate(parts) if parts else np.zeros(0, "<u4")
        numbers = np.concatenate([n for n, _ in words]) if words else np.zeros(0, np.int64)
        sent = np.concatenate([n for _, n in words]) if words else np.zeros(0, np.int64)
        lengths, begin = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        lengths[numbers], begin[numbers] = sent, np.cumsum(sent) - sent
        for payload in left.column("payload").to_pylist():
            doc_ids, valid, counts, repeated, *codes = unsqueeze(payload, "<i8", "u1", "<u4", "<i8", *["u1"] * 5)
            codes, at = unescaped(*codes) - 1, 0
            once = codes < 0
            codes[once] = repeated[0] + np.arange(int(once.sum()))
            for doc, known, count in zip(doc_ids.tolist(), valid.tolist(), counts.tolist(), strict=True):
                own = codes[at : at + count]
                at += count
                n = lengths[own]
                total = int(n.sum())
                within = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
                ids = table[np.repeat(begin[own], n) + within]
                out_ids.append(doc if known else None)
                out_n.append(total)
                out.append(ids.tobytes())
                if with_decoded:
                    plain.append(shared.value.decode(ids))
        found = {"doc_id": pa.array(out_ids, pa.int64()), "n_tokens": pa.array(out_n, pa.int64()), "ids": pa.array(out, pa.binary())}
        return pa.table(found | ({"decoded": pa.array(plain, pa.binary())} if with_decoded else {}))

    requests = blocks.select("block", "words").mapInArrow(ask, "bucket int, block long, request binary")
    replies = exchange(requests, n_buckets, answer)
    positions = blocks.select("block", "payload")
    schema = "doc_id long, n_tokens long, ids binary" + (", decoded binary" if with_decoded else "")
    return positions.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(assemble, schema)


def decode(encoded: DataFrame, rank_file: str) -> DataFrame:
    """``encoded`` with a column ``decoded`` (binary): the ids joined to the token-byte table, a null for null ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(rank_file))

    @F.pandas_udf("binary")
    def bytes_of(ids: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else shared.value.decode(np.frombuffer(x, "<u4")) for x in ids], dtype=object)

    return encoded.withColumn("decoded", bytes_of("ids"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode(spark, documents(spark, sf_dir), ranks, public_tokenizers.PATTERN, with_decoded=True)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
