"""Exact repeats of 50 bytes across documents, by merging Burrows-Wheeler transforms.

Suffix structures over a whole corpus do not distribute, so the corpus is first cut by content. In every window of
50 bytes the 20-byte string of the smallest hash is its *anchor*; consecutive windows with the same anchor form a
*stretch*. Equal windows have equal anchors, so all places of a repeated window meet in the bucket of its anchor.

1. Each block of documents sends the hashes of its anchors; buckets answer which ones other documents hold too.
2. The block sends the stretches of those, each distinct string once with the smallest doc_id in the block. In its
   bucket, the stretches of one set of blocks are a shard with a Burrows-Wheeler transform of its own. The shards
   are merged by refining their interleave by up to ``STRIDE`` symbols a round (:func:`merge`): after ``h`` symbols the suffixes
   are ordered by their first ``h`` bytes, a suffix that parts from all others leaves,
   and after 50 symbols each interval holds the places of one 50-byte string. No suffix is sorted again.
3. The smallest doc_id of each interval goes back to the blocks, which mark and cut their texts.

A stretch that all blocks hold in the same form (most copies) has one distinct string and needs no rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from provenant.llm.blocks import NO_ID, REQUEST, Docs, bucket_count, by_bucket, exchange, raw_bytes, squeeze, unpacked_block, unsqueeze, written_blocks
from provenant.llm.common import documents, drop_written, written
from provenant.llm.shingles import CHUNK, mixed, powers

LENGTH, ANCHOR = 50, 20
BLOCK_BYTES = 4 << 20
SHARDS = 4
#: Symbols of 9 bits that a first sort of suffixes compares.
PACKED = 7
#: Symbols that a round of the merge takes at most.
STRIDE = 5
_bytes = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_base = 0x9E3779B97F4A7C15
_up, _down = powers(_base, CHUNK + 1), powers(pow(_base, -1, 1 << 64), CHUNK + 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ANCHOR bytes at each position (for at most CHUNK bytes)."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_bytes[data] * _down[:n], out=sums[1:], dtype=np.uint64)
    return mixed((sums[ANCHOR:] - sums[:-ANCHOR]) * _up[: n - ANCHOR + 1])


def stretches(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, one after the last window, anchor hash) of each stretch in the texts of a block."""
    width, firsts, ends, hashes = LENGTH - ANCHOR + 1, [], [], []
    step = CHUNK - LENGTH
    for lo in range(0, max(0, len(data) - LENGTH + 1), step):
        part = data[lo : lo + step + LENGTH - 1]
        h = gram_hashes(part)
        key = (h & ~np.uint64(CHUNK - 1)) | np.arange(len(h), dtype=np.uint64)
        small, have = key, 1
        while have < width:
            by = min(have, width - have)
            small = np.minimum(small[:-by], small[by:])
            have += by
        at = (small & np.uint64(CHUNK - 1)).astype(np.int64)
        window = np.arange(len(at), dtype=np.int64) + lo
        begin = np.searchsorted(offsets, [lo, lo + len(at)], "right")
        inner = offsets[begin[0] : begin[1]]  # documents that start inside this part
        number = np.zeros(len(at) + 1, np.int64)
        np.add.at(number, inner[inner <= lo + len(at)] - lo, 1)
        number = np.cumsum(number[:-1]) + begin[0] - 1
        starts = offsets[number]
        doc_end = offsets[np.minimum(number + 1, len(offsets) - 1)]
        whole = window + LENGTH <= doc_end
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1]) | (whole[1:] != whole[:-1])
        edges = np.append(np.nonzero(new)[0], len(at))
        ok = whole[edges[:-1]]
        firsts.append(edges[:-1][ok] + lo)
        ends.append(edges[1:][ok] + lo)
        hashes.append(h[at[edges[:-1][ok]]])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(ends), np.concatenate(hashes)


# --- Burrows-Wheeler transforms -------------------------------------------------------------------------------


def alone(new: np.ndarray) -> np.ndarray:
    """Whether a row is the only one of its group, given which rows begin one."""
    out = new.copy()
    out[:-1] &= new[1:]
    return out


class Shard:
    """The Burrows-Wheeler transform of a set of strings: symbols (0 stands before each string), and their places.

    Row ``i`` is the i-th smallest suffix; ``symbols[i]`` precedes it, ``string[i]`` and ``offset[i]`` say where it is.
    """

    def __init__(self, strings: list[bytes]):
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        # Byte + 1, and an end mark 0 after each string.
        text = np.zeros(int(lengths.sum()) + len(strings), np.uint16)
        ends = np.cumsum(lengths + 1) - 1
        body = np.ones(len(text), bool)
        body[ends] = False
        text[body] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
        string = np.repeat(np.arange(len(strings)), lengths + 1)
        offset = np.arange(len(text)) - np.repeat(ends - lengths, lengths + 1)
        left = ends[string] - np.arange(len(text))  # symbols before the end mark
        # Prefix doubling from PACKED symbols on; end marks order by their string, so no two suffixes stay equal.
        rank = np.zeros(len(text), np.int64)
        for j in range(PACKED):
            rank, n = rank << 9, max(0, len(text) - j)
            rank[:n] |= np.where(left[:n] >= j, text[j:], 0)
        order = np.argsort(rank, kind="stable")
        new = np.ones(len(text), bool)
        new[1:] = (rank[order[1:]] != rank[order[:-1]]) | (left[order[1:]] < PACKED)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(text)), 0))  # a group's rank is the row of its first
        open_, span = order[~alone(new)], PACKED
        while len(open_):
            key = rank[open_] * (len(text) + 1) + rank[open_ + span]
            by = np.argsort(key)
            open_, key = open_[by], key[by]
            group, at = rank[open_], np.arange(len(open_))
            new[: len(open_)] = True
            new, first = new[: len(open_)], np.ones(len(open_), bool)
            new[1:], first[1:] = key[1:] != key[:-1], group[1:] != group[:-1]
            rank[open_] = group + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(first, at, 0))
            open_, span = open_[~alone(new)], 2 * span
        order = np.empty(len(rank), np.int64)
        order[rank] = np.arange(len(rank))
        before = np.where(offset == 0, 0, text[np.maximum(np.arange(len(text)) - 1, 0)])
        self.symbols, self.string, self.offset = before[order].astype(np.uint16), string[order], offset[order]
        self.last = np.empty(len(order), np.int64)  # row of the suffix that is one symbol longer
        self.last[np.argsort(self.symbols, kind="stable")] = np.arange(len(order))


def strides(symbols: np.ndarray, longer: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 1, 2, ... symbols (``most`` at most) before each row: their code in order (0: the string begins there), and the row of
    the suffix that they make. It ends where the codes would no longer fit 16 bits, which sort by radix."""
    size = int(symbols.max(initial=0)) + 1
    used = np.zeros(size, bool)
    used[symbols] = True
    used[0] = True
    single = (np.cumsum(used) - 1)[symbols]
    size, out = int(used.sum()), [(symbols, longer)]
    code, n, far = single, size, longer
    while len(out) < most:
        value = np.where((single == 0) | (code[longer] == 0), 0, code[longer] * size + single)
        if n * size > 1 << 22:
            break
        used = np.zeros(n * size, bool)
        used[value] = True
        used[0] = True
        n = int(used.sum())
        if n > 1 << 16:
            break
        code, far = (np.cumsum(used) - 1)[value], far[longer]
        out.append((code.astype(np.uint16), far))
    return out


def merge(shards: list[Shard], depth: int, stride: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeated intervals of the merged shards: (rows, interval of each row, common prefix of every row).

    Rows are numbered shard after shard. The interleave holds the rows in order of their first ``h`` symbols; a round
    places them stably by the symbols before them, which orders the longer suffixes by one symbol more, or by up to
    ``stride`` (the common prefix is then known to the round). An interval is split where the symbols or the interval that a
    row came from change. A row that is alone in its interval at ``h`` shares fewer than ``h`` symbols with any other row and
    leaves the interleave: what precedes it is alone too.
    """
    starts = np.cumsum([0, *(len(s.symbols) for s in shards)])
    symbols = np.concatenate([s.symbols for s in shards])
    steps = strides(symbols, np.concatenate([s.last + at for s, at in zip(shards, starts, strict=False)]), min(stride, depth))
    prefix = np.zeros(len(symbols), np.int16)
    rows, interval = np.arange(len(symbols)), np.zeros(len(symbols), np.int64)
    h = 0
    while h < depth:
        step = min(len(steps), depth - h)
        h += step
        code, longer = steps[step - 1]
        marks = code[rows]
        order = np.argsort(marks, kind="stable")
        marks, came = marks[order], interval[order]
        new = np.ones(len(rows), bool)
        new[1:] = (marks[1:] != marks[:-1]) | (came[1:] != came[:-1]) | (marks[1:] == 0)
        rows = longer[rows[order]]
        kept = ~alone(new)
        interval, rows = np.cumsum(new)[kept] - 1, rows[kept]
        prefix[rows] = h
    return rows, interval, prefix


def repeated_windows(strings: list[bytes], shard_of: np.ndarray, values: np.ndarray, depth: int = LENGTH) -> list[np.ndarray]:
    """For each string the smallest value of a string that holds the same ``depth`` bytes, window by window."""
    numbers = [np.nonzero(shard_of == k)[0] for k in np.unique(shard_of)]
    shards = [Shard([strings[i] for i in own]) for own in numbers]
    string = np.concatenate([own[s.string] for own, s in zip(numbers, shards, strict=True)])
    offset = np.concatenate([s.offset for s in shards])
    rows, interval, _ = merge(shards, depth, STRIDE)
    windows = np.fromiter((max(0, len(s) - depth + 1) for s in strings), np.int64, len(strings))
    begin = np.cumsum(windows) - windows
    out = np.repeat(values, windows)
    if len(rows):
        least = np.full(int(interval[-1]) + 1, NO_ID, np.int64)
        np.minimum.at(least, interval, values[string[rows]])
        out[begin[string[rows]] + offset[rows]] = least[interval]
    return np.split(out, begin[1:])


# --- the three passes -----------------------------------------------------------------------------------------


def shared_anchors(requests: list[bytes]) -> list[bytes]:
    """For each block a bit per anchor it sent: whether another document has it."""
    sent = [unsqueeze(r, "<u8", "u1") for r in requests]
    every = np.concatenate([h for h, _ in sent])
    _, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
    several = (counts > 1)[inverse] | np.concatenate([m for _, m in sent]).astype(bool)
    ends = np.cumsum([len(h) for h, _ in sent])
    return [squeeze(np.packbits(part)) for part in np.split(several, ends[:-1])]


def sources(requests: list[bytes]) -> list[bytes | None]:
    """For each block the smallest doc_id of every window of every string it sent."""
    sent = [unsqueeze(r, "<u8", "<i8", "<i8", "<u4", "b") for r in requests]
    strings, first, shard, anchors, low, high, places = [], {}, [], [], [], [], []
    for k, (hashes, smallest, largest, lengths, data) in enumerate(sent):
        own, end = [], 0
        for h, a, b, n in zip(hashes.tolist(), smallest.tolist(), largest.tolist(), lengths.tolist(), strict=True):
            s = data[end : end + n]
            end += n
            i = first.get(s)
            if i is None:
                i = first[s] = len(strings)
                strings.append(s)
                shard.append(k * SHARDS // len(sent))
                anchors.append(h)
                low.append(a)
                high.append(b)
            else:
                low[i], high[i] = min(low[i], a), max(high[i], b)
            own.append(i)
        places.append(own)
    low, high = np.array(low, np.int64), np.array(high, np.int64)
    # Strings that meet no other string of their anchor are settled: their windows are theirs alone.
    _, inverse, counts = np.unique(np.array(anchors, np.uint64), return_inverse=True, return_counts=True)
    open_ = np.nonzero(counts[inverse] > 1)[0] if len(strings) else np.zeros(0, np.int64)
    windows = np.fromiter(map(len, strings), np.int64, len(strings)) - LENGTH + 1
    starts = np.cumsum(np.append(0, windows))
    found = np.repeat(low, windows)
    if len(open_):
        # An anchor's strings are compared with each other only, so any cut between anchors bounds the memory.
        open_ = open_[np.argsort(inverse[open_], kind="stable")]
        group = inverse[open_]
        at = 0
        while at < len(open_):
            end = min(len(open_), at + 20_000)
            while end < len(open_) and group[end] == group[end - 1]:
                end += 1
            part = open_[at:end]
            least = repeated_windows([strings[i] for i in part.tolist()], np.array(shard, np.int64)[part], low[part])
            found[flat(starts[part], windows[part])] = np.concatenate(least)
            at = end
    smallest = np.minimum.reduceat(found, starts[:-1]) if len(strings) else found
    replies = []
    for own, (_, _, largest, _, _) in zip(places, sent, strict=True):
        own = np.array(own, np.int64)
        # Where even the block's largest document is no later than the source, there is nothing to mark.
        sizes = np.where(smallest[own] < largest, windows[own], 0)
        replies.append(squeeze(sizes.astype("<u4"), found[flat(starts[own], sizes)].astype("<i8")) if sizes.any() else None)
    return replies


def flat(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def ranked(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and the place of each hash among them, by one sort."""
    order = np.argsort(hashes)
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    inverse = np.empty(len(hashes), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return hashes[order[new]], inverse


def shared_stretches(block: Docs, replies: dict[int, bytes], n_buckets: int):
    """The stretches of a block whose anchors are shared: (firsts, ends, hashes, document numbers)."""
    firsts, ends, hashes = stretches(block.data, block.offsets)
    distinct, inverse = ranked(hashes)
    order, starts = by_bucket((distinct % np.uint64(n_buckets)).astype(np.int64), n_buckets)
    flag = np.zeros(len(distinct), bool)
    for k, reply in replies.items():
        own = order[starts[k] : starts[k + 1]]
        flag[own] = np.unpackbits(unsqueeze(reply, "u1")[0], count=len(own)).astype(bool)
    keep = flag[inverse]
    firsts, ends, hashes = firsts[keep], ends[keep], hashes[keep]
    return firsts, ends, hashes, np.searchsorted(block.offsets, firsts, "right") - 1


def listed(block: Docs, firsts, ends, hashes, docs, n_buckets: int):
    """The distinct strings of the shared stretches (strings, hashes, smallest and largest ids), their numbers in order of the
    bucket and where each bucket begins, and each stretch's bucket and place in it."""
    raw, numbers = block.data.tobytes(), {}
    number = np.fromiter((numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip(firsts.tolist(), (ends + LENGTH - 1).tolist(), strict=True)), np.int64, len(firsts))
    own, ids = np.zeros(len(numbers), np.uint64), block.ids[docs]
    least, most = np.full(len(numbers), NO_ID, np.int64), np.full(len(numbers), np.iinfo(np.int64).min, np.int64)
    own[number] = hashes
    np.minimum.at(least, number, ids)
    np.maximum.at(most, number, ids)
    bucket = (own % np.uint64(n_buckets)).astype(np.int64)
    order, starts = by_bucket(bucket, n_buckets)
    place = np.empty(len(numbers), np.int64)
    place[order] = np.arange(len(numbers)) - starts[bucket[order]]
    return (list(numbers), own, least, most), order, starts, bucket[number], place[number]


def bounds(sizes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A reply's values, where each string's begin, and the smallest and largest of each; without values, NO_ID."""
    starts = np.cumsum(np.append(0, sizes.astype(np.int64)))
    least, most, full = np.full(len(sizes), NO_ID), np.full(len(sizes), NO_ID), sizes > 0
    least[full] = np.minimum.reduceat(values, starts[:-1][full])
    most[full] = np.maximum.reduceat(values, starts[:-1][full])
    return values, starts, least, most


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(spark: SparkSession, docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept_bytes]) for each row of ``docs`` (doc_id, text).

    Defined results: a null or empty text, or one under 50 bytes, loses nothing; a null doc_id counts as larger than
    all others; rows with equal doc_ids do not remove from each other; further columns are not read; an empty table
    gives an empty table; a long text is handled whole, in a block of its own if need be.
    """

    blocks = written_blocks(spark, docs, BLOCK_BYTES)
    n_buckets = bucket_count(raw_bytes(blocks))

    def ask_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                block = unpacked_block(payload)
                firsts, _, hashes = stretches(block.data, block.offsets)
                owner = block.ids[np.searchsorted(block.offsets, firsts, "right") - 1]
                distinct, inverse = ranked(hashes)
                least, most = np.full(len(distinct), NO_ID, np.int64), np.full(len(distinct), np.iinfo(np.int64).min, np.int64)
                np.minimum.at(least, inverse, owner)
                np.maximum.at(most, inverse, owner)
                order, starts = by_bucket((distinct % np.uint64(n_buckets)).astype(np.int64), n_buckets)
                rows = [
                    {"bucket": k, "block": number, "request": squeeze(distinct[own], (least != most)[own].astype(np.uint8), level=1)}
                    for k in range(n_buckets) if len(own := order[starts[k] : starts[k + 1]])
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=REQUEST)

    def ask_sources(key, left: pa.Table, right: pa.Table) -> pa.Table:
        replies, rows = dict(zip(right.column("bucket").to_pylist(), right.column("reply").to_pylist(), strict=True)), []
        for number, payload in zip(left.column("block").to_pylist(), left.column("payload").to_pylist(), strict=True):
            block = unpacked_block(payload)
            (strings, hashes, least, most), order, starts, _, _ = listed(block, *shared_stretches(block, replies, n_buckets), n_buckets)
            for k in np.flatnonzero(np.diff(starts)).tolist():
                own = order[starts[k] : starts[k + 1]]
                texts = [strings[i] for i in own.tolist()]
                blob = squeeze(hashes[own], least[own], most[own], np.array(list(map(len, texts)), "<u4"), b"".join(texts))
                rows.append({"bucket": k, "block": number, "request": blob})
        return pa.Table.from_pylist(rows, schema=REQUEST)

    def cut(key, left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, windows = {}, {}
        for k, kind, reply in zip(right.column("bucket").to_pylist(), right.column("kind").to_pylist(), right.column("reply").to_pylist(), strict=True):
            if kind:
                windows[k] = bounds(*unsqueeze(reply, "<u4", "<i8"))
            else:
                anchors[k] = reply
        out = {c: [] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_bytes"] if with_text else []))}
        for payload in left.column("payload").to_pylist():
            block = unpacked_block(payload)
            found = shared_stretches(block, anchors, n_buckets)
            change = np.zeros(len(block.data) + 1, np.int32)
            _, _, _, bucket, place = listed(block, *found, n_buckets)
            order, begins = by_bucket(bucket, n_buckets)
            for k, (values, starts, least, most) in windows.items():
                own = order[begins[k] : begins[k + 1]]
                own = own[least[place[own]] < block.ids[found[3][own]]]
                at, first, doc = place[own], found[0][own], block.ids[found[3][own]]
                whole = most[at] < doc  # every window of the stretch
                np.add.at(change, first[whole], 1)
                np.add.at(change, (first + starts[at + 1] - starts[at] - 1 + LENGTH)[whole], -1)
                at, first, doc = at[~whole], first[~whole], doc[~whole]
                sizes = starts[at + 1] - starts[at]
                places = flat(starts[at], sizes)
                window = (np.repeat(first - starts[at], sizes) + places)[values[places] < np.repeat(doc, sizes)]
                np.add.at(change, window, 1)
                np.add.at(change, window + LENGTH, -1)
            gone = np.cumsum(change[:-1]) > 0
            for i, doc in enumerate(block.doc_ids()):
                a, b = block.offsets[i], block.offsets[i + 1]
                lost = gone[a:b]
                kept = block.data[a:b][~lost].tobytes()
                spans = int(lost[:1].sum() + (lost[1:] & ~lost[:-1]).sum())
                values = (doc, int(b - a), int(lost.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)
                for c, v in zip(out, values, strict=False):
                    out[c].append(v)
        kinds = (pa.int64(),) * 4 + (pa.string(), pa.binary())
        return pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds, strict=False)})

    from pyspark.sql import functions as F

    requests = blocks.select("block", "payload").mapInArrow(ask_anchors, "bucket int, block long, request binary")
    anchors = written(spark, exchange(requests, n_buckets, shared_anchors))
    texts = blocks.select("block", "payload")
    asked = texts.groupBy("block").cogroup(anchors.groupBy("block")).applyInArrow(ask_sources, "bucket int, block long, request binary")
    replies = exchange(asked, n_buckets, sources).withColumn("kind", F.lit(1))
    both = written(spark, replies.unionByName(anchors.withColumn("kind", F.lit(0))))
    drop_written(spark, anchors)
    right = both.select(F.col("block").alias("block"), "bucket", "kind", "reply")
    return texts.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(cut, RESULT + (", kept_bytes binary" if with_text else ""))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, documents(spark, sf_dir))
