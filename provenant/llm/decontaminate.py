"""Benchmark decontamination by pigeonhole edit matching.

A test item may occur in a document with up to ``e`` edits, ``e`` a share of its length. Split into ``e + 1``
pieces, at least one piece of such an occurrence is untouched. All pieces of a part of the benchmark form one
Aho-Corasick automaton that runs over each text once; the places of an item that its hits point to are verified
with Myers' bit-parallel edit distance, exactly.

Texts and items are compared in lower case, with runs of white space as one space. The benchmark goes to the
executors in parts of bounded size (``PART_CHARS``): a larger benchmark means more passes, not more memory.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provenant.llm.common import documents

EDIT_SHARE = 0.08
#: Items below this many characters are matched exactly; a few letters with edits would match anything.
SHORT = 24
PART_CHARS = 4 << 20
BLANK = re.compile(r"\s+")
HIT_SCHEMA = "doc_id long, item_id long, distance int, start int, end int"


def normal(text: str) -> str:
    return BLANK.sub(" ", text.lower()).strip()


def budget(n: int, share: float) -> int:
    return int(n * share) if n >= SHORT else 0


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the best occurrence of ``pattern`` anywhere in ``text`` with at most ``most`` edits; the first of equals."""
    m = len(pattern)
    where: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        where[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, None
    for j, c in enumerate(text):
        eq = where.get(c, 0)
        x = eq | down
        diagonal = ((((eq & up) + up) ^ up) | eq) & full
        plus, minus = (down | ~(diagonal | up)) & full, up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = (minus | ~(x | plus)) & full, plus & x
        if score <= most and (best is None or score < best[0]):
            best = (score, j + 1)
            if not score:
                break
    return best


class Matcher:
    """The pieces of a set of items, and the search for the items in a text."""

    def __init__(self, items: list[tuple[int, str]], share: float):
        import ahocorasick

        self.items, pieces = [], defaultdict(list)
        for item_id, text in items:
            text = normal(text or "")
            if not text:
                continue
            e, n = budget(len(text), share), len(text)
            cuts = [n * k // (e + 1) for k in range(e + 2)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                pieces[text[a:b]].append((len(self.items), a))
            self.items.append((item_id, text, e))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in pieces.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if pieces:
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best occurrence of each item in a normalised text."""
        if not self.items or not text:
            return []
        places: dict[int, list[int]] = defaultdict(list)
        for end, (length, uses) in self.automaton.iter(text):
            for item, offset in uses:
                places[item].append(end + 1 - length - offset)
        out = []
        for item, starts in places.items():
            item_id, pattern, e = self.items[item]
            best = None
            for lo, hi in merged(starts, e, len(pattern)):
                found = myers(pattern, text[max(0, lo) : hi], e)
                if found and (best is None or found[0] < best[0]):
                    best = (found[0], max(0, lo) + found[1])
            if best:
                out.append((item_id, best[0], self.start(pattern, text, best), best[1]))
        return out

    @staticmethod
    def start(pattern: str, text: str, best: tuple[int, int]) -> int:
        """Where the occurrence that ends at ``best`` starts: the reverse search."""
        distance, end = best
        back = text[max(0, end - len(pattern) - distance) : end][::-1]
        found = myers(pattern[::-1], back, distance)
        return end - found[1] if found else max(0, end - len(pattern))


def merged(starts: list[int], e: int, n: int) -> Iterator[tuple[int, int]]:
    """Stretches of text in which an occurrence may lie whose start is within ``e`` of one of ``starts``."""
    starts = sorted(set(starts))
    lo, last = starts[0], starts[0]
    for s in starts[1:]:
        if s - last > n:
            yield lo - e, last + n + 2 * e
            lo = s
        last = s
    yield lo - e, last + n + 2 * e


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE) -> DataFrame:
    """Rows (doc_id, item_id, distance, start, end): the best occurrence of each item in each document that has one.

    ``start`` and ``end`` count characters of the normalised text. An item of fewer than ``SHORT`` characters must occur as
    it is, without edits. Defined results: a null or blank text or item matches nothing; repeated documents give a row
    each; equal items (ties) each give their row; a document or an item with a null id gives rows with a null id; further columns are not read; an empty table on either side gives
    an empty table; a text is searched whole.
    """
    out = None
    for shared in parts_of(spark, benchmark):

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = matcher_for(shared.value, share)
            for batch in batches:
                ids, found = batch.column(0).to_pylist(), []
                for doc, text in zip(ids, batch.column(1), strict=True):
                    found += [(doc, *hit) for hit in matcher.hits(normal(text.as_py() or ""))]
                columns = list(zip(*found, strict=True)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "distance", "start", "end"])

        hits = docs.select("doc_id", "text").mapInArrow(search, HIT_SCHEMA)
        out = hits if out is None else out.unionByName(hits)
    return out


def without_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item of the benchmark; the same matches as :func:`contaminated`, no shuffle."""
    for shared in parts_of(spark, benchmark):
        docs = docs.filter(~holds_item(shared, share)(F.col(text)))
    return docs


def holds_item(shared, share: float):
    """Whether a text holds an item of a broadcast part, as a column function."""

    @F.pandas_udf("boolean")
    def test(texts: pd.Series) -> pd.Series:
        matcher = matcher_for(shared.value, share)
        return pd.Series([bool(matcher.hits(normal(t or ""))) for t in texts], dtype=bool)

    return test


_latest: list = [None, None, None]


def matcher_for(items: list[tuple[int, str]], share: float) -> Matcher:
    """The matcher of a list of items, made once per worker for the list in use."""
    if _latest[0] is not items or _latest[1] != share:
        _latest[:] = items, share, Matcher(items, share)
    return _latest[2]


def parts_of(spark: SparkSession, benchmark: DataFrame) -> list:
    """The benchmark as broadcast lists of (item_id, text), each of some ``PART_CHARS`` characters."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-total // PART_CHARS))
    out = []
    for k in range(parts):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        rows = [(r["item_id"], r["text"]) for r in part.toLocalIterator()]  # some PART_CHARS
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        out.append(spark.sparkContext.broadcast(rows))
    return out


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
