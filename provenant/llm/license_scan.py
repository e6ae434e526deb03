"""Licence scan: stretches of a text against licence templates by the Dice coefficient over word bigrams.

Text and templates are normalised to lower-case words of letters and digits. A template of ``n`` bigrams and a
stretch of ``w`` bigrams that share ``c`` (with multiplicity) have Dice ``2c / (n + w)``. For a coefficient of at
least ``d`` the sizes bound each other: ``n*d/(2-d) <= w <= n*(2-d)/d`` and ``c >= d*(n+w)/2``; templates of which
a text holds too few bigrams are pruned before any stretch is looked at, as are stretches of impossible size.
The templates are a constant of the library, some hundreds of KB.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from provenant.llm.common import documents
from provenant.llm.license_templates import TEMPLATES
from provenant.llm.shingles import MIX, WordHashes, mixed

WORD = re.compile(r"[^\W_]+")
SCHEMA = "doc_id long, license string, dice double, start_word long, end_word long"
LEAST = 0.85
#: Runs of more places than this are searched with whole arrays.
WIDE = 200
_hashes = WordHashes()


def bigrams(text: str) -> np.ndarray:
    words = WORD.findall(text.lower())
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    return mixed(mixed(h[:-1]) * MIX + h[1:])


class Templates:
    def __init__(self, templates: tuple[tuple[str, str], ...], least: float):
        self.least, self.rows = least, []
        for name, text in templates:
            grams = bigrams(text)
            if len(grams):
                self.rows.append((name, Counter(grams.tolist()), np.unique(grams), len(grams)))
        self.all = np.unique(np.concatenate([r[2] for r in self.rows]))
        self.member = np.stack([np.isin(self.all, r[2]) for r in self.rows], 1).astype(np.float32)
        self.need = np.array([-(-least * r[3] // (2 - least)) for r in self.rows])  # shared bigrams of the smallest stretch

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(licence, dice, first word, end word): the best stretches, none overlapping another of the same text."""
        grams = bigrams(text)
        if not len(grams):
            return []
        slot = np.searchsorted(self.all, grams)
        slot[slot == len(self.all)] = 0
        at = np.nonzero(self.all[slot] == grams)[0]
        if len(at) < self.need.min():
            return []
        found = []
        held, times = np.unique(slot[at], return_counts=True)
        for k in np.nonzero(times.astype(np.float32) @ self.member[held] >= self.need)[0]:
            name, counts, own, n = self.rows[k]
            places = at[self.member[slot[at], k] > 0]
            found += [(d, n, name, a, b) for d, a, b in self.stretches(grams, places, counts, n)]
        # A full text holds its own notice, which may fit it better than the whole.
        found = [f for f in found if not any(g[1] >= 3 * f[1] and g[3] <= f[3] and f[4] <= g[4] for g in found)]
        found.sort(key=lambda f: (-f[0], -f[1], f[2], f[3]))
        out: list[tuple[str, float, int, int]] = []
        for d, _, name, a, b in found:
            if all(b <= x or y <= a for _, _, x, y in out):
                out.append((name, d, a, b))
        return sorted(out, key=lambda f: f[2])

    def stretches(self, grams: np.ndarray, places: np.ndarray, counts: Counter, n: int) -> Iterator[tuple[float, int, int]]:
        """Best stretch of each run of places: stretches start and end at a bigram of the template."""
        widest = int(n * (2 - self.least) / self.least)
        for run in np.split(places, np.nonzero(np.diff(places) > widest - n + 1)[0] + 1):
            best, last = None, len(run)
            if last > WIDE:
                yield from self.wide_stretches(grams, run, counts, n, widest)
                continue
            for i in range(last):
                if best and run[i] >= best[2]:
                    yield best
                    best = None
                end = int(np.searchsorted(run, run[i] + widest))
                if 2 * (end - i) < self.least * (n + 1) or best and best[0] == 1.0:
                    continue
                left, shared = dict(counts), 0
                for j in range(i, end):
                    g = int(grams[run[j]])
                    if left.get(g, 0):
                        left[g] -= 1
                        shared += 1
                        dice = 2 * shared / (n + int(run[j] - run[i]) + 1)
                        if dice >= self.least and (best is None or dice > best[0]):
                            best = (dice, int(run[i]), int(run[j]) + 2)
            if best:
                yield best


    def wide_stretches(self, grams: np.ndarray, run: np.ndarray, counts: Counter, n: int, widest: int) -> Iterator[tuple[float, int, int]]:
        """The same for a long run, all ends of a start at once."""
        g, last = grams[run], len(run)
        order, shared, follows = np.argsort(g, kind="stable"), np.zeros(last, bool), np.full(last, -1)
        starts = np.nonzero(np.concatenate([[True], g[order][1:] != g[order][:-1]]))[0]
        for own in np.split(order, starts[1:]):  # places of one bigram: so many as the template has count, the next when one is left behind
            c = counts[int(g[own[0]])]
            shared[own[:c]] = True
            follows[own[:-c]] = own[c:]
        best = None
        for i in range(last):
            if best and run[i] >= best[2]:
                yield best
                best = None
            end = int(np.searchsorted(run, run[i] + widest))
            if 2 * (end - i) >= self.least * (n + 1) and not (best and best[0] == 1.0):
                dice = 2 * np.cumsum(shared[i:end]) / (n + (run[i:end] - run[i]) + 1)
                j = int(dice.argmax())
                if dice[j] >= self.least and (best is None or dice[j] > best[0]):
                    best = (float(dice[j]), int(run[i]), int(run[i + j]) + 2)
            if follows[i] >= 0:
                shared[follows[i]] = True
        if best:
            yield best


@lru_cache(maxsize=4)
def compiled(templates: tuple[tuple[str, str], ...], least: float) -> Templates:
    return Templates(templates, least)


def license_scan(docs: DataFrame, least: float = LEAST, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """Rows (doc_id, license, dice, start_word, end_word), a row for each licence stretch of a text; words count from 0.

    Defined results: a null, empty or wordless text gives no row; repeated rows give their rows each; of equal
    coefficients the longer template and then the first name wins; a stretch inside one of a template three times as
    long is part of that one; further columns are not read; an empty table
    gives an empty table; a text is scanned whole.
    """
    chosen = tuple(templates or TEMPLATES)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = compiled(chosen, least)
        for batch in batches:
            rows = [(doc, *f) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for f in matcher.scan(text.as_py() or "")]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "license", "dice", "start_word", "end_word"])

    return docs.select("doc_id", "text").mapInArrow(scan, SCHEMA)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))
