"""Fuzzy lookup of names by shared trigrams, without a list of pairs given beforehand.

Two names of Jaccard similarity t or more share a trigram among the rarest of each: of n trigrams in an order that is the
same for all names, the first n - ceil(t * n) + 1 are enough (the prefix). Names are dealt into blocks and questions into
parts, and every block meets every part in a task of its own. There a posting holds the names of a trigram of a prefix, by
what is rare in the block, so common trigrams make none. Sizes, the count of shared prefix trigrams and what can follow behind
them drop names that cannot reach t; the others are compared. Only similar pairs leave the task: no row is made, shuffled or
spilled for a shared trigram.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provenant.operators.retrieval import trigrams
from provenant.session import written

#: Names of a block, and questions of a part, about so many.
BLOCK_NAMES = 30_000


@dataclass
class Index:
    """``names``: (id, grams), written. ``prefixes``: (gram, place, id, n) and ``counts``: (gram, df) follow from it and
    are worked out where they are asked for."""

    names: DataFrame
    prefixes: DataFrame
    counts: DataFrame
    least: float


def needed(n: Column, least: float) -> Column:
    """Trigrams of a name of ``n`` that a similar one must share at least."""
    return F.ceil(n * least - 1e-9)


def ordered(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(id, grams): the distinct trigrams of each name, rarest first; ones that no indexed name has come first."""
    grams = names.filter("name is not null").select("id", F.explode(trigrams(F.col("name"))).alias("gram"))
    with_df = grams.join(counts, "gram", "left").select("id", F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram").alias("g"))
    return with_df.groupBy("id").agg(F.array_sort(F.collect_list("g")).alias("g")).select("id", F.col("g.gram").alias("grams"))  # one name


def prefixes(names: DataFrame, least: float) -> DataFrame:
    n = F.size("grams")
    head = F.slice("grams", F.lit(1), (n - needed(n, least) + 1).cast("int"))
    return names.select(F.posexplode(head).alias("place", "gram"), "id", n.alias("n")).select("gram", "place", "id", "n")


def build(spark: SparkSession, names: DataFrame, least: float = 0.5, id_col: str = "id", name_col: str = "name") -> Index:
    """The index of ``names`` for lookups of similarity ``least`` or more (over 0). Null names are left out."""
    if not 0 < least <= 1:
        raise ValueError("the least similarity lies over 0 and up to 1")
    rows = names.select(F.col(id_col).alias("id"), F.col(name_col).alias("name")).filter("id is not null")
    grams = rows.filter("name is not null").select(F.explode(trigrams(F.col("name"))).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count("*").alias("df"))
    kept = rows.filter("name is not null").groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list(trigrams(F.col("name"))))).alias("grams"))  # one name
    return Index(written(spark, kept), prefixes(ordered(rows, counts), least), counts, least)


class Postings:
    """The grams of a block's names and a part's questions as numbers, rarest in the block first, and postings of the prefixes."""

    def __init__(self, names: pa.ChunkedArray, questions: pa.ChunkedArray, least: float):
        grams = pa.concat_arrays([names.combine_chunks().flatten(), questions.combine_chunks().flatten()]).dictionary_encode()
        codes, self.least = grams.indices.to_numpy(), least
        sizes = [pc.list_value_length(c).to_numpy().astype(np.int64) for c in (names, questions)]
        n = int(sizes[0].sum())
        df = np.bincount(codes[:n], minlength=len(grams.dictionary))
        rank = np.empty(len(df), np.int64)
        rank[np.argsort(df, kind="stable")] = np.arange(len(df))
        (self.names, self.sizes, self.starts), (self.asked, self.qsizes, self.qstarts) = (self.in_order(rank[c], k) for c, k in zip((codes[:n], codes[n:]), sizes, strict=True))
        # One posting for each gram of a prefix: the names, and the gram's place in them.
        place = np.arange(n) - np.repeat(self.starts, self.sizes)
        head = place < np.repeat(self.prefix(self.sizes), self.sizes)
        gram, name, place = self.names[head], np.repeat(np.arange(len(self.sizes)), self.sizes)[head], place[head]
        order = np.argsort(gram, kind="stable")
        self.name, self.place = name[order], place[order]
        self.begins = np.searchsorted(gram[order], np.arange(len(df) + 1))
        self.wanted = np.zeros(len(df), bool)

    @staticmethod
    def in_order(grams: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(sizes)), sizes)
        return grams[np.lexsort((grams, row))], sizes, np.cumsum(sizes) - sizes

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - np.ceil(n * self.least - 1e-9).astype(np.int64) + 1

    def similar(self):
        """(question, names, similarities) by their places, for the questions that have any."""
        least, sizes, seen = self.least, self.sizes, np.zeros(len(self.sizes), np.int32)
        last, qlast = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        enough = np.ceil(sizes * least - 1e-9)
        for q, (a, n, head) in enumerate(zip(self.qstarts.tolist(), self.qsizes.tolist(), self.prefix(self.qsizes).tolist(), strict=True)):
            own = self.asked[a : a + n]
            for i, gram in enumerate(own[:head].tolist()):
                x, z = self.begins[gram], self.begins[gram + 1]
                if x < z:
                    names = self.name[x:z]
                    seen[names] += 1  # a name is in a posting once, and its places ascend with the question's
                    last[names], qlast[names] = self.place[x:z], i
            found = np.flatnonzero(seen)
            if not len(found):
                continue
            size, most = sizes[found], seen[found] + np.minimum(n - qlast[found] - 1, sizes[found] - last[found] - 1)
            seen[found] = 0
            fit = (size >= np.ceil(n * least - 1e-9)) & (n >= enough[found]) & (most >= np.ceil((n + size) * (least / (1 + least)) - 1e-9))
            found, size = found[fit], size[fit]
            if not len(found):
                continue
            self.wanted[own] = True
            ends = np.cumsum(size)
            both = np.add.reduceat(self.wanted[self.names[np.repeat(self.starts[found] - ends + size, size) + np.arange(ends[-1])]], ends - size, dtype=np.int64)
            self.wanted[own] = False
            similarity = both / (n + size - both)
            fit = similarity >= least - 1e-9
            if fit.any():
                yield q, found[fit], similarity[fit]


def candidates(index: Index, asked: DataFrame) -> DataFrame:
    """(query, id, similarity) of the names that are similar enough to ``asked`` (id, grams)."""
    n_blocks, n_parts = (max(1, -(-rows.count() // BLOCK_NAMES)) for rows in (index.names, asked))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    names = index.names.select("id", "grams", dealt(n_blocks).alias("block"), every(n_parts).alias("part"))
    questions = asked.select("id", "grams", dealt(n_parts).alias("part"), every(n_blocks).alias("block"))
    kinds = [rows.schema["id"].dataType.simpleString() for rows in (asked, index.names)]
    least = index.least

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = list(Postings(left.column("grams"), right.column("grams"), least).similar()) if len(left) and len(right) else []
        at = np.repeat(np.array([q for q, _, _ in found], np.int64), [len(rows) for _, rows, _ in found])
        rows, similarity = (np.concatenate([np.zeros(0, kind), *(f[k] for f in found)]) for k, kind in ((1, np.int64), (2, np.float64)))
        return pa.table({"query": right.column("id").take(pa.array(at)), "id": left.column("id").take(pa.array(rows)), "similarity": pa.array(similarity)})

    groups = 2 * n_blocks * n_parts  # so that few groups share a task
    left, right = (rows.repartition(groups, "block", "part").groupBy("block", "part") for rows in (names, questions))
    return left.cogroup(right).applyInArrow(meet, f"query {kinds[0]}, id {kinds[1]}, similarity double")


def lookup(index: Index, queries: DataFrame, query_id: str = "query", name_col: str = "name") -> DataFrame:
    """(query, id, similarity) of every indexed name that is similar enough to a question's."""
    rows = queries.select(F.col(query_id).alias("id"), F.col(name_col).alias("name")).filter("id is not null and name is not null")
    asked = rows.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list(trigrams(F.col("name"))))).alias("grams"))  # one name
    return candidates(index, asked)
