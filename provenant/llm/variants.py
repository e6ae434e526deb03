"""Spelling variants of a corpus's words by full neighbourhood generation.

1. Words and their counts, by DataFrame functions.
2. Every distinct deletion, replacement and insertion over the observed alphabet is made for every word: a change is
   an operation at a place with a character, and ``neighbours`` leaves out those that give a string twice. Their hashes
   follow from the word's by arithmetic, so a word of n letters costs about 2 * n * alphabet additions and no string.
3. A Bloom filter of the vocabulary (a bitmap of a fixed size at most) drops nearly all changes that are no word. The
   others become strings and are hash-joined to the vocabulary by Spark. What joins is one edit away; no distance is
   computed. The filter only saves shuffling: what it lets through wrongly finds no partner.
4. A word's form is its commonest neighbour if that is far commoner; roots follow by pointer doubling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provenant.llm.common import documents, drop_written, written
from provenant.llm.shingles import MIX, mixed, powers

#: Letters of a run: ASCII, and the code points U+00C0 to U+00FF, so that a code point is one Latin-1 byte.
RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_base = 0x9E3779B97F4A7C15
_inverse = pow(_base, -1, 1 << 64)
_codes = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bits of the filter for each word, and its largest size (64 MiB), beyond which more changes reach the join.
BITS_PER_WORD, MOST_BITS = 32, 1 << 29
#: Hash functions of the filter for short words and, as a wrong pass is dearer there, for words of over LONG letters.
FUNCTIONS, LONG_FUNCTIONS, LONG = 2, 8, 32
#: Changes whose hashes are made at a time.
CHUNK = 1 << 18


def words(docs: DataFrame, deleted_of: int = 31, shortest: int = 7, least: int = 2) -> DataFrame:
    """(word, n): the runs of letters of all texts, ASCII in lower case, of ``shortest`` letters or more, that occur ``least`` times or more.

    One occurrence in ``deleted_of`` loses the letter that the CRC-32 of its id and run tells (0: none does).
    """
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"{RUN}{{{shortest},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    word: Column = F.col("run")
    if deleted_of:
        h = F.crc32(F.concat_ws(":", "id", "run"))
        at = (h % F.length("run")).cast("int")
        word = F.when(h % deleted_of == 0, F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))).otherwise(word)
    counted = found.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter((F.length("word") >= shortest) & (F.col("n") >= least))


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of Latin-1 bytes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def hashes(w: np.ndarray) -> np.ndarray:
    """The polynomial of each row of letters."""
    return (_codes[w] * powers(_base, max(w.shape[1], 2))[: w.shape[1]]).sum(1, dtype=np.uint64)


def neighbours(w: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(change, places, hashes, distinct) of the changes of the rows of ``w``, by row, place and letter, some places at a time.

    Of equal strings one is ``distinct``: in a stretch of equal letters the last one is deleted, and a letter is inserted
    after its equals, not before. Changes of different kinds differ in length.
    """
    n, length = w.shape
    power = powers(_base, length + 2)
    before = np.zeros((n, length + 1), np.uint64)
    np.cumsum(_codes[w] * power[:length], 1, out=before[:, 1:], dtype=np.uint64)
    after = before[:, -1:] - before  # of the letters from each place on
    lower, higher = after * np.uint64(_inverse), after * np.uint64(_base)
    last = np.ones((n, length, 1), bool)
    last[:, :-1, 0] = w[:, :-1] != w[:, 1:]
    yield 0, np.arange(length), (before[:, :-1] + lower[:, 1:])[:, :, None], last

    codes, step = _codes[alphabet], max(1, CHUNK // (len(alphabet) * n))
    for at in range(0, length + 1, step):
        places = np.arange(at, min(at + step, length + 1))
        made = codes * power[places][:, None]  # the new letter at its place
        inner = places[places < length]
        other = w[:, inner, None] != alphabet
        yield 1, inner, (before[:, inner] + after[:, inner + 1])[:, :, None] + made[: len(inner)], other
        free = np.ones((n, len(places), len(alphabet)), bool)
        free[:, : len(inner)] = other
        yield 2, places, (before[:, places] + higher[:, places])[:, :, None] + made, free


def first_bit(h: np.ndarray, size: int) -> np.ndarray:
    """The first place in a filter of ``size`` bits (a power of two)."""
    return ((h * MIX) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def more_bits(h: np.ndarray, length: int, size: int) -> Iterator[np.ndarray]:
    """The further places of strings of one length."""
    h = mixed(h)
    step = mixed(h) | np.uint64(1)
    for _ in range(1, LONG_FUNCTIONS if length > LONG else FUNCTIONS):
        yield (h & np.uint64(size - 1)).astype(np.int64)
        h = h + step


def held(filled: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (filled[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0


def passed(filled: np.ndarray, h: np.ndarray, distinct: np.ndarray, length: int) -> np.ndarray:
    """Flat positions of the distinct changes that the filter lets through."""
    size, h = 8 * len(filled), h.ravel()
    left = np.flatnonzero(held(filled, first_bit(h, size)) & distinct.ravel())
    turns = more_bits(h[left], length, size)
    ok = np.ones(len(left), bool)
    for places in turns:
        ok &= held(filled, places)
    return left[ok]


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, letters) of words of equal length, as many as one chunk of changes takes for each letter."""
    sizes = np.array(list(map(len, words)))
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        many = max(1, CHUNK // (64 * int(length)))
        for lo in range(0, len(at), many):
            yield at[lo : lo + many], letters([words[i] for i in at[lo : lo + many]])


def bloom(spark: SparkSession, vocabulary: DataFrame, n_words: int) -> np.ndarray:
    """The filter of a vocabulary (word), as bytes of eight bits: built in stretches by tasks, at most MOST_BITS in all."""
    stretch = 1 << 18  # bits
    size = 1 << (max(stretch, min(n_words * BITS_PER_WORD, MOST_BITS)) - 1).bit_length()

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, w in by_length(batch.column(0).to_pylist()):
                h = hashes(w)
                at = np.concatenate([first_bit(h, size), *more_bits(h, w.shape[1], size)])
                yield pa.RecordBatch.from_arrays([pa.array(at // stretch, pa.int32()), pa.array(at % stretch, pa.int32())], ["stretch", "place"])

    def fill(table: pa.Table) -> pa.Table:
        here = np.zeros(stretch, bool)
        here[table.column("place").to_numpy()] = True
        return pa.table({"stretch": table.column("stretch")[:1], "filled": pa.array([np.packbits(here, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros(size // 8, np.uint8)
    found = vocabulary.select("word").mapInArrow(places, "stretch int, place int").groupBy("stretch").applyInArrow(fill, "stretch int, filled binary")
    for row in found.collect():  # size // stretch rows of 32 KiB
        out[row.stretch * stretch // 8 : (row.stretch + 1) * stretch // 8] = np.frombuffer(row.filled, np.uint8)
    return out


def changed(w: np.ndarray, change: int, rows: np.ndarray, places: np.ndarray, new: np.ndarray) -> list[str]:
    """The strings that single changes make of rows of ``w``."""
    out, skip = [], 0 if change == 2 else 1
    for row, at, letter in zip(rows.tolist(), places.tolist(), new.tolist(), strict=True):
        word = w[row].tobytes()
        out.append((word[:at] + (bytes([letter]) if change else b"") + word[at + skip :]).decode("latin-1"))
    return out


def candidates(texts: list[str], alphabet: np.ndarray, filled: np.ndarray) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(positions of words, their changes) that the filter lets through, of all distinct changes of ``texts``."""
    for at, w in by_length(texts):
        for change, places, h, distinct in neighbours(w, alphabet):
            left = passed(filled, h, distinct, w.shape[1] + change - 1)
            if len(left):
                row, place, letter = np.unravel_index(left, h.shape)
                yield at[row], changed(w, change, row, places[place], alphabet[letter])


def neighbour_pairs(spark: SparkSession, vocabulary: DataFrame, n_words: int) -> DataFrame:
    """(word, n, near, near_n): all pairs of words of ``vocabulary`` (word, n) that one edit separates, both ways round."""
    chars = vocabulary.select(F.explode(F.split("word", "")).alias("c")).distinct()  # 90 letters at most
    alphabet = np.array(sorted(ord(r.c) for r in chars.collect() if r.c), np.uint8)
    shared = spark.sparkContext.broadcast(bloom(spark, vocabulary, n_words))

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, near in candidates(batch.column(0).to_pylist(), alphabet, shared.value):
                source = pa.array(source)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(source), batch.column(1).take(source), pa.array(near, pa.string())], ["word", "n", "near"])

    made = vocabulary.select("word", "n").mapInArrow(generate, "word string, n long, near string")
    return made.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n")


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form), following forms to their end. A form is far commoner than its word, so
    chains are short and no circle; each round doubles the steps."""
    at = written(spark, forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not at.join(ahead, "root", "left_semi").limit(1).count():
            return at
        step = written(spark, at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
        drop_written(spark, at)
        at = step


def variants(spark: SparkSession, docs: DataFrame, times: int = 10, deleted_of: int = 31, shortest: int = 7, least: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of ``docs`` (doc_id, text); see :func:`words`.

    Defined results: a null or empty text has no words; a null id counts as the empty string; repeated rows count each
    time; of neighbours that are equally common the smallest by code points is taken, and only then compared with the
    word (``times`` as common or more); a word without form is its own root; a word without neighbours has n_near 0;
    texts and words of any length are taken whole; further columns are not read; an empty table gives an empty table.
    """
    vocabulary = written(spark, words(docs, deleted_of, shortest, least))
    pairs = neighbour_pairs(spark, vocabulary, vocabulary.count())
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    found = vocabulary.join(best, "word", "left").withColumn("form", F.when(-F.col("best.n") >= times * F.col("n"), F.col("best.near")))
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", F.when(F.col("form").isNotNull(), -F.col("best.n")).alias("form_n"))
    found = written(spark, found)
    drop_written(spark, vocabulary)
    ends = roots(spark, found.filter("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark, documents(spark, sf_dir))
