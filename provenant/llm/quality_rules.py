"""Line-first quality rules, in DataFrame functions only.

Each line of a text is judged by itself: broken punctuation, navigation, boilerplate. Failing lines are
removed; a document that loses more than ``max_lost`` of its word characters that way is rejected, as is one
that fails the base rules (too few words, or too many words inside repeated 8-word windows).

Everything is a projection of one row: no shuffle, no Python, and the scan reads the text once. An array that
several expressions use is bound with :func:`let`, so that it is computed once and not once per element.

Defined results: a null or empty text has no words, so it fails the base rules; repeated rows are judged each;
columns that share a name with a result are replaced; an empty table gives an empty table. Blank lines are
never removed and count for nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provenant.llm.common import documents, free_name

BLANK = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines_removed", "chars_removed", "clean_text")

#: A line of at most this many words that holds one of these phrases is boilerplate.
BOILERPLATE_WORDS = 30
BOILERPLATE = (
    "all rights reserved", "privacy policy", "cookie policy", "accept cookies", "use of cookies", "terms of service",
    "terms of use", "enable javascript", "javascript is disabled", "subscribe to our newsletter", "sign up for our",
    "click here to", "share this", "skip to content", "back to top", "read more »", "lorem ipsum",
)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words in order. One literal split character is far cheaper than a pattern."""
    for blank in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.filter(F.split(text, " "), lambda w: w != "")


def repeat_words(words: Column) -> Column:
    """How many words lie in 8-word windows that the array holds twice or more.

    Windows are compared by 64-bit hashes, built from word hashes by pairing three times (1, 2, 4, 8 words).
    """

    def covered(hashes: Column) -> Column:
        """Sort (hash, position), keep equal neighbours, and measure the union of their windows."""
        tagged = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(t: Column) -> Column:
            found = F.filter(t, lambda x, k: (F.get(t, k - 1)["h"] == x["h"]) | (F.get(t, k + 1)["h"] == x["h"]))
            return F.sort_array(F.transform(found, lambda x: x["i"]))

        def span(p: Column) -> Column:
            gaps = F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
            return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

        return let(let(tagged, starts), span)

    def count(hashes: Column) -> Column:
        whole = F.slice(hashes, 1, F.size(hashes) - (WINDOW - 1))  # the last windows would be short
        return let(whole, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))

    def paired(hashes: Column, step: int) -> Column:
        return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + step)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    eights = let(let(let(hashes, lambda h: paired(h, 1)), lambda h: paired(h, 2)), lambda h: paired(h, 4))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(let(eights, count)).cast("long")


def line_fails(line: Column) -> Column:
    """True for a line that a rule removes; null-free; blank lines pass."""

    def judge(words: Column) -> Column:
        n, chars = F.size(words), F.length(line)
        symbols = chars - F.length(F.regexp_replace(line, SYMBOL, ""))
        shouts = F.size(F.split(line, r"[!?]{2,}")) - 1
        letterless = ~line.rlike(r"[\p{L}\p{N}]")
        unended = (n < 3) & ~line.rlike(r"[\p{L}\p{N}].*[.!?…:;。！？”\"')\]]\s*$") & (symbols > 0)
        navigation = (F.size(F.split(line, r"\s[|»›·•>]\s")) - 1) * 4 >= n
        boilerplate = (n <= BOILERPLATE_WORDS) & F.lower(line).rlike("|".join(BOILERPLATE))
        monotone = (n >= 10) & (F.size(F.filter(words, lambda w, i: F.get(words, i - 1) == w)) * 2 >= n)
        punctuation = letterless | unended | (symbols * 3 > n) | (shouts * 3 > n)
        return (n > 0) & (punctuation | ((n >= 3) & navigation) | boilerplate | monotone)

    return let(words_of(line), judge)


def may_fail(text: Column, n_symbols: Column, n_repeats: Column) -> Column:
    """False only where no line of the text can fail: each rule needs one of these marks somewhere."""
    low = F.lower(text)
    phrase = low.contains(BOILERPLATE[0])
    for p in BOILERPLATE[1:]:
        phrase = phrase | low.contains(p)
    return (n_symbols > 0) | (n_repeats >= 5) | text.rlike(r"[!?]{2}|[»›·•]|(?m:^[^\p{L}\p{N}\n]+$)") | phrase


def quality_rules(docs: DataFrame, text: str = "text", min_words: int = 20, max_repeat_pct: int = 30, max_lost_pct: int = 50) -> DataFrame:
    """``docs`` with the columns of ``RESULTS`` added.

    Defined results: a null or empty text has no words and fails the base rules; equal lines, ties and repeated rows are
    judged each; columns called like a result are replaced, all others are kept; an empty table gives an empty table; a
    text is judged whole, however long.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    has_word = r"[^\x20\x09-\x0D]"

    def measured(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.size(F.filter(words, lambda w, i: F.get(words, i - 1) == w)).alias("n_repeats"),
            repeat_words(words).alias("n_repeat_words"),
        )

    out = docs.drop(*RESULTS)
    seen, rest = free_name(docs, "__quality_words"), free_name(docs, "__quality_rest")
    out = out.withColumn(seen, let(words_of(whole), measured))
    out = out.withColumn("n_symbols", (F.length(whole) - F.length(F.regexp_replace(whole, SYMBOL, ""))).cast("long"))
    suspect = may_fail(whole, F.col("n_symbols"), F.col(f"{seen}.n_repeats"))
    out = out.withColumn(rest, F.when(suspect, F.filter(F.split(whole, "\n"), lambda x: ~line_fails(x))))
    n_dup = let(F.filter(F.split(whole, "\n"), lambda x: x.rlike(has_word)), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    out = out.select(
        *[c for c in out.columns if c not in (seen, rest, "n_symbols")],
        F.col(f"{seen}.n_words").alias("n_words"),
        F.col(f"{seen}.word_chars").alias("word_chars"),
        "n_symbols",
        n_dup.cast("long").alias("n_dup_lines"),
        F.col(f"{seen}.n_repeat_words").alias("n_repeat_words"),
        F.when(F.col(rest).isNull(), 0).otherwise(F.size(F.split(whole, "\n")) - F.size(rest)).cast("long").alias("n_lines_removed"),
        F.coalesce(F.array_join(rest, "\n"), whole).alias("clean_text"),
    )
    clean_chars = F.length(F.regexp_replace("clean_text", BLANK, ""))
    out = out.withColumn("chars_removed", F.when(F.col("n_lines_removed") == 0, 0).otherwise(F.col("word_chars") - clean_chars).cast("long"))
    out = out.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & (100 * F.col("chars_removed") <= max_lost_pct * F.col("word_chars")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).drop("text", "clean_text")
