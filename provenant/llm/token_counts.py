"""Token counts by the whole-token shortcut.

A sentence-piece BPE model never merges across a point that no vocabulary string spans. In the model used
here no piece holds a space mark after another character and none holds a line feed, so a text falls into
independent pre-tokens: a run of space marks with the characters after it, or a run of line feeds. Before
any text is read, every vocabulary string of pre-token shape is encoded alone; those that come back as one
token form the shortcut table. Matching pre-tokens then count as one without a merge, and only the rest is
merged (each distinct string once per worker, in a table of bounded size).

Both facts are checked when the table is built, so a vocabulary for which they fail is refused.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provenant.llm.common import documents, segments

SPACE = "▁"
PRETOKEN = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+")
CUT = re.compile(f"(?<=[^{SPACE}]){SPACE}|(?<=[^\n])\n")
#: Distinct merged strings that a worker remembers; the table is emptied when full, which costs time only.
REMEMBERED = 500_000


class Counts(dict):
    """Tokens by pre-token: starts as the shortcut table, fills with merged strings."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        normal = [
            p for i, p in enumerate(pieces)
            if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i))
        ]
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in normal):
            raise ValueError("a vocabulary string spans two pre-tokens; the shortcut would be wrong")
        probe = self.model.encode("a\nb", out_type=str)
        if probe[0] != SPACE + "a" or len(self.model.encode("  ")) < 1:
            raise ValueError("the model must add a space mark in front and keep white space")
        whole = [p for p in normal if PRETOKEN.fullmatch(p)]
        self.shortcut = {p: 1 for p in whole if self.alone(p) == 1}
        super().__init__(self.shortcut)

    def alone(self, pretoken: str) -> int:
        """Tokens of a pre-token that stands between two others."""
        if pretoken[0] == SPACE:  # the library puts this mark in front itself
            rest = pretoken[1:]
            return len(self.model.encode(rest)) if rest else 1
        return len(self.model.encode("\n" + pretoken)) - 2  # without the front mark and the line feed

    def __missing__(self, pretoken: str) -> int:
        if len(self) - len(self.shortcut) >= REMEMBERED:
            self.clear()
            self.update(self.shortcut)
        n = self[pretoken] = self.alone(pretoken)
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = SPACE + text.replace(" ", SPACE)
        get, find = self.__getitem__, PRETOKEN.findall
        if len(marked) < 1 << 20:
            return sum(map(get, find(marked)))
        return sum(sum(map(get, find(part))) for part in segments(marked, CUT))


@lru_cache(maxsize=4)
def counts_for(model_file: str) -> Counts:
    return Counts(model_file)


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit.

    Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows are counted each; every
    other column is kept (columns that are called like the three results are replaced); an empty table gives
    an empty table. Special strings inside a text are ordinary text, as the library treats them.
    """

    @F.pandas_udf("long")
    def n_tokens(texts: pd.Series) -> pd.Series:
        count = counts_for(model_file).count
        return pd.Series([count(x) if x else 0 for x in texts], dtype="int64")

    whole = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.drop("n_bytes", "n_tokens", "over_limit")
        .withColumn("n_bytes", F.octet_length(whole).cast("long"))
        .withColumn("n_tokens", n_tokens(whole))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(documents(spark, sf_dir), model).drop("text")
