"""What the operators of this folder share: reading documents, scratch tables, splitting long texts."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provenant.session import run_dir

#: A text is handled in pieces of about this many characters where a whole copy of its tokens would not fit.
SEGMENT_CHARS = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table, with the two columns the operators read."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def written(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read again: its lineage ends there.

    A lost executor then costs a re-read, not a recomputation, and each consumer sees the same rows. What the caller does
    not drop itself goes with the application's folder.
    """
    path = f"{run_dir(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._provenant_path = path
    return out


def drop_written(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables of :func:`written` that no later plan reads."""
    for table in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(table._provenant_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a table of counts that is broadcast; a larger one is joined by a shuffle.
MOST_BROADCAST = 100_000


def few(table: DataFrame) -> DataFrame:
    """A written table marked for broadcasting where it has few rows; else as it is."""
    return F.broadcast(table) if table.count() <= MOST_BROADCAST else table


def segments(text: str, cut: re.Pattern[str], size: int = SEGMENT_CHARS) -> Iterator[str]:
    """``text`` in order as pieces of at least ``size`` characters, each cut where ``cut`` starts to match."""
    start = 0
    while len(text) - start > size:
        found = cut.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(df: DataFrame, stem: str = "__provenant") -> str:
    """A column name that ``df`` does not use, in any case."""
    taken = {c.lower() for c in df.columns}
    return next(name for name in (f"{stem}{n}" for n in range(len(taken) + 1)) if name not in taken)
