"""Ranks, previous values and running maxima inside a key that may hold a large share of all rows.

The order is cut into stretches, which one window each handles; what a stretch hands on to the next ones of its key is summed
up first, in a window over the stretches. A hot key is thus dealt over as many tasks as it has stretches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Stretches of the whole order; a key's window over its stretches has as many rows at most.
STRETCHES = 256


def stretched(rows: DataFrame, order: str, stretches: int) -> DataFrame:
    """``rows`` with ``_stretch``, an equal share of the range of ``order`` (a whole number)."""
    span = rows.agg(F.min(order).alias("least"), F.max(order).alias("most")).first()
    least, width = span.least or 0, max(1, -(-((span.most or 0) - (span.least or 0) + 1) // stretches))
    return rows.withColumn("_stretch", F.floor((F.col(order) - F.lit(least)) / F.lit(width)).cast("long"))


def with_heads(rows: DataFrame, keys: list[str], sums: dict[str, Column], before: dict[str, Column]) -> DataFrame:
    """``rows`` with what the earlier stretches of their key come to: ``sums`` of a stretch, and ``before`` over these."""
    heads = rows.groupBy(*keys, "_stretch").agg(*(c.alias(n) for n, c in sums.items()))
    heads = heads.select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)], F.col("_stretch").alias("_hs"), *(c.alias(n) for n, c in before.items()))
    same = [rows[k].eqNullSafe(heads[f"_h{i}"]) for i, k in enumerate(keys)]
    return rows.join(heads, [*same, rows["_stretch"] == heads["_hs"]]).drop("_hs", *(f"_h{i}" for i in range(len(keys))))


def numbered(rows: DataFrame, keys: list[str], order: str, value: str, no: str, previous: str, stretches: int = STRETCHES) -> DataFrame:
    """``rows`` with their number in the order of their key, from 1, and the ``value`` of the row before."""
    rows, over = stretched(rows, order, stretches), W.partitionBy(*keys).orderBy("_stretch")
    before = {"_offset": F.sum("_n").over(over.rowsBetween(W.unboundedPreceding, -1)), "_handed": F.lag("_last").over(over)}
    rows = with_heads(rows, keys, {"_n": F.count("*"), "_last": F.max_by(value, order)}, before)
    inside = W.partitionBy(*keys, "_stretch").orderBy(order)
    first = F.row_number().over(inside)
    out = rows.withColumns({no: (F.coalesce("_offset", F.lit(0)) + first).cast("long"), previous: F.when(first > 1, F.lag(value).over(inside)).otherwise(F.col("_handed"))})
    return out.drop("_stretch", "_offset", "_handed")


def running_max(rows: DataFrame, keys: list[str], order: str, value: str, out: str, stretches: int = STRETCHES) -> DataFrame:
    """``rows`` with the largest ``value`` of their key up to their place in the order; nulls do not count."""
    rows, over = stretched(rows, order, stretches), W.partitionBy(*keys).orderBy("_stretch")
    rows = with_heads(rows, keys, {"_most": F.max(value)}, {"_handed": F.max("_most").over(over.rowsBetween(W.unboundedPreceding, -1))})
    here = F.max(value).over(W.partitionBy(*keys, "_stretch").orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn(out, F.greatest(here, F.col("_handed"))).drop("_stretch", "_handed")
