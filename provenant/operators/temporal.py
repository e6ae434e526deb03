"""As-of resolution, version differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def earliest_end(*ends: Column) -> Column:
    """The first of expiry, withdrawal and effective supersession; unknown ones do not count."""
    return F.least(*ends) if len(ends) > 1 else ends[0]


def state_at(x: Column, effective: Column, expiry: Column, withdrawn: Column, superseded: Column) -> Column:
    """State of a version on day ``x``: its interval is [from, to). Recency decides nothing."""
    end = earliest_end(expiry, withdrawn, superseded)
    ended = F.coalesce(end <= x, F.lit(False))
    return (
        F.when(effective.isNull(), "UNKNOWN")
        .when(effective > x, "NOT_YET_EFFECTIVE")
        .when(~ended, "IN_FORCE")
        .when(end == withdrawn, "WITHDRAWN")
        .when(end == superseded, "SUPERSEDED")
        .otherwise("EXPIRED")
    )


def resolved_state(
    x: Column, effective: Column, expiry: Column, withdrawn: Column, superseded: Column, partly: Column, amended: Column, conflicting: Column
) -> Column:
    """The state of a version on day ``x``, of nine. ``partly``: superseded for a part of it only; ``amended``: the first
    day of an amendment; ``conflicting``: an overlapping duty without an explicit relation. Order of input decides nothing."""
    plain = state_at(x, effective, expiry, withdrawn, F.when(~F.coalesce(partly, F.lit(False)), superseded))
    return (
        F.when(plain == "UNKNOWN", "UNKNOWN_EFFECTIVE_DATE")
        .when(plain == "NOT_YET_EFFECTIVE", "ISSUED_NOT_EFFECTIVE")
        .when(plain != "IN_FORCE", plain)
        .when(F.coalesce(conflicting, F.lit(False)), "CONFLICTED")
        .when(F.coalesce(partly & (superseded <= x), F.lit(False)), "PARTIALLY_SUPERSEDED")
        .when(F.coalesce(amended <= x, F.lit(False)), "IN_FORCE_AMENDED")
        .otherwise("IN_FORCE")
    )


#: Levels of stretches: 2 ** LEVELS units of time are told apart, whatever the time spans.
LEVELS = 16


def ticks(at: Column, kind: T.DataType) -> Column:
    """A time as a whole number: days, microseconds, or the number that it is."""
    if isinstance(kind, T.DateType):
        return F.unix_date(at).cast("long")
    return at.cast("long") if isinstance(kind, T.NumericType) else F.unix_micros(at.cast("timestamp"))


def stretches(first: Column, end: Column) -> Column:
    """The few stretches (level, no) that make up the units from ``first`` to before ``end``: at most two of each level.

    A stretch of level l is 2 ** l units long and begins at a multiple of that. At each level, what is left of the range
    gives up its first unit where that is odd, and its last where its end is odd; the rest halves.
    """

    found = []
    for level in range(LEVELS + 1):
        a, b, here = F.ceil(first / (1 << level)).cast("long"), F.floor(end / (1 << level)).cast("long"), F.lit(level).alias("level")
        found.append(F.when((a % 2 == 1) & (a < b), F.struct(here, a.alias("no"))))
        found.append(F.when((b % 2 == 1) & (a + a % 2 < b), F.struct(here, (b - 1).alias("no"))))
    return F.array_compact(F.array(*found))


def applicable(intervals: DataFrame, points: DataFrame, keys: list[str]) -> DataFrame:
    """Intervals (keys, start, end) that hold at points (keys, at): start <= at < end; an open end never ends.

    Time is cut into 2 ** LEVELS units between the first and the last point. An interval becomes the few stretches that make
    it up and a point the stretches that it lies in, one of each level, and they meet by equality: a pair is made where the
    interval holds at the point's unit, and only in the two units where an interval begins and ends are others left out. A
    key with many of both is spread over its stretches.
    """
    kind = points.schema["at"].dataType
    when, start, end = ticks(F.col("at"), kind), ticks(F.col("start"), intervals.schema["start"].dataType), ticks(F.col("end"), intervals.schema["end"].dataType)
    span = points.agg(F.min(when).alias("least"), F.max(when).alias("most")).first()
    if span.least is None:
        return points.join(intervals, keys).limit(0)
    unit = max(1, -(-(span.most - span.least + 1) // (1 << LEVELS)))
    place = lambda t: F.floor((t - F.lit(span.least)) / F.lit(unit)).cast("long")
    last = F.lit((span.most - span.least) // unit + 1)
    ranges = intervals.filter((start <= span.most) & F.coalesce(end > F.greatest(start, F.lit(span.least)), F.lit(True)))
    ends = F.least(F.coalesce(place(end - 1) + 1, last), last)
    pieces = ranges.select("*", F.explode(stretches(F.greatest(place(start), F.lit(0)), ends)).alias("_s"))
    pieces = pieces.select(*intervals.columns, F.col("_s.level").alias("_level"), F.col("_s.no").alias("_no"))
    levels = F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))
    at = points.filter(F.col("at").isNotNull()).select("*", place(when).alias("_unit"), levels.alias("_level"))
    at = at.withColumn("_no", F.expr("shiftright(_unit, _level)")).drop("_unit")
    found = at.join(pieces, [*keys, "_level", "_no"]).drop("_level", "_no")
    return found.filter("start <= at and (end is null or at < end)")


def latest_before(rows: DataFrame, points: DataFrame, keys: list[str], when: str, values: list[str]) -> DataFrame:
    """As-of join: for each point (keys, at) the values of the last row with ``when`` <= at.

    One shuffle by key: both sides' rows are sorted together and the last known row is carried forward, so no pairs
    are made.
    """
    from pyspark.sql import Window as W

    row = F.struct(*values)
    left = points.select(*keys, F.col("at"), F.lit(1).alias("_point"), F.struct(*points.columns).alias("_p"), F.lit(None).cast(rows.select(row.alias("r")).schema["r"].dataType).alias("_r"))
    right = rows.select(*keys, F.col(when).alias("at"), F.lit(0).alias("_point"), F.lit(None).cast(points.select(F.struct(*points.columns).alias("p")).schema["p"].dataType).alias("_p"), row.alias("_r"))
    w = W.partitionBy(*keys).orderBy("at", "_point").rowsBetween(W.unboundedPreceding, 0)
    both = left.unionByName(right).withColumn("_last", F.last("_r", ignorenulls=True).over(w))
    return both.filter("_point = 1").select("_p.*", *(F.col(f"_last.{v}").alias(v) for v in values))


def version_diff(old: DataFrame, new: DataFrame, label: str, hash_: str) -> DataFrame:
    """(label, change): ADDED, REMOVED or MODIFIED nodes between two versions; equal ones are left out."""
    o, n = old.select(label, F.col(hash_).alias("old_hash")), new.select(label, F.col(hash_).alias("new_hash"))
    change = F.when(F.col("old_hash").isNull(), "ADDED").when(F.col("new_hash").isNull(), "REMOVED").when(F.col("old_hash") != F.col("new_hash"), "MODIFIED")
    return o.join(n, label, "full_outer").select(label, change.alias("change")).filter("change is not null")
