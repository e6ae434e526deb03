"""Folds over streams: each result is that of the batch fold over the same rows, however the input is split.

Rows of a key wait until the watermark has passed them and are then folded in order of time, so rows that come late by less
than the delay take their place. Later ones are dropped, as by every stateful operator. Timers wake a key when rows are due, or
when its state says that something happens by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from provenant.operators.folds import AT, Fold, micros

#: State with timers and several variables lies in RocksDB.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def millis(at: int) -> int:
    """The first millisecond that is not before a microsecond: timers and watermarks count milliseconds."""
    return -(-at // 1000)


class Ordered(StatefulProcessor):
    """Keeps the state of a key and its rows that are not due yet."""

    def __init__(self, fold: Fold, states: T.StructType, rows: T.StructType, order: list[str], names: list[str]):
        self.fold, self.states, self.rows, self.order, self.names = fold, states, rows, order, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.states)
        self.waiting = handle.getListState("waiting", self.rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        # Every call to a state is an exchange with the executor's JVM, so a key makes the same few however many rows it has.
        new = [tuple(row[f] for f in self.rows.names) for row in rows]
        if new:
            self.waiting.appendList(new)
            at = self.rows.names.index(AT)
            self.handle.registerTimer(millis(min(r[at] for r in new)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = [dict(zip(self.rows.names, r, strict=True)) for r in self.waiting.get()]
        due = sorted((r for r in waiting if r[AT] <= upto), key=lambda r: [(r[c] is not None, r[c]) for c in (AT, *self.order)])
        later = [r for r in waiting if r[AT] > upto]
        before = self.state.get()
        before = state = None if before is None else tuple(before)
        state, out = self.fold.run(state, due)
        state, last = self.fold.tick(state, upto)
        if due and later:
            self.waiting.put([tuple(r.values()) for r in later])
        elif due:
            self.waiting.clear()
        if state is not None and state != before:
            self.state.update(state)
        # One timer: for the first row that still waits, or for what the state does by itself before that.
        wake = self.fold.wake(state)
        wakes = [r[AT] for r in later] + ([wake] if wake is not None and wake > upto else [])
        if wakes:
            self.handle.registerTimer(millis(min(wakes)))
        for row in out + last:
            yield Row(**dict(zip(self.names, (*key, *row), strict=True)))


def folded_stream(stream: DataFrame, keys: list[str], when: str, order: list[str], fold: Fold, delay: str) -> DataFrame:
    """(keys, output) of ``fold`` over a stream whose rows come at most ``delay`` late; see ``folds.folded``."""
    kept = stream.filter(F.col(when).isNotNull()).withColumn(AT, micros(F.col(when), stream.schema[when].dataType)).withWatermark(when, delay)
    rows = T.StructType([T.StructField(f.name, f.dataType) for f in kept.schema.fields if f.name not in (*keys, when)])
    output = T.StructType([*(stream.schema[k] for k in keys), *T.StructType.fromDDL(fold.output).fields])
    return kept.groupBy(*keys).transformWithState(Ordered(fold, T.StructType.fromDDL(fold.states), rows, order, output.names), output, "append", "eventtime")


def run_to(spark: SparkSession, rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write a stateful stream's rows to Parquet, each once, until its input is used up."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, PROVIDER)  # a query keeps the settings with which it starts
    try:
        return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(name, before)
