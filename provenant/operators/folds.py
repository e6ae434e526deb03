"""Rules whose next answer depends on the one before, as folds over the rows of a key in order of time.

A :class:`Fold` is a small state and a step. :func:`folded` runs it over a table in one shuffle by key, with one state in
memory at a time; ``provenant.streaming.ordered`` runs the same steps over a stream, with state and timers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from provenant.operators.responses import REFUSALS, RESETS

AT = "_at"


@dataclass(frozen=True)
class Fold:
    """``step(state, row)`` and ``tick(state, upto)`` return the new state and rows of ``output``; times are in microseconds.

    ``state`` is a tuple of the ``states`` fields, None at first. ``tick`` tells what happens by itself up to a time, and
    ``wake(state)`` when that may be next.
    """

    states: str
    output: str
    step: Callable[[tuple | None, dict], tuple[tuple | None, list[tuple]]]
    tick: Callable[[tuple | None, int], tuple[tuple | None, list[tuple]]] = lambda state, upto: (state, [])
    wake: Callable[[tuple | None], int | None] = lambda state: None

    def run(self, state: tuple | None, rows: list[dict]) -> tuple[tuple | None, list[tuple]]:
        out = []
        for row in rows:
            state, before = self.tick(state, row[AT])
            state, after = self.step(state, row)
            out += before + after
        return state, out


def micros(at: Column, kind: T.DataType) -> Column:
    """A time as microseconds; whole numbers stay as they are."""
    return at.cast("long") if isinstance(kind, T.IntegralType) else F.unix_micros(at.cast("timestamp"))


def folded(rows: DataFrame, keys: list[str], when: str, order: list[str], fold: Fold, until: int | None = None) -> DataFrame:
    """(keys, output) of ``fold`` over the rows of each key by ``when`` and ``order``; what comes by itself is told up to ``until``.

    Rows without a time are left out. A key's rows are streamed through one task in order and never held together.
    """
    kept = rows.filter(F.col(when).isNotNull()).withColumn(AT, micros(F.col(when), rows.schema[when].dataType))
    schema = T.StructType([*(rows.schema[k] for k in keys), *T.StructType.fromDDL(fold.output).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []

        def ended() -> list[tuple]:
            return [(*key, *o) for o in fold.tick(state, until)[1]] if key is not None and until is not None else []

        for batch in batches:
            for row in batch.to_pylist():
                own = tuple(row[k] for k in keys)
                if own != key:
                    out += ended()
                    key, state = own, None
                state, made = fold.run(state, [row])
                out += [(*key, *o) for o in made]
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, o, strict=True)) for o in out], arrow)
                out = []
        if last := ended():
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, o, strict=True)) for o in last], arrow)

    return kept.repartition(*keys).sortWithinPartitions(*keys, AT, *order).mapInArrow(run, schema)


# --- the job queue --------------------------------------------------------------------------------------------

#: Commands to a job (job_id, seq, kind, worker, error, run_after, retry_at, max_attempts), times in microseconds.
COMMANDS = "job_id long, seq long, at timestamp, kind string, worker string, error string, run_after long, retry_at long, max_attempts int"
MOST_ERROR = 500


def queue_step(state: tuple | None, c: dict) -> tuple[tuple | None, list[tuple]]:
    """A job is enqueued once. Only a runnable job is claimed, and only the worker that holds it completes or fails it;
    a failed one is queued again for ``retry_at`` while attempts remain. Other commands change nothing."""
    kind, at = c["kind"], c[AT]
    if state is None:
        if kind != "ENQUEUE":
            return None, []
        ready = max(c["run_after"] if c["run_after"] is not None else at, at)
        return ("QUEUED", 0, c["max_attempts"] or 1, ready, None, False, 1), [(0, at, "ENQUEUED", None)]
    status, attempts, most, ready, holder, told, n = state
    if kind == "CLAIM" and status == "QUEUED" and ready <= at:
        return ("RUNNING", attempts + 1, most, ready, c["worker"], told, n + 1), [(n, at, "CLAIMED", c["worker"])]
    if status == "RUNNING" and holder == c["worker"] and holder is not None:
        error = (c["error"] or "")[:MOST_ERROR]
        if kind == "COMPLETE":
            return ("SUCCEEDED", attempts, most, ready, None, told, n + 1), [(n, at, "SUCCEEDED", None)]
        if kind == "FAIL" and c["retry_at"] is not None and attempts < most:
            return ("QUEUED", attempts, most, max(c["retry_at"], at), None, False, n + 1), [(n, at, "RETRY_SCHEDULED", error)]
        if kind == "FAIL":
            return ("FAILED", attempts, most, ready, None, told, n + 1), [(n, at, "FAILED", error)]
    return state, []


def queue_tick(state: tuple | None, upto: int) -> tuple[tuple | None, list[tuple]]:
    """A queued job becomes runnable when its time has come."""
    if state is None or state[0] != "QUEUED" or state[5] or state[3] > upto:
        return state, []
    return (*state[:5], True, state[6] + 1), [(state[6], state[3], "RUNNABLE", None)]


def queue_wake(state: tuple | None) -> int | None:
    return state[3] if state is not None and state[0] == "QUEUED" and not state[5] else None


#: Events (job_id, n, at, event, detail): n counts a job's events from 0.
QUEUE = Fold("status string, attempts int, most int, ready long, holder string, told boolean, n long", "n long, at long, event string, detail string", queue_step, queue_tick, queue_wake)


# --- breaker and pacing ---------------------------------------------------------------------------------------


def breaker(threshold: int, refusals: tuple[int, ...] = REFUSALS, resets: tuple[int, ...] = RESETS) -> Fold:
    """(seq, status, tripped) of the attempts (seq, status) that a run makes: the one at which refusals since the last reset
    reach the threshold is its last."""

    def step(state: tuple | None, row: dict) -> tuple[tuple | None, list[tuple]]:
        n, tripped = state or (0, False)
        if tripped:
            return state, []
        status = row["status"]
        n = 0 if status in resets else n + (status in refusals)
        tripped = status in refusals and n >= threshold
        return (n, tripped), [(row["seq"], status, tripped)]

    return Fold("refusals int, tripped boolean", "seq long, status int, tripped boolean", step)


def pacing(min_delay: int) -> Fold:
    """(seq, since) of the requests (seq, end) that begin less than ``min_delay`` microseconds after the one before began,
    or before it ended."""

    def step(state: tuple | None, row: dict) -> tuple[tuple | None, list[tuple]]:
        start = row[AT]
        late = state is not None and (start - state[0] < min_delay or (state[1] is not None and state[1] > start))
        return (start, row["end"]), [(row["seq"], start - state[0])] if late else []

    return Fold("start long, end long", "seq long, since long", step)
