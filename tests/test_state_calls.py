from pyspark.sql import types as T

from provenant.operators import folds
from provenant.streaming.ordered import Ordered


class Handle:
    """Counts the exchanges of a key with its state."""

    def __init__(self):
        self.calls, self.timers, self.rows = 0, [], []

    def getValueState(self, name, schema):  # noqa: N802
        return self

    getListState = getValueState  # noqa: N815

    def registerTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.append(at)

    def appendValue(self, row):  # noqa: N802
        self.appendList([row])

    def appendList(self, rows):  # noqa: N802
        self.calls += 1
        self.rows += rows


def test_calls_do_not_grow_with_the_rows_of_a_key(spark):
    rows = T.StructType.fromDDL("seq long, end long, _at long")
    step = Ordered(folds.pacing(1000), T.StructType.fromDDL("start long, end long"), rows, ["seq"], ["host", "seq", "since"])
    handle = Handle()
    step.init(handle)
    given = [{"seq": i, "end": None, "_at": 5_000_000 - i * 2000} for i in range(500)]
    assert list(step.handleInputRows(("h",), iter(given), None)) == []
    assert len(handle.rows) == 500 and handle.calls <= 4 and min(handle.timers) == 5000 - 499 * 2
