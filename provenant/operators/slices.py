"""Row by row Python over columns in bounded memory.

Spark hands a worker up to 10,000 rows at a time; as pandas objects and results they would all be held at once. Here a batch
stays in Arrow and only a slice of it is made into Python values.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import ArrowUDFType
from pyspark.sql.pandas.types import to_arrow_type

#: Rows, and bytes of input by their average, of a slice.
SLICE_ROWS, SLICE_BYTES = 256, 4 << 20


def by_slices(kind: T.DataType):
    """Register ``f`` (a list for each column, all of one length) -> list of values of ``kind``, as a function of columns."""

    def add(f: Callable[..., list]):
        arrow = to_arrow_type(kind)

        def run(batches):
            for batch in batches:
                columns = batch if isinstance(batch, tuple) else (batch,)
                n = len(columns[0])
                rows = max(1, min(SLICE_ROWS, SLICE_BYTES * n // (1 + sum(c.nbytes for c in columns))))
                for at in range(0, n, rows):
                    yield pa.array(f(*(c.slice(at, rows).to_pylist() for c in columns)), arrow)

        return F.arrow_udf(run, kind, ArrowUDFType.SCALAR_ITER)

    return add
