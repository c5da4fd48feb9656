"""Arrow batches of bounded size for Python tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame

BATCH_BYTES, BATCH_ROWS = "4m", "4000"

_HELD: dict[tuple[str, str], tuple] = {}


def held(function: Callable) -> Callable:
    """Keeps the last result of ``function`` until a held function of another module is called.

    A Python worker serves one task after the other. Without this it would
    keep the models of all operators and inputs that it has ever worked on.
    """
    here, name = function.__module__, function.__name__

    @wraps(function)
    def last(*args):
        if any(module != here for module, _ in _HELD):
            _HELD.clear()
        found = _HELD.get((here, name))
        if found is None or found[0] != args:
            _HELD.pop((here, name), None)  # before the next one is made
            found = _HELD[here, name] = args, function(*args)
        return found[1]

    return last


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` on batches of at most ``BATCH_BYTES`` (or one row), so that long texts don't pile up in a task."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)

    def released(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(rows)
        pa.default_memory_pool().release_unused()  # a worker lives on beside the tasks of other stages

    return df.mapInArrow(released, schema)
