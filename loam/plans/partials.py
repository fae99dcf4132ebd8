"""Sums of large arrays over all rows: one array a task, added in tasks first
where those of all tasks are too much for the driver."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SENT_BYTES = 64 << 20


def packed(values: np.ndarray) -> pa.RecordBatch:
    """A task's array as its one row."""
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(values, np.float64).tobytes()], pa.binary())], names=["v"])


def summed(parts: DataFrame, tasks: int, size: int, sent_bytes: int = SENT_BYTES) -> np.ndarray:
    """The sum of the arrays (``v binary``, ``size`` doubles, one a task)."""
    def add(batches):
        out = np.zeros(size)
        for b in batches:
            for v in b.column(0).to_pylist():
                out += np.frombuffer(v)
        yield packed(out)

    while tasks > 2 and tasks * size * 8 > sent_bytes:
        tasks = math.isqrt(tasks) + 1
        parts = parts.repartition(tasks).mapInArrow(add, "v binary")
    total = np.zeros(size)
    for row in parts.toLocalIterator():
        total += np.frombuffer(row["v"])
    return total
