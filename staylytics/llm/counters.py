"""Tables of counters with a fixed size, counted in tasks and added up by a tree of tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics.session import settle

SLICE = 1 << 14  # counters per shipped row
FAN_IN = 64  # partial tables added up in one task
SCHEMA = "slice int, task int, counts binary"


def ship(counts: np.ndarray) -> dict[str, pa.Array]:
    """Columns of ``SCHEMA`` with the counters (uint32, a multiple of ``SLICE``) of the task that calls."""
    from pyspark import TaskContext

    k = counts.size // SLICE
    return {
        "slice": pa.array(range(k), pa.int32()), "task": pa.array([TaskContext.get().partitionId()] * k, pa.int32()),
        "counts": pa.array([c.tobytes() for c in counts.reshape(k, SLICE)], pa.binary()),
    }


def added(parts: DataFrame, size: int) -> np.ndarray:
    """The sums of all shipped tables of ``size`` counters. No task reads more than ``FAN_IN`` partial slices of one."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.uint32).astype(np.uint64) for x in table.column("counts"))
        clipped = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
        task = table.column("task")[0].as_py() // FAN_IN
        return pa.table({"slice": table.column("slice")[:1], "task": pa.array([task], pa.int32()), "counts": pa.array([clipped.tobytes()], pa.binary())})

    tables = (parts.agg(F.max("task")).first()[0] or 0) + 1
    while True:
        parts = parts.groupBy("slice", (F.col("task") / FAN_IN).cast("int")).applyInArrow(add, SCHEMA)
        tables = -(-tables // FAN_IN)
        if tables <= 1:
            break
        parts = settle(parts)
    out = np.zeros(size, np.uint32)
    for row in parts.collect():  # one row for each of the size / SLICE slices
        out[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = np.frombuffer(row["counts"], np.uint32)
    return out
