"""Sums of long vectors over all tasks, none of them gathered in one place."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 12  # numbers in a row of a summed vector
FAN = 1024  # partial sums of each chunk


def parts_of(vector: np.ndarray) -> pa.RecordBatch:
    """A long vector of doubles as rows, each a chunk of it."""
    task = TaskContext.get().partitionId()
    cut = [vector[i : i + CHUNK].tobytes() for i in range(0, len(vector), CHUNK)]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(cut), task)), pa.array(np.arange(len(cut))), pa.array(cut, pa.binary())],
        names=["task", "chunk", "data"],
    )


PARTS = "task long, chunk long, data binary"


def summed(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of the vectors that tasks have given; added up in two steps, chunk by chunk."""

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in rows["data"].to_pylist())
        first = rows.slice(0, 1)
        return pa.table({"task": first["task"], "chunk": first["chunk"],
                         "data": pa.array([total.tobytes()], pa.binary())})

    some = parts.withColumn("task", F.pmod("task", F.lit(FAN)))
    some = some.groupBy("task", "chunk").applyInArrow(add, PARTS)
    out = np.zeros(-(-size // CHUNK) * CHUNK)
    for row in some.groupBy("chunk").applyInArrow(add, PARTS).collect():
        values = np.frombuffer(row["data"], np.float64)
        out[row["chunk"] * CHUNK : row["chunk"] * CHUNK + len(values)] = values
    return out[:size]
