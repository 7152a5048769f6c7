"""Sums of arrays over all rows of a frame, computed by numpy kernels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Groups in which tasks' arrays are added on Spark before the driver.
MERGES = 32


def added(rows: DataFrame, kernel: Callable[[pa.RecordBatch], np.ndarray], size: int, tasks: int | None = None) -> np.ndarray:
    """The sum of the arrays (``size`` doubles) that ``kernel`` gives per
    Arrow batch.  Every task sends one array; those of more than MERGES tasks
    are added in MERGES groups first, so what reaches the driver is bounded."""
    def pack(total: np.ndarray, part: int) -> dict:
        return {"part": pa.array([part], pa.int32()), "total": pa.array([total.tobytes()], pa.binary())}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            total += kernel(b)
        yield pa.RecordBatch.from_pydict(pack(total, TaskContext.get().partitionId() % MERGES))

    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(size)
        for x in table["total"]:
            total += np.frombuffer(x.as_py())
        return pa.table(pack(total, 0))

    schema = "part int, total binary"
    parts = rows.mapInArrow(scan, schema)
    if (rows.rdd.getNumPartitions() if tasks is None else tasks) > MERGES:
        parts = parts.groupBy("part").applyInArrow(merge, schema)
    return sum((np.frombuffer(r.total) for r in parts.collect()), np.zeros(size))
