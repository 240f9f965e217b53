"""Sums of feature-sized arrays over a table: Gram matrices, gradients, Hessians.

``fn`` maps a batch of rows (a matrix and the other columns) to an array; a task adds the arrays of its
batches in place, so it sends one row whatever its input. The tasks' rows are added in a tree: beyond
``FAN_IN`` of them, a second stage adds groups first, so the driver adds ``FAN_IN`` rows at most.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows that one step of the tree, or the driver, adds.
FAN_IN = 64
#: Numbers in the matrix of one batch; rows are added in blocks of so many.
BLOCK_CELLS = 1 << 20

_PART = "part binary"


def array_sum(df: DataFrame, vector: str, others: Sequence[str], size: int,
              fn: Callable[..., np.ndarray]) -> np.ndarray:
    """Sum over all rows of ``fn(matrix, *columns)``, an array of ``size`` doubles; zeros for an empty table.

    ``vector`` is an array<double> column of one length without nulls, ``others`` numeric columns. The
    functions hold all they need, so workers need not import this package; ``fn`` has to do so too.
    """
    n_others, cells = len(others), BLOCK_CELLS

    def row(total):
        return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def partial(batches):
        total, seen = np.zeros(size), False
        for rb in batches:
            if not rb.num_rows:
                continue
            flat = rb.column(0).flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(rb.num_rows, -1)
            cols = [rb.column(i + 1).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(n_others)]
            step = max(1, cells // max(1, x.shape[1]))
            for at in range(0, len(x), step):
                total += fn(x[at:at + step], *[c[at:at + step] for c in cols])
            seen = True
        if seen:
            yield row(total)

    def add(batches):
        total, seen = np.zeros(size), False
        for rb in batches:
            for x in rb.column(0):
                total += np.frombuffer(x.as_py())
                seen = True
        if seen:
            yield row(total)

    source = df.select(vector, *others)
    parts = source.mapInArrow(partial, _PART)
    if source.rdd.getNumPartitions() > FAN_IN:
        parts = parts.repartition(FAN_IN).mapInArrow(add, _PART)
    total = np.zeros(size)
    for r in parts.collect():   # FAN_IN rows at most
        total += np.frombuffer(bytes(r["part"]))
    return total


def gram(df: DataFrame, vector: str, width: int) -> tuple[float, np.ndarray, np.ndarray]:
    """(rows, sums, cross products) of an array<double> column of ``width`` numbers, in one pass."""

    def fn(x):
        return np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])

    total = array_sum(df, vector, [], 1 + width + width * width, fn)
    return total[0], total[1:1 + width], total[1 + width:].reshape(width, width)
