"""Dealing rows to tasks. Tables of numbers are packed to a few bytes a row, so one split of a file may hold millions of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes of the largest table that rows are made of, as it lies in files, for which there is one task.
TASK_BYTES = 128_000
_UNKNOWN = 1 << 60


def tasks(rows: DataFrame) -> int | None:
    """How many tasks rows are dealt to, in proportion to the largest table they are read from; None where its size is unknown."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = max(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return max(1, -(-size // TASK_BYTES)) if size < _UNKNOWN else None


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by keys to so many tasks, which adaptive execution leaves alone: it sees packed bytes, not the work on a row."""
    n = tasks(rows)
    return rows.repartition(*([n] if n else []), *keys)
