"""One pass over a table that adds up dense arrays, whatever the number of tasks."""

from __future__ import annotations

import io
from collections.abc import Callable, Hashable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

_SLOTS = 8

Arrays = Mapping[Hashable, np.ndarray]


def _bytes(a: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, np.asarray(a, np.float64))
    return out.getvalue()


def _array(raw: bytes) -> np.ndarray:
    return np.load(io.BytesIO(raw))


def added_up(
    df: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], Iterator[Arrays]],
    finish: Callable[[str, np.ndarray], np.ndarray] | None = None,
) -> dict[str, np.ndarray]:
    """Sums of the arrays that ``make`` yields from the batches of each task, by name.

    A task adds up what it yields and hands on one row per name. The rows of a name are
    added by streams, by task number in ``_SLOTS`` slots, so that neither a task nor the
    driver holds the partial sums of all tasks. The driver gets at most ``_SLOTS`` arrays
    per name; names and shapes must not grow with the rows. With ``finish`` all rows of a
    name meet in one stream, and the driver gets only what it makes of their sum.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for arrays in make(batches):
            for name, a in arrays.items():
                total[str(name)] = total[str(name)] + a if str(name) in total else np.asarray(a, np.float64)
        slot = 0 if finish else TaskContext.get().partitionId() % _SLOTS
        for name, a in total.items():
            yield pa.RecordBatch.from_pylist([{"name": name, "slot": slot, "data": _bytes(a)}], schema=schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, None

        def added() -> pa.RecordBatch:
            data = _bytes(finish(last[0], total) if finish else total)
            return pa.RecordBatch.from_pylist([dict(zip(names, (*last, data)))], schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                at = row["name"], row["slot"]
                if at != last:
                    if last is not None:
                        yield added()
                    last, total = at, 0.0
                total = total + _array(row["data"])
        if last is not None:
            yield added()

    kind, names = "name string, slot int, data binary", ("name", "slot", "data")
    schema = pa.schema([("name", pa.string()), ("slot", pa.int32()), ("data", pa.binary())])
    parts = df.mapInArrow(partial, kind)
    by_slot = parts.repartition("name", "slot").sortWithinPartitions("name", "slot").mapInArrow(merge, kind)
    total: dict[str, np.ndarray] = {}
    for row in sorted(by_slot.collect(), key=lambda r: (r["name"], r["slot"])):
        total[row["name"]] = total.get(row["name"], 0.0) + _array(row["data"])
    return total


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    """A column of equally long lists of numbers as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(np.float64)
