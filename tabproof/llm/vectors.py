"""Embedding vectors as rows of whole numbers, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Whole numbers are kept within this, so that squared distances fit 64 bits. Entries of
#: embeddings are a million times smaller.
LARGEST = 2**27


def whole_rows(column: pa.Array, scale: int, length: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the usable vectors of a list column, and ``floor(scale * entry)`` of each
    group of one length, in the order of ``places``.

    A vector is usable if it is not null, not empty, holds no null and nothing that is not
    finite, and has ``length`` entries if that is given. Rows come sorted by length.
    """
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    places, parts = [np.empty(0, np.int64)], []
    for size in np.unique(sizes[sizes > 0]) if length is None else [length]:
        at = np.flatnonzero(sizes == size)
        entries = pc.cast(pc.list_flatten(column.take(pa.array(at))), pa.float64())
        rows = entries.to_numpy(zero_copy_only=False).reshape(len(at), int(size))
        usable = np.isfinite(rows).all(1)
        with np.errstate(over="ignore"):
            rows = np.clip(np.floor(rows[usable] * scale), -LARGEST, LARGEST)
        places.append(at[usable])
        parts.append(rows.astype(np.int64))
    return np.concatenate(places), parts


def packed(rows: np.ndarray) -> pa.Array:
    """Each row's numbers as 32-bit integers in one binary value."""
    data = np.ascontiguousarray(rows, "<i4")
    offsets = np.arange(len(data) + 1, dtype=np.int64) * data.shape[1] * 4
    whole = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(data), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    return whole.cast(pa.binary())


def unpacked(column: pa.Array, length: int) -> np.ndarray:
    """The matrix of a column made by ``packed`` with ``length`` numbers in each row."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), length).astype(np.int64)


def summed(df: DataFrame, terms: Callable[[pa.RecordBatch], np.ndarray], whole: bool) -> np.ndarray:
    """Sum over all batches of ``df`` of the array that ``terms`` gives for one.

    Each task adds up its batches and sends one array, whose cells are added by groups, so
    the driver gets as many numbers as ``terms`` gives. Whole numbers stay exact beyond 64
    bits and come back as Python's. Empty without rows.
    """
    kind = "decimal(38,0)" if whole else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                more = terms(batch).astype(object if whole else float)
                total = more if total is None else total + more
        if total is not None:
            cells = [Decimal(int(t)) for t in total] if whole else total.tolist()
            of = pa.decimal128(38, 0) if whole else pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array([cells], pa.list_(of))], ["cells"])

    cells = df.mapInArrow(run, f"cells array<{kind}>").select(F.posexplode("cells").alias("place", "cell"))
    cell = F.sum("cell").cast("decimal(38,0)") if whole else F.sum("cell")
    found = cells.groupBy("place").agg(cell.alias("cell")).orderBy("place").collect()
    values = [int(r["cell"]) if whole else r["cell"] for r in found]
    return np.array(values, object if whole else float)
