"""What the two operators on vectors share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of equal length without nulls as the rows of a matrix of doubles."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return values.reshape(len(vectors), -1)


def within_one(rows: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two that brings their largest component to 0.5 to 1, exactly: squares of very small or
    large components would not be numbers."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def usable(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", group: str | None = "label"
) -> DataFrame:
    """``(vec_id, grp, vector, same)`` for every row; components stay floats if they are, else they become doubles.

    ``vector`` is null if the row takes no part: null, empty or zero vectors, null or non-finite components. ``same``
    is a digest that equal vectors of one group share; vectors of different lengths differ. Other columns are left out.
    """

    given = vectors.schema[vector].dataType
    kind = "float" if isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType) else "double"
    element = np.float32 if kind == "float" else np.float64

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, values = batch.column(1).to_pylist(), batch.column(2)
            out, same = [], []
            for g, v in zip(groups, values, strict=True):
                row = None
                if v.is_valid and len(v):
                    # A null component becomes NaN, and -0.0 becomes 0.0.
                    row = v.values.to_numpy(zero_copy_only=False).astype(element) + element(0)
                    row = row if np.isfinite(row).all() and row.any() else None
                out.append(row)
                same.append(None if row is None else hashlib.sha1(repr(g).encode() + b"|" + row.tobytes()).digest())
            rows = pa.array(out, pa.list_(pa.from_numpy_dtype(element)))
            columns = [batch.column(0), batch.column(1), rows, pa.array(same, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "grp", "vector", "same"])

    grp = F.col(group).cast("string") if group else F.lit("")
    rows = vectors.select(
        F.col(key).cast("long").alias("vec_id"), grp.alias("grp"), F.col(vector).cast(f"array<{kind}>").alias("vector")
    )
    return rows.mapInArrow(of_batches, f"vec_id long, grp string, vector array<{kind}>, same binary")
