"""Packed vectors for operators 1 and 9."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> F.Column:
    """Whether the vector is not null and holds no null and no non-finite component."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(x.isNotNull() & ~bad, F.lit(False))


def pack(matrix: np.ndarray) -> list[bytes]:
    """Rows as bytes, of four a component where that loses nothing, with the size of a component first."""
    with np.errstate(over="ignore"):
        small = matrix.astype("<f4")
    short = (small == matrix).all(axis=1) if matrix.shape[1] else np.ones(len(matrix), dtype=bool)
    return [b"4" + small[i].tobytes() if short[i] else b"8" + matrix[i].astype("<f8").tobytes() for i in range(len(matrix))]


def unpack(rows: list[bytes], dimension: int) -> np.ndarray:
    if all(r[:1] == b"4" for r in rows):
        return np.frombuffer(b"".join(r[1:] for r in rows), dtype="<f4").reshape(len(rows), dimension).astype(float)
    return np.stack([np.frombuffer(r, dtype="<f4" if r[:1] == b"4" else "<f8", offset=1) for r in rows]).astype(float).reshape(len(rows), dimension)


def doubles(df: DataFrame, vector: str) -> F.Column:
    return df[vector].cast("array<double>")
