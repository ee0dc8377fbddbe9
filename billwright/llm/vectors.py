"""What the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: str | None = None
) -> DataFrame:
    """(id, vector array<double>) of the rows whose vector has finite components only.

    Null and empty vectors, and ones that hold a null, NaN or infinite component, are
    left out. ``keep`` names a column that stays.
    """
    rows = vectors.select(
        *([keep] if keep else []),
        vectors[id_col].cast("long").alias("id"),
        vectors[vector_col].cast("array<double>").alias("vector"),
    )
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where((F.size("vector") > 0) & ~odd)


def integers(vector: str) -> Column:
    """floor(256 * x) of every component, as array<long>; beyond 2 ** 62 either way it is that."""
    most = float(2**62)
    return F.transform(
        vector, lambda x: F.floor(F.least(F.greatest(x * 256, F.lit(-most)), F.lit(most))).cast("long")
    )


def products(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Inner products of each row with each of ``others``, both of int64, as int64.

    They are exact; those that a long can't hold are the nearest long.
    """
    size = lambda x: int(np.abs(x.astype(np.float64)).max(initial=0.0)) + 1
    most = size(rows) * size(others) * max(1, rows.shape[1])
    if most < 2**52:  # sums of products of this size are exact in doubles, which multiply faster
        return (rows.astype(np.float64) @ others.T.astype(np.float64)).astype(np.int64)
    if most < 2**62:
        return rows @ others.T
    exact = rows.astype(object) @ others.T.astype(object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def matrix(lists: pa.ListArray) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    sizes = np.diff(lists.offsets.to_numpy())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors of different lengths can't be compared")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
