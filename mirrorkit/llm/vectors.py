"""Vectors that can take part in a search: finite, not zero, of one dimension."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vec: array<double>) of the rows that take part.

    Left out: null ids, null, empty and zero vectors, vectors with null or
    non-finite components. Lengths must agree among the rest, see
    ``one_length``.
    """
    return df.select(F.col(id_col).cast("bigint").alias("vec_id"),
                     F.col(vector_col).cast("array<double>").alias("vec")).filter(takes_part())


def one_length(vecs: DataFrame) -> int:
    """Number of vectors; an error if they are of different lengths, which no distance compares."""
    total, least, most = vecs.agg(F.count(F.lit(1)), F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if total and least != most:
        raise ValueError(f"vectors of different lengths, from {least} to {most} components")
    return total


def takes_part():
    """Condition over ``vec_id`` and ``vec``; never null."""
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0),
                      F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix of doubles."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(n, -1) if n else flat.reshape(0, 0), dtype=np.float64)
