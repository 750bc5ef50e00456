"""What the operators over vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Whether a vector is there and holds finite numbers only."""
    infinite = F.lit(float("inf"))

    def finite(x: Column) -> Column:
        number = x.cast("double")
        return F.coalesce(~F.isnan(number) & (F.abs(number) < infinite), F.lit(False))

    return F.col(vector).isNotNull() & F.forall(F.col(vector), finite)


def first_rows(rows: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest by the other columns in order."""
    rest = [c for c in rows.columns if c != key]
    least = rows.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return least.select(key, "_row.*")


def matrix(column: pa.ChunkedArray | pa.Array, kind=np.float64, width: int = 0) -> np.ndarray:
    """Vectors as the rows of a matrix, shorter ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    width = max(width, int(lengths.max(initial=0)))
    if len(values) == len(lengths) * width:
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), kind)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
