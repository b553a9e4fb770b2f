"""Embedding columns as arrays of raw numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector, nonzero: bool = False) -> Column:
    """Whether a vector is not null, not empty and has only finite components (and, if asked, not only zeros)."""
    value = F.col(vector)
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = F.coalesce((F.size(value) > 0) & ~bad, F.lit(False))
    return ok & F.exists(value, lambda x: x != 0) if nonzero else ok


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def kind_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
