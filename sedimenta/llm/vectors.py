"""Helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, every component a finite number."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def rows_of(column) -> np.ndarray:
    """A pandas column of equally long vectors as a matrix of doubles."""
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def vectors(table: DataFrame, id_column: str, vector: str) -> DataFrame:
    """Usable vectors with their number and their length; rows without a number take no part."""
    value = F.col(vector)
    return table.filter(F.col(id_column).isNotNull() & usable(value)).select(
        F.col(id_column).cast("long").alias("vec_id"),
        value.cast("array<double>").alias("vector"),
        F.size(value).alias("width"),
    )
