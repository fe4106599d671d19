"""Row rules: duplicates, empty rows, null keys, schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_RANK = "_rank"


def distinct_rows(df: DataFrame) -> DataFrame:
    """One row per distinct row; null equals null. Copies merge before the shuffle."""
    return df.dropDuplicates()


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Leave out rows that are null in every column."""
    return df.na.drop("all")


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Leave out rows without a key; the test on a stored column is pushed into the scan."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def keep_first(df: DataFrame, keys: Sequence[str], order: Iterable[Column] = ()) -> DataFrame:
    """One row per key: the first by `order`, ties broken by every other column.

    The order is total up to identical rows, so the row kept does not depend on file order,
    partitioning or a retried task, and exact copies need no `distinct` first. Spark limits
    each key to its first row per partition before the shuffle, so even a key that holds a
    third of all rows sends at most one row per map task.
    """
    others = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    first = Window.partitionBy(*keys).orderBy(*order, *others)
    return (
        df.withColumn(_RANK, F.row_number().over(first)).filter(F.col(_RANK) == 1).drop(_RANK)
    )


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of `schema`, in its order: extras dropped, missing ones null.

    A column of another type is an error unless widening loses nothing; text is cast by the
    cleaning rules, never here.
    """
    return df.to(schema)


def stamp(df: DataFrame, column: str) -> DataFrame:
    """Load time, one value for all rows of a query."""
    return df.withColumn(column, F.current_timestamp())


def sample_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first `n` rows by `order`: a top-n on every partition, then one of n rows each."""
    return df.orderBy(*order).limit(n)


def sample_values(df: DataFrame, column: str, n: int = 6) -> DataFrame:
    """The first `n` distinct known values of a column."""
    known = df.select(column).filter(F.col(column).isNotNull())
    return known.distinct().orderBy(column).limit(n)
