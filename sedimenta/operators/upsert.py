"""Merge of a batch into a target by primary key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_rows(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target rows replaced by the batch row of the same key, plus the batch's new keys.

    Nothing is deleted. Keys are unique on both sides, so the anti join has no hot key; a batch
    below the broadcast threshold leaves the target unshuffled.
    """
    kept = target.join(batch.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(batch.select(*target.columns))


def merge_native(table: str, batch: DataFrame, key: str) -> None:
    """The same merge done by the table itself, for catalogs whose tables accept MERGE.

    Such tables rewrite only the files a batch touches; plain Parquet tables refuse it.
    """
    batch.alias("batch").mergeInto(
        table, F.col(f"{table}.{key}") == F.col(f"batch.{key}")
    ).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def require_unique(df: DataFrame, key: str) -> None:
    """Fail before a write when a key repeats, as a merge would be ambiguous."""
    repeated = df.groupBy(key).count().filter("count > 1").select(key).take(5)
    if repeated:
        raise ValueError(f"repeated {key} in batch, for example {[row[0] for row in repeated]}")
