"""Joins from a child table to parents that are unique on their key, and integrity reports.

Every lookup is one plain join with the child on the left, whatever the sizes. Spark broadcasts a
parent whose measured size allows it; beyond that both sides are shuffled, and a key that owns a
large share of the child, or rows without a key, make a large partition that adaptive execution
splits over many tasks, repeating the parent's few rows (`spark.sql.adaptive.skewJoin` and
`forceOptimizeSkewedJoin`, set in `sedimenta.session`). A wide child that looks up two large parents
by different keys would be shuffled once for each; a `Grid` deals it out once for both.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reasons given for a rejected row.
NO_CUSTOMER = "CLIENTE INEXISTENTE"
NO_PRODUCT = "PRODUCTO INEXISTENTE"
NO_PARENTS = "CLIENTE Y PRODUCTO INEXISTENTES"


@dataclass(frozen=True)
class Parent:
    """A referenced table: `foreign` in the child points at `key` of `rows`."""

    rows: DataFrame
    key: str
    foreign: str

    def keys(self) -> DataFrame:
        return self.rows.select(F.col(self.key).alias(self.foreign))


CELL = "_cell"


@dataclass(frozen=True)
class Grid:
    """One deal of a child for lookups by two keys, both whole numbers.

    Every key has `side` buckets, and a cell is a bucket of the one with a bucket of the other. A
    row of the child lies in one cell; a row of a parent is repeated in the `side` cells where its
    key can occur, so a lookup by either key joins within cells. The child is shuffled once instead
    of once per key, a parent `side` times: for parents of far fewer rows than the child. Adaptive
    execution splits no cell, but the rows of a key that owns a large share of the child are spread
    over `side` cells by the other key.
    """

    keys: tuple[str, str]
    side: int

    def deal(self, child: DataFrame, spread: str) -> DataFrame:
        """The child by cells. Rows without a key match nothing and are dealt out by `spread`."""
        first, second = [
            F.coalesce(self._bucket(key), self._hash(axis, F.col(spread)))
            for axis, key in enumerate(self.keys)
        ]
        return self._by_cell(child, first, second)

    def copies(self, parent: DataFrame, key: str) -> DataFrame:
        """A parent, each row in all cells where its key can occur."""
        every = F.explode(F.sequence(F.lit(0), F.lit(self.side - 1)))
        parent = parent.filter(F.col(key).isNotNull()).withColumn(CELL, every)
        buckets = [self._bucket(k) if k == key else F.col(CELL) for k in self.keys]
        return self._by_cell(parent, *buckets)

    def _bucket(self, key: str) -> Column:
        return F.when(F.col(key).isNotNull(), self._hash(self.keys.index(key), F.col(key)))

    def _hash(self, axis: int, value: Column) -> Column:
        # Keys of any whole type fall into one bucket, the same number as another key into another.
        return F.pmod(F.xxhash64(F.lit(axis), value.cast("bigint")), F.lit(self.side))

    def _by_cell(self, rows: DataFrame, first: Column, second: Column) -> DataFrame:
        cell = (first * self.side + second).cast("int")
        return rows.withColumn(CELL, cell).repartitionById(self.side**2, F.col(CELL))


def lookup(child: DataFrame, parent: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join `child` to `parent`, which is unique on `on` (semi and anti joins take any parent).
    Rows without a key match nothing."""
    on = list(on)
    if how in ("left_semi", "left_anti"):
        return child.join(parent.select(*on), on, how).select(*child.columns)
    more = [c for c in parent.columns if c not in on]
    return child.join(parent, on, how).select(*child.columns, *more)


def referential_filter(child: DataFrame, parents: Sequence[Parent]) -> DataFrame:
    """Rows whose every reference exists; a null reference does not."""
    for parent in parents:
        child = lookup(child, parent.keys(), [parent.foreign], "left_semi")
    return child


def orphans(child: DataFrame, parent: Parent) -> DataFrame:
    """Rows whose reference is missing from the parent or null."""
    return lookup(child, parent.keys(), [parent.foreign], "left_anti")


def orphan_report(child: DataFrame, customer: Parent, product: Parent) -> DataFrame:
    """Rows `referential_filter` would reject, with the reason, in one pass over the child."""
    columns = child.columns
    for flag, parent in (("_customer", customer), ("_product", product)):
        known = parent.keys().distinct().withColumn(flag, F.lit(True))
        child = lookup(child, known, [parent.foreign])
    no_customer, no_product = F.col("_customer").isNull(), F.col("_product").isNull()
    return child.filter(no_customer | no_product).select(
        *columns, orphan_reason(no_customer, no_product).alias("motivo")
    )


def orphan_reason(no_customer: Column, no_product: Column) -> Column:
    return (
        F.when(no_customer & no_product, F.lit(NO_PARENTS))
        .when(no_customer, F.lit(NO_CUSTOMER))
        .otherwise(F.lit(NO_PRODUCT))
    )


def orphan_summary(report: DataFrame) -> DataFrame:
    """How many rows were rejected for each reason."""
    return report.groupBy("motivo").agg(F.count(F.lit(1)).alias("filas"))
