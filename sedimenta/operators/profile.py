"""Profiling and data-quality checks, in long format: one row per finding.

Every profile is aggregates over the whole table; per-column work shares one pass. Only
results of grouping are sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.numbers import to_number
from sedimenta.operators.joins import Parent, lookup
from sedimenta.operators.rows import drop_null_keys


def _findings(df: DataFrame, findings: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Aggregates of the whole table in one pass, returned as one row per finding."""
    rows = [F.struct(*[c.alias(name) for name, c in row.items()]) for row in findings]
    return df.agg(F.array(*rows).alias("findings")).select(F.inline("findings"))


def profile_nulls(df: DataFrame) -> DataFrame:
    """Rows, columns, rows null throughout, and nulls of each column: one pass."""
    everything_null = F.lit(True)
    for c in df.columns:
        everything_null = everything_null & F.col(c).isNull()
    totals = [
        ("rows", "*", F.count(F.lit(1))),
        ("columns", "*", F.lit(len(df.columns)).cast("bigint")),
        ("all_null_rows", "*", F.count_if(everything_null)),
        *[("nulls", c, F.count_if(F.col(c).isNull())) for c in df.columns],
    ]
    return _findings(
        df,
        [
            {"metric": F.lit(metric), "column_name": F.lit(column), "value": value}
            for metric, column, value in totals
        ],
    )


def profile_row_dups(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus copies; copies are counted before the shuffle."""
    counts = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return counts.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Known keys held by more than one row, most frequent first."""
    counts = drop_null_keys(df, [key]).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter("n > 1").orderBy(F.desc("n"), key)


def profile_domain(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every variant of each column with its row count, nulls as a variant of their own."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = (
        long.unpivot([], list(columns), "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.orderBy("column_name", F.col("value").asc_nulls_last())


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    numeric = df.select(*[to_number(F.col(c).cast("string")).alias(c) for c in columns])
    return numeric.unpivot([], list(columns), "column_name", "value")


def profile_numeric_domain(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sorted distinct numbers of each text column; what is no number is left out."""
    known = _numbers(df, columns).filter(F.col("value").isNotNull())
    return known.distinct().orderBy("column_name", "value")


def profile_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest, largest, known and distinct numbers of each text column.

    Values are counted once per distinct value first, so a value that fills a third of the
    table travels as one row.
    """
    counts = (
        _numbers(df, columns).groupBy("column_name", "value").agg(F.count("value").alias("n"))
    )
    return counts.groupBy("column_name").agg(
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.sum("n").alias("known"),
        F.count("value").alias("distinct_values"),
    )


def count_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule, all rules in one pass."""
    return _findings(
        df,
        [
            {"check_name": F.lit(name), "violations": F.count_if(rule)}
            for name, rule in rules.items()
        ],
    )


def list_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The offending rows, once for each rule they break."""
    broken = F.filter(
        F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]),
        lambda name: name.isNotNull(),
    )
    return df.select("*", F.explode(broken).alias("check_name"))


def dq_checks(
    df: DataFrame, key: str, rules: Mapping[str, Column], parents: Mapping[str, Parent]
) -> DataFrame:
    """Rule violations, missing parents and repeated keys as (check_name, violations).

    Parents are looked up on the way, and rows are first reduced to one for each key, with its
    copies and what they break, so that one pass over the table tells it all. A key that fills a
    third of the table is one row of each task by then.
    """
    child, rules = df, dict(rules)
    for i, (name, parent) in enumerate(parents.items()):
        known = parent.keys().distinct().withColumn(f"_known_{i}", F.lit(True))
        child = lookup(child, known, [parent.foreign])
        rules[name] = F.col(f"_known_{i}").isNull()
    broken = [F.count_if(rule).alias(f"_broken_{i}") for i, rule in enumerate(rules.values())]
    by_key = child.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.count(F.lit(1)).alias("_n"), *broken)
    found = {name: F.sum(f"_broken_{i}") for i, name in enumerate(rules)}
    found["repeated_key"] = F.sum(F.when(F.col("_key").isNotNull(), F.col("_n") - 1))
    return _findings(
        by_key,
        [
            {"check_name": F.lit(name), "violations": F.coalesce(n, F.lit(0))}
            for name, n in found.items()
        ],
    )


def load_metrics(raw: DataFrame, key: Column, kept: DataFrame | None = None) -> DataFrame:
    """Rows read, rows with a usable key, distinct keys, and rows that reached the end.

    Counted by query rather than by accumulators, which count twice when a lost executor's
    tasks run again.
    """
    by_key = raw.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    keyed = F.sum(F.when(F.col("_key").isNotNull(), F.col("_n")))
    steps = {
        "read": F.coalesce(F.sum("_n"), F.lit(0)),
        "keyed": F.coalesce(keyed, F.lit(0)),
        "distinct_keys": F.count("_key"),
    }
    metrics = _findings(
        by_key, [{"step": F.lit(step), "total_rows": n} for step, n in steps.items()]
    )
    if kept is None:
        return metrics
    return metrics.unionByName(
        kept.agg(F.lit("kept").alias("step"), F.count(F.lit(1)).alias("total_rows"))
    )
