"""The whole refresh: text files -> raw -> stage -> analytics.

Three stages in order, each a set of lazy plans ended by a write. An error stops the run at the
stage that raised it; what earlier stages published stays, and a re-run repeats them without
harm. Rows are never brought to the driver.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.numbers import money_left_out, to_integer
from sedimenta.operators.profile import load_metrics
from sedimenta.operators.rows import conform, stamp
from sedimenta.plans import clean, model
from sedimenta.schemas import DIM_CUSTOMER, DIM_PRODUCT, FACT_SALES, TABLES, TableSpec
from sedimenta.sources import csv, tables
from sedimenta.sources.tables import (
    ensure_database,
    ensure_keyed,
    hold,
    load_stamp,
    publish,
    release,
    replace_partitions,
    upsert,
)

FILES = {name: f"{name}.csv" for name in TABLES}


@dataclass(frozen=True)
class Layers:
    raw: str = "raw"
    stage: str = "stage"
    analytics: str = "analytics"

    def raw_table(self, name: str) -> str:
        return f"{self.raw}.{name}_raw"

    def stage_table(self, name: str) -> str:
        return f"{self.stage}.{name}_stage"

    def model(self, name: str) -> str:
        return f"{self.analytics}.{name}"


@dataclass(frozen=True)
class Step:
    """One table loaded: rows in it afterwards, the seconds the load took, and for a stage table
    what became of the rows of this load (see `load_counts`)."""

    stage: str
    table: str
    rows: int
    seconds: float
    counts: Mapping[str, int] = field(default_factory=dict)


def _timed(stage: str, table: str, load: Callable[[], DataFrame], counts=None) -> Step:
    began = time.monotonic()
    # A count of a Parquet table is answered from its footers.
    rows = load().count()
    return Step(stage, table, rows, time.monotonic() - began, counts or {})


def ingest(
    spark: SparkSession,
    sources: Mapping[str, str],
    landing: str,
    layers: Layers = Layers(),
) -> list[Step]:
    """Archive each input as it arrived under its load time, then replace its raw table."""
    ensure_database(spark, layers.raw)

    def load(name: str, path: str) -> DataFrame:
        csv.archive(spark, path, landing, name, load_stamp())
        return publish(csv.scan_raw(spark, path), layers.raw_table(name))

    return [
        _timed("raw", layers.raw_table(name), lambda n=name, p=path: load(n, p))
        for name, path in sources.items()
    ]


_TOTAL = "total_amount_usd"


def merge_stage(held: DataFrame, spec: TableSpec, layers: Layers = Layers()) -> DataFrame:
    """Merge a held batch, already stamped and fitted to the declared schema, into its stage table."""
    ensure_keyed(held.sparkSession, layers.stage_table(spec.name), spec.stage)
    return upsert(held, layers.stage_table(spec.name), spec.key)


def load_counts(raw: DataFrame, spec: TableSpec, kept: DataFrame) -> dict[str, int]:
    """Rows of this load: read, with a usable key, with distinct keys, removed as orphans, kept.
    Only the key column of the raw table is read; kept rows are counted from the held batch. Where
    these carry a total, `amounts_left_out` tells how many no sum of money can take."""
    found = load_metrics(raw.select(spec.key), to_integer(F.col(spec.key)), kept).collect()
    counts = {row.step: row.total_rows for row in found}
    counts["orphans"] = counts["distinct_keys"] - counts["kept"]
    if _TOTAL in kept.columns:
        counts["amounts_left_out"] = kept.agg(money_left_out(F.col(_TOTAL))).first()[0]
    return counts


def build_stage(spark: SparkSession, layers: Layers = Layers()) -> list[Step]:
    """Clean and merge every table; orders are checked against the parents of this load.

    Each batch is written once, and everything that follows reads that copy."""
    ensure_database(spark, layers.stage)
    steps, held, paths = [], {}, []

    def batch(name: str) -> DataFrame:
        raw = spark.table(layers.raw_table(name))
        if name == "customers":
            return clean.clean_customers(raw)
        if name == "products":
            return clean.clean_products(raw)
        return clean.clean_orders(raw, held["customers"], held["products"])

    try:
        for name in ("customers", "products", "orders"):
            spec = TABLES[name]
            held[name], path = hold(conform(stamp(batch(name), spec.stamp), spec.stage), name)
            paths.append(path)
            counts = load_counts(spark.table(layers.raw_table(name)), spec, held[name])
            table = layers.stage_table(name)
            steps.append(
                _timed("stage", table, lambda n=name: merge_stage(held[n], TABLES[n], layers), counts)
            )
    finally:
        for path in paths:
            release(spark, path)
    return steps


def stage_metrics(spark: SparkSession, steps: Iterable[Step]) -> DataFrame:
    """The counts of the steps of a load as (table_name, step, total_rows)."""
    rows = [(s.table, step, n) for s in steps for step, n in s.counts.items()]
    return spark.createDataFrame(rows, "table_name string, step string, total_rows bigint")


@dataclass(frozen=True)
class Model:
    """An analytics table: a plan, or the text of a query, and how it is laid out."""

    name: str
    rows: Callable[[SparkSession], DataFrame] | str
    partition_by: Sequence[str] = ()


def star_schema(layers: Layers = Layers()) -> list[Model]:
    """Dimensions first, then the fact. The fact is laid out by month: questions about a
    period read only its months."""

    def stage(spark: SparkSession, name: str) -> DataFrame:
        return spark.table(layers.stage_table(name))

    def finished(rows: DataFrame, schema) -> DataFrame:
        return conform(stamp(rows, "analytics_updated_at"), schema)

    return [
        Model(
            layers.model("dim_cliente"),
            lambda s: finished(model.dim_customer(stage(s, "customers")), DIM_CUSTOMER),
        ),
        Model(
            layers.model("dim_producto"),
            lambda s: finished(model.dim_product(stage(s, "products")), DIM_PRODUCT),
        ),
        Model(
            layers.model("fact_venta"),
            lambda s: finished(
                model.fact_sales(stage(s, "orders"), stage(s, "products")),
                FACT_SALES,
            ),
            ("mes_fecha",),
        ),
    ]


def run_models(spark: SparkSession, models: Iterable[Model]) -> list[Step]:
    """Create or replace each table in the given order; the first error ends the run."""

    def rows(m: Model) -> DataFrame:
        return spark.sql(m.rows) if isinstance(m.rows, str) else m.rows(spark)

    return [
        _timed("analytics", m.name, lambda m=m: publish(rows(m), m.name, m.partition_by))
        for m in models
    ]


def _stamps(spark: SparkSession, layers: Layers) -> dict[str, str]:
    """When the newest row of each table that the fact is made of was merged."""
    newest = {}
    for name in ("orders", "products"):
        last = spark.table(layers.stage_table(name)).agg(F.max(TABLES[name].stamp).cast("string"))
        newest[name] = last.first()[0] or "0001-01-01"
    return newest


def changed_months(spark: SparkSession, layers: Layers, since: Mapping[str, str]) -> DataFrame:
    """Months (`mes_fecha`, null for sales without a date) in which the fact would be another if it
    were built anew, given the stage rows merged after `since`.

    New and old rows of the orders merged since then are told apart by 128-bit fingerprints, so an
    order that came again as it was changes nothing; an order that moved changes both months. A
    product whose category or cost is another than in the fact changes the months it was sold in.
    """
    old = spark.table(layers.model("fact_venta"))

    def merged(name: str) -> DataFrame:
        spec = TABLES[name]
        return spark.table(layers.stage_table(name)).filter(
            F.col(spec.stamp) > F.lit(since[name]).cast("timestamp")
        )

    values = [c for c in FACT_SALES.fieldNames() if c != "analytics_updated_at"]
    prints = [F.xxhash64(F.lit(k), *values).alias(f"print_{k}") for k in (1, 2)]
    new = conform(model.fact_sales(merged("orders"), spark.table(layers.stage_table("products"))), FACT_SALES)
    new, known = new.select("order_id", "mes_fecha", *prints), old.select("order_id", *prints)
    changed = new.join(known, ["order_id", "print_1", "print_2"], "left_anti")
    left = old.join(changed.select("order_id"), "order_id", "left_semi")
    products = merged("products").select(
        "product_id", F.col("category").alias("now_category"), F.col("cost_usd").alias("now_cost")
    )
    same = F.col("product_category").eqNullSafe(F.col("now_category"))
    same = same & F.col("unit_cost_usd").eqNullSafe(F.col("now_cost"))
    sold = old.join(products, "product_id").filter(~same)
    months = [rows.select("mes_fecha") for rows in (changed, left, sold)]
    return months[0].unionByName(months[1]).unionByName(months[2]).distinct()


def refresh_fact(spark: SparkSession, fact: Model, layers: Layers = Layers()) -> DataFrame:
    """Bring the fact up to the stage tables, writing only the months that changed.

    What was merged since the fact was last brought up is known from the rows' stamps, also after
    a load that failed in between; a fact that tells nothing about that is built whole.
    """
    upto = _stamps(spark, layers)
    since = tables.marks(spark, fact.name)
    if upto.keys() <= since.keys():
        # At most as many values as there are months.
        months = [row[0] for row in changed_months(spark, layers, since).collect()]
        if months:
            replace_partitions(fact.rows(spark), fact.name, "mes_fecha", months)
    else:
        publish(fact.rows(spark), fact.name, fact.partition_by)
    tables.note(spark, fact.name, **upto)
    return spark.table(fact.name)


def build_analytics(spark: SparkSession, layers: Layers = Layers()) -> list[Step]:
    """The star schema and the report view over it; of the fact, the months that changed."""
    ensure_database(spark, layers.analytics)
    *dimensions, fact = star_schema(layers)
    steps = run_models(spark, dimensions)
    steps.append(_timed("analytics", fact.name, lambda: refresh_fact(spark, fact, layers)))
    report = model.report_view_sql(
        *[layers.model(n) for n in ("fact_venta", "dim_producto", "dim_cliente")]
    )
    spark.sql(f"CREATE OR REPLACE VIEW {layers.model('vw_reporte_ventas')} AS {report}")
    return steps


def refresh(
    spark: SparkSession,
    source_folder: str,
    landing: str,
    layers: Layers = Layers(),
    files: Mapping[str, str] = FILES,
) -> list[Step]:
    """Run the three stages over the files of a folder; the steps tell what became of the rows."""
    sources = {name: f"{source_folder}/{file}" for name, file in files.items()}
    return [
        *ingest(spark, sources, landing, layers),
        *build_stage(spark, layers),
        *build_analytics(spark, layers),
    ]
