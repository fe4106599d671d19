"""Every operator of the library as a query over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bindings import tables as t
from sedimenta.functions import dates, numbers, text
from sedimenta.operators import joins, profile, rows
from sedimenta.operators.joins import Parent
from sedimenta.plans import clean, model, questions
from sedimenta.schemas import PRODUCTS
from sedimenta.sources import tables

col = F.col

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- text, numbers and dates -----------------------------------------------------------------


@query
def parse_date(spark, sf):
    orders = t.derive(spark, sf, t.RAW_ORDERS)
    return orders.select(
        "order_id",
        dates.parse_date(col("order_date")).alias("order_date"),
        dates.parse_date(col("ship_date")).alias("ship_date"),
    )


@query
def to_integer(spark, sf):
    orders = t.derive(spark, sf, t.RAW_ORDERS)
    ids = ("order_id", "customer_id", "product_id", "quantity")
    return orders.select(*[numbers.to_integer(col(c)).alias(c) for c in ids])


@query
def to_number(spark, sf):
    orders = t.derive(spark, sf, t.RAW_ORDERS)
    amounts = ("quantity", "unit_price_usd", "total_amount_usd", "discount_pct")
    return orders.select("order_id", *[numbers.to_number(col(c)).alias(c) for c in amounts])


@query
def canonical_supplier(spark, sf):
    products = t.derive(spark, sf, t.RAW_PRODUCTS)
    return products.select("product_id", text.canonical_supplier(col("supplier")).alias("supplier"))


@query
def to_boolean(spark, sf):
    products = t.derive(spark, sf, t.RAW_PRODUCTS)
    return products.select("product_id", text.to_boolean(col("active")).alias("active"))


@query
def normalize_text(spark, sf):
    documents = t.table(spark, sf, "documents")
    return documents.select(
        "doc_id",
        text.upper_text(col("text")).alias("upper_text"),
        text.trim_text(col("text")).alias("trimmed_text"),
    )


@query
def standardize_domain(spark, sf):
    orders = t.derive(spark, sf, t.RAW_ORDERS)
    return orders.select(
        "order_id",
        text.in_domain(text.upper_text(col("status")), text.STATUSES).alias("status"),
        text.in_domain(text.payment_code(col("payment_method")), text.PAYMENTS).alias(
            "payment_method"
        ),
    )


@query
def range_guard(spark, sf):
    events = t.table(spark, sf, "events")
    return events.select("event_id", numbers.in_range(col("value"), 0, 120).alias("value"))


@query
def floor_invalid_to_zero(spark, sf):
    customers = t.table(spark, sf, "customer")
    return customers.select(
        "c_custkey", numbers.positive_or_zero(col("c_acctbal")).alias("balance")
    )


@query
def repair_quantity(spark, sf):
    orders = t.derive(spark, sf, t.RAW_ORDERS)
    amounts = [
        numbers.to_number(col(c)) for c in ("quantity", "total_amount_usd", "unit_price_usd")
    ]
    return orders.select("order_id", numbers.repair_quantity(*amounts).alias("quantity"))


def _lines(spark, sf) -> DataFrame:
    lines, orders = t.lines_and_orders(t.table(spark, sf, "lineitem"), t.table(spark, sf, "orders"))
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


@query
def date_order_guard(spark, sf):
    ordered, shipped = col("o_orderdate").cast("date"), col("l_shipdate").cast("date")
    return _lines(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        ordered.alias("order_date"),
        dates.not_before(shipped, ordered).alias("ship_date"),
    )


@query
def date_parts(spark, sf):
    day = col("o_orderdate").cast("date")
    return t.table(spark, sf, "orders").select(
        "o_orderkey",
        dates.year_number(day).alias("anio"),
        dates.month_number(day).alias("mes"),
        dates.month_start(day).alias("mes_fecha"),
        dates.quarter_start(day).alias("trimestre_fecha"),
    )


@query
def full_name(spark, sf):
    customers = t.derive(spark, sf, t.STAGE_CUSTOMERS)
    return customers.select(
        "customer_id", text.full_name(col("first_name"), col("last_name")).alias("nombre_completo")
    )


@query
def pii_hash(spark, sf):
    customers = t.derive(spark, sf, t.RAW_CUSTOMERS)
    return customers.select("customer_id", text.email_token(col("email")).alias("email_hash"))


@query
def pii_mask(spark, sf):
    customers = t.derive(spark, sf, t.RAW_CUSTOMERS)
    return customers.select("customer_id", text.mask_phone(col("phone")).alias("phone_masked"))


@query
def product_margin(spark, sf):
    products = t.derive(spark, sf, t.STAGE_PRODUCTS)
    price, cost = col("price_usd"), col("cost_usd")
    return products.select(
        "product_id",
        numbers.margin(price, cost).alias("margin_usd"),
        numbers.margin_share(price, cost).alias("margin_pct"),
    )


# --- rows ------------------------------------------------------------------------------------


def _sparse_lines(spark, sf) -> DataFrame:
    """Line keys with the lines of one return flag blanked out and some keys lost."""
    blank = (col("l_returnflag") == "R") & (col("l_linestatus") == "O")
    lost = blank | (col("l_returnflag") == "N") & (col("l_linestatus") == "F")
    return t.table(spark, sf, "lineitem").select(
        F.when(~lost, col("l_orderkey")).alias("order_key"),
        F.when(~blank, col("l_linenumber")).alias("line_number"),
        F.when(~blank, col("l_returnflag")).alias("flag"),
    )


@query
def distinct_rows(spark, sf):
    return rows.distinct_rows(_sparse_lines(spark, sf))


@query
def drop_empty_rows(spark, sf):
    return rows.drop_empty_rows(_sparse_lines(spark, sf))


@query
def drop_null_keys(spark, sf):
    return rows.drop_null_keys(_sparse_lines(spark, sf), ["order_key"])


_LINE_KEY = ["l_orderkey", "l_linenumber"]


@query
def dedup_first(spark, sf):
    return rows.keep_first(t.table(spark, sf, "lineitem"), _LINE_KEY)


@query
def dedup_earliest(spark, sf):
    lines = t.table(spark, sf, "lineitem")
    return rows.keep_first(lines, _LINE_KEY, [col("l_shipdate").asc_nulls_last()])


@query
def conform_schema(spark, sf):
    # Columns out of order, one too many, one missing.
    products = t.derive(spark, sf, t.STAGE_PRODUCTS)
    loose = products.select(
        "active", "supplier", "stock_units", "price_usd", "category", "product_name",
        "product_id", F.lit("?").alias("shelf"),
    )
    typed = StructType([f for f in PRODUCTS.stage if f.name != PRODUCTS.stamp])
    return rows.conform(loose, typed)


@query
def sample_rows(spark, sf):
    return rows.sample_rows(
        t.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 5, ["o_orderkey"]
    )


@query
def sample_values(spark, sf):
    return rows.sample_values(t.derive(spark, sf, t.RAW_CUSTOMERS), "registration_date")


# --- joins -----------------------------------------------------------------------------------


def _line_parents(spark, sf) -> list[Parent]:
    """Parents with gaps: suppliers in debt and economy parts are unknown."""
    suppliers = t.table(spark, sf, "supplier").filter("s_acctbal >= 0")
    parts = t.table(spark, sf, "part").filter("p_type <> 'ECONOMY'")
    return [Parent(suppliers, "s_suppkey", "l_suppkey"), Parent(parts, "p_partkey", "l_partkey")]


def _references(spark, sf) -> DataFrame:
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity"
    )


@query
def referential_filter(spark, sf):
    return joins.referential_filter(_references(spark, sf), _line_parents(spark, sf))


@query
def orphan_report(spark, sf):
    return joins.orphan_report(_references(spark, sf), *_line_parents(spark, sf))


@query
def orphan_summary(spark, sf):
    return joins.orphan_summary(orphan_report(spark, sf))


@query
def merge_upsert(spark, sf):
    customers = t.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    target = customers.filter("c_acctbal >= 0")
    batch = (
        customers.filter("c_mktsegment IN ('BUILDING', 'MACHINERY')")
        .withColumn("c_acctbal", col("c_acctbal") + 1000)
        .withColumn("c_mktsegment", F.lit("MERGED"))
    )
    name = f"merge_upsert_{uuid4().hex}"
    for part in (target, batch):  # scans of files, so they need not be held
        tables.upsert(part, name, "c_custkey", bucket_rows=10_000)
    return spark.table(name)


# --- cleaning --------------------------------------------------------------------------------


@query
def clean_customers(spark, sf):
    return clean.clean_customers(t.derive(spark, sf, t.RAW_CUSTOMERS))


@query
def clean_products(spark, sf):
    return clean.clean_products(t.derive(spark, sf, t.RAW_PRODUCTS))


@query
def clean_orders(spark, sf):
    return clean.clean_orders(
        t.derive(spark, sf, t.RAW_ORDERS), clean_customers(spark, sf), clean_products(spark, sf)
    )


@query
def clean_orders_unchecked(spark, sf):
    return clean.clean_orders(t.derive(spark, sf, t.RAW_ORDERS))


# --- star schema and questions ---------------------------------------------------------------


@query
def dim_customer(spark, sf):
    return model.dim_customer(t.derive(spark, sf, t.STAGE_CUSTOMERS))


@query
def dim_product(spark, sf):
    return model.dim_product(t.derive(spark, sf, t.STAGE_PRODUCTS))


@query
def fact_sales(spark, sf, grid=None):
    return model.fact_sales(
        t.derive(spark, sf, t.STAGE_ORDERS), t.derive(spark, sf, t.STAGE_PRODUCTS), grid
    )


@query
def report_view(spark, sf):
    products, customers = dim_product(spark, sf), dim_customer(spark, sf)
    usual = model.report_view(fact_sales(spark, sf), products, customers)
    grid = t.sales_grid(spark, sf, usual)
    if grid is None:
        return usual
    return model.report_view(fact_sales(spark, sf, grid), products, customers, grid)


@query
def q1_top_customers(spark, sf):
    return questions.top_customers(fact_sales(spark, sf), dim_customer(spark, sf))


@query
def q2_monthly_revenue(spark, sf):
    return questions.monthly_revenue(fact_sales(spark, sf))


@query
def q3_outliers(spark, sf):
    events = t.table(spark, sf, "events")
    return questions.outliers(
        events.select(
            col("event_id").alias("order_id"),
            col("user_id").alias("customer_id"),
            col("value").alias("gross_amount_usd"),
        )
    )


@query
def report_top_products(spark, sf):
    return questions.top_products(fact_sales(spark, sf), dim_product(spark, sf))


@query
def report_monthly_sales(spark, sf):
    return questions.monthly_sales(fact_sales(spark, sf))


@query
def report_status_share(spark, sf):
    return questions.status_share(fact_sales(spark, sf))


@query
def revenue_from_raw(spark, sf):
    """Dirty extracts to monthly revenue in one plan: clean, check, model, aggregate."""
    return questions.monthly_revenue(
        model.fact_sales(clean_orders(spark, sf), clean_products(spark, sf))
    )


# --- profiling and quality -------------------------------------------------------------------


@query
def profile_nulls(spark, sf):
    return profile.profile_nulls(t.derive(spark, sf, t.RAW_ORDERS))


@query
def profile_row_dups(spark, sf):
    return profile.profile_row_dups(t.derive(spark, sf, t.RAW_ORDERS))


@query
def duplicate_keys(spark, sf):
    return profile.duplicate_keys(t.derive(spark, sf, t.RAW_ORDERS), "order_id")


@query
def profile_domain(spark, sf):
    return profile.profile_domain(
        t.derive(spark, sf, t.RAW_ORDERS), ["status", "payment_method", "discount_pct"]
    )


@query
def profile_numeric_domain(spark, sf):
    return profile.profile_numeric_domain(t.derive(spark, sf, t.RAW_CUSTOMERS), ["age"])


@query
def profile_range(spark, sf):
    return profile.profile_range(
        t.derive(spark, sf, t.RAW_ORDERS),
        ["quantity", "unit_price_usd", "total_amount_usd", "discount_pct"],
    )


def order_rules() -> dict:
    """Rules a clean order obeys; null counts as a breach only where a value is required."""
    return {
        "quantity_not_positive": col("quantity") <= 0,
        "quantity_missing": col("quantity").isNull(),
        "shipped_before_ordered": col("ship_date") < col("order_date"),
        "order_date_missing": col("order_date").isNull(),
        "discount_out_of_range": ~col("discount_pct").between(0, 20),
        "status_unknown": col("status") == text.UNKNOWN,
    }


@query
def dq_checks(spark, sf):
    orders = clean_orders_unchecked(spark, sf)
    customers, products = clean.order_parents(clean_customers(spark, sf), clean_products(spark, sf))
    return profile.dq_checks(
        orders, "order_id", order_rules(), {"no_customer": customers, "no_product": products}
    )


@query
def dq_violations(spark, sf):
    raw = t.derive(spark, sf, t.RAW_PRODUCTS).select(
        "product_id", numbers.to_number(col("price_usd")).alias("price_usd"), "cost_usd"
    )
    return profile.list_violations(
        raw, {"price_not_positive": col("price_usd") <= 0, "cost_missing": col("cost_usd").isNull()}
    )


@query
def load_metrics(spark, sf):
    return profile.load_metrics(
        t.derive(spark, sf, t.RAW_ORDERS),
        numbers.to_integer(col("order_id")),
        clean_orders(spark, sf),
    )
