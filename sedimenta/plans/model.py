"""The star schema: two dimensions, the sales fact and the report over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.dates import month_number, month_start, year_number
from sedimenta.functions.numbers import margin, margin_share, money
from sedimenta.functions.text import email_token, full_name, mask_phone
from sedimenta.operators.joins import CELL, Grid, lookup
from sedimenta.schemas import REPORT_VIEW

col = F.col


def dim_customer(customers: DataFrame) -> DataFrame:
    """One row per customer, address hashed and phone masked."""
    return customers.select(
        "customer_id",
        full_name(col("first_name"), col("last_name")).alias("nombre_completo"),
        "first_name",
        "last_name",
        email_token(col("email")).alias("email_hash"),
        mask_phone(col("phone")).alias("phone_masked"),
        "city",
        "country",
        "age",
        "loyalty_tier",
        "registration_date",
    )


def dim_product(products: DataFrame) -> DataFrame:
    price, cost = col("price_usd"), col("cost_usd")
    return products.select(
        "product_id",
        "product_name",
        "category",
        "supplier",
        "price_usd",
        "cost_usd",
        margin(price, cost).alias("margin_usd"),
        margin_share(price, cost).alias("margin_pct"),
        "stock_units",
        "active",
    )


def fact_sales(orders: DataFrame, products: DataFrame, grid: Grid | None = None) -> DataFrame:
    """One row per order row with its measures; an unknown product gives null cost and profit.

    All statuses are kept. With a `grid` of products and customers the fact is dealt out by its
    cells and keeps their number, for a report that looks up customers too.
    """
    costs = products.select(
        "product_id",
        col("category").alias("product_category"),
        col("cost_usd").alias("unit_cost_usd"),
    )
    cell = [CELL] if grid else []
    if grid:
        orders, costs = grid.deal(orders, "order_id"), grid.copies(costs, "product_id")
    day, gross = col("order_date"), col("total_amount_usd")
    discount = F.coalesce(col("discount_pct"), F.lit(0.0))
    net = gross * (1 - discount / 100)
    cost = col("quantity") * col("unit_cost_usd")
    return lookup(orders, costs, ["product_id", *cell]).select(
        "order_id",
        "customer_id",
        "product_id",
        "product_category",
        "order_date",
        "ship_date",
        year_number(day).alias("anio"),
        month_number(day).alias("mes"),
        month_start(day).alias("mes_fecha"),
        "quantity",
        "unit_price_usd",
        "discount_pct",
        gross.alias("gross_amount_usd"),
        money(gross * discount / 100).alias("discount_amount_usd"),
        money(net).alias("net_amount_usd"),
        "unit_cost_usd",
        money(cost).alias("cost_total_usd"),
        money(net - cost).alias("profit_usd"),
        "status",
        "payment_method",
        *cell,
    )


def report_view(
    fact: DataFrame, products: DataFrame, customers: DataFrame, grid: Grid | None = None
) -> DataFrame:
    """Every sale with the names and attributes of its product and customer: the plan of the
    deployed view. A fact that was dealt out by a `grid` is joined where it lies."""
    cell = [CELL] if grid else []
    if grid:
        products = grid.copies(products, "product_id")
        customers = grid.copies(customers, "customer_id")
    inputs = {"fact": fact, "products": products, "customers": customers}
    text = report_view_sql("{fact}", "{products}", "{customers}", cell)
    return fact.sparkSession.sql(text, **inputs)


def report_view_sql(fact: str, products: str, customers: str, also: Sequence[str] = ()) -> str:
    """The same report as the text of a catalog view, for dashboards; rows that join agree in the
    columns `also` besides their key."""
    from_products = {"product_name"}
    from_customers = {"nombre_completo", "city", "loyalty_tier"}
    columns = ", ".join(
        f"{'pr' if c in from_products else 'c' if c in from_customers else 'f'}.{c}"
        for c in REPORT_VIEW.fieldNames()
    )
    by_product, by_customer = [
        " AND ".join(f"f.{c} = {parent}.{c}" for c in (key, *also))
        for parent, key in (("pr", "product_id"), ("c", "customer_id"))
    ]
    return (
        f"SELECT {columns} FROM {fact} f"
        f" LEFT JOIN {products} pr ON {by_product}"
        f" LEFT JOIN {customers} c ON {by_customer}"
    )
