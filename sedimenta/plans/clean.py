"""Raw text to typed, clean rows.

Rows are parsed and put right first and then reduced to one per key, so the one shuffle of each
table carries typed values instead of text, and ties are decided on clean values. Exact copies,
empty rows and rows without a usable key need no step of their own: copies share a key and
`keep_first` keeps one of them, and an empty row has no key.

Each table is read in two projections: texts are parsed into columns, then rules refer to those
columns, so no parse is repeated however often a rule mentions its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.dates import not_before, parse_date
from sedimenta.functions.numbers import (
    cents,
    in_range,
    positive_or_zero,
    repair_quantity,
    to_integer,
    to_number,
    whole,
)
from sedimenta.functions.text import (
    COUNTRY,
    PAYMENTS,
    STATUSES,
    TIERS,
    canonical_supplier,
    in_domain,
    payment_code,
    to_boolean,
    trim_text,
    upper_text,
)
from sedimenta.operators.joins import Parent, referential_filter
from sedimenta.operators.rows import drop_null_keys, keep_first
from sedimenta.session import compile_by_operator

col = F.col


def _parsed(raw: DataFrame, key: str, columns: dict) -> DataFrame:
    """The parsed columns of rows that have a usable key."""
    compile_by_operator(raw.sparkSession)
    parsed = raw.select(*[column.alias(name) for name, column in columns.items()])
    return drop_null_keys(parsed, [key])


def _each(function, names: list[str]) -> dict:
    return {name: function(col(name)) for name in names}


def clean_customers(raw: DataFrame) -> DataFrame:
    """One row per customer: of several, the one registered first."""
    parsed = _parsed(
        raw,
        "customer_id",
        {
            "customer_id": to_integer(col("customer_id")),
            **_each(upper_text, ["first_name", "last_name"]),
            **_each(trim_text, ["email", "phone"]),
            "city": upper_text(col("city")),
            "country": F.lit(COUNTRY),
            "age": to_number(col("age")),
            "registration_date": parse_date(col("registration_date")),
            "loyalty_tier": upper_text(col("loyalty_tier")),
        },
    )
    customers = parsed.withColumns(
        {
            "age": whole(in_range(col("age"), 0, 120)),
            "loyalty_tier": in_domain(col("loyalty_tier"), TIERS),
        }
    )
    return keep_first(customers, ["customer_id"], [col("registration_date").asc_nulls_last()])


def clean_products(raw: DataFrame) -> DataFrame:
    """One row per product, invalid prices, costs and stocks as 0."""
    parsed = _parsed(
        raw,
        "product_id",
        {
            "product_id": to_integer(col("product_id")),
            **_each(upper_text, ["product_name", "category"]),
            **_each(to_number, ["price_usd", "cost_usd", "stock_units"]),
            "supplier": canonical_supplier(col("supplier")),
            "active": to_boolean(col("active")),
        },
    )
    products = parsed.withColumns(
        {
            "price_usd": cents(positive_or_zero(col("price_usd"))),
            "cost_usd": cents(positive_or_zero(col("cost_usd"))),
            "stock_units": whole(positive_or_zero(col("stock_units"))),
        }
    )
    return keep_first(products, ["product_id"])


def clean_orders(
    raw: DataFrame, customers: DataFrame | None = None, products: DataFrame | None = None
) -> DataFrame:
    """One row per order; with both parents given, only orders whose references exist."""
    parsed = _parsed(
        raw,
        "order_id",
        {
            **_each(to_integer, ["order_id", "customer_id", "product_id"]),
            **_each(to_number, ["quantity", "unit_price_usd", "total_amount_usd"]),
            **_each(parse_date, ["order_date", "ship_date"]),
            "status": upper_text(col("status")),
            "payment_method": payment_code(col("payment_method")),
            "discount_pct": to_number(col("discount_pct")),
            "credit_card_last4": trim_text(col("credit_card_last4")),
        },
    )
    orders = parsed.withColumns(
        {
            "quantity": repair_quantity(
                col("quantity"), col("total_amount_usd"), col("unit_price_usd")
            ),
            "ship_date": not_before(col("ship_date"), col("order_date")),
            "status": in_domain(col("status"), STATUSES),
            "payment_method": in_domain(col("payment_method"), PAYMENTS),
        }
    )
    unique = keep_first(orders, ["order_id"])
    if customers is None or products is None:
        return unique
    return referential_filter(unique, order_parents(customers, products))


def order_parents(customers: DataFrame, products: DataFrame) -> list[Parent]:
    return [
        Parent(customers, "customer_id", "customer_id"),
        Parent(products, "product_id", "product_id"),
    ]
