"""Declared tables of the three layers: columns, types and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def schema(**columns: str) -> T.StructType:
    """`schema(order_id="bigint", ...)` as a nullable StructType."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


@dataclass(frozen=True)
class TableSpec:
    """One entity: its primary key, the typed stage schema and the raw text columns."""

    name: str
    key: str
    stage: T.StructType

    @property
    def stamp(self) -> str:
        return "stage_updated_at"

    @property
    def raw_columns(self) -> list[str]:
        return [c for c in self.stage.fieldNames() if c != self.stamp]

    @property
    def raw(self) -> T.StructType:
        return schema(**dict.fromkeys(self.raw_columns, "string"))


CUSTOMERS = TableSpec(
    "customers",
    "customer_id",
    schema(
        customer_id="bigint",
        first_name="string",
        last_name="string",
        email="string",
        phone="string",
        city="string",
        country="string",
        age="bigint",
        registration_date="date",
        loyalty_tier="string",
        stage_updated_at="timestamp",
    ),
)

PRODUCTS = TableSpec(
    "products",
    "product_id",
    schema(
        product_id="bigint",
        product_name="string",
        category="string",
        price_usd="double",
        cost_usd="double",
        stock_units="bigint",
        supplier="string",
        active="boolean",
        stage_updated_at="timestamp",
    ),
)

ORDERS = TableSpec(
    "orders",
    "order_id",
    schema(
        order_id="bigint",
        customer_id="bigint",
        product_id="bigint",
        quantity="bigint",
        unit_price_usd="double",
        total_amount_usd="double",
        order_date="date",
        ship_date="date",
        status="string",
        payment_method="string",
        discount_pct="double",
        credit_card_last4="string",
        stage_updated_at="timestamp",
    ),
)

# Parents come before the table that refers to them.
TABLES = {spec.name: spec for spec in (CUSTOMERS, PRODUCTS, ORDERS)}

DIM_CUSTOMER = schema(
    customer_id="bigint",
    nombre_completo="string",
    first_name="string",
    last_name="string",
    email_hash="string",
    phone_masked="string",
    city="string",
    country="string",
    age="bigint",
    loyalty_tier="string",
    registration_date="date",
    analytics_updated_at="timestamp",
)

DIM_PRODUCT = schema(
    product_id="bigint",
    product_name="string",
    category="string",
    supplier="string",
    price_usd="double",
    cost_usd="double",
    margin_usd="double",
    margin_pct="double",
    stock_units="bigint",
    active="boolean",
    analytics_updated_at="timestamp",
)

FACT_SALES = schema(
    order_id="bigint",
    customer_id="bigint",
    product_id="bigint",
    product_category="string",
    order_date="date",
    ship_date="date",
    anio="bigint",
    mes="bigint",
    mes_fecha="date",
    quantity="bigint",
    unit_price_usd="double",
    discount_pct="double",
    gross_amount_usd="double",
    discount_amount_usd="double",
    net_amount_usd="double",
    unit_cost_usd="double",
    cost_total_usd="double",
    profit_usd="double",
    status="string",
    payment_method="string",
    analytics_updated_at="timestamp",
)

REPORT_VIEW = schema(
    order_id="bigint",
    order_date="date",
    mes_fecha="date",
    anio="bigint",
    mes="bigint",
    product_id="bigint",
    product_name="string",
    product_category="string",
    customer_id="bigint",
    nombre_completo="string",
    city="string",
    loyalty_tier="string",
    quantity="bigint",
    unit_price_usd="double",
    discount_pct="double",
    gross_amount_usd="double",
    net_amount_usd="double",
    profit_usd="double",
    status="string",
    payment_method="string",
)
