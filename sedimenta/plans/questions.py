"""Ready-made questions on the star schema.

Sales are aggregated before names are joined, so joins see one row per customer or product
however many sales they have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.dates import quarter_start
from sedimenta.functions.numbers import fraction, money_sum, z_score

col = F.col


def top_customers(fact: DataFrame, customers: DataFrame, n: int = 3) -> DataFrame:
    """Customers with most orders in the last quarter of the data; ties by customer.

    The quarter is found and filtered on the first day of the month: a quarter starts with a
    month, and a fact partitioned by month then reads only that quarter.
    """
    month = col("mes_fecha")
    last_quarter = fact.agg(quarter_start(F.max(month))).scalar()
    counts = (
        fact.filter(month >= last_quarter)
        .groupBy("customer_id")
        .agg(F.count_distinct("order_id").alias("cantidad_pedidos"))
    )
    return (
        counts.join(customers.select("customer_id", "nombre_completo"), "customer_id")
        .select("customer_id", "nombre_completo", "cantidad_pedidos")
        .orderBy(F.desc("cantidad_pedidos"), "customer_id")
        .limit(n)
    )


def monthly_revenue(fact: DataFrame) -> DataFrame:
    """Net revenue of completed orders by month and category, highest first."""
    return (
        fact.filter(col("order_date").isNotNull() & (col("status") == "COMPLETED"))
        .groupBy("anio", "mes", col("product_category").alias("categoria"))
        .agg(money_sum(col("net_amount_usd")).alias("revenue_total"))
        .orderBy(F.desc("revenue_total"), "anio", "mes", "categoria")
    )


def outliers(fact: DataFrame, deviations: float = 2.0) -> DataFrame:
    """Sales more than `deviations` sample standard deviations above the mean, with z-score.

    Mean and deviation are scalar subqueries answered by one aggregate; sales are then filtered
    where they are scanned, without a join.
    """
    amount = col("gross_amount_usd")
    known = fact.filter(amount.isNotNull())
    mean = known.agg(F.avg(amount)).scalar()
    deviation = known.agg(F.stddev_samp(amount)).scalar()
    z = z_score(amount, mean, deviation)
    return (
        fact.filter(z > deviations)
        .select(
            "order_id",
            "customer_id",
            amount.alias("total_amount_usd"),
            fraction(z).alias("z_score"),
        )
        .orderBy(F.desc("z_score"), "order_id")
    )


def top_products(fact: DataFrame, products: DataFrame, n: int = 5) -> DataFrame:
    """Products with most net revenue; only the winners' names are looked up."""
    best = (
        fact.groupBy("product_id")
        .agg(money_sum(col("net_amount_usd")).alias("ingresos"))
        .orderBy(F.desc_nulls_last("ingresos"), "product_id")
        .limit(n)
    )
    # How large the winners are is for Spark to see, which knows the limit.
    names = products.select("product_id", "product_name").join(
        best.select("product_id"), "product_id", "left_semi"
    )
    return (
        best.join(names, "product_id", "left")
        .select("product_id", "product_name", "ingresos")
        .orderBy(F.desc_nulls_last("ingresos"), "product_id")
    )


def monthly_sales(fact: DataFrame) -> DataFrame:
    """Net sales and orders per month, in time order, undated sales last."""
    return (
        fact.groupBy("mes_fecha")
        .agg(
            money_sum(col("net_amount_usd")).alias("ventas"),
            F.count(F.lit(1)).alias("pedidos"),
        )
        .orderBy(col("mes_fecha").asc_nulls_last())
    )


def status_share(fact: DataFrame) -> DataFrame:
    """Share of sales in each status, in percent."""
    counts = fact.groupBy("status").agg(F.count(F.lit(1)).alias("pedidos"))
    total = counts.agg(F.sum("pedidos")).scalar()
    share = col("pedidos") * 100.0 / total
    return counts.select("status", "pedidos", fraction(share).alias("porcentaje")).orderBy(
        F.desc("pedidos"), "status"
    )
