"""The three business extracts, derived from the benchmark tables.

The benchmark tables are clean, so the usual dirt is written into text columns by arithmetic on
the key. Every expression is plain SQL that Spark and the checking engine read alike, and every
derivation keeps all rows of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sedimenta.operators.joins import Grid


def _pick(pieces: list[str], key: str) -> str:
    """One of some equally long texts, by the remainder of the key."""
    width = len(pieces[0])
    start = f"cast(1 + {width} * ({key} % {len(pieces)}) AS int)"
    return f"substring('{''.join(pieces)}', {start}, {width})"


def _dirty_date(day: str, key: str) -> str:
    """Three separators, missing and impossible days, a time of day."""
    separated = f"replace({day}, '-', {_pick(['-', '/', '.'], key)})"
    time = _pick([" " * 6] * 25 + [" 10:00"], key)
    return (
        f"CASE {key} % 53 WHEN 1 THEN NULL WHEN 2 THEN '2023-2-29' "
        f"ELSE concat({separated}, {time}) END"
    )


def _dirty_id(key: str) -> str:
    """Blanks, signs, decimals, words instead of numbers, nothing."""
    sign, decimals = _pick([" ", "+"], key), _pick(["  "] * 18 + [".0", ".5"], key)
    return (
        f"CASE {key} % 59 WHEN 1 THEN 'sin id' WHEN 2 THEN NULL "
        f"ELSE concat({sign}, cast({key} AS string), {decimals}) END"
    )


def _select(columns: dict[str, str], source: str) -> str:
    body = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return f"SELECT {body} FROM {source}"


def _empty_rows(columns: dict[str, str]) -> str:
    return _select({c: "cast(NULL AS string)" for c in columns}, "nation")


_CUSTOMER = {
    "customer_id": _dirty_id("c_custkey"),
    "first_name": "CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE concat(' ', lower(c_mktsegment)) END",
    "last_name": "concat(c_name, ' ')",
    "email": "concat(' ', c_name, '@Mail.Example')",
    "phone": (
        "CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'n/a-' "
        "ELSE concat('+57 ', cast(3000000000 + c_custkey AS string), ' ') END"
    ),
    "city": "concat('City ', cast(c_nationkey AS string), '  ')",
    "country": (
        "CASE c_nationkey % 4 WHEN 0 THEN 'Col.' WHEN 1 THEN 'colombia' WHEN 2 THEN 'CO' END"
    ),
    "age": (
        "CASE c_custkey % 9 WHEN 0 THEN '200' WHEN 1 THEN '-5' WHEN 2 THEN NULL "
        "WHEN 3 THEN 'n/d' ELSE cast(c_custkey % 100 AS string) END"
    ),
    "registration_date": (
        "concat(cast(2019 + c_custkey % 6 AS string), CASE c_custkey % 3 WHEN 0 THEN '-' "
        "WHEN 1 THEN '/' ELSE '.' END, cast(1 + c_custkey % 12 AS string), '-', "
        "cast(1 + c_custkey % 31 AS string))"
    ),
    "loyalty_tier": (
        "CASE c_custkey % 6 WHEN 0 THEN 'Gold' WHEN 1 THEN ' silver ' WHEN 2 THEN 'BRONZE' "
        "WHEN 3 THEN 'platinum' WHEN 4 THEN 'gold' END"
    ),
}

# Customers in debt registered again earlier; a whole segment was exported twice.
RAW_CUSTOMERS = " UNION ALL ".join(
    [
        _select(_CUSTOMER, "customer"),
        _select(
            {**_CUSTOMER, "registration_date": "'2018.12.31'", "city": "'Cali'"},
            "customer WHERE c_acctbal < 0",
        ),
        _select(_CUSTOMER, "customer WHERE c_mktsegment = 'BUILDING'"),
        _empty_rows(_CUSTOMER),
    ]
)

_PRODUCT = {
    "product_id": _dirty_id("p_partkey"),
    "product_name": "concat(' ', p_name)",
    "category": (
        "CASE WHEN p_partkey % 4 = 0 THEN lower(p_type) ELSE concat(p_type, ' ') END"
    ),
    "price_usd": (
        "CASE p_partkey % 41 WHEN 0 THEN '0' WHEN 1 THEN '-1424.71' WHEN 2 THEN NULL "
        "WHEN 3 THEN '12f' ELSE cast(p_retailprice AS string) END"
    ),
    "cost_usd": (
        "CASE p_partkey % 43 WHEN 0 THEN NULL WHEN 1 THEN 'gratis' "
        "ELSE cast(p_retailprice * 0.6e0 AS string) END"
    ),
    "stock_units": (
        "CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '-3' WHEN 2 THEN '1e3' "
        "WHEN 3 THEN concat(cast(p_size AS string), '.0') WHEN 4 THEN '2.5' "
        "ELSE cast(p_size AS string) END"
    ),
    "supplier": (
        "CASE p_partkey % 6 WHEN 0 THEN 'proveedor_a' WHEN 1 THEN 'Proveedor C ' "
        "WHEN 2 THEN 'ProveedorB' WHEN 3 THEN 'Proveedor' WHEN 4 THEN p_brand END"
    ),
    "active": (
        "CASE p_partkey % 7 WHEN 0 THEN '1' WHEN 1 THEN 'True' WHEN 2 THEN 'FALSE' "
        "WHEN 3 THEN '0' WHEN 4 THEN ' si ' WHEN 5 THEN 't' END"
    ),
}

# Large parts come again with a trailing blank in the name.
RAW_PRODUCTS = " UNION ALL ".join(
    [
        _select(_PRODUCT, "part"),
        _select({**_PRODUCT, "product_name": "concat(' ', p_name, '  ')"}, "part WHERE p_size > 25"),
        _empty_rows(_PRODUCT),
    ]
)

_LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"

# Line key and days as text, worked out once.
_EXPORTED_LINES = (
    "(SELECT *, l_orderkey * 8 + l_linenumber AS line_id, "
    "cast(cast(o_orderdate AS date) AS string) AS order_day, "
    f"cast(cast(l_shipdate AS date) AS string) AS ship_day FROM {_LINES}) lines"
)

_ORDER = {
    "order_id": _dirty_id("line_id"),
    "customer_id": (
        "CASE l_orderkey % 61 WHEN 0 THEN NULL WHEN 1 THEN '999999999' WHEN 2 THEN 'x' "
        "ELSE cast(o_custkey AS string) END"
    ),
    "product_id": (
        "CASE l_partkey % 67 WHEN 0 THEN NULL WHEN 1 THEN '888888888' "
        "ELSE concat(cast(l_partkey AS string), ' ') END"
    ),
    "quantity": (
        "CASE line_id % 23 WHEN 0 THEN NULL WHEN 1 THEN '-3' WHEN 2 THEN '0' "
        "WHEN 3 THEN 'dos' ELSE cast(l_quantity AS string) END"
    ),
    "unit_price_usd": (
        "CASE l_partkey % 71 WHEN 0 THEN '0' "
        "ELSE cast(l_extendedprice / l_quantity AS string) END"
    ),
    "total_amount_usd": (
        "CASE line_id % 73 WHEN 0 THEN NULL ELSE cast(l_extendedprice AS string) END"
    ),
    "order_date": _dirty_date("order_day", "o_orderkey"),
    "ship_date": _dirty_date("ship_day", "line_id"),
    "status": (
        "CASE WHEN l_returnflag = 'R' THEN 'Returned' WHEN o_orderstatus = 'F' THEN 'completed' "
        "WHEN o_orderstatus = 'O' THEN ' Pending ' WHEN l_linenumber = 7 THEN 'Shipped' "
        "WHEN l_linenumber < 6 THEN 'CANCELLED' END"
    ),
    "payment_method": (
        "CASE l_linenumber WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'debit_card' WHEN 3 THEN 'PayPal' "
        "WHEN 4 THEN ' cash' WHEN 5 THEN 'credit  card' WHEN 6 THEN 'Bitcoin' END"
    ),
    "discount_pct": (
        "CASE line_id % 29 WHEN 0 THEN NULL WHEN 1 THEN '5%' "
        "ELSE cast(l_discount * 100 AS string) END"
    ),
    "credit_card_last4": (
        "CASE WHEN l_linenumber < 4 THEN concat(' ', cast(1000 + l_suppkey AS string)) END"
    ),
}

# Returned open lines were exported twice; line numbers repeat within an order by themselves.
RAW_ORDERS = " UNION ALL ".join(
    [
        _select(_ORDER, _EXPORTED_LINES),
        _select(_ORDER, f"{_EXPORTED_LINES} WHERE l_returnflag = 'R' AND l_linestatus = 'O'"),
        _empty_rows(_ORDER),
    ]
)

# The same roles without dirt, typed as the stage layer would hold them.
STAGE_CUSTOMERS = _select(
    {
        "customer_id": "c_custkey",
        "first_name": "CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_mktsegment END",
        "last_name": "CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE upper(c_name) END",
        "email": "concat(c_name, '@Mail.Example')",
        "phone": (
            "CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '12' "
            "ELSE concat('+57 ', cast(3000000000 + c_custkey AS string)) END"
        ),
        "city": "concat('CITY ', cast(c_nationkey AS string))",
        "country": "'COLOMBIA'",
        "age": "CASE WHEN c_custkey % 9 > 3 THEN c_custkey % 100 END",
        "registration_date": "cast('2020-02-29' AS date)",
        "loyalty_tier": (
            "CASE c_custkey % 4 WHEN 0 THEN 'GOLD' WHEN 1 THEN 'SILVER' WHEN 2 THEN 'BRONZE' "
            "ELSE 'NO DETERMINADO' END"
        ),
    },
    "customer",
)

STAGE_PRODUCTS = _select(
    {
        "product_id": "p_partkey",
        "product_name": "upper(p_name)",
        "category": "p_type",
        "price_usd": "CASE WHEN p_partkey % 41 = 0 THEN 0e0 ELSE p_retailprice END",
        "cost_usd": "p_retailprice * 0.6e0",
        "stock_units": "cast(p_size AS bigint)",
        "supplier": "concat('PROVEEDOR ', substring('ABC', cast(1 + p_size % 3 AS int), 1))",
        "active": "p_size > 10",
    },
    "part",
)

STAGE_ORDERS = _select(
    {
        "order_id": "l_orderkey",
        "customer_id": "o_custkey",
        "product_id": "l_partkey",
        "quantity": "cast(l_quantity AS bigint)",
        "unit_price_usd": "l_extendedprice / l_quantity",
        "total_amount_usd": "l_extendedprice",
        "order_date": "cast(o_orderdate AS date)",
        "ship_date": (
            "CASE WHEN l_shipdate >= o_orderdate THEN cast(l_shipdate AS date) END"
        ),
        "status": (
            "CASE WHEN l_returnflag = 'R' THEN 'RETURNED' WHEN o_orderstatus = 'F' THEN "
            "'COMPLETED' WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE 'CANCELLED' END"
        ),
        "payment_method": (
            "CASE l_linenumber % 4 WHEN 0 THEN 'CASH' WHEN 1 THEN 'PAYPAL' "
            "WHEN 2 THEN 'CREDIT_CARD' ELSE 'DEBIT_CARD' END"
        ),
        "discount_pct": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount * 100 END",
        "credit_card_last4": "cast(1000 + l_suppkey AS string)",
    },
    _LINES,
)

_TABLES = ("nation", "customer", "part", "orders", "lineitem")

# Lines that a task joins to their orders, and from how many on they are dealt out that way.
_LINES_A_TASK, _MANY_LINES = 1 << 19, 1 << 22

# Copies of a parent in a grid. A task that writes to 14 squared cells need not hold its rows, which
# it does from 200 partitions on (`spark.shuffle.sort.bypassMergeThreshold`).
_SIDE = 14


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table, as its files are split."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines_and_orders(lines: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables, dealt out alike by order so that what a task joins does not grow with them.

    Partitions of many narrow rows compress to little, so by bytes too many are put into a task.
    The count is read from the footers of the files.
    """
    n = lines.count()
    if n <= _MANY_LINES:
        return lines, orders
    tasks = max(-(-n // _LINES_A_TASK), int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")


def sales_grid(spark: SparkSession, sf_dir: str, usual: DataFrame) -> Grid | None:
    """The grid in which sales look up products and customers, where the `usual` plan would shuffle
    them for both and the copies of the parents are fewer rows. The counts are read from the footers.

    Its side depends on no table, so what is shuffled stays in proportion to them.
    """
    lines, *parents = [table(spark, sf_dir, n).count() for n in ("lineitem", "part", "customer")]
    if lines <= _MANY_LINES or _SIDE * sum(parents) > lines:
        return None
    if "BroadcastHashJoin" in usual._jdf.queryExecution().executedPlan().toString():
        return None
    return Grid(("product_id", "customer_id"), _SIDE)


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A derivation over the benchmark tables it names, as a Spark plan."""
    words = sql.replace(")", " ").split()
    inputs = {name: table(spark, sf_dir, name) for name in _TABLES if name in words}
    if "lineitem" in inputs and "orders" in inputs:
        dealt = lines_and_orders(inputs["lineitem"], inputs["orders"])
        inputs["lineitem"], inputs["orders"] = dealt
    for name in inputs:
        sql = sql.replace(f"FROM {name}", f"FROM {{{name}}} AS {name}")
        sql = sql.replace(f"JOIN {name}", f"JOIN {{{name}}} AS {name}")
    return spark.sql(sql, **inputs)
