"""The same results as SQL for the checking engine, written apart from the Spark plans."""

from __future__ import annotations

from bindings import tables as t

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _trim(c: str) -> str:
    return f"trim({c}, {_WS})"


def _upper(c: str) -> str:
    # The checking engine upper-cases letter by letter: a sharp s gets a capital form, not SS.
    return f"replace(upper({_trim(c)}), 'ẞ', 'SS')"


def _number(c: str) -> str:
    x = _trim(c)
    return (
        f"CASE WHEN regexp_full_match({x}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
        f"THEN try_cast({x} AS DOUBLE) END"
    )


def _integer(c: str) -> str:
    n = f"({_number(c)})"
    return f"CASE WHEN {n} = floor({n}) THEN try_cast({n} AS BIGINT) END"


def _whole(n: str) -> str:
    return f"CASE WHEN ({n}) = floor({n}) THEN try_cast(({n}) AS BIGINT) END"


def _date(c: str) -> str:
    x = f"replace(replace({_trim(c)}, '/', '-'), '.', '-')"
    return (
        f"CASE WHEN regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') "
        f"THEN CAST(try_strptime({x}, '%Y-%m-%d') AS DATE) END"
    )


def _domain(x: str, *values: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"CASE WHEN {x} IN ({listed}) THEN {x} ELSE 'NO DETERMINADO' END"


def _supplier(c: str) -> str:
    letter = f"regexp_extract(upper({c}), '([A-Z])\\s*$', 1)"
    return (
        f"CASE WHEN coalesce({letter}, '') <> '' THEN 'PROVEEDOR ' || {letter} "
        "ELSE 'NO DETERMINADO' END"
    )


def _boolean(c: str) -> str:
    return f"coalesce({_upper(c)} IN ('1', 'TRUE', 'T', 'YES', 'SI'), false)"


def _round(x: str, places: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(18, {places + 4})), {places}) AS DOUBLE)"


def _cents(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


def _quantity(q: str, total: str, price: str) -> str:
    repaired = f"round_even(({total}) / nullif({price}, 0), 0)"
    return _whole(f"CASE WHEN ({q}) > 0 THEN ({q}) ELSE {repaired} END")


def _sum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(20, 2))) AS DOUBLE)"


def _mask(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN '****' || right(regexp_replace({c}, '\\D', '', 'g'), 4) END"


def _hash(c: str) -> str:
    return f"sha256(lower({_trim(c)}))"


_NAME = "trim(coalesce(first_name, '') || ' ' || coalesce(last_name, ''))"

_STATUS = _domain(_upper("status"), "COMPLETED", "PENDING", "CANCELLED", "RETURNED")
_PAYMENT = _domain(
    f"replace({_upper('payment_method')}, ' ', '_')",
    "CREDIT_CARD", "DEBIT_CARD", "PAYPAL", "CASH",
)


def _first(columns, key, source, order=""):
    """One row per key under a total order."""
    ties = ", ".join(f"{c} NULLS LAST" for c in columns if c not in key.split(", "))
    return (
        f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY "
        f"{order}{ties}) AS rn FROM {source}) ranked WHERE rn = 1)"
    )


_RAW = f"""WITH raw_customers AS ({t.RAW_CUSTOMERS}), raw_products AS ({t.RAW_PRODUCTS}),
raw_orders AS ({t.RAW_ORDERS})"""

_CUSTOMER_COLUMNS = list(t._CUSTOMER)
_PRODUCT_COLUMNS = list(t._PRODUCT)
_ORDER_COLUMNS = list(t._ORDER)

_age = _number("age")
_CLEAN = f"""{_RAW},
typed_customers AS (
  SELECT {_integer('customer_id')} AS customer_id, {_upper('first_name')} AS first_name,
    {_upper('last_name')} AS last_name,
    {_trim('email')} AS email, {_trim('phone')} AS phone, {_upper('city')} AS city,
    'COLOMBIA' AS country,
    {_whole(f"CASE WHEN ({_age}) BETWEEN 0 AND 120 THEN ({_age}) END")} AS age,
    {_date('registration_date')} AS registration_date,
    {_domain(_upper('loyalty_tier'), 'BRONZE', 'SILVER', 'GOLD')} AS loyalty_tier
  FROM (SELECT DISTINCT * FROM raw_customers) d),
clean_customers AS (SELECT * EXCLUDE rn FROM
  {_first(_CUSTOMER_COLUMNS, 'customer_id', 'typed_customers WHERE customer_id IS NOT NULL',
          'registration_date NULLS LAST, ')} u),
typed_products AS (
  SELECT {_integer('product_id')} AS product_id, {_upper('product_name')} AS product_name,
    {_upper('category')} AS category,
    {_cents(f"CASE WHEN ({_number('price_usd')}) > 0 THEN ({_number('price_usd')}) ELSE 0 END")} AS price_usd,
    {_cents(f"CASE WHEN ({_number('cost_usd')}) > 0 THEN ({_number('cost_usd')}) ELSE 0 END")} AS cost_usd,
    {_whole(f"CASE WHEN ({_number('stock_units')}) > 0 THEN ({_number('stock_units')}) ELSE 0 END")} AS stock_units,
    {_supplier('supplier')} AS supplier, {_boolean('active')} AS active
  FROM (SELECT DISTINCT * FROM raw_products) d),
clean_products AS (SELECT * EXCLUDE rn FROM
  {_first(_PRODUCT_COLUMNS, 'product_id', 'typed_products WHERE product_id IS NOT NULL')} u),
typed_orders AS (
  SELECT {_integer('order_id')} AS order_id, {_integer('customer_id')} AS customer_id,
    {_integer('product_id')} AS product_id,
    {_quantity(_number('quantity'), _number('total_amount_usd'), _number('unit_price_usd'))} AS quantity,
    {_number('unit_price_usd')} AS unit_price_usd, {_number('total_amount_usd')} AS total_amount_usd,
    {_date('order_date')} AS order_date,
    CASE WHEN {_date('ship_date')} < {_date('order_date')} THEN NULL ELSE {_date('ship_date')} END AS ship_date,
    {_STATUS} AS status, {_PAYMENT} AS payment_method,
    {_number('discount_pct')} AS discount_pct, {_trim('credit_card_last4')} AS credit_card_last4
  FROM (SELECT DISTINCT * FROM raw_orders) d),
unchecked_orders AS (SELECT * EXCLUDE rn FROM
  {_first(_ORDER_COLUMNS, 'order_id', 'typed_orders WHERE order_id IS NOT NULL')} u),
clean_orders AS (
  SELECT * FROM unchecked_orders o
  WHERE EXISTS (SELECT 1 FROM clean_customers c WHERE c.customer_id = o.customer_id)
    AND EXISTS (SELECT 1 FROM clean_products p WHERE p.product_id = o.product_id))"""

_DIM_CUSTOMER = f"""SELECT customer_id, {_NAME} AS nombre_completo, first_name, last_name,
  {_hash('email')} AS email_hash, {_mask('phone')} AS phone_masked, city, country, age,
  loyalty_tier, registration_date"""

_MARGIN_PCT = _round("(price_usd - cost_usd) / nullif(price_usd, 0)", 4)
_DIM_PRODUCT = f"""SELECT product_id, product_name, category, supplier, price_usd, cost_usd,
  {_round('price_usd - cost_usd', 2)} AS margin_usd, {_MARGIN_PCT} AS margin_pct, stock_units, active"""


def _fact(orders: str, products: str) -> str:
    gross, disc = "o.total_amount_usd", "coalesce(o.discount_pct, 0)"
    net = f"{gross} * (1 - {disc} / 100)"
    cost = "o.quantity * p.cost_usd"
    return f"""SELECT o.order_id, o.customer_id, o.product_id, p.category AS product_category,
  o.order_date, o.ship_date, CAST(year(o.order_date) AS BIGINT) AS anio,
  CAST(month(o.order_date) AS BIGINT) AS mes, CAST(date_trunc('month', o.order_date) AS DATE) AS mes_fecha,
  o.quantity, o.unit_price_usd, o.discount_pct, {gross} AS gross_amount_usd,
  {_round(f'{gross} * {disc} / 100', 2)} AS discount_amount_usd, {_round(net, 2)} AS net_amount_usd,
  p.cost_usd AS unit_cost_usd, {_round(cost, 2)} AS cost_total_usd,
  {_round(f'{net} - {cost}', 2)} AS profit_usd, o.status, o.payment_method
FROM {orders} o LEFT JOIN {products} p ON o.product_id = p.product_id"""


_STAR = f"""WITH customers AS ({t.STAGE_CUSTOMERS}), products AS ({t.STAGE_PRODUCTS}),
sales_orders AS ({t.STAGE_ORDERS}),
dim_customer AS ({_DIM_CUSTOMER} FROM customers), dim_product AS ({_DIM_PRODUCT} FROM products),
fact AS ({_fact('sales_orders', 'products')})"""

_Q2 = f"""SELECT anio, mes, product_category AS categoria, {_sum('net_amount_usd')} AS revenue_total
FROM fact WHERE order_date IS NOT NULL AND status = 'COMPLETED' GROUP BY 1, 2, 3"""

_SPARSE = """(SELECT
  CASE WHEN NOT ((l_returnflag = 'R' AND l_linestatus = 'O')
    OR (l_returnflag = 'N' AND l_linestatus = 'F')) THEN l_orderkey END AS order_key,
  CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'O') THEN l_linenumber END AS line_number,
  CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'O') THEN l_returnflag END AS flag
FROM lineitem) s"""

_LINE_COLUMNS = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
_LINES = "SELECT l_orderkey, l_linenumber, " + ", ".join(_LINE_COLUMNS)

_REFERENCES = """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity{extra}
FROM lineitem l
LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) s ON l_suppkey = s_suppkey
LEFT JOIN (SELECT p_partkey FROM part WHERE p_type <> 'ECONOMY') p ON l_partkey = p_partkey
WHERE {where}"""
_ORPHANS = _REFERENCES.format(
    extra=""", CASE WHEN s_suppkey IS NULL AND p_partkey IS NULL
    THEN 'CLIENTE Y PRODUCTO INEXISTENTES' WHEN s_suppkey IS NULL THEN 'CLIENTE INEXISTENTE'
    ELSE 'PRODUCTO INEXISTENTE' END AS motivo""",
    where="s_suppkey IS NULL OR p_partkey IS NULL",
)


def _long(source: str, name: str, value: str, entries: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS {name}, CAST({expression} AS BIGINT) AS {value} FROM {source}"
        for label, expression in entries.items()
    )


_PROFILE_NULLS = " UNION ALL ".join(
    [
        "SELECT 'rows' AS metric, '*' AS column_name, count(*) AS value FROM raw_orders",
        f"SELECT 'columns', '*', CAST({len(_ORDER_COLUMNS)} AS BIGINT)",
        "SELECT 'all_null_rows', '*', count(*) FROM raw_orders WHERE "
        + " AND ".join(f"{c} IS NULL" for c in _ORDER_COLUMNS),
        *[
            f"SELECT 'nulls', '{c}', count(*) - count({c}) FROM raw_orders"
            for c in _ORDER_COLUMNS
        ],
    ]
)

_RANGED = ("quantity", "unit_price_usd", "total_amount_usd", "discount_pct")

ORACLE: dict[str, str] = {
    "parse_date": f"""{_RAW} SELECT order_id, {_date('order_date')} AS order_date,
        {_date('ship_date')} AS ship_date FROM raw_orders""",
    "to_integer": f"{_RAW} SELECT "
    + ", ".join(
        f"{_integer(c)} AS {c}" for c in ("order_id", "customer_id", "product_id", "quantity")
    )
    + " FROM raw_orders",
    "to_number": f"{_RAW} SELECT order_id, "
    + ", ".join(f"{_number(c)} AS {c}" for c in _RANGED)
    + " FROM raw_orders",
    "canonical_supplier": f"{_RAW} SELECT product_id, {_supplier('supplier')} AS supplier FROM raw_products",
    "to_boolean": f"{_RAW} SELECT product_id, {_boolean('active')} AS active FROM raw_products",
    "normalize_text": f"""SELECT doc_id, {_upper('text')} AS upper_text,
        {_trim('text')} AS trimmed_text FROM documents""",
    "standardize_domain": f"""{_RAW} SELECT order_id, {_STATUS} AS status,
        {_PAYMENT} AS payment_method FROM raw_orders""",
    "range_guard": """SELECT event_id, CASE WHEN value BETWEEN 0 AND 120 THEN value END AS value
        FROM events""",
    "floor_invalid_to_zero": """SELECT c_custkey, greatest(c_acctbal, 0) AS balance FROM customer""",
    "repair_quantity": f"""{_RAW} SELECT order_id, {_quantity(_number('quantity'),
        _number('total_amount_usd'), _number('unit_price_usd'))} AS quantity FROM raw_orders""",
    "date_order_guard": """SELECT l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS order_date,
        CASE WHEN CAST(l_shipdate AS DATE) >= CAST(o_orderdate AS DATE)
        THEN CAST(l_shipdate AS DATE) END AS ship_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "date_parts": """SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS anio,
        CAST(month(o_orderdate) AS BIGINT) AS mes,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS mes_fecha,
        CAST(date_trunc('quarter', o_orderdate) AS DATE) AS trimestre_fecha FROM orders""",
    "full_name": f"{_STAR} SELECT customer_id, {_NAME} AS nombre_completo FROM customers",
    "pii_hash": f"{_RAW} SELECT customer_id, {_hash('email')} AS email_hash FROM raw_customers",
    "pii_mask": f"{_RAW} SELECT customer_id, {_mask('phone')} AS phone_masked FROM raw_customers",
    "product_margin": f"""{_STAR} SELECT product_id, {_round('price_usd - cost_usd', 2)} AS margin_usd,
        {_MARGIN_PCT} AS margin_pct FROM products""",
    "distinct_rows": f"SELECT DISTINCT order_key, line_number, flag FROM {_SPARSE}",
    "drop_empty_rows": f"""SELECT order_key, line_number, flag FROM {_SPARSE}
        WHERE order_key IS NOT NULL OR line_number IS NOT NULL OR flag IS NOT NULL""",
    "drop_null_keys": f"SELECT order_key, line_number, flag FROM {_SPARSE} WHERE order_key IS NOT NULL",
    "dedup_first": f"{_LINES} FROM {_first(_LINE_COLUMNS, 'l_orderkey, l_linenumber', 'lineitem')} u",
    "dedup_earliest": f"""{_LINES} FROM {_first(_LINE_COLUMNS, 'l_orderkey, l_linenumber',
        'lineitem', 'l_shipdate, ')} u""",
    "conform_schema": f"""{_STAR} SELECT product_id, product_name, category, price_usd,
        CAST(NULL AS DOUBLE) AS cost_usd, stock_units, supplier, active FROM products""",
    "sample_rows": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
    "sample_values": f"""{_RAW} SELECT DISTINCT registration_date FROM raw_customers
        WHERE registration_date IS NOT NULL ORDER BY 1 LIMIT 6""",
    "referential_filter": _REFERENCES.format(
        extra="", where="s_suppkey IS NOT NULL AND p_partkey IS NOT NULL"
    ),
    "orphan_report": _ORPHANS,
    "orphan_summary": f"SELECT motivo, count(*) AS filas FROM ({_ORPHANS}) r GROUP BY motivo",
    "merge_upsert": """WITH batch AS (SELECT c_custkey, 'MERGED' AS c_mktsegment,
        c_acctbal + 1000 AS c_acctbal FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
        SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
        WHERE c_acctbal >= 0 AND c_custkey NOT IN (SELECT c_custkey FROM batch)
        UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal FROM batch""",
    "clean_customers": f"{_CLEAN} SELECT * FROM clean_customers",
    "clean_products": f"{_CLEAN} SELECT * FROM clean_products",
    "clean_orders": f"{_CLEAN} SELECT * FROM clean_orders",
    "clean_orders_unchecked": f"{_CLEAN} SELECT * FROM unchecked_orders",
    "dim_customer": f"{_STAR} SELECT * FROM dim_customer",
    "dim_product": f"{_STAR} SELECT * FROM dim_product",
    "fact_sales": f"{_STAR} SELECT * FROM fact",
    "report_view": f"""{_STAR} SELECT f.order_id, f.order_date, f.mes_fecha, f.anio, f.mes,
        f.product_id, p.product_name, f.product_category, f.customer_id, c.nombre_completo, c.city,
        c.loyalty_tier, f.quantity, f.unit_price_usd, f.discount_pct, f.gross_amount_usd,
        f.net_amount_usd, f.profit_usd, f.status, f.payment_method
        FROM fact f LEFT JOIN dim_product p ON f.product_id = p.product_id
        LEFT JOIN dim_customer c ON f.customer_id = c.customer_id""",
    "q1_top_customers": f"""{_STAR} SELECT f.customer_id, c.nombre_completo,
        count(DISTINCT f.order_id) AS cantidad_pedidos
        FROM fact f JOIN dim_customer c ON f.customer_id = c.customer_id
        WHERE f.order_date >= (SELECT date_trunc('quarter', max(order_date)) FROM fact)
        GROUP BY 1, 2 ORDER BY cantidad_pedidos DESC, f.customer_id LIMIT 3""",
    "q2_monthly_revenue": f"{_STAR} {_Q2}",
    "q3_outliers": f"""WITH stats AS (SELECT avg(value) AS mean, stddev_samp(value) AS sd FROM events)
        SELECT event_id AS order_id, user_id AS customer_id, value AS total_amount_usd,
        {_round('(value - mean) / sd', 4)} AS z_score FROM events CROSS JOIN stats
        WHERE (value - mean) / sd > 2""",
    "report_top_products": f"""{_STAR} SELECT f.product_id, p.product_name, ingresos
        FROM (SELECT product_id, {_sum('net_amount_usd')} AS ingresos FROM fact
          GROUP BY product_id ORDER BY ingresos DESC, product_id LIMIT 5) f
        LEFT JOIN dim_product p ON f.product_id = p.product_id""",
    "report_monthly_sales": f"""{_STAR} SELECT mes_fecha, {_sum('net_amount_usd')} AS ventas,
        count(*) AS pedidos FROM fact GROUP BY mes_fecha""",
    "report_status_share": f"""{_STAR} SELECT status, count(*) AS pedidos,
        {_round('count(*) * 100.0 / (SELECT count(*) FROM fact)', 4)} AS porcentaje
        FROM fact GROUP BY status""",
    "revenue_from_raw": f"{_CLEAN}, fact AS ({_fact('clean_orders', 'clean_products')}) {_Q2}",
    "profile_nulls": f"{_RAW} {_PROFILE_NULLS}",
    "profile_row_dups": f"""{_RAW} SELECT (SELECT count(*) FROM raw_orders) AS total_rows,
        (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_orders) d) AS distinct_rows,
        (SELECT count(*) FROM raw_orders)
        - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_orders) d) AS duplicate_rows""",
    "duplicate_keys": f"""{_RAW} SELECT order_id, count(*) AS n FROM raw_orders
        WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1""",
    "profile_domain": f"{_RAW} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM raw_orders GROUP BY {c}"
        for c in ("status", "payment_method", "discount_pct")
    ),
    "profile_numeric_domain": f"""{_RAW} SELECT DISTINCT 'age' AS column_name, {_age} AS value
        FROM raw_customers WHERE ({_age}) IS NOT NULL""",
    "profile_range": f"{_RAW} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, min({_number(c)}) AS min_value, max({_number(c)}) AS max_value, "
        f"count({_number(c)}) AS known, count(DISTINCT {_number(c)}) AS distinct_values FROM raw_orders"
        for c in _RANGED
    ),
    "dq_checks": f"{_CLEAN} "
    + _long(
        "unchecked_orders o",
        "check_name",
        "violations",
        {
            "quantity_not_positive": "count(*) FILTER (quantity <= 0)",
            "quantity_missing": "count(*) FILTER (quantity IS NULL)",
            "shipped_before_ordered": "count(*) FILTER (ship_date < order_date)",
            "order_date_missing": "count(*) FILTER (order_date IS NULL)",
            "discount_out_of_range": "count(*) FILTER (discount_pct < 0 OR discount_pct > 20)",
            "status_unknown": "count(*) FILTER (status = 'NO DETERMINADO')",
            "repeated_key": "count(*) - count(DISTINCT order_id)",
            "no_customer": "count(*) FILTER (customer_id IS NULL OR customer_id NOT IN "
            "(SELECT customer_id FROM clean_customers))",
            "no_product": "count(*) FILTER (product_id IS NULL OR product_id NOT IN "
            "(SELECT product_id FROM clean_products))",
        },
    ),
    "dq_violations": f"""{_RAW}, p AS (SELECT product_id, {_number('price_usd')} AS price_usd, cost_usd
        FROM raw_products)
        SELECT *, 'price_not_positive' AS check_name FROM p WHERE price_usd <= 0
        UNION ALL SELECT *, 'cost_missing' FROM p WHERE cost_usd IS NULL""",
    "load_metrics": f"{_CLEAN} "
    + _long(
        "raw_orders",
        "step",
        "total_rows",
        {
            "read": "count(*)",
            "keyed": f"count({_integer('order_id')})",
            "distinct_keys": f"count(DISTINCT {_integer('order_id')})",
            "kept": "max((SELECT count(*) FROM clean_orders))",
        },
    ),
}
