"""Cleaning, star schema and questions: the order rules, the shipped extracts, and plan shape."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from bindings import tables
from bindings.queries import QUERIES
from sedimenta.functions.text import UNKNOWN
from sedimenta.plans import clean, model, questions
from sedimenta.schemas import CUSTOMERS, ORDERS, PRODUCTS
from sedimenta.sources import csv

# A folder with the shipped customer and product extracts; their tests exist only with it.
EXTRACTS = os.environ.get("EXTRACTS_DIR", "")
SF = "/root/testdata/sf0.001"



def shipped(test):
    return test if os.path.isdir(EXTRACTS) else None


benchmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")

ORDER_ROWS = [
    ("100", "1", "10", "2", "5.0", "10.0", "2024-01-05", "2024/01/07", "completed", "credit card"),
    ("100", "1", "10", "2", "5.0", "10.0", "2024-01-05", "2024/01/07", "completed", "credit card"),
    ("101", "1", "11", "-3", "4.0", "10.0", "2024.02.01", "2024.01.01", "Shipped", "Bitcoin"),
    ("102", "2", "10", None, "4.0", "14.0", "bad", "2024-03-01", " pending ", "PayPal"),
    ("103", "2", "10", "0", "0", "9.0", "2024-03-02", None, "returned", "cash"),
    ("104", "9", "10", "1", "1.0", "1.0", "2024-03-02", None, "pending", "cash"),
    ("105", "1", "99", "1", "1.0", "1.0", "2024-03-02", None, "pending", "cash"),
    ("106", "9", "99", "1", "1.0", "1.0", "2024-03-02", None, "pending", "cash"),
    ("107", None, "10", "1", "1.0", "1.0", "2024-03-02", None, "pending", "cash"),
    (None, "1", "10", "1", "1.0", "1.0", "2024-03-02", None, "pending", "cash"),
    ("abc", "1", "10", "1", "1.0", "1.0", "2024-03-02", None, "pending", "cash"),
    (None,) * 10,
]


@pytest.fixture(scope="module")
def raw_orders(spark):
    data = [(*row, None, None) for row in ORDER_ROWS]
    return spark.createDataFrame(data, ORDERS.raw)


@pytest.fixture(scope="module")
def parents(spark):
    customers = spark.createDataFrame([(1,), (2,)], "customer_id bigint")
    products = spark.createDataFrame([(10,), (11,)], "product_id bigint")
    return customers, products


@pytest.mark.parametrize("broadcast", [True, False])
def test_order_rules(spark, raw_orders, parents, request, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    got = {r.order_id: r for r in clean.clean_orders(raw_orders, *parents).collect()}
    assert sorted(got) == [100, 101, 102, 103]
    assert (got[100].status, got[100].payment_method) == ("COMPLETED", "CREDIT_CARD")
    assert (got[101].quantity, got[101].ship_date) == (2, None)
    assert (got[101].status, got[101].payment_method) == (UNKNOWN, UNKNOWN)
    assert (got[102].quantity, got[102].order_date) == (4, None)
    assert got[102].ship_date == dt.date(2024, 3, 1)
    assert (got[102].status, got[102].payment_method) == ("PENDING", "PAYPAL")
    assert got[103].quantity is None


def test_orders_without_parents_are_not_checked(spark, raw_orders, parents):
    assert clean.clean_orders(raw_orders).count() == 8
    assert clean.clean_orders(raw_orders, customers=parents[0]).count() == 8


def test_cleaning_does_not_depend_on_partitioning(spark, raw_orders, parents):
    one = clean.clean_orders(raw_orders.repartition(1), *parents)
    many = clean.clean_orders(raw_orders.repartition(13), *parents)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_a_distinct_before_the_dedup_changes_nothing(spark, raw_orders):
    with_distinct = clean.clean_orders(raw_orders.dropDuplicates())
    without = clean.clean_orders(raw_orders)
    assert with_distinct.exceptAll(without).count() == 0 and without.count() == 8


def counts(df, column):
    return {r[0]: r["count"] for r in df.groupBy(column).count().collect()}


# The dirt of the business extracts: empty rows, copies, keys that differ by blanks, mixed date
# separators, impossible ages, missing values, variants of every closed domain.
CUSTOMER_EXTRACT = """customer_id,first_name,last_name,email,phone,city,country,age,registration_date,loyalty_tier
1,Ana,Gómez,ana@x.co,+57 3147960607,cali,COLOMBIA,-5,2024-01-05,Gold
1,Ana,Gómez,ana@x.co,+57 3147960607,cali,COLOMBIA,-5,2024-01-05,Gold
2,,Ruiz,luis@x.co,12,Bogota,Col.,200,2023/12/31,GOLD
,,,,,,,,,
3,Eva,Paz,,,MEDELLIN,colombia,44,2023.02.29,Silver
,,,,,,,,,
3,Eva,Paz,,,Medellin,CO,44,2023.02.28,bronze
4,Leo,Sol,leo@x.co,n/a-,Cali ,Colombia,31,2024-1-5,platinum
"""
PRODUCT_EXTRACT = """product_id,product_name,category,price_usd,cost_usd,stock_units,supplier,active
10,Tablero,electronics,1102.08,670.73,3,proveedor_a,true
10,Tablero  ,electronics,1102.08,670.73,3,proveedor_a,true
11,"Lápiz, rojo",Electronics,0,,,Proveedor C,1
12,Silla,HOME & KITCHEN,-1424.71,5,2.5,ProveedorB,FALSE
13,Mesa,Home & Kitchen,20,x,7,,0
"""


def test_customer_extract(spark, tmp_path):
    (tmp_path / "customers.csv").write_text(CUSTOMER_EXTRACT, encoding="utf-8")
    raw = csv.scan_raw(spark, str(tmp_path / "customers.csv"))
    assert raw.columns == CUSTOMERS.raw_columns
    assert (raw.count(), raw.dropDuplicates().count()) == (8, 6)
    customers = clean.clean_customers(raw)
    assert counts(customers, "city") == {"CALI": 2, "BOGOTA": 1, "MEDELLIN": 1}
    # Of customer 3 the row with a date comes first.
    assert counts(customers, "loyalty_tier") == {"GOLD": 2, "BRONZE": 1, UNKNOWN: 1}
    assert counts(customers, "country") == {"COLOMBIA": 4}
    rows = {r.customer_id: r for r in customers.collect()}
    assert [rows[i].age for i in (1, 2, 3, 4)] == [None, None, 44, 31]
    assert [rows[i].registration_date for i in (1, 2, 3, 4)] == [
        dt.date(2024, 1, 5), dt.date(2023, 12, 31), dt.date(2023, 2, 28), dt.date(2024, 1, 5)
    ]
    dim = {r.customer_id: r for r in model.dim_customer(customers).collect()}
    assert [dim[i].nombre_completo for i in (1, 2)] == ["ANA GÓMEZ", "RUIZ"]
    assert [dim[i].phone_masked for i in (1, 2, 3, 4)] == ["****0607", "****12", None, "****"]


def test_product_extract(spark, tmp_path):
    (tmp_path / "products.csv").write_text(PRODUCT_EXTRACT, encoding="utf-8")
    raw = csv.scan_raw(spark, str(tmp_path / "products.csv"))
    assert raw.columns == PRODUCTS.raw_columns
    products = clean.clean_products(raw)
    assert counts(products, "category") == {"ELECTRONICS": 2, "HOME & KITCHEN": 2}
    assert counts(products, "supplier") == {
        "PROVEEDOR A": 1, "PROVEEDOR B": 1, "PROVEEDOR C": 1, UNKNOWN: 1
    }
    assert counts(products, "active") == {True: 2, False: 2}
    rows = {r.product_id: r for r in products.collect()}
    assert [rows[i].price_usd for i in (10, 11, 12, 13)] == [1102.08, 0, 0, 20]
    assert [rows[i].cost_usd for i in (10, 11, 12, 13)] == [670.73, 0, 5, 0]
    assert [rows[i].stock_units for i in (10, 11, 12, 13)] == [3, 0, None, 7]
    dim = {r.product_id: r.margin_pct for r in model.dim_product(products).collect()}
    assert (dim[10], dim[11]) == (0.3914, None)


@shipped
def test_shipped_customers(spark):
    raw = csv.scan_raw(spark, f"{EXTRACTS}/customers.csv")
    assert raw.columns == CUSTOMERS.raw_columns
    assert (raw.count(), raw.dropDuplicates().count()) == (109, 101)
    customers = clean.clean_customers(raw).cache()
    assert customers.count() == 100
    assert counts(customers, "city") == {
        "BARRANQUILLA": 8, "BOGOTA": 21, "CALI": 32, "CARTAGENA": 15, "MEDELLIN": 24
    }
    assert counts(customers, "loyalty_tier") == {"BRONZE": 31, "GOLD": 44, "SILVER": 15, UNKNOWN: 10}
    assert counts(customers, "country") == {"COLOMBIA": 100}
    assert customers.agg(
        F.count("age"), F.sum("age"), F.min("age"), F.max("age")
    ).first() == (27, 947, 20, 65)
    assert customers.agg(
        F.count("registration_date"), F.min("registration_date"), F.max("registration_date"),
        F.count("phone"), F.count("first_name"), F.count("email"),
    ).first() == (100, dt.date(2023, 1, 12), dt.date(2024, 6, 19), 95, 97, 100)

    dim = {r.customer_id: r for r in model.dim_customer(customers).collect()}
    assert dim[1073].nombre_completo == "ANDREA HERNÁNDEZ"
    assert dim[1073].phone_masked == "****0607"
    assert dim[1073].email_hash == (
        "f0547cf1eaf95e8c45c391a06b8307d80b06819087af982fceaca442192b407b"
    )
    assert (dim[1038].nombre_completo, dim[1038].phone_masked) == ("HERNÁNDEZ", "****2319")
    assert dim[1076].phone_masked is None
    assert dim[1093].nombre_completo == "VALENTINA PÉREZ"
    assert dim[1088].nombre_completo == "ANDREA MORALES"


@shipped
def test_shipped_products(spark):
    raw = csv.scan_raw(spark, f"{EXTRACTS}/products.csv")
    assert raw.columns == PRODUCTS.raw_columns
    products = clean.clean_products(raw).cache()
    assert (raw.count(), products.count()) == (47, 43)
    assert counts(products, "category") == {
        "BEAUTY": 5, "BOOKS": 6, "CLOTHING": 7, "ELECTRONICS": 8, "HOME & KITCHEN": 6,
        "SPORTS": 6, "TOYS": 5,
    }
    assert counts(products, "supplier") == {
        "PROVEEDOR A": 18, "PROVEEDOR B": 5, "PROVEEDOR C": 10, UNKNOWN: 10
    }
    assert counts(products, "active") == {True: 22, False: 21}
    sums = products.agg(F.sum("stock_units"), F.sum("price_usd"), F.sum("cost_usd")).first()
    assert (sums[0], round(sums[1], 2), round(sums[2], 2)) == (5319, 29715.09, 14868.08)
    assert products.agg(
        F.count_if(F.col("price_usd") == 0), F.count_if(F.col("cost_usd") == 0),
        F.count_if(F.col("stock_units") == 0),
    ).first() == (2, 2, 23)
    dim = model.dim_product(products)
    total, known = dim.agg(F.sum("margin_usd"), F.count("margin_pct")).first()
    assert (round(total, 2), known) == (14847.01, 41)


@pytest.fixture(scope="module")
def star(spark):
    orders = spark.createDataFrame(
        [
            (1, 1, 10, 2, 5.0, 10.0, dt.date(2024, 3, 31), None, "COMPLETED", "CASH", 10.0, None),
            (2, 1, 10, 1, 5.0, 5.0, dt.date(2024, 4, 1), None, "COMPLETED", "CASH", None, None),
            (3, 2, 11, 1, 7.0, 7.0, dt.date(2024, 6, 30), None, "PENDING", "CASH", 0.0, None),
            (4, 2, 99, 3, 1.0, 3.0, dt.date(2024, 5, 2), None, "COMPLETED", "CASH", 50.0, None),
            (5, 3, 10, 1, 5.0, 5.0, dt.date(2024, 5, 3), None, "COMPLETED", "CASH", 0.0, None),
            (6, 9, 10, 1, 5.0, 5.0, None, None, "COMPLETED", "CASH", 0.0, None),
        ],
        clean_schema(ORDERS),
    )
    products = spark.createDataFrame(
        [(10, "P10", "TOYS", 5.0, 2.0, 1, "S", True), (11, "P11", "BOOKS", 0.0, 3.0, 1, "S", True)],
        clean_schema(PRODUCTS),
    )
    customers = spark.createDataFrame(
        [(i, f"N{i}", None, None, None, "C", "COLOMBIA", None, None, "GOLD") for i in (1, 2, 3)],
        clean_schema(CUSTOMERS),
    )
    return model.fact_sales(orders, products), model.dim_product(products), model.dim_customer(customers)


def clean_schema(spec):
    return type(spec.stage)([f for f in spec.stage if f.name != spec.stamp])


def test_fact_measures(star):
    fact = {r.order_id: r for r in star[0].collect()}
    first = fact[1]
    assert (first.gross_amount_usd, first.discount_amount_usd, first.net_amount_usd) == (10, 1, 9)
    assert (first.unit_cost_usd, first.cost_total_usd, first.profit_usd) == (2, 4, 5)
    assert (first.anio, first.mes, first.mes_fecha) == (2024, 3, dt.date(2024, 3, 1))
    assert (fact[2].net_amount_usd, fact[2].discount_amount_usd) == (5, 0)
    assert (fact[4].product_category, fact[4].profit_usd, fact[4].net_amount_usd) == (None, None, 1.5)
    assert fact[6].mes_fecha is None


def test_questions(star):
    fact, products, customers = star
    # The last quarter starts in April, so order 1 is out; customer 9 is unknown.
    assert [tuple(r) for r in questions.top_customers(fact, customers).collect()] == [
        (2, "N2", 2), (1, "N1", 1), (3, "N3", 1)
    ]
    assert [tuple(r) for r in questions.monthly_revenue(fact).collect()] == [
        (2024, 3, "TOYS", 9.0), (2024, 4, "TOYS", 5.0), (2024, 5, "TOYS", 5.0), (2024, 5, None, 1.5)
    ]
    assert [tuple(r) for r in questions.top_products(fact, products, 2).collect()] == [
        (10, "P10", 24.0), (11, "P11", 7.0)
    ]
    assert [tuple(r) for r in questions.monthly_sales(fact).collect()] == [
        (dt.date(2024, 3, 1), 9.0, 1), (dt.date(2024, 4, 1), 5.0, 1),
        (dt.date(2024, 5, 1), 6.5, 2), (dt.date(2024, 6, 1), 7.0, 1), (None, 5.0, 1),
    ]
    assert [tuple(r) for r in questions.status_share(fact).collect()] == [
        ("COMPLETED", 5, 83.3333), ("PENDING", 1, 16.6667)
    ]


def test_outliers(spark):
    values = [10.0] * 50 + [500.0, None]
    fact = spark.createDataFrame(
        [(i, i, v) for i, v in enumerate(values)],
        "order_id bigint, customer_id bigint, gross_amount_usd double",
    )
    assert [tuple(r) for r in questions.outliers(fact).collect()] == [(50, 50, 500.0, 7.0014)]
    assert questions.outliers(fact.filter("gross_amount_usd = 10")).count() == 0
    assert questions.outliers(fact.limit(1)).count() == 0


def test_report_keeps_every_sale(spark, star, request):
    fact, products, customers = star
    report = model.report_view(fact, products, customers).cache()
    assert report.count() == 6
    named = {r.order_id: (r.product_name, r.nombre_completo, r.city) for r in report.collect()}
    assert named[1] == ("P10", "N1", "C")
    assert named[4] == (None, "N2", "C")
    assert named[6] == ("P10", None, None)
    request.getfixturevalue("no_broadcast")
    shuffled = model.report_view(fact, products, customers)
    assert shuffled.exceptAll(report).count() == 0 and shuffled.count() == 6


@benchmark
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_stay_on_the_jvm_and_distributed(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                     "ArrowEvalPython", "MapInPandas", "RDDScan"):
        assert unwanted not in plan
    # A window over a whole table would run in one task.
    assert "Window [row_number() windowspecdefinition(_" not in plan


@benchmark
def test_plans_read_only_what_they_use(spark):
    def plan(name):
        return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()

    q2 = plan("q2_monthly_revenue")
    assert "c_name" not in q2 and "l_suppkey" not in q2 and "l_tax" not in q2
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in plan("q3_outliers")
    assert "PushedFilters: [IsNotNull(value)]" in plan("q3_outliers")


@benchmark
def test_flagship_returns_rows(spark):
    result = driver.entry(spark)
    assert result.columns == ["anio", "mes", "categoria", "revenue_total"]
    assert result.count() > 0


@benchmark
@pytest.mark.parametrize("name", ["clean_orders", "dq_checks", "revenue_from_raw", "report_view"])
def test_shuffled_plans_scan_a_table_once_per_use(spark, no_broadcast, name):
    def scans():
        return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString().count("Scan parquet")

    without = scans()
    for setting in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(setting)
    assert without == scans()


@benchmark
def test_dedup_limits_keys_before_its_exchange(spark):
    plan = QUERIES["dedup_first"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Partial" in plan.split("Exchange hashpartitioning")[1]


def test_deployed_view_and_report_are_one_plan(spark, star):
    fact, products, customers = star
    for name, df in (("v_fact", fact), ("v_products", products), ("v_customers", customers)):
        df.createOrReplaceTempView(name)
    deployed = spark.sql(model.report_view_sql("v_fact", "v_products", "v_customers"))
    report = model.report_view(fact, products, customers)
    # Sales of unknown products and customers are among them.
    assert deployed.exceptAll(report).count() == 0 and report.exceptAll(deployed).count() == 0
    assert report.filter("product_name IS NULL").count() == 1
    assert report.filter("nombre_completo IS NULL").count() == 1


def test_cleaning_compiles_by_operator_in_any_session(spark):
    """Also in a session built without `configure`; a lower limit of the caller's stays."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    raw = spark.createDataFrame([], CUSTOMERS.raw)
    try:
        for before, after in (("65535", "8000"), ("4000", "4000")):
            spark.conf.set(limit, before)
            clean.clean_customers(raw)
            assert spark.conf.get(limit) == after
    finally:
        spark.conf.unset(limit)


def test_lines_are_dealt_out_by_how_many_they_are(spark, tmp_path, monkeypatch):
    """What a task joins does not grow with the table, and the rows stay the same."""
    orders = spark.range(40).selectExpr("if(id = 7, null, id) AS o_orderkey", "id % 5 AS o_custkey")
    lines = spark.range(200).selectExpr("if(id % 11 = 0, null, id % 45) AS l_orderkey", "id AS l_partkey")
    orders.union(orders.limit(3)).write.parquet(f"{tmp_path}/orders.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    sql = "SELECT l_orderkey, l_partkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
    few = sorted(map(tuple, tables.derive(spark, str(tmp_path), sql).collect()))
    monkeypatch.setattr(tables, "_MANY_LINES", 100)
    monkeypatch.setattr(tables, "_LINES_A_TASK", 20)
    many = tables.derive(spark, str(tmp_path), sql)
    assert sorted(map(tuple, many.collect())) == few and few
    dealt = [tables.table(spark, str(tmp_path), name) for name in ("lineitem", "orders")]
    assert [df.rdd.getNumPartitions() for df in tables.lines_and_orders(*dealt)] == [10, 10]


def test_many_sales_are_shuffled_once_for_their_report(spark, tmp_path, monkeypatch, no_broadcast):
    """Many lines look up products and customers where they lie, with the rows of the usual plan."""
    made = {
        "orders": spark.range(400).selectExpr(
            "id AS o_orderkey", "if(id % 9 = 0, null, id % 50) AS o_custkey",
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id) AS o_orderdate",
            "if(id % 2 = 0, 'F', 'O') AS o_orderstatus",
        ),
        "lineitem": spark.range(2000).selectExpr(
            "id % 410 AS l_orderkey", "if(id % 7 = 0, null, id % 30) AS l_partkey",
            "double(1 + id % 5) AS l_quantity", "double(id) AS l_extendedprice", "0.05D AS l_discount",
            "timestamp_ntz'2024-06-01 00:00:00' AS l_shipdate", "if(id % 3 = 0, 'R', 'N') AS l_returnflag",
            "int(1 + id % 7) AS l_linenumber", "id % 4 AS l_suppkey",
        ),
        "part": spark.range(25).selectExpr(
            "id AS p_partkey", "concat('part ', id) AS p_name", "concat('TYPE ', id % 3) AS p_type",
            "double(id) AS p_retailprice", "int(id % 20) AS p_size", "'B' AS p_brand",
        ),
        "customer": spark.range(40).selectExpr(
            "id AS c_custkey", "concat('Name ', id) AS c_name", "int(id % 5) AS c_nationkey",
            "'BUILDING' AS c_mktsegment",
        ),
    }
    made["part"] = made["part"].union(made["part"].filter("p_partkey = 3"))
    for name, rows in made.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")

    def exchanges(report):
        return report._jdf.queryExecution().executedPlan().toString().count(" Exchange ")

    usual = QUERIES["report_view"](spark, str(tmp_path))
    assert exchanges(usual) == 7
    monkeypatch.setattr(tables, "_MANY_LINES", 100)
    monkeypatch.setattr(tables, "_SIDE", 3)
    dealt = QUERIES["report_view"](spark, str(tmp_path))
    # Lines, orders, the sales, the product's cost and name, the customer.
    assert exchanges(dealt) == 6
    assert dealt.schema == usual.schema
    assert dealt.count() == usual.count() > 1900
    assert dealt.exceptAll(usual).count() == 0 and usual.exceptAll(dealt).count() == 0
    # Parents of too many rows are not copied, nor those that are broadcast.
    monkeypatch.setattr(tables, "_SIDE", 40)
    assert exchanges(QUERIES["report_view"](spark, str(tmp_path))) == 7
    monkeypatch.setattr(tables, "_SIDE", 3)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_cell" not in QUERIES["report_view"](spark, str(tmp_path))._jdf.queryExecution().toString()
