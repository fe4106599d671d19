"""Text files to star schema in a scratch warehouse: archive, replace, merge, re-run."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sedimenta.plans import clean, questions, refresh
from sedimenta.schemas import CUSTOMERS, DIM_CUSTOMER, FACT_SALES, ORDERS, PRODUCTS, REPORT_VIEW
from sedimenta.sources import csv, tables

CUSTOMER_LINES = [
    ",".join(CUSTOMERS.raw_columns),
    '1,Ana,"Gómez, Ruiz",ana@x.co,+57 300 123 4567,Cali,CO,30,2024/01/05,Gold',
    '1,Ana,"Gómez, Ruiz",ana@x.co,+57 300 123 4567,Cali,CO,30,2023.01.05,Gold',
    "2,Luis,NA,luis@x.co,,Bogota,Col.,200,2024-02-01,",
    ",,,,,,,,,",
]
PRODUCT_LINES = [
    ",".join(PRODUCTS.raw_columns),
    "10,Tablero,toys,5.0,2.0,3,proveedor_a,1",
    '11,"Libro ""Uno""",Books,0,null,,ProveedorB,FALSE',
]
ORDER_LINES = [
    ",".join(ORDERS.raw_columns),
    "100,1,10,2,5.0,10.0,2024-01-05,2024/01/07,completed,credit card,10,0042",
    "100,1,10,2,5.0,10.0,2024-01-05,2024/01/07,completed,credit card,10,0042",
    "101,2,11,-3,4.0,10.0,2024.02.01,2024.01.01,Shipped,Bitcoin,,",
    "102,9,10,1,5.0,5.0,2024-02-01,,pending,cash,,",
    "103,2,10,1,5.0,5.0,,,pending,cash,,",
]


def write(folder, name, lines):
    (folder / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.fixture
def extracts(tmp_path):
    write(tmp_path, "customers", CUSTOMER_LINES)
    write(tmp_path, "products", PRODUCT_LINES)
    write(tmp_path, "orders", ORDER_LINES)
    return tmp_path


def layers(tag):
    return refresh.Layers(f"raw_{tag}", f"stage_{tag}", f"analytics_{tag}")


def body(df, *without):
    return sorted((tuple(r) for r in df.drop(*without).collect()), key=str)


def test_scan_is_text_with_missing_as_null(spark, extracts):
    raw = csv.scan_raw(spark, str(extracts / "customers.csv"))
    assert {f.dataType.simpleString() for f in raw.schema} == {"string"}
    rows = {(r.customer_id, r.registration_date): r for r in raw.collect()}
    assert len(rows) == 4
    assert rows["1", "2024/01/05"].last_name == "Gómez, Ruiz"
    luis = rows["2", "2024-02-01"]
    assert (luis.last_name, luis.phone, luis.loyalty_tier) == (None, None, None)
    assert rows[None, None] == (None,) * 10
    products = {r.product_id: r for r in csv.scan_raw(spark, str(extracts / "products.csv")).collect()}
    assert (products["11"].product_name, products["11"].cost_usd) == ('Libro "Uno"', None)


@pytest.mark.parametrize("token", csv.NULL_TOKENS)
def test_missing_tokens(spark, tmp_path, token):
    (tmp_path / "t.csv").write_text(f'a,b\n{token},x\n"{token}",y\n {token}.,z\n', encoding="utf-8")
    rows = csv.scan_raw(spark, str(tmp_path / "t.csv")).collect()
    assert {r.b: r.a for r in rows} == {"x": None, "y": None, "z": f" {token}."}


def test_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv.scan_raw(spark, str(tmp_path)).collect()


def lines_of(folder):
    parts = sorted(p for p in Path(folder).iterdir() if p.name.startswith("part-"))
    return b"".join(p.read_bytes() for p in parts).decode("utf-8")


def test_archive_keeps_every_load_as_it_arrived(spark, extracts, tmp_path):
    landing = str(tmp_path / "landing")
    path = extracts / "customers.csv"
    path.write_text(path.read_text(encoding="utf-8") + '3,"a\nb",x\r\n4,1,2,3,4,5,6,7,8,9,10,11\n', encoding="utf-8")
    first = csv.archive(spark, str(path), landing, "customers", "20240101_000000")
    assert first.endswith("customers/ingest_ts=20240101_000000")
    assert lines_of(first) == path.read_bytes().decode("utf-8")
    csv.archive(spark, str(path), landing, "customers", "20240102_000000")
    assert len(list(Path(landing, "customers").iterdir())) == 2
    with pytest.raises(Exception, match="(?i)exist"):
        csv.archive(spark, str(path), landing, "customers", "20240101_000000")


def test_load_stamps_of_one_second_differ():
    assert len({tables.load_stamp() for _ in range(50)}) > 1


def test_line_breaks_in_quotes_are_read_whole(spark, extracts, tmp_path):
    names = layers("breaks")
    landing = tmp_path / "landing"
    write(extracts, "products", [*PRODUCT_LINES, '12,"two\nlines",Books,1,1,1,ProveedorB,TRUE'])
    refresh.refresh(spark, str(extracts), str(landing), names)
    products = {r.product_id: r for r in spark.table(names.raw_table("products")).collect()}
    assert len(products) == 3 and products["12"].product_name == "two\nlines"
    (folder,) = (landing / "products").iterdir()
    assert lines_of(folder) == (extracts / "products.csv").read_bytes().decode("utf-8")


@pytest.mark.parametrize("surplus", ["12,n,Books,1,1,1,ProveedorB,TRUE,more", "12,n,Books,1,1,1,ProveedorB,TRUE,"])
def test_surplus_fields_stop_the_load(spark, extracts, tmp_path, surplus):
    names = layers(f"surplus_{len(surplus)}")
    landing = tmp_path / "landing"
    refresh.refresh(spark, str(extracts), str(landing), names)
    write(extracts, "products", [*PRODUCT_LINES, surplus])
    with pytest.raises(Exception, match="more fields than the header: 12,n"):
        refresh.refresh(spark, str(extracts), str(landing), names)
    assert spark.table(names.raw_table("products")).count() == 2
    # The input is kept all the same.
    newest = sorted((landing / "products").iterdir())[-1]
    assert lines_of(newest) == (extracts / "products.csv").read_bytes().decode("utf-8")


def test_missing_last_fields_are_null(spark, extracts, tmp_path):
    names = layers("short")
    write(extracts, "products", [*PRODUCT_LINES, "12,n,Books"])
    refresh.refresh(spark, str(extracts), str(tmp_path / "landing"), names)
    row = spark.table(names.raw_table("products")).filter("product_id = 12").first()
    assert (row.category, row.price_usd, row.active) == ("Books", None, None)


def bucket_files(spark, name):
    root = Path(tables._root(spark, name).removeprefix("file:"))
    return {p: p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def test_a_merge_leaves_untouched_buckets_as_they_are(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS keyed")
    rows = spark.range(1000).select("id", F.lit("a").alias("v"))
    held, path = tables.hold(rows, "keyed")
    tables.upsert(held, "keyed.t", "id", bucket_rows=40)
    before = bucket_files(spark, "keyed.t")
    assert len(before) == 32
    batch, other = tables.hold(spark.createDataFrame([(7, "b"), (5000, "c")], "id long, v string"), "keyed")
    for _ in range(3):
        merged = tables.upsert(batch, "keyed.t", "id", bucket_rows=60)
        assert merged.count() == 1001
        assert {r.id: r.v for r in merged.filter("v <> 'a'").collect()} == {7: "b", 5000: "c"}
    after = bucket_files(spark, "keyed.t")
    kept = {p for p in before if p in after}
    # At most two buckets were touched, and their first files are gone by now.
    assert len(kept) >= 30 and all(after[p] == before[p] for p in kept)
    assert len(after) <= len(kept) + 2 * 2
    empty, third = tables.hold(batch.limit(0), "keyed")
    assert tables.upsert(empty, "keyed.t", "id").count() == 1001
    for p in (path, other, third):
        tables.release(spark, p)


def test_buckets_grow_in_number_one_by_one(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS growing")
    total = 0
    for step in range(4):
        many = 300 * 4**step
        batch = spark.range(total, total + many).select("id", F.lit(step).alias("v"))
        held, path = tables.hold(batch, "growing")
        merged = tables.upsert(held, "growing.t", "id", bucket_rows=200)
        tables.release(spark, path)
        total += many
        assert (merged.count(), merged.select("id").distinct().count()) == (total, total)
        buckets = tables._buckets(spark, "growing.t")
        assert sum(b.rows for b in buckets) == total
        assert max(b.rows for b in buckets) <= 300  # hashes part a bucket about in half
        assert sum(2.0**-b.depth for b in buckets) == 1.0  # every hash falls into one of them
    # A small batch rewrites a small share of a table that has grown.
    before = bucket_files(spark, "growing.t")
    small, path = tables.hold(spark.range(5).select("id", F.lit(9).alias("v")), "growing")
    merged = tables.upsert(small, "growing.t", "id", bucket_rows=200)
    again = set(bucket_files(spark, "growing.t")) - set(before)
    assert merged.filter("v = 9").count() == 5 and merged.count() == total
    assert len(again) <= 10 < len(before) / 10
    # One bucket alone is parted where its keys alone come.
    deepest = max(b.depth for b in tables._buckets(spark, "growing.t"))
    ids = [r.id for r in spark.range(10**6, 10**6 + 90_000).filter(F.pmod(F.xxhash64("id"), F.lit(1 << 8)) == 3).collect()]
    held, other = tables.hold(spark.createDataFrame([(i, 1) for i in ids], "id long, v int"), "growing")
    count = len(tables._buckets(spark, "growing.t"))
    tables.upsert(held, "growing.t", "id", bucket_rows=200)
    buckets = tables._buckets(spark, "growing.t")
    assert max(b.depth for b in buckets) > deepest and len(buckets) - count < 10
    for p in (path, other):
        tables.release(spark, p)


def test_of_two_loads_at_once_the_later_is_refused(spark, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS racing")
    one, first = tables.hold(spark.createDataFrame([(1, "one")], "id long, v string"), "racing")
    two, second = tables.hold(spark.createDataFrame([(2, "two")], "id long, v string"), "racing")
    tables.ensure_keyed(spark, "racing.t", one.schema)
    point, started = tables._point, []

    def overtaken(*args):
        if not started:
            started.append(True)
            tables.upsert(two, "racing.t", "id")  # another load ends while this one writes
        return point(*args)

    monkeypatch.setattr(tables, "_point", overtaken)
    with pytest.raises(tables.ChangedMeanwhile):
        tables.upsert(one, "racing.t", "id")
    assert [tuple(r) for r in spark.table("racing.t").collect()] == [(2, "two")]
    root = Path(tables._root(spark, "racing.t").removeprefix("file:"))
    assert len([p for p in root.iterdir() if p.is_dir()]) == 1  # nothing of the refused load is left
    assert tables.upsert(one, "racing.t", "id").count() == 2
    for p in (first, second):
        tables.release(spark, p)


def test_long_lists_of_buckets_are_told_in_parts(spark, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS parts")
    monkeypatch.setattr(tables, "_PROPERTY_CHARS", 50)
    held, path = tables.hold(spark.range(500).select("id", F.lit(1).alias("v")), "parts")
    for _ in range(2):
        assert tables.upsert(held, "parts.t", "id", bucket_rows=50).count() == 500
    assert sum(b.rows for b in tables._buckets(spark, "parts.t")) == 500
    tables.release(spark, path)


def test_refresh_end_to_end_and_again(spark, extracts, tmp_path):
    names = layers("e2e")
    landing = str(tmp_path / "landing")
    steps = refresh.refresh(spark, str(extracts), landing, names)
    assert [(s.stage, s.table.split(".")[1], s.rows) for s in steps] == [
        ("raw", "customers_raw", 4), ("raw", "products_raw", 2), ("raw", "orders_raw", 5),
        ("stage", "customers_stage", 2), ("stage", "products_stage", 2), ("stage", "orders_stage", 3),
        ("analytics", "dim_cliente", 2), ("analytics", "dim_producto", 2), ("analytics", "fact_venta", 3),
    ]
    for name, spec in (("customers", CUSTOMERS), ("products", PRODUCTS), ("orders", ORDERS)):
        assert spark.table(names.stage_table(name)).schema == spec.stage
    fact = spark.table(names.model("fact_venta"))
    assert set(fact.columns) == set(FACT_SALES.names)
    assert spark.table(names.model("dim_cliente")).schema == DIM_CUSTOMER
    customers = {r.customer_id: r for r in spark.table(names.stage_table("customers")).collect()}
    assert customers[1].registration_date == dt.date(2023, 1, 5)
    assert customers[2].age is None

    report = spark.table(names.model("vw_reporte_ventas"))
    assert report.schema.names == REPORT_VIEW.names
    assert report.count() == 3
    top = questions.top_customers(fact, spark.table(names.model("dim_cliente")))
    assert [tuple(r) for r in top.collect()] == [(1, "ANA GÓMEZ, RUIZ", 1), (2, "LUIS", 1)]
    metrics = {
        (r.table_name.split(".")[1], r.step): r.total_rows
        for r in refresh.stage_metrics(spark, steps).collect()
    }
    assert metrics["orders_stage", "read"] == 5 and metrics["orders_stage", "distinct_keys"] == 4
    assert metrics["orders_stage", "kept"] == 3 and metrics["orders_stage", "orphans"] == 1
    assert metrics["customers_stage", "keyed"] == 3

    stage_tables = [names.stage_table(n) for n in ("customers", "products", "orders")]
    before = [body(spark.table(t), "stage_updated_at") for t in stage_tables]
    for _ in range(2):
        refresh.refresh(spark, str(extracts), landing, names)
    assert before == [body(spark.table(t), "stage_updated_at") for t in stage_tables]
    # The current version of a table and the one before it; nothing older, nothing held.
    found = [t.name for t in spark.catalog.listTables(names.raw) if t.name.startswith("orders_")]
    assert len(found) == 3
    assert len(bucket_files(spark, names.stage_table("orders"))) <= 2 * 3
    held = tables.shared_folder(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(held)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert len(files.listStatus(path)) == 0


def test_new_extract_updates_inserts_and_never_deletes(spark, extracts, tmp_path):
    names = layers("incremental")
    landing = str(tmp_path / "landing")
    refresh.refresh(spark, str(extracts), landing, names)
    write(extracts, "orders", [
        ORDER_LINES[0],
        "101,2,11,4,4.0,16.0,2024.02.01,2024.02.02,completed,cash,,",
        "104,1,11,1,4.0,4.0,2024.03.01,,returned,paypal,5,",
    ])
    steps = refresh.refresh(spark, str(extracts), landing, names)
    counts = {s.table.split(".")[1]: s.counts for s in steps}["orders_stage"]
    # Of this load alone, though four orders are in the table.
    assert counts == {"read": 2, "keyed": 2, "distinct_keys": 2, "kept": 2, "orphans": 0, "amounts_left_out": 0}
    orders = {r.order_id: r for r in spark.table(names.stage_table("orders")).collect()}
    assert sorted(orders) == [100, 101, 103, 104]
    assert (orders[101].status, orders[101].quantity) == ("COMPLETED", 4)
    assert spark.table(names.raw_table("orders")).count() == 2


def test_a_failing_stage_leaves_the_published_tables(spark, extracts, tmp_path):
    names = layers("failing")
    landing = str(tmp_path / "landing")
    refresh.refresh(spark, str(extracts), landing, names)
    before = body(spark.table(names.raw_table("customers")))
    with pytest.raises(Exception):
        refresh.refresh(spark, str(tmp_path / "missing"), landing, names)
    assert body(spark.table(names.raw_table("customers"))) == before


def test_models_may_be_sql_and_run_in_order(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS models_db")
    steps = refresh.run_models(spark, [
        refresh.Model("models_db.base", lambda s: s.range(5).withColumn("g", F.col("id") % 2)),
        refresh.Model("models_db.counts", "SELECT g, count(*) AS n FROM models_db.base GROUP BY g"),
    ])
    assert [s.rows for s in steps] == [5, 2]
    again = refresh.run_models(spark, [refresh.Model("models_db.base", lambda s: s.range(3))])
    assert again[0].rows == 3


def test_publish_by_partition_splits_and_prunes(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS layout")
    df = spark.range(9000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01"))
        .when(F.col("id") % 3 == 1, F.lit("2024-02-01"))
        .cast("date").alias("mes_fecha"),
    )
    table = tables.publish(df, "layout.sales", ["mes_fecha"])
    assert table.count() == 9000
    plan = table.filter("mes_fecha >= date'2024-02-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mes_fecha" in plan
    assert table.filter("mes_fecha IS NULL").count() == 3000


def test_quarter_question_reads_only_its_months(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS pruned")
    fact = spark.range(400).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 7).alias("customer_id"),
        F.trunc(F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")), "month")
        .alias("mes_fecha"),
    )
    fact = tables.publish(fact, "pruned.fact", ["mes_fecha"])
    customers = spark.range(7).select(
        F.col("id").alias("customer_id"), F.lit("x").alias("nombre_completo")
    )
    question = questions.top_customers(fact, customers)
    plan = question._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan or "PartitionFilters: [isnotnull(mes_fecha" in plan
    # Days 365..399 fall in the last quarter, five for each customer.
    assert [tuple(r) for r in question.collect()] == [(0, "x", 5), (1, "x", 5), (2, "x", 5)]


class Session:
    """Just the settings of a session; the folder is fixed when a real one starts."""

    def __init__(self, **settings):
        self.settings = {key.replace("_", "."): value for key, value in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_shared_folder_is_the_one_the_cluster_names():
    named = Session(spark_checkpoint_dir="hdfs://shared", spark_sql_warehouse_dir="hdfs://lake")
    assert tables.shared_folder(named) == "hdfs://shared/_held"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_folder(Session(spark_sql_warehouse_dir="hdfs://lake"))


def test_a_load_in_progress_survives_a_publish(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS progress")
    spark.range(3).write.saveAsTable("progress.t__vINPROGRESS")
    for n in (1, 2, 3):
        tables.publish(spark.range(n), "progress.t")
    assert spark.table("progress.t__vINPROGRESS").count() == 3
    published = [t.name for t in spark.catalog.listTables("progress") if t.name.startswith("t__v")]
    assert len(published) == 3  # the current one, the one before, and the one in progress


def test_each_batch_is_written_once(spark, extracts, tmp_path, monkeypatch):
    written = []
    hold = refresh.hold
    monkeypatch.setattr(refresh, "hold", lambda df, name: written.append(name) or hold(df, name))
    refresh.refresh(spark, str(extracts), str(tmp_path / "landing"), layers("once"))
    assert written == ["customers", "products", "orders"]


def test_plain_files_do_not_merge_by_themselves(spark):
    spark.range(2).write.mode("overwrite").saveAsTable("plain_files")
    assert not tables.accepts_merge(spark, "plain_files")
    assert not tables.accepts_merge(spark, "no_such_table")


def test_released_results_may_be_gone_already(spark):
    held, path = tables.hold(spark.range(3), "three")
    assert held.count() == 3
    tables.release(spark, path)
    tables.release(spark, path)


def test_unknown_rows_of_orders_do_not_reach_stage(spark, extracts):
    raw = csv.scan_raw(spark, str(extracts / "orders.csv"))
    assert clean.clean_orders(raw).count() == 4


def month_files(spark, name):
    version = tables.current_version(spark, name)
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {version}").filter("col_name = 'Location'").first().data_type
    root = Path(location.removeprefix("file:"))
    return {p.parent.name: (p.name, p.stat().st_mtime_ns) for p in root.rglob("*.parquet")}


def test_a_load_rewrites_only_the_months_it_changes(spark, extracts, tmp_path):
    names = layers("months")
    landing, fact = str(tmp_path / "landing"), names.model("fact_venta")
    header = ORDER_LINES[0]
    orders = [f"{k},1,{10 + k % 2},1,5.0,10.0,2024-{k:02d}-05,,pending,cash,," for k in range(1, 8)]
    write(extracts, "orders", [header, *orders])
    refresh.refresh(spark, str(extracts), landing, names)
    first = month_files(spark, fact)
    assert len(first) == 7

    def whole():  # the fact as a full rebuild would have it
        stage = {n: spark.table(names.stage_table(n)) for n in ("orders", "products")}
        return body(refresh.conform(refresh.model.fact_sales(stage["orders"], stage["products"]), FACT_SALES),
                    "analytics_updated_at")

    # The same rows once more: nothing is written.
    refresh.refresh(spark, str(extracts), landing, names)
    assert month_files(spark, fact) == first
    # One order changes, one moves to another month and empties its own, one loses its date, one is new.
    orders[0] = "1,1,11,3,5.0,15.0,2024-01-05,,pending,cash,,"
    orders[1] = "2,1,10,1,5.0,10.0,2024-03-09,,pending,cash,,"
    orders[3] = "4,1,10,1,5.0,10.0,,,pending,cash,,"
    write(extracts, "orders", [header, *orders, "9,1,10,1,5.0,10.0,2024-09-01,,pending,cash,,"])
    refresh.refresh(spark, str(extracts), landing, names)
    second = month_files(spark, fact)
    same = {m for m in first if second.get(m) == first[m]}
    assert same == {f"mes_fecha=2024-0{k}-01" for k in (5, 6, 7)}
    assert second.keys() - first.keys() == {"mes_fecha=2024-09-01", "mes_fecha=__HIVE_DEFAULT_PARTITION__"}
    assert first.keys() - second.keys() == {"mes_fecha=2024-02-01", "mes_fecha=2024-04-01"}
    assert body(spark.table(fact).select(*FACT_SALES.names), "analytics_updated_at") == whole()
    # A product's cost changes the months it was sold in; a load that failed before the fact is caught up.
    write(extracts, "products", [*PRODUCT_LINES[:2], '11,"Libro ""Uno""",Books,9,4,,ProveedorB,FALSE'])
    sources = {n: f"{extracts}/{f}" for n, f in refresh.FILES.items()}
    refresh.ingest(spark, sources, landing, names)
    refresh.build_stage(spark, names)
    refresh.build_analytics(spark, names)
    third = month_files(spark, fact)
    assert {m for m in second if third[m] != second[m]} == {f"mes_fecha=2024-0{k}-01" for k in (1, 3, 5, 7)}
    assert body(spark.table(fact).select(*FACT_SALES.names), "analytics_updated_at") == whole()
    assert spark.table(names.model("vw_reporte_ventas")).count() == 8
