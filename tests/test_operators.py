"""Row rules, joins, upsert and profiling on small tables written by hand."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedimenta.operators import joins, profile, rows, upsert
from sedimenta.operators.joins import Parent
from sedimenta.schemas import schema


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """Sales of which one customer holds a third and another third has no customer."""
    n = 30_000
    return spark.range(n).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 3 == 1, F.col("id") % 5_000)
        .cast("bigint")
        .alias("customer_id"),
        (F.col("id") % 40).alias("product_id"),
    )


@pytest.fixture(scope="module")
def customers(spark):
    return spark.range(0, 4_000).select(
        F.col("id").alias("customer_id"), F.concat(F.lit("c"), "id").alias("name")
    )


def test_distinct_empty_and_null_keys(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, None), (1, None), (None, None), (None, None), (None, "b")],
        "k int, v string",
    )
    assert as_set(rows.distinct_rows(df)) == [(1, "a"), (1, None), (None, "b"), (None, None)]
    assert rows.drop_empty_rows(df).count() == 5
    assert rows.drop_null_keys(df, ["k"]).count() == 4


def test_keep_first_is_total_and_independent_of_partitioning(spark):
    data = [(1, "b", "x"), (1, "a", "z"), (1, "a", "y"), (1, "a", "y"), (2, None, "n"),
            (2, "q", None), (3, None, None)]
    expected = [(1, "a", "y"), (2, "q", None), (3, None, None)]
    for parts in (1, 13):
        df = spark.createDataFrame(data, "k int, o string, v string").repartition(parts)
        assert as_set(rows.keep_first(df, ["k"])) == expected
    latest = rows.keep_first(df, ["k"], [F.col("v").desc_nulls_last()])
    assert as_set(latest) == [(1, "a", "z"), (2, None, "n"), (3, None, None)]


def test_keep_first_limits_keys_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    plan = rows.keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange")[1]
    assert plan.count("WindowGroupLimit") >= 2


def test_conform_orders_drops_and_fills(spark):
    df = spark.createDataFrame([(1.5, 2, "x")], "b double, a bigint, extra string")
    wanted = schema(a="bigint", b="double", c="string")
    result = rows.conform(df, wanted)
    assert result.schema.names == ["a", "b", "c"]
    assert result.first() == (2, 1.5, None)
    with pytest.raises(Exception, match="INVALID_COLUMN_OR_FIELD_DATA_TYPE|incompatible|CANNOT"):
        rows.conform(df, schema(extra="bigint")).collect()


@pytest.fixture
def low_skew_bounds(spark):
    """Skew thresholds for a small table, so what holds a share of it counts as hot."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_hot_and_missing_keys_are_split(spark, skewed, customers, no_broadcast, low_skew_bounds, how):
    # Several map tasks, as only what they wrote apart can be read apart.
    child = skewed.repartition(24)
    joined = joins.lookup(child, customers, ["customer_id"], how)
    rows_of = joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    names = skewed.select("customer_id").distinct().count()
    assert names > 2
    known = {r.customer_id for r in customers.collect()}
    expected = [r for r in skewed.collect()]
    inside = [r for r in expected if r.customer_id in known]
    count = {"left": len(expected), "inner": len(inside), "left_semi": len(inside),
             "left_anti": len(expected) - len(inside)}[how]
    assert len(rows_of) == count


def test_grid_looks_up_two_parents_with_one_shuffle(spark, skewed, no_broadcast):
    """Also for keys that are hot, null, unknown, of another whole type, or repeated in a parent."""
    child = skewed.withColumn("product_id", F.when(F.col("order_id") % 5 > 0, F.col("product_id")))
    child = child.union(spark.sql("SELECT null, null, null UNION ALL SELECT null, 7, 3"))
    customers = spark.range(4_000).selectExpr("id AS customer_id", "concat('C', id) AS customer")
    customers = customers.union(spark.sql("SELECT null, 'none' UNION ALL SELECT 8, 'again'"))
    products = spark.range(30).selectExpr("int(id) AS product_id", "concat('P', id) AS product")
    products = products.union(products.filter("product_id = 5"))
    plain = joins.lookup(joins.lookup(child, products, ["product_id"]), customers, ["customer_id"])

    grid = joins.Grid(("product_id", "customer_id"), 3)
    dealt = grid.deal(child, "order_id")
    found = joins.lookup(dealt, grid.copies(products, "product_id"), ["product_id", joins.CELL])
    found = joins.lookup(found, grid.copies(customers, "customer_id"), ["customer_id", joins.CELL])
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    rows_of = found.select(*plain.columns)
    assert rows_of.count() == plain.count() > child.count()
    assert rows_of.exceptAll(plain).count() == 0 and plain.exceptAll(rows_of).count() == 0
    # A third of the rows has no customer, a third the same one; a fifth has no product.
    sizes = [r["count"] for r in dealt.groupBy(joins.CELL).count().collect()]
    assert len(sizes) == 9 and max(sizes) < 2 * child.count() / 9


def test_small_parents_are_broadcast(spark, skewed, customers):
    plan = joins.lookup(skewed, customers, ["customer_id"])
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("broadcast", [True, False])
def test_integrity(spark, request, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    orders = spark.createDataFrame(
        [(100, 1, 10), (104, 9, 10), (105, 1, 99), (106, 9, 99), (107, None, 10), (108, None, None)],
        "order_id bigint, customer_id bigint, product_id bigint",
    )
    customers = Parent(spark.createDataFrame([(1,), (2,), (1,)], "id bigint"), "id", "customer_id")
    products = Parent(spark.createDataFrame([(10,), (11,), (None,)], "id bigint"), "id", "product_id")
    assert as_set(joins.referential_filter(orders, [customers, products])) == [(100, 1, 10)]
    report = joins.orphan_report(orders, customers, products)
    assert {r.order_id: r.motivo for r in report.collect()} == {
        104: joins.NO_CUSTOMER, 105: joins.NO_PRODUCT, 106: joins.NO_PARENTS,
        107: joins.NO_CUSTOMER, 108: joins.NO_PARENTS,
    }
    assert as_set(joins.orphan_summary(report)) == [
        (joins.NO_CUSTOMER, 2), (joins.NO_PARENTS, 2), (joins.NO_PRODUCT, 1)
    ]
    assert joins.orphans(orders, products).count() == 3


def test_merge_updates_inserts_and_keeps(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([("B", 2), (None, 3)], "v string, k int")
    merged = upsert.merge_rows(target, batch, "k")
    assert merged.columns == ["k", "v"]
    assert as_set(merged) == [(1, "a"), (2, "B"), (3, None)]
    assert as_set(upsert.merge_rows(merged, batch, "k")) == as_set(merged)


def test_merge_refuses_repeated_keys(spark):
    with pytest.raises(ValueError, match="repeated k"):
        upsert.require_unique(spark.createDataFrame([(1,), (1,)], "k int"), "k")


def test_native_merge_is_left_to_tables_that_accept_it(spark):
    spark.createDataFrame([(1, "a")], "k int, v string").write.mode("overwrite").saveAsTable("plain")
    batch = spark.createDataFrame([(1, "b")], "k int, v string")
    with pytest.raises(Exception, match="MERGE"):
        upsert.merge_native("plain", batch, "k")


@pytest.fixture(scope="module")
def messy(spark):
    return spark.createDataFrame(
        [("1", "Gold", "5"), ("1", "Gold", "5"), ("2", None, "-1"), ("2", "GOLD", "x"),
         ("2", "gold", "7.5"), (None, None, None)],
        "id string, tier string, price string",
    )


def test_profiles(spark, messy):
    nulls = {(r.metric, r.column_name): r.value for r in profile.profile_nulls(messy).collect()}
    assert nulls == {
        ("rows", "*"): 6, ("columns", "*"): 3, ("all_null_rows", "*"): 1,
        ("nulls", "id"): 1, ("nulls", "tier"): 2, ("nulls", "price"): 1,
    }
    assert profile.profile_row_dups(messy).first() == (6, 5, 1)
    assert [tuple(r) for r in profile.duplicate_keys(messy, "id").collect()] == [("2", 3), ("1", 2)]
    assert [tuple(r) for r in profile.profile_domain(messy, ["tier"]).collect()] == [
        ("tier", "GOLD", 1), ("tier", "Gold", 2), ("tier", "gold", 1), ("tier", None, 2)
    ]
    numbers = profile.profile_numeric_domain(messy, ["price"])
    assert [r.value for r in numbers.collect()] == [-1.0, 5.0, 7.5]
    assert profile.profile_range(messy, ["price"]).first() == ("price", -1.0, 7.5, 4, 3)
    assert [r.tier for r in rows.sample_values(messy, "tier", 2).collect()] == ["GOLD", "Gold"]


def test_profiles_of_an_empty_table(spark, messy):
    empty = messy.limit(0)
    assert {r.value for r in profile.profile_nulls(empty).collect()} == {0, 3}
    assert profile.profile_row_dups(empty).first() == (0, 0, 0)
    assert as_set(profile.load_metrics(empty, F.col("id"))) == [
        ("distinct_keys", 0), ("keyed", 0), ("read", 0)
    ]


def test_checks_and_metrics(spark, messy):
    typed = messy.withColumn("price", F.col("price").try_cast("double"))
    rules = {"price_not_positive": F.col("price") <= 0, "tier_missing": F.col("tier").isNull()}
    parent = Parent(spark.createDataFrame([("1",)], "id string"), "id", "id")
    checks = profile.dq_checks(typed, "id", rules, {"no_parent": parent})
    assert {r.check_name: r.violations for r in checks.collect()} == {
        "price_not_positive": 1, "tier_missing": 2, "repeated_key": 3, "no_parent": 4
    }
    listed = profile.list_violations(typed, rules)
    assert as_set(listed.select("id", "check_name")) == [
        ("2", "price_not_positive"), ("2", "tier_missing"), (None, "tier_missing")
    ]
    metrics = profile.load_metrics(messy, F.col("id"), messy.limit(2))
    assert {r.step: r.total_rows for r in metrics.collect()} == {
        "read": 6, "keyed": 5, "distinct_keys": 2, "kept": 2
    }


def test_schema_helper_is_nullable():
    built = schema(a="bigint")
    assert isinstance(built, StructType) and built["a"].nullable


def test_checks_scan_the_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 5), (1, -5), (None, -1), (None, 2)], "k int, v int").write.parquet(path)
    found = profile.dq_checks(spark.read.parquet(path), "k", {"negative": F.col("v") < 0}, {})
    assert {tuple(r) for r in found.collect()} == {("negative", 2), ("repeated_key", 1)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    none = profile.dq_checks(spark.read.parquet(path).limit(0), "k", {"negative": F.col("v") < 0}, {})
    assert {tuple(r) for r in none.collect()} == {("negative", 0), ("repeated_key", 0)}
