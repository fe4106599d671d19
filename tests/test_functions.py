"""Column functions against the edge cases of the business rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sedimenta.functions import dates, numbers, text
from sedimenta.functions.text import UNKNOWN, WHITESPACE

DAY = dt.date(2024, 1, 5)


def evaluate(spark, function, inputs, kind="string"):
    rows = list(enumerate(inputs))
    df = spark.createDataFrame([(i, v) for i, v in rows], f"i int, v {kind}")
    result = df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
    return [row.r for row in result]


CASES = {
    "parse_date": (
        dates.parse_date,
        {
            "2024.01.05": DAY, "2024/01/05": DAY, " 2024-01-05 ": DAY, "2024-1-5": DAY,
            "2024-01.5": DAY, "2024/13/01": None, "20240105": None, "2024-01-05 10:00": None,
            "24-01-05": None, "2023-02-29": None, "2024-001-05": None, "2024-01-05\n": DAY,
            "2024-01-05T": None, "-2024-01-05": None, "bad": None, "": None, None: None,
        },
    ),
    "to_integer": (
        numbers.to_integer,
        {
            " 12 ": 12, "1e3": 1000, "+5": 5, "-7": -7, "12.0": 12, "12.": 12, "0x1F": None,
            "1_000": None, "1,000": None, "": None, "nan": None, "12.5": None, "inf": None,
            "Infinity": None, "12L": None, "\t12\n": 12, "12\u3000": None, "1e40": None, ".0": 0,
            "9007199254740993": 9007199254740993, "9223372036854775807": 2**63 - 1,
            "9223372036854775808": None, None: None,
        },
    ),
    "to_number": (
        numbers.to_number,
        {
            ".5": 0.5, "5.": 5.0, "-1424.71": -1424.71, "1e3": 1000.0, "12f": None, "1d": None,
            "1e400": None, "TRUE": None, "NaN": None, "Infinity": None, "": None, ".": None,
            "\t7\n": 7.0, None: None,
        },
    ),
    "supplier": (
        text.canonical_supplier,
        {
            "proveedor_a": "PROVEEDOR A", "Proveedor C ": "PROVEEDOR C",
            "ProveedorB": "PROVEEDOR B", "Proveedor": "PROVEEDOR R", "x9": UNKNOWN,
            "": UNKNOWN, "b \n": "PROVEEDOR B", "ñ": UNKNOWN, None: UNKNOWN,
        },
    ),
    "active": (
        text.to_boolean,
        {
            "1": True, "True": True, "t ": True, "si": True, "yes": True, "0": False,
            "SÍ": False, "2": False, "": False, None: False,
        },
    ),
    "payment": (
        lambda c: text.in_domain(text.payment_code(c), text.PAYMENTS),
        {
            "Credit Card": "CREDIT_CARD", " cash ": "CASH", "PayPal": "PAYPAL",
            "credit  card": UNKNOWN, "debit-card": UNKNOWN, None: UNKNOWN,
        },
    ),
    "tier": (
        lambda c: text.in_domain(text.upper_text(c), text.TIERS),
        {"Gold": "GOLD", " bronze": "BRONZE", "platinum": UNKNOWN, None: UNKNOWN},
    ),
    "phone": (
        text.mask_phone,
        {"+57 3147960607": "****0607", "12": "****12", "n/a-": "****", None: None},
    ),
    "email": (
        text.email_token,
        {
            " Andrea.Hernandez76@gmail.com ":
                "f0547cf1eaf95e8c45c391a06b8307d80b06819087af982fceaca442192b407b",
            None: None,
        },
    ),
    "upper": (
        text.upper_text,
        {" hernández ": "HERNÁNDEZ", "straße": "STRASSE", "": "", None: None},
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_text_rules(spark, name):
    function, cases = CASES[name]
    assert evaluate(spark, function, cases) == list(cases.values())


def test_trim_strips_every_kind_of_white_space(spark):
    inputs = [f"{c}a{c}b{c}" for c in WHITESPACE] + ["​a​", "  ", ""]
    assert evaluate(spark, text.trim_text, inputs) == [s.strip() for s in inputs]


def test_rounding_modes(spark):
    halves = [0.5, 1.5, 2.5, -0.5, None]
    # A missing quantity falls back to the total over a price of one.
    one = F.lit(1.0)
    repaired = evaluate(
        spark, lambda c: numbers.repair_quantity(F.lit(None).cast("double"), c, one), halves,
        "double",
    )
    assert repaired == [0, 2, 2, 0, None]
    assert evaluate(spark, numbers.cents, [0.125, 0.285, 0.575, 2.0], "double") == [
        0.12, 0.28, 0.57, 2.0
    ]
    noisy = 123.45 * (1 - 0.1)  # 111.105 with binary noise
    assert evaluate(
        spark, numbers.money, [noisy, 2.675, -2.675, 1e20, 1e300, None], "double"
    ) == [111.11, 2.68, -2.68, 1e20, 1e300, None]
    assert evaluate(spark, numbers.fraction, [0.39135, 1102.08], "double") == [0.3914, 1102.08]


def test_guards(spark):
    assert evaluate(spark, lambda c: numbers.in_range(c, 0, 120),
                    [-5.0, 0.0, 120.0, 200.0, None], "double") == [None, 0.0, 120.0, None, None]
    assert evaluate(spark, numbers.positive_or_zero,
                    [-1.0, 0.0, 3.5, float("nan"), None], "double") == [0.0, 0.0, 3.5, 0.0, 0.0]
    # Text `-0` is 0, not -0.0.
    zeros = evaluate(spark, lambda c: numbers.cents(numbers.positive_or_zero(c)), [-0.0, 0.0], "double")
    assert [str(z) for z in zeros] == ["0.0", "0.0"]
    assert evaluate(spark, numbers.whole,
                    [3.0, 3.5, float("inf"), 1e30, None], "double") == [3, None, None, None, None]


def test_quantity_is_repaired_only_when_invalid(spark):
    rows = [(2.0, 10.0, 5.0), (-3.0, 10.0, 4.0), (None, 14.0, 4.0), (0.0, 9.0, 0.0),
            (0.0, None, 1.0), (0.0, -4.0, 2.0)]
    df = spark.createDataFrame(rows, "q double, t double, p double").coalesce(1)
    got = df.select(numbers.repair_quantity(F.col("q"), F.col("t"), F.col("p")).alias("r"))
    assert [r.r for r in got.collect()] == [2, 2, 4, None, None, -2]


def test_date_order_and_parts(spark):
    rows = [(DAY, dt.date(2024, 1, 4)), (DAY, DAY), (None, DAY), (DAY, None)]
    df = spark.createDataFrame(rows, "o date, s date").coalesce(1)
    got = df.select(dates.not_before(F.col("s"), F.col("o")).alias("r")).collect()
    assert [r.r for r in got] == [None, DAY, DAY, None]
    parts = spark.createDataFrame([(dt.date(2024, 5, 17),)], "d date").select(
        dates.year_number(F.col("d")), dates.month_number(F.col("d")),
        dates.month_start(F.col("d")), dates.quarter_start(F.col("d")),
    )
    assert tuple(parts.first()) == (2024, 5, dt.date(2024, 5, 1), dt.date(2024, 4, 1))
    assert [f.dataType.simpleString() for f in parts.schema] == ["bigint", "bigint", "date", "date"]


def test_names_margins_and_scores(spark):
    names = spark.createDataFrame(
        [("A", "B"), (None, "B"), ("A", None), (None, None)], "f string, l string"
    ).coalesce(1)
    got = names.select(text.full_name(F.col("f"), F.col("l")).alias("n")).collect()
    assert [r.n for r in got] == ["A B", "B", "A", ""]
    prices = spark.createDataFrame([(0.0, 1.0), (1102.08, 670.73)], "p double, c double").coalesce(1)
    got = prices.select(
        numbers.margin(F.col("p"), F.col("c")), numbers.margin_share(F.col("p"), F.col("c"))
    ).collect()
    assert [tuple(r) for r in got] == [(-1.0, None), (431.35, 0.3914)]
    flat = spark.createDataFrame([(5.0, 5.0, 0.0)], "v double, m double, s double")
    assert flat.select(numbers.z_score(F.col("v"), F.col("m"), F.col("s"))).first()[0] is None


def test_rounding_is_one_form_at_every_magnitude(spark):
    values = [4503599627370495.5, 1e12 + 0.125, 1e13 + 0.375, 2e18, -1e25]
    assert evaluate(spark, numbers.money, values, "double") == [
        4503599627370495.5, 1e12 + 0.13, 1e13 + 0.38, 2e18, -1e25
    ]
    assert evaluate(spark, numbers.fraction, [1e11 + 0.00005, 12345678901.23456], "double") == [
        100000000000.0001, 12345678901.2346
    ]


def test_sum_of_money_is_exact_and_loses_nothing(spark):
    def total(values):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
        return df.agg(numbers.money_sum(F.col("v"))).first()[0]

    assert total([0.1] * 1000 + [None]) == 100.0
    assert total([1e30, 2.5]) == 1e30
    assert total([1e30]) == 1e30
    assert total([1e18, 0.25, -1e18]) == 0.25
    assert total([2e18] * 5 + [0.01, -1e19]) == 0.01
    assert total([None]) is None
    assert total([9e35] * 1000 + [-9e35] * 999 + [0.25, -9e35]) == 0.25
    assert total([9e35] * 1000) == 9e38  # beyond 38 digits
    assert total([-3e20, 0.01, 3e20]) == 0.01
    assert total([5.0, 1e36, float("nan"), float("-inf")]) == 5.0


def test_amounts_left_out_are_counted(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, None, 9e35, 1e36, -1e300, float("nan"), float("inf")]], "v double")
    assert df.agg(numbers.money_left_out(F.col("v"))).first()[0] == 4
