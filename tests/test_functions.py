from __future__ import annotations

import hashlib
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratastar import functions as fn
from stratastar.functions.keys import NULL_TOKEN


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_flags(spark):
    texts = ["1", "TRUE", " oui ", "Yes", "0", "non", "", None, "a, b"]
    assert column(spark, texts, fn.flag) == [True] * 4 + [False] * 5
    assert column(spark, texts, fn.flag_present) == [True] * 6 + [False, False, True]


def test_decimals(spark):
    texts = ["12.345", " 5 ", "1e3", "", "n/a", "12345678901234567890", None, "-0.005"]
    found = column(spark, texts, fn.to_decimal)
    assert found == [Decimal("12.35"), Decimal("5.00"), Decimal("1000.00"), None, None, None, None, Decimal("-0.01")]


def test_ints(spark):
    assert column(spark, ["12", " 5 ", "1.0", "", "n/a", "99999999999", None], fn.to_int) == [12, 5, None, None, None, None, None]
    assert column(spark, ["12.7", "n/a", None, "-3"], fn.int_or) == [12, 0, 0, -3]


def test_dates(spark):
    texts = ["2025-01-02", "2025-01-02 08:00:03", "2025-13-02", "", None]
    assert column(spark, texts, fn.to_date) == [date(2025, 1, 2)] * 2 + [None] * 3
    assert column(spark, texts, fn.to_timestamp)[:3] == [datetime(2025, 1, 2), datetime(2025, 1, 2, 8, 0, 3), None]
    assert column(spark, texts, lambda c: fn.date_key(fn.to_date(c))) == [20250102, 20250102, None, None, None]


def test_names_keep_the_blank(spark):
    df = spark.createDataFrame([(None, "X"), ("Y", None), (None, None), ("A", "B")], "a string, b string")
    assert [r[0] for r in df.select(fn.full_name("a", "b")).collect()] == [" X", "Y ", " ", "A B"]


def test_month_start(spark):
    df = spark.createDataFrame([(2025, 1), (2025, 13), (None, 5), (2025, None)], "y int, m int")
    assert [r[0] for r in df.select(fn.month_start("y", "m")).collect()] == [date(2025, 1, 1), None, None, None]


def test_surrogate_keys(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    row = df.select(
        fn.surrogate_key("x"), fn.surrogate_key("x", "y"), fn.unknown_key(), fn.unknown_key("VENTE"), fn.surrogate_key("x", algorithm="md5")
    ).first()
    texts = ["a", f"a-{NULL_TOKEN}", "__UNKNOWN__", "VENTE-__UNKNOWN__"]
    assert list(row)[:4] == [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    assert row[4] == hashlib.md5(b"a").hexdigest()
    with pytest.raises(ValueError):
        fn.surrogate_key("x", algorithm="crc")


def test_calendar_attributes(spark):
    row = spark.createDataFrame([(date(2025, 3, 2),)], "d date").select(*fn.calendar_attributes("d")).first()
    assert tuple(row) == (20250302, date(2025, 3, 2), 2025, 1, 3, 2, "March", "Sunday", 1, 202503, "2025-03")


def test_source_text(spark):
    df = spark.createDataFrame(
        [(True, datetime(2025, 1, 2, 3, 4, 5), date(2025, 1, 2), 1.005, float("nan"), 7, None)],
        "b boolean, t timestamp_ntz, d date, x double, n double, i int, z double",
    )
    assert tuple(df.select(*fn.source_text(df)).first()) == ("1", "2025-01-02 03:04:05", "2025-01-02", "1.00", None, "7", None)
    assert df.select(*fn.source_text(df, scale=4)).first()["x"] == "1.0050"


def test_finance(spark):
    df = spark.createDataFrame([(1,)], "i int")

    def one(c):
        return df.select(c).first()[0]

    assert one(fn.instalment(F.lit(200000), F.lit(0.03), F.lit(240))) == Decimal("1109.20")
    assert one(fn.instalment(F.lit(0), F.lit(0.03), F.lit(240))) == Decimal("0.00")
    assert one(fn.instalment(F.lit(1200), F.lit(0.0), F.lit(12))) == Decimal("100.00")
    assert one(fn.sale_amounts(F.lit("100.03"))["ht"]) == Decimal("83.36")
    split = fn.commission_split(F.lit("1000"), F.lit("0.05"), F.lit(None).cast("string"), F.lit("0.4"))
    assert [one(split[k]) for k in ("gross", "net", "partner", "internal")] == [Decimal(v) for v in ("50.00", "42.50", "0.00", "50.00")]
    assert one(fn.capital_gain(F.lit("100"), F.lit("90"))["net"]) == Decimal("-10.00")
    assert one(fn.capital_gain(F.lit("100"), F.lit("200"))["net"]) == Decimal("66.40")
    assert one(fn.annual_yield(F.lit("10"), F.lit("0"))) == Decimal("120.0000")
    assert one(fn.annual_yield(F.lit("10"), F.lit(None).cast("double"))) == Decimal("120.0000")
    assert [one(fn.occupancy(F.lit(d), F.lit("900"))["rent"]) for d in (0, 15, 30, 45)] == [Decimal(v) for v in ("900", "450", "0", "0")]
    assert one(fn.tax_result(F.lit("100"), F.lit("150"), F.lit("0"))["tax"]) == Decimal("0.00")
    assert one(fn.elapsed_days(F.lit(None).cast("date"), F.lit(date(2025, 1, 1)))) is None


def test_float_text_decides_by_the_binary_value(spark):
    values = [1.005, 0.125, 2.675, 0.375, -0.005, -0.0, 1e15, 99999999.995, float("inf"), float("-inf"), 4503599627370497.5]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double").orderBy("i")
    for scale in (0, 1, 2, 3):
        assert [r[0] for r in df.select(fn.float_text(F.col("x"), scale)).collect()] == [format(x, f".{scale}f") for x in values]
    assert spark.sql("SELECT double('NaN') AS x").select(fn.float_text(F.col("x"))).first()[0] is None


def test_long_ids_and_names_stay_whole(spark):
    df = spark.createDataFrame([("x" * 60 + "1", "y" * 300)], "a string, b string")
    assert tuple(df.select(fn.id_text("a"), fn.full_name("b", "a")).first()) == ("x" * 60 + "1", "y" * 300 + " " + "x" * 60 + "1")
    assert df.select(fn.fitted_text("a", 61)).first()[0] == "x" * 60 + "1"
    with pytest.raises(Exception, match="longer than 60 characters"):
        df.select(fn.fitted_text("a", 60)).collect()
