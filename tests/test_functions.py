"""Column helpers on the dirty values the cleaning steps have to handle."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hearth.functions import (
    blank_to_null,
    clean_count_int,
    clean_money_int,
    exact_avg,
    exact_mean,
    guarded_ratio,
    month_start,
    norm,
    nullif_ratio,
    period_end_year,
    round_half_up_cents,
)


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize("text,expected", [
    ("  £31,461 ", 31461),
    ("£ 31 461", 31461),
    ("n/a", None),
    (None, None),
    ("99999999999", None),
    ("1200.50", None),
    ("", None),
    ("-12", -12),
])
def test_clean_money_int(spark, text, expected):
    assert one(spark, clean_money_int, text) == expected


def test_clean_money_blank_as_zero(spark):
    assert one(spark, lambda c: clean_money_int(c, blank_as_zero=True), "") == 0
    assert one(spark, lambda c: clean_money_int(c, blank_as_zero=True), "  ") == 0
    assert one(spark, lambda c: clean_money_int(c, blank_as_zero=True), "x") is None


@pytest.mark.parametrize("text,expected", [
    (" 1,250 ", 1250),
    ("1 250", None),
    ("£1250", None),
    ("", None),
])
def test_clean_count_int(spark, text, expected):
    assert one(spark, clean_count_int, text) == expected


@pytest.mark.parametrize("text,expected", [("   ", None), (" London ", "London"), (None, None), ("", None)])
def test_blank_to_null(spark, text, expected):
    assert one(spark, blank_to_null, text) == expected


@pytest.mark.parametrize("label,expected", [
    ("Apr 2022 to Mar 2023", 2023),
    ("23", 23),
    ("n/a", None),
    ("unknown", None),
    (None, None),
])
def test_period_end_year(spark, label, expected):
    assert one(spark, period_end_year, label) == expected


def test_norm_matches_case_and_padding(spark):
    df = spark.createDataFrame([("HARTLEPOOL", " Hartlepool  ")], "a string, b string")
    assert df.filter(norm("a") == norm("b")).count() == 1
    assert df.filter(F.col("a") == F.col("b")).count() == 0


def test_month_start(spark):
    assert one(spark, month_start, dt.date(2023, 5, 17), "date") == dt.date(2023, 5, 1)
    assert one(spark, month_start, dt.datetime(2023, 5, 17, 13, 0), "timestamp_ntz") == dt.date(2023, 5, 1)


def test_exact_avg_is_grouping_invariant(spark):
    vals = [Decimal("0.10"), Decimal("0.20"), Decimal("0.40"), Decimal("1234567.89"), Decimal("3.33")]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(vals)], "g int, v decimal(18,2)")
    whole = df.agg(exact_avg("v").alias("m")).first()["m"]
    parts = df.groupBy("g").agg(F.sum("v").alias("s"), F.count("v").alias("n"))
    merged = parts.agg(exact_mean(F.sum("s"), F.sum("n")).alias("m")).first()["m"]
    assert whole == merged
    assert abs(whole - float(sum(vals)) / len(vals)) < 1e-9
    # repeating every row k times leaves the mean bit-identical
    tripled = df.unionByName(df).unionByName(df).agg(exact_avg("v").alias("m")).first()["m"]
    assert tripled == whole


def test_exact_avg_ignores_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, Decimal("2.00")), (1, None), (2, None)], "g int, v decimal(18,2)")
    got = dict(df.groupBy("g").agg(exact_avg("v").alias("m")).collect())
    assert got == {1: 2.0, 2: None}


@pytest.mark.parametrize("values,expected", [
    (["1.00", "2.00"], "1.50"),
    (["0.01", "0.02"], "0.02"),      # 0.015 -> half up
    (["0.01", "0.01", "0.02"], "0.01"),  # 0.01333
    (["-0.01", "-0.02"], "-0.02"),   # half away from zero
    (["100000.05", "100000.00"], "100000.03"),
])
def test_round_half_up_cents(spark, values, expected):
    df = spark.createDataFrame([(Decimal(v),) for v in values], "v decimal(18,2)")
    got = df.agg(round_half_up_cents(F.sum("v"), F.count("v")).alias("m")).first()["m"]
    assert got == Decimal(expected)


def test_ratios(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (10.0, None), (10.0, -2.0)], "a double, b double")
    got = [tuple(r) for r in df.select(guarded_ratio("a", "b").alias("g"), nullif_ratio("a", "b").alias("n")).collect()]
    assert got == [(None, None), (2.5, 2.5), (None, None), (None, -5.0)]


def test_round_half_up_cents_is_exact_beyond_double_precision(spark):
    """Sums far above 2**53 cents still round exactly (no double division on the way)."""
    from decimal import ROUND_HALF_UP

    values = [Decimal("9999999999999999.99"), Decimal("9999999999999999.98"), Decimal("9999999999999999.97"),
              Decimal("0.01")]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(18,2)")
    got = df.agg(round_half_up_cents(F.sum("v"), F.count("v")).alias("m")).first()["m"]
    expected = (sum(values) / len(values)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    assert got == expected


def test_round_half_up_cents_beyond_64_bit_totals(spark):
    """A group whose cent total exceeds the 64-bit range still averages exactly (no overflow)."""
    from decimal import ROUND_HALF_UP

    v = Decimal("9999999999999999.99")
    df = spark.range(0, 1000).select(F.lit(v).cast("decimal(18,2)").alias("v")).unionByName(
        spark.createDataFrame([(Decimal("0.02"),)], "v decimal(18,2)"))
    got = df.agg(round_half_up_cents(F.sum("v"), F.count("v")).alias("m")).first()["m"]
    expected = ((v * 1000 + Decimal("0.02")) / 1001).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    assert got == expected
