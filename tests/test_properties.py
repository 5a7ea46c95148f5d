"""Property tests: the exact mean and the cent rounding against Python's exact arithmetic, and
the level generics against a direct computation."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearth.functions import exact_mean, round_half_up_cents

from conftest import literal_model, month, rows

cents = st.integers(min_value=-10**11, max_value=10**11)
groups = st.lists(st.lists(cents, min_size=1, max_size=12), min_size=1, max_size=15)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(groups)
def test_exact_mean_and_rounding_match_python(spark, gs):
    data = [(g, Decimal(c).scaleb(-2)) for g, values in enumerate(gs) for c in values]
    df = spark.createDataFrame(data, "g int, v decimal(18,2)")
    out = df.groupBy("g").agg(
        exact_mean(F.sum("v"), F.count("v")).alias("m"),
        round_half_up_cents(F.sum("v"), F.count("v")).alias("r"),
    )
    got = {r["g"]: (r["m"], r["r"]) for r in out.collect()}
    for g, values in enumerate(gs):
        total = sum(values)
        mean = float(Fraction(total, 100 * len(values)))          # correctly rounded
        cents_mean = (Decimal(total) / len(values)).quantize(Decimal(1), rounding=ROUND_HALF_UP)
        assert got[g] == (mean, cents_mean.scaleb(-2)), (g, values)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(1, 12), st.integers(1, 3), st.integers(1, 10**8)),
                min_size=1, max_size=30, unique_by=lambda t: t[:3]))
def test_level_means_equal_direct_means(spark, facts):
    """avg_by_level at region and national level equals the mean of the fact rows computed
    directly (in Python, exactly)."""
    from hearth.operators.levels import measure_by_level

    prices = [(month(2000 + y, mm), k, Decimal(c).scaleb(-2)) for y, mm, k, c in facts]
    m = literal_model(spark, [(1, "A"), (2, "B"), (3, "C")], prices=prices)
    nat = {r[0]: r[1] for r in measure_by_level(m, "price", "national").collect()}
    reg = {(r[0], r[1]): r[2] for r in measure_by_level(m, "price", "region").collect()}
    by_month: dict = {}
    by_region: dict = {}
    for y, mm, k, c in facts:
        by_month.setdefault(month(2000 + y, mm), []).append(c)
        by_region.setdefault((month(2000 + y, mm), "ABC"[k - 1]), []).append(c)
    assert nat == {t: float(Fraction(sum(v), 100 * len(v))) for t, v in by_month.items()}
    assert reg == {t: float(Fraction(sum(v), 100 * len(v))) for t, v in by_region.items()}


def test_register_views_publishes_all_and_is_idempotent(spark):
    from hearth.plans.views import VIEWS, register_views

    m = literal_model(spark, [(1, "A")], prices=[(month(2000), 1, 100)], rents=[(2000, 1, 10)],
                      earnings=[(2000, 1, 1200)])
    names = register_views(spark, m)
    assert names == list(VIEWS) and len(names) == 23
    register_views(spark, m)  # create-or-replace: a second publication does not fail
    got = rows(spark.sql("SELECT YearMonth, Price_Income_Ratio, Rent_Income_Ratio FROM vw_housing_affordability_index"))
    assert got == [(month(2000), 100 / 1200, 10 * 12.0 / 1200)]


def test_avg_by_level_rejects_unknown_level(spark):
    from hearth.operators.levels import avg_by_level

    m = literal_model(spark, [(1, "A")])
    with pytest.raises(ValueError):
        avg_by_level(m.fact_rent, "county", "PeriodEndYear", "MedianMonthlyRent", "x")


def _py_int(text):
    import re

    if text is None or not re.fullmatch(r"[+-]?[0-9]+", text):
        return None
    v = int(text)
    return v if -2**31 <= v < 2**31 else None


money_text = st.text(alphabet="0123456789,£ +-.a\t", max_size=14)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), money_text), min_size=1, max_size=200))
def test_lenient_integer_parsing_agrees_across_spark_duckdb_and_python(spark, texts):
    import duckdb

    from hearth.functions import clean_count_int, clean_money_int
    from oracle import EARN_INT, RENT_INT

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: (r["m"], r["c"]) for r in df.select(
        "i", clean_money_int("t").alias("m"), clean_count_int("t").alias("c")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE x (i INTEGER, Median_Annual_Earnings VARCHAR, Median VARCHAR)")
    con.executemany("INSERT INTO x VALUES (?, ?, ?)", [(i, t, t) for i, t in enumerate(texts)])
    duck = {i: (m, c) for i, m, c in con.execute(f"SELECT i, {EARN_INT}, {RENT_INT} FROM x").fetchall()}
    for i, t in enumerate(texts):
        money = None if t is None else t.strip(" ")
        money = None if money is None else money.replace(",", "").replace("£", "").replace(" ", "")
        count = None if t is None else t.strip(" ").replace(",", "")
        expected = (_py_int(money), _py_int(count))
        assert got[i] == expected == duck[i], (t, got[i], duck[i], expected)
