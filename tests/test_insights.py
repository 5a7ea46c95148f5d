"""Insight queries on literal facts: edge cases, and rewritten plans against the row-level
(naive) form of the same query."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hearth.functions import exact_avg
from hearth.plans import insights as I

from conftest import literal_model, month, rows


@pytest.fixture(scope="module")
def yoy_model(spark):
    return literal_model(
        spark, [(1, "A"), (2, "B")],
        prices=[(month(2000), 1, 100), (month(2001), 1, 110), (month(2000), 2, 0), (month(2001), 2, 50)])


def test_q2_yoy(yoy_model):
    got = rows(I.q2_price_yoy(yoy_model))
    assert got == [
        ("A", 2000, 100.0, None, None),
        ("A", 2001, 110.0, 100.0, 10.0),
        ("B", 2000, 0.0, None, None),
        ("B", 2001, 50.0, 0.0, None),   # previous 0 -> NULL, not an error
    ]


def test_q2_lag_is_previous_row_not_previous_year(spark):
    m = literal_model(spark, [(1, "A")], prices=[(month(2000), 1, 100), (month(2003), 1, 200)])
    assert rows(I.q2_price_yoy(m), "Year", "PrevYearPrice") == [(2000, None), (2003, 100.0)]


def test_q5_rank_ties_share_and_skip(spark):
    m = literal_model(
        spark, [(1, "A"), (2, "B"), (3, "C")],
        prices=[(month(2000), k, 100) for k in (1, 2, 3)]
        + [(month(2001), 1, 105), (month(2001), 2, 105), (month(2001), 3, 103)])
    got = rows(I.q5_growth_rank(m), "RegionName", "Year", "YoY_GrowthPercent", "GrowthRank")
    assert got == [("A", 2001, 5.0, 1), ("B", 2001, 5.0, 1), ("C", 2001, 3.0, 3)]


def test_q7_correlation_edges(spark):
    m = literal_model(
        spark, [(1, "One"), (2, "Flat"), (3, "Lin")],
        prices=[(month(2000), 1, 100), (month(2000), 2, 100), (month(2001), 2, 200),
                (month(2000), 3, 1), (month(2001), 3, 2)],
        rents=[(2000, 1, 10), (2000, 2, 10), (2001, 2, 10), (2000, 3, 2), (2001, 3, 4)])
    got = dict(I.q7_price_rent_corr(m).collect())
    assert got == {"One": None, "Flat": None, "Lin": 1.0}


def test_q3_guard_zero_rent(spark):
    m = literal_model(spark, [(1, "A"), (2, "B")],
                      prices=[(month(2000), 1, 120), (month(2000), 2, 120)],
                      rents=[(2000, 1, 0), (2000, 2, 10)])
    assert rows(I.q3_price_to_rent(m), "RegionName", "PriceToRentRatio") == [("A", None), ("B", 1.0)]


def test_q1a_keeps_years_without_rent(spark):
    m = literal_model(spark, [(1, "A")], prices=[(month(2000), 1, 10), (month(2001), 1, 20)],
                      rents=[(2001, 1, 5)])
    assert rows(I.q1a_price_vs_rent_left(m)) == [(2000, "A", 10.0, None), (2001, "A", 20.0, 5.0)]
    assert rows(I.q1b_price_vs_rent_inner(m)) == [(2001, "A", 20.0, 5.0)]


def test_q10_listed_years_only_and_rent_ratio_null(spark):
    m = literal_model(
        spark, [(1, "A"), (2, "B")],
        prices=[(month(y, mm), k, 100 * k + y - 2000) for y in (2022, 2023, 2024) for mm in (1, 6) for k in (1, 2)],
        earnings=[(y, k, 30000 + k) for y in (2022, 2023, 2024) for k in (1, 2)],
        rents=[(2023, 1, 900), (2023, 2, 1000), (2021, 1, 800)])
    out = I.q10_national_trend(m, years=(2023, 2024))
    got = rows(out, "Year", "National_AvgMonthlyRent", "RentToIncomeRatio")
    assert sorted({g[0] for g in got}) == [2023, 2024]
    assert all(g[2] is None for g in got)
    assert (2023, 950.0, None) in got
    price_rows = out.filter(F.col("National_AvgHousePrice").isNotNull()).collect()
    assert all(r["PriceToIncomeRatio"] == r["National_AvgHousePrice"] / r["National_AvgEarnings"] for r in price_rows)


# ---------------------------------------------------------------- rewrites == naive row-level form

@pytest.fixture(scope="module")
def multi_model(spark):
    regions = [(1, "A"), (2, "B"), (3, "C")]
    prices = [(month(y, mm), k, 1000 + 37 * k + 11 * mm + y % 7 + 0.01 * (k * mm % 3))
              for y in (2019, 2020, 2021) for mm in (1, 2, 3, 7, 12) for k in (1, 2, 3) if not (k == 3 and y == 2019)]
    rents = [(y, k, 500 + 13 * k + y % 5 + 0.05) for y in (2019, 2020, 2021) for k in (1, 2)]
    earnings = [(y, k, 25000 + 101 * k + y % 3 + 0.33) for y in (2019, 2020, 2021) for k in (1, 2, 3) if (y, k) != (2021, 2)]
    return literal_model(spark, regions, prices, rents, earnings)


def _naive_year_join(m):
    d = m.dim_date
    return (m.fact_house_price.alias("f")
            .join(m.dim_region.alias("r"), "RegionKey")
            .join(d, F.col("f.YearMonth") == d["DateValue"]))


def test_q1a_equals_row_level_join(multi_model):
    m = multi_model
    j = _naive_year_join(m).join(
        m.fact_rent.alias("fr"),
        (F.col("fr.RegionKey") == F.col("r.RegionKey")) & (F.col("fr.PeriodEndYear") == F.year("DateValue")), "left")
    naive = j.groupBy(F.year("DateValue").alias("Year"), F.col("r.RegionName").alias("RegionName")).agg(
        exact_avg("f.AveragePrice").alias("AvgHousePrice"), exact_avg("fr.MedianMonthlyRent").alias("AvgMonthlyRent"))
    assert rows(I.q1a_price_vs_rent_left(m)) == rows(naive, *I.q1a_price_vs_rent_left(m).columns)


def test_q8n_equals_row_level_join(multi_model):
    m = multi_model
    d = m.dim_date
    j = (m.fact_house_price.alias("f").join(d, F.col("f.YearMonth") == d["DateValue"])
         .join(m.fact_earnings.alias("fe"),
               (F.col("fe.RegionKey") == F.col("f.RegionKey")) & (F.col("fe.Year") == F.year("DateValue"))))
    naive = j.groupBy(F.year("DateValue").alias("Year")).agg(
        exact_avg("f.AveragePrice").alias("p"), exact_avg("fe.Median_Annual_Earnings").alias("e"))
    got = rows(I.q8n_national_price_to_income(m), "Year", "National_AvgHousePrice", "National_AvgEarnings")
    assert got == rows(naive)


def test_q9_semi_join_equals_day_fan_out(multi_model):
    m = multi_model
    d = m.dim_date
    j = (m.fact_rent.alias("fr").join(m.dim_region.alias("r"), "RegionKey")
         .join(m.fact_earnings.alias("fe"),
               (F.col("fe.RegionKey") == F.col("fr.RegionKey")) & (F.col("fe.Year") == F.col("fr.PeriodEndYear")))
         .join(d, F.col("fr.PeriodEndYear") == F.year(d["DateValue"])))
    naive = j.groupBy(F.year("DateValue").alias("Year"), F.col("r.RegionName")).agg(
        exact_avg("fr.MedianMonthlyRent").alias("r"), exact_avg("fe.Median_Annual_Earnings").alias("e"))
    got = rows(I.q9_rent_to_income(m), "Year", "RegionName", "AvgMonthlyRent", "AvgEarnings")
    assert got == rows(naive)


def test_q9a_q9n_weighted_sums_equal_all_pairs(multi_model):
    m = multi_model
    pairs = (m.fact_rent.alias("fr").join(m.dim_region.alias("r"), "RegionKey")
             .join(m.fact_earnings.alias("fe"), F.col("fe.RegionKey") == F.col("fr.RegionKey")))
    naive = pairs.groupBy(F.col("r.RegionName")).agg(
        exact_avg("fr.MedianMonthlyRent").alias("r"), exact_avg("fe.Median_Annual_Earnings").alias("e"))
    got = rows(I.q9a_rent_to_income_region(m), "RegionName", "AvgMonthlyRent_2023", "AvgEarnings_2024")
    assert got == rows(naive)
    nat = pairs.agg(exact_avg("fr.MedianMonthlyRent").alias("r"), exact_avg("fe.Median_Annual_Earnings").alias("e"))
    assert rows(I.q9n_rent_to_income_national(m), "National_AvgMonthlyRent_2023", "National_AvgEarnings_2024") == rows(nat)


def test_q9n_empty_input_gives_one_null_row(spark):
    m = literal_model(spark, [(1, "A")])
    assert rows(I.q9n_rent_to_income_national(m)) == [(None, None, None)]


def test_every_insight_and_view_runs_on_empty_facts(spark):
    from hearth.plans.views import VIEWS

    m = literal_model(spark, [(1, "A"), (2, "B")])
    for name, fn in {**I.INSIGHTS, **VIEWS}.items():
        n = fn(m).count()
        expected = 1 if name == "q9n_rent_to_income_national" else (11323 if name == "vw_dim_date" else
                                                                    2 if name in ("vw_dim_region", "vw_bridge_lad_region") else 0)
        assert n == expected, name


def test_non_overlapping_years(spark):
    m = literal_model(spark, [(1, "A")], prices=[(month(2001), 1, 10)], rents=[(2005, 1, 5)],
                      earnings=[(2009, 1, 100)])
    assert I.q1b_price_vs_rent_inner(m).count() == 0
    assert I.q9_rent_to_income(m).count() == 0
    assert rows(I.q1a_price_vs_rent_left(m)) == [(2001, "A", 10.0, None)]
    # the all-years pairing still pairs them
    assert rows(I.q9a_rent_to_income_region(m)) == [("A", 5.0, 100.0, 0.6)]


def test_bridge_copies_weight_district_views_like_row_level_joins(spark):
    """A district repeated many times in the lookup (and one listed under two regions) gives the
    same district means as the row-level join over every copy."""
    from hearth.functions import exact_avg
    from hearth.operators.levels import measure_by_level, ratio_by_level

    bridge = [("D1", "Hot", 1)] * 40 + [("D2", "Split", 1), ("D3", "Split", 2), ("D3", "Split", 2), ("D4", "Solo", 2)]
    m = literal_model(
        spark, [(1, "A"), (2, "B")],
        prices=[(month(2020, mm), k, 100 * k + mm + 0.37) for mm in (1, 2, 3) for k in (1, 2)],
        earnings=[(2020, 1, 30000.11), (2020, 2, 25000.5)],
        bridge=bridge)
    row_level = m.fact_house_price.join(m.bridge, "RegionKey").groupBy(
        "YearMonth", F.col("LAD23NM").alias("LADName")).agg(exact_avg("AveragePrice").alias("LAD_AvgPrice"))
    assert rows(measure_by_level(m, "price", "lad")) == rows(row_level)
    e_level = m.fact_earnings.join(m.bridge, "RegionKey").groupBy(
        "Year", F.col("LAD23NM").alias("LADName")).agg(exact_avg("Median_Annual_Earnings").alias("e"))
    naive = row_level.join(e_level, (F.year("YearMonth") == F.col("Year")) & (row_level.LADName == e_level.LADName)) \
        .select("YearMonth", row_level.LADName, "LAD_AvgPrice", "e", (F.col("LAD_AvgPrice") / F.col("e")).alias("r"))
    assert rows(ratio_by_level(m, "price", "lad", "r")) == rows(naive)


def test_fact_house_price_weights_lookup_copies(spark):
    import datetime as dt
    from decimal import Decimal

    from hearth.operators import model as M

    dim = spark.createDataFrame([(1, "E1", "North", "England")],
                                "RegionKey bigint, RegionCode string, RegionName string, Country string")
    lad = spark.createDataFrame([(i, "C1", "Hot", "E1", "North") for i in range(30)] + [(99, "C2", "Cold", "E1", "North")],
                                "ObjectId bigint, LAD23CD string, LAD23NM string, RGN23CD string, RGN23NM string")
    bridge = M.bridge_lad_region(lad, dim)
    prices = spark.createDataFrame([(dt.date(2020, 1, 5), "HOT", Decimal("10.00")),
                                    (dt.date(2020, 1, 6), "COLD", Decimal("41.00"))],
                                   "Date date, RegionName string, AveragePrice decimal(18,2)")
    # row-level join: 30 copies of 10.00 and one 41.00 -> (300 + 41) / 31 = 11.0
    assert rows(M.fact_house_price(prices, bridge, dim)) == [(dt.date(2020, 1, 1), 1, Decimal("11.00"))]


def test_strict_year_option(spark):
    m = literal_model(spark, [(1, "A")], prices=[(month(2000), 1, 100), (month(2003), 1, 200), (month(2004), 1, 220)])
    assert rows(I.q2_price_yoy(m, strict_year=True), "Year", "PrevYearPrice") == [
        (2000, None), (2003, None), (2004, 200.0)]
    assert rows(I.q5_growth_rank(m, strict_year=True), "Year", "GrowthRank") == [(2004, 1)]
    assert rows(I.q5_growth_rank(m), "Year") == [(2003,), (2004,)]     # parity: previous row


def test_q10_merge_years_option(spark):
    m = literal_model(spark, [(1, "A")], prices=[(month(2023), 1, 300000)], earnings=[(2023, 1, 30000)],
                      rents=[(2023, 1, 1000)])
    assert rows(I.q10_national_trend(m, (2023,), merge_years=True)) == [
        (2023, 300000.0, 30000.0, 1000.0, 10.0, 0.4)]
    parity = rows(I.q10_national_trend(m, (2023,)), "Year", "RentToIncomeRatio")
    assert parity == [(2023, None), (2023, None)]
