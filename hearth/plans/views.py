"""The published views: six wrappers, nine level averages, seven ratio views and the
affordability index. ``register_views`` publishes them all as temporary views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions.measures import nullif_ratio
from hearth.operators.joins import size_checked_broadcast
from hearth.operators.levels import measure_by_level, ratio_by_level
from hearth.plans.pipeline import Model


def vw_fact_house_prices(m: Model) -> DataFrame:
    return m.fact_house_price.select("YearMonth", "RegionKey", "AveragePrice")


def vw_fact_earnings(m: Model) -> DataFrame:
    return m.fact_earnings.select("Year", "RegionKey", "Median_Annual_Earnings")


def vw_fact_rent(m: Model) -> DataFrame:
    return m.fact_rent.select("PeriodEndYear", "RegionKey", "MedianMonthlyRent")


def vw_dim_region(m: Model) -> DataFrame:
    return m.dim_region.select("RegionKey", "RegionCode", "RegionName", "Country")


def vw_dim_date(m: Model) -> DataFrame:
    return m.dim_date.select("DateValue", "YEAR", "MONTH", "MonthName", "YearMonthKey")


def vw_bridge_lad_region(m: Model) -> DataFrame:
    return m.bridge.select("LAD23CD", "LAD23NM", "RegionKey", "RegionCode", "RegionName")


def _level_view(measure: str, level: str) -> Callable[[Model], DataFrame]:
    def view(m: Model) -> DataFrame:
        return measure_by_level(m, measure, level)

    view.__name__ = f"{level}_avg_{measure}"
    return view


vw_national_avg_house_prices = _level_view("price", "national")
vw_national_avg_house_rent = _level_view("rent", "national")
vw_national_avg_earnings = _level_view("earnings", "national")
vw_region_avg_house_prices = _level_view("price", "region")
vw_region_avg_house_rent = _level_view("rent", "region")
vw_region_avg_earnings = _level_view("earnings", "region")
vw_lad_avg_house_prices = _level_view("price", "lad")
vw_lad_avg_house_rent = _level_view("rent", "lad")
vw_lad_avg_earnings = _level_view("earnings", "lad")


def vw_lad_price_ratios(m: Model) -> DataFrame:
    """District price against its region's and the nation's price for the same month.

    A district is paired with the regions it belongs to in the bridge (distinct pairs: a
    membership test, not a join that could repeat rows). Region and national monthly means
    have at most as many rows as the price fact; they are broadcast when that bound is within
    the broadcast limit.
    """
    bound = m.row_bound("fact_house_price")
    lad = measure_by_level(m, "price", "lad", with_regions=True)
    region = measure_by_level(m, "price", "region")
    national = measure_by_level(m, "price", "national")
    # the district aggregate carries its regions' names: the bridge is read and dealt once (a NULL
    # district name matches nothing, as in the source's IN)
    j = (
        lad.where("LADName IS NOT NULL").withColumn("RegionName", F.explode("RegionNames"))
        .join(size_checked_broadcast(region, bound), ["YearMonth", "RegionName"])
        .join(size_checked_broadcast(national, bound), "YearMonth")
    )
    return j.select(
        "YearMonth", "LADName", "LAD_AvgPrice", "Region_AvgPrice", "National_AvgPrice",
        nullif_ratio("LAD_AvgPrice", "Region_AvgPrice").alias("LAD_vs_Region_Ratio"),
        nullif_ratio("LAD_AvgPrice", "National_AvgPrice").alias("LAD_vs_National_Ratio"),
    )


def _ratio_view(numerator: str, level: str, out_col: str, factor: float) -> Callable[[Model], DataFrame]:
    def view(m: Model) -> DataFrame:
        return ratio_by_level(m, numerator, level, out_col, factor)

    view.__name__ = f"{level}_{numerator}_income_ratio"
    return view


vw_national_price_income_ratio = _ratio_view("price", "national", "Price_Income_Ratio", 1.0)
vw_region_price_income_ratio = _ratio_view("price", "region", "Price_Income_Ratio", 1.0)
vw_lad_price_income_ratio = _ratio_view("price", "lad", "Price_Income_Ratio", 1.0)
vw_national_rent_income_ratio = _ratio_view("rent", "national", "Rent_Income_Ratio", 12.0)
vw_region_rent_income_ratio = _ratio_view("rent", "region", "Rent_Income_Ratio", 12.0)
vw_lad_rent_income_ratio = _ratio_view("rent", "lad", "Rent_Income_Ratio", 12.0)


def vw_housing_affordability_index(m: Model) -> DataFrame:
    """National monthly price, yearly earnings and rent with both income ratios."""
    hp = measure_by_level(m, "price", "national")
    e = measure_by_level(m, "earnings", "national")
    r = measure_by_level(m, "rent", "national")
    j = hp.join(e, F.year(hp["YearMonth"]) == e["Year"]).join(r, r["PeriodEndYear"] == e["Year"])
    return j.select(
        "YearMonth", "National_AvgPrice", "National_AvgAnnualEarnings",
        nullif_ratio("National_AvgPrice", "National_AvgAnnualEarnings").alias("Price_Income_Ratio"),
        "National_AvgMonthlyRent",
        nullif_ratio(F.col("National_AvgMonthlyRent") * F.lit(12.0), "National_AvgAnnualEarnings").alias(
            "Rent_Income_Ratio"),
    )


VIEWS: dict[str, Callable[[Model], DataFrame]] = {
    "vw_fact_house_prices": vw_fact_house_prices,
    "vw_fact_earnings": vw_fact_earnings,
    "vw_fact_rent": vw_fact_rent,
    "vw_dim_region": vw_dim_region,
    "vw_dim_date": vw_dim_date,
    "vw_bridge_lad_region": vw_bridge_lad_region,
    "vw_national_avg_house_prices": vw_national_avg_house_prices,
    "vw_national_avg_house_rent": vw_national_avg_house_rent,
    "vw_national_avg_earnings": vw_national_avg_earnings,
    "vw_region_avg_house_prices": vw_region_avg_house_prices,
    "vw_region_avg_house_rent": vw_region_avg_house_rent,
    "vw_region_avg_earnings": vw_region_avg_earnings,
    "vw_lad_avg_house_prices": vw_lad_avg_house_prices,
    "vw_lad_avg_house_rent": vw_lad_avg_house_rent,
    "vw_lad_avg_earnings": vw_lad_avg_earnings,
    "vw_lad_price_ratios": vw_lad_price_ratios,
    "vw_national_price_income_ratio": vw_national_price_income_ratio,
    "vw_region_price_income_ratio": vw_region_price_income_ratio,
    "vw_lad_price_income_ratio": vw_lad_price_income_ratio,
    "vw_national_rent_income_ratio": vw_national_rent_income_ratio,
    "vw_region_rent_income_ratio": vw_region_rent_income_ratio,
    "vw_lad_rent_income_ratio": vw_lad_rent_income_ratio,
    "vw_housing_affordability_index": vw_housing_affordability_index,
}


def register_views(spark: SparkSession, m: Model) -> list[str]:
    """Publish every view (create-or-replace, so re-running is idempotent)."""
    for name, fn in VIEWS.items():
        fn(m).createOrReplaceTempView(name)
    return list(VIEWS)
