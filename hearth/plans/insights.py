"""The fifteen affordability insight queries over the star schema.

Plan shape: the region dimension joins map-side when its checked size allows. Prices that meet
rents or earnings (unique per region and year) are first reduced to one exact (sum, count) pair per
(RegionKey, year); a rent repeated over n months is carried as ``rent * n`` with weight n. That gives
exactly the averages of the row-level join (see ``price_with``). The date dimension is only an
existence test (``left_semi``): joining it row-for-row would multiply rows by the days of a year
without changing any average.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions.measures import MONEY, exact_avg, exact_mean, guarded_ratio, moments, pearson, scaled_mean
from hearth.operators.joins import size_checked_broadcast
from hearth.plans.pipeline import Model


def _regions(m: Model) -> DataFrame:
    return size_checked_broadcast(m.dim_region.select("RegionKey", "RegionName"), m.row_bound("dim_region"))


def _calendar_months(m: Model) -> DataFrame:
    # bounded by the calendar parameters (one row per day of the span)
    return F.broadcast(m.dim_date.select(F.col("DateValue").alias("YearMonth")))


def _calendar_years(m: Model) -> DataFrame:
    return F.broadcast(m.dim_date.select(F.col("YEAR").alias("Year")).distinct())


def price_parts(m: Model, in_calendar: bool = True) -> DataFrame:
    """(RegionKey, Year, _ps, _pn): exact price sum and month count per region-year."""
    f = m.fact_house_price
    if in_calendar:
        f = f.join(_calendar_months(m), "YearMonth", "left_semi")
    p = F.col("AveragePrice").cast(MONEY)
    return f.groupBy("RegionKey", F.year("YearMonth").alias("Year")).agg(
        F.sum(p).alias("_ps"), F.count(p).alias("_pn")
    )


def _weighted(value: str, weight: str, prefix: str) -> list:
    """Sum and count of ``value`` repeated ``weight`` times (NULL values carry no weight)."""
    v = F.col(value).cast(MONEY)
    return [
        (v * F.col(weight).cast("decimal(20,0)")).alias(f"{prefix}s"),
        F.when(v.isNotNull(), F.col(weight)).otherwise(F.lit(0)).cast("bigint").alias(f"{prefix}n"),
    ]


def _rent_by_year(m: Model) -> DataFrame:
    return m.fact_rent.select("RegionKey", F.col("PeriodEndYear").alias("Year"), "MedianMonthlyRent")


def _earnings_by_year(m: Model) -> DataFrame:
    return m.fact_earnings.select("RegionKey", "Year", "Median_Annual_Earnings")


def _mean(prefix: str) -> F.Column:
    return exact_mean(F.sum(f"{prefix}s"), F.sum(f"{prefix}n"))


OTHER = {
    "rent": ("fact_rent", "MedianMonthlyRent", _rent_by_year),
    "earnings": ("fact_earnings", "Median_Annual_Earnings", _earnings_by_year),
}


def price_with(m: Model, other: str, how: str = "inner", by_region: bool = True) -> DataFrame:
    """Monthly prices joined with the yearly rent or earnings fact on (region, year), as rows
    ``(Year, [RegionName], <value>, ps, pn, xs, xn)`` whose sums give the exact means of the
    row-level join: ``ps/pn`` for the price, ``xs/xn`` for the other measure.

    The prices are first reduced to one exact (sum, count) per region-year - collapsed map-side,
    so a region with most of the rows costs one row for each task - and the other value is carried
    with the month count as weight: the same sums as the row-level join. The size check of the
    other side decides its broadcast hint and nothing else.
    """
    table, value, select = OTHER[other]
    right = size_checked_broadcast(select(m), m.row_bound(table))
    j = price_parts(m).join(right, ["RegionKey", "Year"], how)
    cols = [F.col("_ps").alias("ps"), F.col("_pn").alias("pn"), *_weighted(value, "_pn", "x")]
    if by_region:
        j = j.join(_regions(m), "RegionKey")
    return j.select("Year", *(["RegionName"] if by_region else []), value, *cols)


def _price_vs_rent(m: Model, how: str) -> DataFrame:
    return price_with(m, "rent", how).groupBy("Year", "RegionName").agg(
        _mean("p").alias("AvgHousePrice"), _mean("x").alias("AvgMonthlyRent"))


def q1a_price_vs_rent_left(m: Model) -> DataFrame:
    """Yearly regional price and rent; years without rent keep a NULL rent."""
    return _price_vs_rent(m, "left")


def q1b_price_vs_rent_inner(m: Model) -> DataFrame:
    """Yearly regional price and rent, overlapping years only."""
    return _price_vs_rent(m, "inner")


def _yearly_price_by_name(m: Model, in_calendar: bool) -> DataFrame:
    # the region dimension is broadcast (a map-side join), so the fact is aggregated once,
    # after it: pre-aggregating would only add an exchange
    f = m.fact_house_price
    if in_calendar:
        f = f.join(_calendar_months(m), "YearMonth", "left_semi")
    return f.join(_regions(m), "RegionKey").groupBy("RegionName", F.year("YearMonth").alias("Year")).agg(
        exact_avg("AveragePrice").alias("AvgHousePrice"))


def _with_previous(df: DataFrame, strict_year: bool = False) -> DataFrame:
    """Previous row's price per region. ``strict_year=True`` keeps it only when that row is the
    previous calendar year (the source compares with the previous *row*, so a missing year makes
    its "year-on-year" span several years)."""
    w = Window.partitionBy("RegionName").orderBy("Year")
    prev = F.lag("AvgHousePrice").over(w)
    if strict_year:
        prev = F.when(F.lag("Year").over(w) == F.col("Year") - 1, prev)
    return df.withColumn("PrevYearPrice", prev)


def _pct_change(cur: str, prev: str) -> F.Column:
    return (F.col(cur) - F.col(prev)) * F.lit(100.0) / F.nullif(F.col(prev), F.lit(0.0))


def q2_price_yoy(m: Model, strict_year: bool = False) -> DataFrame:
    """Year-on-year % change of the regional price (previous *row*, first year NULL)."""
    df = _with_previous(_yearly_price_by_name(m, in_calendar=False), strict_year)
    return df.select(
        "RegionName", "Year", "AvgHousePrice", "PrevYearPrice",
        _pct_change("AvgHousePrice", "PrevYearPrice").alias("YoY_PercentChange"),
    )


def q3_price_to_rent(m: Model) -> DataFrame:
    """Price / (12 x monthly rent) for overlapping years; NULL unless rent > 0 (the guard tests
    the denominator, and rent x 12 > 0 exactly when rent > 0)."""
    df = q1b_price_vs_rent_inner(m)
    return df.withColumn(
        "PriceToRentRatio", guarded_ratio(F.col("AvgHousePrice"), F.col("AvgMonthlyRent") * F.lit(12.0))
    ).select("Year", "RegionName", "AvgHousePrice", "AvgMonthlyRent", "PriceToRentRatio")


def q4_price_to_earnings(m: Model) -> DataFrame:
    """Price / earnings per year and region, earnings being part of the grouping."""
    df = price_with(m, "earnings").groupBy("Year", "RegionName", "Median_Annual_Earnings").agg(
        _mean("p").alias("AvgHousePrice"))
    return df.select(
        "Year", "RegionName", "AvgHousePrice", "Median_Annual_Earnings",
        guarded_ratio(F.col("AvgHousePrice"), F.col("Median_Annual_Earnings").cast("double")).alias(
            "PriceToEarningsRatio"),
    )


def q5_growth_rank(m: Model, strict_year: bool = False) -> DataFrame:
    """Regions ranked by year-on-year price growth within each year (1 = fastest)."""
    df = _with_previous(_yearly_price_by_name(m, in_calendar=True), strict_year).filter(
        F.col("PrevYearPrice").isNotNull())
    growth = (F.col("AvgHousePrice") - F.col("PrevYearPrice")) * F.lit(1.0) / F.nullif(
        F.col("PrevYearPrice"), F.lit(0.0))
    w = Window.partitionBy("Year").orderBy(growth.desc_nulls_last())
    return df.select(
        "RegionName", "Year", "AvgHousePrice", "PrevYearPrice",
        _pct_change("AvgHousePrice", "PrevYearPrice").alias("YoY_GrowthPercent"),
        F.rank().over(w).cast("bigint").alias("GrowthRank"),
    )


def q6_rent_rank(m: Model) -> DataFrame:
    """Regions ranked by rent within each year, both directions."""
    df = m.fact_rent.join(_regions(m), "RegionKey").groupBy("RegionName", F.col("PeriodEndYear").alias("Year")).agg(
        exact_avg("MedianMonthlyRent").alias("AvgMonthlyRent"))
    w = Window.partitionBy("Year")
    return df.select(
        "RegionName", "Year", "AvgMonthlyRent",
        F.rank().over(w.orderBy(F.col("AvgMonthlyRent").desc_nulls_last())).cast("bigint").alias("RentRank_Highest"),
        F.rank().over(w.orderBy(F.col("AvgMonthlyRent").asc_nulls_first())).cast("bigint").alias("RentRank_Lowest"),
    )


def q7_price_rent_corr(m: Model) -> DataFrame:
    """Sample Pearson correlation of yearly price and rent per region, in full precision and bit for
    bit the same however the rows are partitioned; NULL for one year or a flat series.

    Yearly means enter with six places, as the source's decimal averages have; their moments are
    exact integers, so partial states may be added in any order.
    """
    yearly = price_with(m, "rent").groupBy("Year", "RegionName").agg(
        scaled_mean(F.sum("ps"), F.sum("pn")).alias("x"), scaled_mean(F.sum("xs"), F.sum("xn")).alias("y"))
    return yearly.groupBy("RegionName").agg(*moments("x", "y")).select("RegionName", pearson().alias("PriceRentCorrelation"))


def q7b_overlap_years(m: Model) -> DataFrame:
    """Number of years with both a price and a rent, per region."""
    return price_with(m, "rent").groupBy("RegionName").agg(F.countDistinct("Year").alias("OverlappingYears"))


def _price_earnings(m: Model, by_region: bool) -> DataFrame:
    return price_with(m, "earnings", by_region=by_region)


def q8_price_to_income(m: Model) -> DataFrame:
    """Price-to-income ratio per year and region."""
    df = _price_earnings(m, True).groupBy("Year", "RegionName").agg(
        _mean("p").alias("AvgHousePrice"), _mean("x").alias("AvgEarnings"))
    return df.withColumn("PriceToIncomeRatio", guarded_ratio("AvgHousePrice", "AvgEarnings"))


def _national_price_income(m: Model) -> DataFrame:
    return _price_earnings(m, False).groupBy("Year").agg(
        _mean("p").alias("National_AvgHousePrice"), _mean("x").alias("National_AvgEarnings"))


def q8n_national_price_to_income(m: Model) -> DataFrame:
    """National price-to-income per year (means over region-months with earnings)."""
    return _national_price_income(m).withColumn(
        "National_PriceToIncomeRatio", guarded_ratio("National_AvgHousePrice", "National_AvgEarnings"))


def q9_rent_to_income(m: Model) -> DataFrame:
    """12 x rent / earnings per year and region, years present in the calendar."""
    j = (
        _rent_by_year(m)
        .join(_earnings_by_year(m), ["RegionKey", "Year"])
        .join(_calendar_years(m), "Year", "left_semi")
        .join(_regions(m), "RegionKey")
    )
    df = j.groupBy("Year", "RegionName").agg(
        exact_avg("MedianMonthlyRent").alias("AvgMonthlyRent"),
        exact_avg("Median_Annual_Earnings").alias("AvgEarnings"),
    )
    return df.withColumn("RentToIncomeRatio", guarded_ratio(F.col("AvgMonthlyRent") * F.lit(12.0), F.col("AvgEarnings")))


def _cross_year_parts(m: Model) -> DataFrame:
    """Per RegionKey: rent and earnings (sum, non-null count, rows) — the all-years x all-years
    pairing is evaluated as weighted sums instead of materialising the pairs."""
    r = F.col("MedianMonthlyRent").cast(MONEY)
    e = F.col("Median_Annual_Earnings").cast(MONEY)
    rent = m.fact_rent.groupBy("RegionKey").agg(
        F.sum(r).alias("rs"), F.count(r).alias("rn"), F.count(F.lit(1)).alias("rrows"))
    earn = m.fact_earnings.groupBy("RegionKey").agg(
        F.sum(e).alias("es"), F.count(e).alias("en"), F.count(F.lit(1)).alias("erows"))
    dec = "decimal(20,0)"
    return rent.join(earn, "RegionKey").select(
        "RegionKey",
        (F.col("rs") * F.col("erows").cast(dec)).alias("prs"), (F.col("rn") * F.col("erows")).alias("prn"),
        (F.col("es") * F.col("rrows").cast(dec)).alias("pes"), (F.col("en") * F.col("rrows")).alias("pen"),
    )


def _cross_year_means(df: DataFrame, keys: Sequence[str], rent_col: str, earn_col: str, ratio_col: str) -> DataFrame:
    out = df.groupBy(*keys).agg(
        exact_mean(F.sum("prs"), F.sum("prn")).alias(rent_col),
        exact_mean(F.sum("pes"), F.sum("pen")).alias(earn_col),
    )
    return out.withColumn(ratio_col, guarded_ratio(F.col(rent_col) * F.lit(12.0), F.col(earn_col)))


def q9a_rent_to_income_region(m: Model) -> DataFrame:
    """Rent-to-income per region pairing every rent year with every earnings year."""
    df = _cross_year_parts(m).join(_regions(m), "RegionKey")
    return _cross_year_means(df, ["RegionName"], "AvgMonthlyRent_2023", "AvgEarnings_2024", "RentToIncomeRatio")


def q9n_rent_to_income_national(m: Model) -> DataFrame:
    """National rent-to-income over the same all-years pairing (always one row)."""
    return _cross_year_means(_cross_year_parts(m), [], "National_AvgMonthlyRent_2023", "National_AvgEarnings_2024",
                             "National_RentToIncomeRatio")


def q10_national_trend(m: Model, years: Sequence[int] = (2023, 2024), merge_years: bool = False) -> DataFrame:
    """National price, earnings and rent for the listed years, with both ratios.

    Price+earnings rows and rent rows come from separate branches (UNION ALL), so the
    rent-to-income ratio is NULL on every row — kept, as the source defines it.
    ``merge_years=True`` instead combines the two branches into one row per year (a full outer
    join on Year), so a year with rent and earnings gets its rent-to-income ratio.
    """
    years = [int(y) for y in years]
    lo, hi = min(years), max(years)
    # date-range predicate on the month column reaches the Parquet scan; the year list
    # alone (a function of the column) cannot be pushed down
    fhp = m.fact_house_price.filter(
        (F.col("YearMonth") >= F.make_date(F.lit(lo), F.lit(1), F.lit(1)))
        & (F.col("YearMonth") <= F.make_date(F.lit(hi), F.lit(12), F.lit(31)))
    )
    scoped = Model(m.dim_region, m.dim_date, m.bridge, m.fact_earnings.filter(F.col("Year").isin(years)),
                   m.fact_rent.filter(F.col("PeriodEndYear").isin(years)), fhp, rows=m.rows)
    he = _national_price_income(scoped).select(
        "Year", "National_AvgHousePrice", "National_AvgEarnings",
        F.lit(None).cast("double").alias("National_AvgMonthlyRent"))
    rent = (
        scoped.fact_rent.join(_regions(m), "RegionKey")
        .groupBy(F.col("PeriodEndYear").alias("Year"))
        .agg(exact_avg("MedianMonthlyRent").alias("National_AvgMonthlyRent"))
        .select("Year", F.lit(None).cast("double").alias("National_AvgHousePrice"),
                F.lit(None).cast("double").alias("National_AvgEarnings"), "National_AvgMonthlyRent")
    )
    if merge_years:
        t = he.drop("National_AvgMonthlyRent").join(
            rent.select("Year", "National_AvgMonthlyRent"), "Year", "full_outer").filter(F.col("Year").isin(years))
    else:
        t = he.unionByName(rent).filter(F.col("Year").isin(years))
    price, earn, rentc = F.col("National_AvgHousePrice"), F.col("National_AvgEarnings"), F.col("National_AvgMonthlyRent")
    return t.select(
        "Year", "National_AvgHousePrice", "National_AvgEarnings", "National_AvgMonthlyRent",
        F.when((earn > 0) & price.isNotNull(), price / earn).alias("PriceToIncomeRatio"),
        F.when((earn > 0) & rentc.isNotNull(), rentc * F.lit(12.0) / earn).alias("RentToIncomeRatio"),
    )


INSIGHTS = {
    "q1a_price_vs_rent_left": q1a_price_vs_rent_left,
    "q1b_price_vs_rent_inner": q1b_price_vs_rent_inner,
    "q2_price_yoy": q2_price_yoy,
    "q3_price_to_rent": q3_price_to_rent,
    "q4_price_to_earnings": q4_price_to_earnings,
    "q5_growth_rank": q5_growth_rank,
    "q6_rent_rank": q6_rent_rank,
    "q7_price_rent_corr": q7_price_rent_corr,
    "q7b_overlap_years": q7b_overlap_years,
    "q8_price_to_income": q8_price_to_income,
    "q8n_national_price_to_income": q8n_national_price_to_income,
    "q9_rent_to_income": q9_rent_to_income,
    "q9a_rent_to_income_region": q9a_rent_to_income_region,
    "q9n_rent_to_income_national": q9n_rent_to_income_national,
    "q10_national_trend": q10_national_trend,
}
