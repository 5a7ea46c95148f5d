"""Star-schema builders: dim_region, dim_date, bridge_lad_region and the three facts.

Join strategy (checked with ``explain``):

* ``dim_region`` is a filtered copy of the reference list of regions, so its size is bounded
  by that list, never by the facts: it is broadcast when its counted rows are within the limit.
* ``dim_date`` is generated from two parameters; its size is ``end - start + 1`` days.
* The district bridge grows with the number of districts: it is never hinted, AQE picks
  broadcast or sort-merge from the runtime size of the (pre-aggregated) sides.
* House prices meet a district lookup of checked size map-side and are shuffled once, as sums per
  (month, region). Beyond that size they are first reduced to (month, district), so a district
  holding a third of all rows is collapsed map-side instead of landing in one task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearth.functions.measures import MONEY, round_half_up_cents
from hearth.functions.text import collated, month_start, norm, period_end_year
from hearth.operators.cleaning import enforce_not_null, widen_decimal
from hearth.operators.gate import MODES, Rules
from hearth.operators.joins import size_checked_broadcast, within_limit
from hearth.operators.keys import dense_key, stable_key
from hearth.sources.versions import VersionedTable

# Calendar span of the date dimension in the source.
DATE_START = "1995-01-01"
DATE_END = "2025-12-31"

# NOT NULL rules of the modelled tables (the source declares them column by column).
NOT_NULL: dict[str, list[str]] = {
    "bridge_lad_region": ["LAD23CD"],
    "fact_earnings": ["Median_Annual_Earnings"],
    "fact_rent": ["PeriodEndYear", "MedianMonthlyRent"],
    "fact_house_price": ["YearMonth", "AveragePrice"],
}


# Columns (or groups of columns) that the source declares unique.
KEYS: dict[str, list[tuple[str, ...]]] = {
    "dim_region": [("RegionKey",), ("RegionCode",), ("RegionName",)],
    "dim_date": [("DateValue",)],
    "bridge_lad_region": [("LAD23CD",), ("LAD23NM",)],
    "fact_earnings": [("Year", "RegionKey")],
    "fact_rent": [("PeriodEndYear", "RegionKey")],
    "fact_house_price": [("YearMonth", "RegionKey")],
}


def rules(table: str) -> Rules:
    """All declared rules of a table."""
    return Rules(tuple(NOT_NULL.get(table, ())), tuple(KEYS.get(table, ())))


def enforce(df: DataFrame, table: str, mode: str = "filter") -> DataFrame:
    """Apply a table's NOT NULL rules: as a filter (on a written table it reaches the scan), by
    stopping the job at the first violation (``fail``), or not at all (``report``)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return df if mode == "report" else enforce_not_null(df, NOT_NULL[table], fail=mode == "fail")


def dim_region(regions: DataFrame, country: str = "ENGLAND", distributed_key: bool = False,
               known: VersionedTable | None = None) -> DataFrame:
    """``(RegionKey BIGINT, RegionCode, RegionName, Country)`` for one country.

    The surrogate key is the row number in ``RegionCode`` order. By default a window without a
    partition key numbers the rows in one task — right for the bounded reference list of
    regions. ``distributed_key=True`` numbers them in parallel (``keys.dense_key``) for a
    dimension that does not fit one task; both give the same keys when codes are unique. With a
    table of ``known`` keys, regions keep the keys they were first given, and only new codes are
    numbered (``keys.stable_key``).
    """
    rows = regions.filter(collated("Country") == country.rstrip(" ").upper()).select("RegionCode", "RegionName", "Country")
    if known is not None:
        return stable_key(rows, "RegionCode", "RegionKey", known)
    if distributed_key:
        return dense_key(rows, ["RegionCode"], "RegionKey")
    w = Window.orderBy("RegionCode")
    return rows.select(F.row_number().over(w).cast("bigint").alias("RegionKey"), "RegionCode", "RegionName", "Country")


def _region_lookup(dim: DataFrame, dim_rows: int | None) -> DataFrame:
    return size_checked_broadcast(dim.select("RegionKey", norm("RegionName").alias("_rk")), dim_rows)


def fact_earnings_unchecked(earnings: DataFrame, dim: DataFrame, dim_rows: int | None = None) -> DataFrame:
    """Earnings fact before its NOT NULL rule. ``dim_rows`` (the written dimension's row count) lets it
    be broadcast when it is within the limit."""
    e = earnings.select("Year", norm("Region_name").alias("_rk"), "Median_Annual_Earnings")
    joined = e.join(_region_lookup(dim, dim_rows), "_rk").select("Year", "RegionKey", "Median_Annual_Earnings")
    return widen_decimal(joined, ["Median_Annual_Earnings"])


def fact_earnings(earnings: DataFrame, dim: DataFrame) -> DataFrame:
    """``(Year, RegionKey, Median_Annual_Earnings DECIMAL(18,2))``; unmatched names drop out."""
    return enforce(fact_earnings_unchecked(earnings, dim), "fact_earnings")


def fact_rent_unchecked(rents: DataFrame, dim: DataFrame, dim_rows: int | None = None) -> DataFrame:
    """Rent fact before its NOT NULL rules (``PeriodEndYear`` may be NULL)."""
    r = rents.select(
        period_end_year("PeriodLabel").alias("PeriodEndYear"), norm("Region").alias("_rk"), "Median"
    )
    joined = r.join(_region_lookup(dim, dim_rows), "_rk").select("PeriodEndYear", "RegionKey", F.col("Median").alias("MedianMonthlyRent"))
    return widen_decimal(joined, ["MedianMonthlyRent"])


def fact_rent(rents: DataFrame, dim: DataFrame, dim_rows: int | None = None) -> DataFrame:
    """``(PeriodEndYear INT, RegionKey, MedianMonthlyRent DECIMAL(18,2))``."""
    return enforce(fact_rent_unchecked(rents, dim, dim_rows), "fact_rent")


def bridge_lad_region_unchecked(lad: DataFrame, dim: DataFrame, dim_rows: int | None = None) -> DataFrame:
    """District -> region mapping before its NOT NULL rule."""
    d = size_checked_broadcast(dim.select("RegionKey", "RegionCode", "RegionName", norm("RegionName").alias("_rk")), dim_rows)
    b = lad.select("LAD23CD", "LAD23NM", norm("RGN23NM").alias("_rk")).join(d, "_rk")
    return b.select("LAD23CD", "LAD23NM", "RegionKey", "RegionCode", "RegionName")


def bridge_lad_region(lad: DataFrame, dim: DataFrame) -> DataFrame:
    """``(LAD23CD, LAD23NM, RegionKey, RegionCode, RegionName)``: district -> region."""
    return enforce(bridge_lad_region_unchecked(lad, dim), "bridge_lad_region")


def price_sums(prices: DataFrame, bridge: DataFrame, dim: DataFrame, bridge_rows: int | None = None,
               dim_rows: int | None = None) -> DataFrame:
    """``(YearMonth, RegionKey, _s, _n)``: exact sum and count of the district prices of a month and region.

    District names are matched
    case- and padding-insensitively (the source relies on its collation for this).
    ``bridge_rows`` (the written bridge's row count) bounds the district side: within the
    broadcast limit the prices meet it map-side and are shuffled once, as sums per month and region;
    beyond it they are reduced per district before a shuffle join.
    """
    p = prices.select(
        month_start("Date").alias("YearMonth"),
        norm("RegionName").alias("_dk"),
        F.col("AveragePrice").cast(MONEY).alias("_p"),
    )
    # copies of a bridge row are collapsed into a weight before the join (a district repeated
    # in the lookup multiplies its price rows, exactly as the row-level join does)
    districts = (
        bridge.select(norm("LAD23NM").alias("_dk"), "RegionKey")
        .join(size_checked_broadcast(dim.select("RegionKey"), dim_rows), "RegionKey")
        .groupBy("_dk", "RegionKey")
        .agg(F.count(F.lit(1)).alias("_m"))
    )
    if within_limit(districts, bridge_rows):
        # map-side join straight off the scan; the one exchange carries (month, region) sums
        parts = p.select("YearMonth", "_dk", F.col("_p").alias("_s"), F.col("_p").isNotNull().cast("bigint").alias("_n"))
        joined = parts.join(F.broadcast(districts), "_dk")
    else:
        # both sides shuffle by district: reduce the prices first, so that a district with a third
        # of all rows is collapsed map-side
        parts = p.groupBy("YearMonth", "_dk").agg(F.sum("_p").alias("_s"), F.count("_p").alias("_n"))
        joined = parts.join(districts, "_dk")
    return joined.groupBy("YearMonth", "RegionKey").agg(
        F.sum(F.col("_s") * F.col("_m").cast("decimal(20,0)")).alias("_s"), F.sum(F.col("_n") * F.col("_m")).alias("_n"))


def fact_house_price_unchecked(prices: DataFrame, bridge: DataFrame, dim: DataFrame,
                               bridge_rows: int | None = None, dim_rows: int | None = None) -> DataFrame:
    """Monthly regional price = unweighted mean of the district rows (see :func:`price_sums`), before
    NOT NULL rules: ``(YearMonth, RegionKey, AveragePrice DECIMAL(18,2))``."""
    sums = price_sums(prices, bridge, dim, bridge_rows, dim_rows)
    return sums.select("YearMonth", "RegionKey", round_half_up_cents("_s", "_n").alias("AveragePrice"))


def fact_house_price(prices: DataFrame, bridge: DataFrame, dim: DataFrame,
                     bridge_rows: int | None = None, dim_rows: int | None = None) -> DataFrame:
    return enforce(fact_house_price_unchecked(prices, bridge, dim, bridge_rows, dim_rows), "fact_house_price")


def dim_date(spark: SparkSession, start: str = DATE_START, end: str = DATE_END) -> DataFrame:
    """One row per day: ``(DateValue, YEAR, MONTH, MonthName, YearMonthKey)``.

    Generated from ``spark.range`` (split across tasks) rather than a recursive CTE.
    """
    d0 = _dt.date.fromisoformat(start)
    days = (_dt.date.fromisoformat(end) - d0).days + 1
    d = F.date_add(F.lit(d0), F.col("id").cast("int"))
    return (
        spark.range(0, max(days, 0))
        .select(d.alias("DateValue"))
        .select(
            "DateValue",
            F.year("DateValue").alias("YEAR"),
            F.month("DateValue").alias("MONTH"),
            F.date_format("DateValue", "MMMM").alias("MonthName"),
            (F.year("DateValue") * 100 + F.month("DateValue")).alias("YearMonthKey"),
        )
    )
