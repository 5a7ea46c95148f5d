"""The data-quality checks run between the pipeline steps, plus two constraint reports
(declared keys, NOT NULL rules) that stand in for the source's storage-level constraints."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions.text import period_end_year
from hearth.operators import model as M
from hearth.operators import quality as Q
from hearth.plans.context import Housing

LAD_COLUMNS = ["ObjectId", "LAD23CD", "LAD23NM", "RGN23CD", "RGN23NM"]


def _count_orphans(child: DataFrame, parent: DataFrame, alias: str) -> DataFrame:
    return Q.count_where(Q.orphans(child, parent, "RegionKey"), None, alias)


CHECKS: dict[str, Callable[[Housing], DataFrame]] = {
    # region dimension
    "dq_region_null_keys": lambda h: Q.count_where(h.model.dim_region, F.col("RegionKey").isNull(), "NullKeys"),
    "dq_region_dup_code": lambda h: Q.duplicates(h.model.dim_region, ["RegionCode"], "c"),
    "dq_region_dup_name": lambda h: Q.duplicates(h.model.dim_region, ["RegionName"], "c"),
    # rents
    "dq_rent_bad_period": lambda h: h.cleaned.rents_unfixed.filter(period_end_year("PeriodLabel").isNull()),
    "dq_rent_top10": lambda h: Q.top_n(
        h.model.fact_rent, [F.col("PeriodEndYear").desc(), F.col("RegionKey").asc()], 10),
    "dq_rent_regions_per_year": lambda h: Q.rows_per(h.model.fact_rent, ["PeriodEndYear"], "RegionsWithRent"),
    "dq_rent_rows_per_region": lambda h: Q.rows_per(h.cleaned.rents_unfixed, ["Region"], "cnt"),
    "dq_regions_without_rent": lambda h: Q.orphans(h.model.dim_region, h.fact_rent_before_fix, "RegionKey").select(
        "RegionName"),
    "dq_rent_unmatched_regions": lambda h: Q.unmatched_names(
        h.cleaned.rents_unfixed, "Region", h.model.dim_region, "RegionName"),
    # house prices (district level, as imported)
    "dq_price_top10": lambda h: Q.top_n(
        h.cleaned.prices_raw,
        [F.col("Date").desc(), F.col("RegionName").asc(), F.col("AveragePrice").asc_nulls_first()], 10),
    "dq_price_missing_fields": lambda h: h.cleaned.prices.filter(
        F.col("RegionName").isNull() | (F.col("RegionName") == "") | F.col("Date").isNull()
        | F.col("AveragePrice").isNull()),
    "dq_price_dupes": lambda h: Q.duplicates(h.cleaned.prices, ["Date", "RegionName"], "dupes"),
    "dq_price_unmatched_names": lambda h: Q.unmatched_names(
        h.cleaned.prices, "RegionName", h.model.dim_region, "RegionName", normalise_left=False),
    # the check above compares district names with *region* names, so it lists every
    # district; this one compares them with the districts the model can place
    "dq_price_unmatched_districts": lambda h: Q.unmatched_names(
        h.cleaned.prices, "RegionName", h.model.bridge, "LAD23NM"),
    # district lookup
    "dq_lad_total_rows": lambda h: Q.count_where(h.cleaned.lad, None, "TotalRows"),
    "dq_lad_null_profile": lambda h: Q.null_profile(h.cleaned.lad, LAD_COLUMNS),
    "dq_lad_dup_code": lambda h: Q.duplicates(h.cleaned.lad, ["LAD23CD"], "cnt"),
    "dq_lad_region_names": lambda h: Q.distinct_values(h.cleaned.lad, "RGN23NM"),
    "dq_lad_preview": lambda h: Q.top_n(h.cleaned.lad, [F.col("ObjectId").asc()], 10),
    "dq_lad_unmatched_regions": lambda h: Q.unmatched_names(
        h.cleaned.lad, "RGN23NM", h.model.dim_region, "RegionName").select(
        F.col("RGN23NM").alias("ONS_Region"), F.lit(None).cast("string").alias("DimRegion")),
    # bridge
    "dq_bridge_rows": lambda h: Q.count_where(h.model.bridge, None, "RowsInBridge"),
    "dq_bridge_null_region": lambda h: Q.count_where(h.model.bridge, F.col("RegionKey").isNull(), "NullRegionKeys"),
    "dq_lads_per_region": lambda h: Q.rows_per(h.model.bridge, ["RegionName"], "LADs"),
    # house price fact
    "dq_price_null_month": lambda h: Q.count_where(
        h.model.unchecked["fact_house_price"], F.col("YearMonth").isNull(), "NullYears"),
    "dq_price_fact_dupes": lambda h: Q.duplicates(h.model.fact_house_price, ["YearMonth", "RegionKey"], "cnt"),
    "dq_price_no_date": lambda h: Q.rows_per(
        h.model.fact_house_price.join(h.model.dim_date.select(F.col("DateValue").alias("YearMonth")),
                                      "YearMonth", "left_anti"),
        ["YearMonth"], "RowsWithoutMatch"),
    # facts vs dimension
    "dq_rent_orphans": lambda h: _count_orphans(h.model.fact_rent, h.model.dim_region, "MissingRegionKeys_fact_rent"),
    "dq_rent_years": lambda h: Q.rows_per(h.model.fact_rent, ["PeriodEndYear"], "Records"),
    "dq_earnings_orphans": lambda h: _count_orphans(
        h.model.fact_earnings, h.model.dim_region, "MissingRegionKeys_fact_earnings"),
    "dq_earnings_years": lambda h: Q.rows_per(h.model.fact_earnings, ["Year"], "Records"),
}


def declared_keys(h: Housing) -> dict:
    m = h.model
    return {
        "dim_region": (m.dim_region, ["RegionKey"]),
        "dim_region.code": (m.dim_region, ["RegionCode"]),
        "dim_region.name": (m.dim_region, ["RegionName"]),
        "fact_earnings": (m.fact_earnings, ["Year", "RegionKey"]),
        "fact_rent": (m.fact_rent, ["PeriodEndYear", "RegionKey"]),
        "bridge_lad_region": (m.bridge, ["LAD23CD"]),
        "bridge_lad_region.name": (m.bridge, ["LAD23NM"]),
        "fact_house_price": (m.fact_house_price, ["YearMonth", "RegionKey"]),
        "dim_date": (m.dim_date, ["DateValue"]),
    }


def not_null_rules(h: Housing) -> dict:
    """Tables as they are *before* each NOT NULL rule is enforced."""
    c, m = h.cleaned, h.model
    rules = {
        "rents": (c.rents_deleted, ["Median_int", "Region", "PeriodLabel"]),
        "dim_region": (m.dim_region, ["RegionKey"]),
    }
    for table in ("fact_rent", "bridge_lad_region", "fact_house_price", "fact_earnings"):
        rules[table] = (m.unchecked[table], M.NOT_NULL[table])
    rules["dim_date"] = (m.dim_date, ["DateValue"])
    return rules


CHECKS["dq_unique_keys"] = lambda h: Q.key_violations(declared_keys(h))
CHECKS["dq_not_null"] = lambda h: Q.not_null_violations(not_null_rules(h))
