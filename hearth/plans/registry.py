"""Every query the library answers, keyed by name: ``QUERIES[name](spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.operators import cleaning as C
from hearth.plans import csv_round
from hearth.plans.checks import CHECKS
from hearth.plans.context import Housing, housing
from hearth.plans.insights import INSIGHTS, q10_national_trend
from hearth.plans.views import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

# Presentation order of the source's queries (``ORDER BY``). Spark's default null ordering
# (ASC nulls first, DESC nulls last) is the source engine's, so plain asc/desc reproduce it.
# The results are small (regions x years), so the global sort is cheap. ``-col`` = descending.
ORDER: dict[str, list[str]] = {
    "q1a_price_vs_rent_left": ["Year", "RegionName"],
    "q1b_price_vs_rent_inner": ["Year", "RegionName"],
    "q2_price_yoy": ["RegionName", "Year"],
    "q3_price_to_rent": ["Year", "RegionName"],
    "q4_price_to_earnings": ["Year", "RegionName"],
    "q5_growth_rank": ["Year", "GrowthRank"],
    "q6_rent_rank": ["Year", "RentRank_Highest"],
    "q7_price_rent_corr": ["RegionName"],
    "q7b_overlap_years": ["-OverlappingYears"],
    "q8_price_to_income": ["Year", "RegionName"],
    "q8n_national_price_to_income": ["Year"],
    "q9_rent_to_income": ["Year", "RegionName"],
    "q9a_rent_to_income_region": ["-RentToIncomeRatio"],
    "q10_national_trend": ["Year"],
    "dq_rent_regions_per_year": ["-PeriodEndYear"],
    "dq_rent_rows_per_region": ["Region"],
    "dq_rent_unmatched_regions": ["Region"],
    "dq_lad_region_names": ["RGN23NM"],
    "dq_lad_unmatched_regions": ["ONS_Region"],
    "dq_lads_per_region": ["RegionName"],
    "dq_rent_years": ["PeriodEndYear"],
    "dq_earnings_years": ["Year"],
}


def _sort_key(c: str) -> F.Column:
    return F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc()


def _ordered(fn: Callable[[Housing], DataFrame], order: list[str] | None) -> Callable[[Housing], DataFrame]:
    def run(h: Housing) -> DataFrame:
        df = fn(h)
        return df.orderBy(*[_sort_key(c) for c in order]) if order else df

    return run


def _on(fn: Callable[[Housing], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(housing(spark, sf_dir))

    return run


MODEL_QUERIES: dict[str, Callable[[Housing], DataFrame]] = {
    "dim_region": lambda h: h.model.dim_region,
    "bridge_lad_region": lambda h: h.model.bridge,
    "fact_earnings": lambda h: h.model.fact_earnings,
    "fact_rent": lambda h: h.model.fact_rent,
    "fact_house_price": lambda h: h.model.fact_house_price,
}

CLEANING_QUERIES: dict[str, Callable[[Housing], DataFrame]] = {
    "clean_money_int": lambda h: h.cleaned.earnings_int,
    "failed_conversion_count": lambda h: C.failed_conversion_count(
        h.cleaned.earnings_int, "Median_Annual_Earnings", "Median_Annual_Earnings_int"),
    "swap_clean_column": lambda h: h.cleaned.earnings,
    "drop_throwaway": lambda h: h.cleaned.rents_trimmed_cols,
    "clean_count_int": lambda h: h.cleaned.rents_int,
    "failed_conversion_rows": lambda h: C.failed_conversion_rows(h.cleaned.rents_int, "Median", "Median_int"),
    "blank_to_null": lambda h: h.cleaned.rents_blank_null,
    "null_violations": lambda h: C.null_violations(h.cleaned.rents_blank_null, ["Median_int", "Region", "PeriodLabel"]),
    "drop_blank_rows": lambda h: h.cleaned.rents_deleted,
    "remap_value": lambda h: h.cleaned.rents,
    "upper_trim": lambda h: h.cleaned.prices,
    "widen_decimal": lambda h: C.widen_decimal(h.cleaned.earnings, ["Median_Annual_Earnings"]),
    # the rent fact as its reload after the label fix left it, before its NOT NULL rules
    "reload_after_fix": lambda h: h.model.unchecked["fact_rent"],
}

INSIGHT_QUERIES: dict[str, Callable[[Housing], DataFrame]] = {
    name: (lambda fn: (lambda h: fn(h.model)))(fn) for name, fn in INSIGHTS.items()
}
INSIGHT_QUERIES["q10_national_trend"] = lambda h: q10_national_trend(h.model, h.trend_years)

# The calendar dimension and its wrapper view are generated from two date parameters, not read
# from the inputs, so they are not registered as queries (their work would not grow with the
# data); the calendar is part of the model, used by every calendar-aware query, and tested
# directly (tests/test_cleaning_and_model.py::test_dim_date_bounds).
NOT_REGISTERED = {"vw_dim_date"}

VIEW_QUERIES: dict[str, Callable[[Housing], DataFrame]] = {
    name: (lambda fn: (lambda h: fn(h.model)))(fn) for name, fn in VIEWS.items() if name not in NOT_REGISTERED
}

# every query as a function of a workspace (test tables or raw files: ``Housing.from_raw``)
HOUSING_QUERIES: dict[str, Callable[[Housing], DataFrame]] = {
    name: _ordered(fn, ORDER.get(name))
    for group in (MODEL_QUERIES, CLEANING_QUERIES, CHECKS, INSIGHT_QUERIES, VIEW_QUERIES)
    for name, fn in group.items()
}

# the same queries over the test tables in ``sf_dir`` (one shared workspace per folder)
QUERIES: dict[str, Query] = {name: _on(fn) for name, fn in HOUSING_QUERIES.items()} | {
    # the CSV import, over files made of the orders
    "import_csv_prices": csv_round.imported_prices,
    "import_csv_rejected": csv_round.rejected_lines,
}


def run_query(h: Housing, name: str) -> DataFrame:
    """Run a registered query by name on a workspace."""
    return HOUSING_QUERIES[name](h)
