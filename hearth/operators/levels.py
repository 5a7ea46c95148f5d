"""Hierarchy operators: one mean per (time, level member) and income ratios between levels.

Levels: ``national`` (mean over region rows), ``region`` (mean per region name) and ``lad``
(every district inherits the rows of its region through the bridge, so a district carries its
region's value — the source defines the district views this way).

Scale: national and region means are one aggregation (the bounded region dimension is joined
map-side). For districts the fact is first reduced to one (sum, count) pair per
(time, RegionKey) — at most as many rows as the written fact, a bound checked before it is
broadcast into the district fan-out. The bridge is hash-partitioned by district name once, into
as many partitions as the fan-out's row count asks for, and collapsed there to distinct (district,
region) pairs with a copy count; the fan-out (districts x time values, the view's inherent output
size) is aggregated in place: no exchange moves the fan-out rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions.measures import MONEY, exact_avg, exact_mean, nullif_ratio
from hearth.operators.joins import size_checked_broadcast

if TYPE_CHECKING:
    from hearth.plans.pipeline import Model

LEVELS = ("national", "region", "lad")


@dataclass(frozen=True)
class Measure:
    time_col: str
    value_col: str
    out_cols: dict[str, str]  # level -> output column name


# Output column names of the published views.
MEASURES = {
    "price": Measure("YearMonth", "AveragePrice",
                     {"national": "National_AvgPrice", "region": "Region_AvgPrice", "lad": "LAD_AvgPrice"}),
    "rent": Measure("PeriodEndYear", "MedianMonthlyRent",
                    {"national": "National_AvgMonthlyRent", "region": "Region_AvgMonthlyRent",
                     "lad": "LAD_AvgMonthlyRent"}),
    "earnings": Measure("Year", "Median_Annual_Earnings",
                        {"national": "National_AvgAnnualEarnings", "region": "Region_AvgAnnualEarnings",
                         "lad": "LAD_AvgAnnualEarnings"}),
}
MEMBER_COL = {"national": None, "region": "RegionName", "lad": "LADName"}


def per_region(fact: DataFrame, time_col: str, value_col: str) -> DataFrame:
    """(time, RegionKey, _s, _n): exact partial sums, one row per region and time value."""
    v = F.col(value_col).cast(MONEY)
    return fact.groupBy(time_col, "RegionKey").agg(F.sum(v).alias("_s"), F.count(v).alias("_n"))


# Rows of the district fan-out made by one task, about, and from which two tasks share it.
FAN_OUT_ROWS = 100_000
SHARED_ROWS = 10_000
MAX_FAN_OUT_TASKS = 20_000


def fan_out_tasks(model_rows: int | None, bridge_rows: int | None, region_rows: int | None, default: int) -> int:
    """Tasks for a fan-out of the bridge over a fact: each district gets the rows of its region, so
    about bridge rows x fact rows / regions are made, whatever few bytes the bridge itself has.
    ``default`` where a count is unknown."""
    if model_rows is None or bridge_rows is None or region_rows is None:
        return default
    made = bridge_rows * model_rows // max(1, region_rows)
    return min(MAX_FAN_OUT_TASKS, max(2 if made > SHARED_ROWS else 1, -(-made // FAN_OUT_ROWS)))


def districts_by_name(bridge: DataFrame, tasks: int | None = None) -> DataFrame:
    """Distinct (district, region) pairs with their number of copies ``_m``, hash-partitioned by
    district name into ``tasks`` partitions (an explicit number, which adaptive execution does not
    coalesce by the bridge's few bytes). One exchange: the pairs are counted behind it, in place.

    Copies of a bridge row only multiply a district's rows, so they are carried as a weight: a
    district with a third of all bridge rows costs one row of the fan-out, not a third of it.
    """
    # a NULL region key can never match the join on RegionKey that follows, so those rows are
    # dropped before the shuffle (a NULL district name stays: it is a group of its own)
    keyed = bridge.filter(F.col("RegionKey").isNotNull()).select(
        F.col("LAD23NM").alias("LADName"), "RegionKey", "RegionName")
    tasks = tasks or int(bridge.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(tasks, "LADName").groupBy("LADName", "RegionKey", "RegionName").agg(
        F.count(F.lit(1)).alias("_m"))


def _times_copies(c: str) -> Column:
    return F.col(c) * F.col("_m").cast("decimal(20,0)") if c in ("_s", "_es") else F.col(c) * F.col("_m")


def avg_by_level(
    fact: DataFrame,
    level: str,
    time_col: str,
    value_col: str,
    out_col: str,
    dim_region: DataFrame | None = None,
    bridge: DataFrame | None = None,
    fact_rows: int | None = None,
    tasks: int | None = None,
    region_rows: int | None = None,
    with_regions: bool = False,
) -> DataFrame:
    """Mean of ``value_col`` per ``time_col`` (and region / district name for those levels).

    ``fact_rows`` (an upper bound of the fact's rows, e.g. from the written table) lets the
    reduced fact be broadcast into the district fan-out when it is within the broadcast limit;
    ``tasks`` is the fan-out's partition number. ``with_regions`` adds the names of a district's
    regions (``RegionNames``, at most one for each region) from the same aggregate.
    """
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}, got {level!r}")
    if level == "national":
        return fact.groupBy(time_col).agg(exact_avg(value_col).alias(out_col))
    if level == "region":
        if dim_region is None:
            raise ValueError("region level needs dim_region")
        # bounded dimension, map-side join: one aggregation after it
        rows = fact.join(size_checked_broadcast(dim_region.select("RegionKey", "RegionName"), region_rows), "RegionKey")
        return rows.groupBy(time_col, "RegionName").agg(exact_avg(value_col).alias(out_col))
    if bridge is None:
        raise ValueError("lad level needs the bridge")
    # the reduced fact has at most as many rows as the fact: broadcast it when that bound is
    # checked small, and the bridge streams through without moving the fan-out
    parts = per_region(fact, time_col, value_col)
    pairs = districts_by_name(bridge, tasks)
    rows = pairs.join(size_checked_broadcast(parts, fact_rows), "RegionKey")
    mean = exact_mean(F.sum(_times_copies("_s")), F.sum(_times_copies("_n"))).alias(out_col)
    if not with_regions:
        return rows.groupBy(time_col, "LADName").agg(mean)
    # all regions of the district, whether or not they have the time value
    named = pairs.withColumn("RegionNames", F.collect_set("RegionName").over(Window.partitionBy("LADName")))
    rows = named.join(size_checked_broadcast(parts, fact_rows), "RegionKey")
    return rows.groupBy(time_col, "LADName").agg(mean, F.first("RegionNames").alias("RegionNames"))


def _tasks(model: Model, measure: str, level: str) -> int | None:
    if level != "lad":
        return None
    default = int(model.bridge.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fan_out_tasks(_fact_rows(model, measure), model.row_bound("bridge_lad_region"), model.row_bound("dim_region"), default)


def measure_by_level(model: Model, measure: str, level: str, with_regions: bool = False) -> DataFrame:
    """``avg_by_level`` for one of the three model measures (``price``, ``rent``, ``earnings``)."""
    m = MEASURES[measure]
    fact = {"price": model.fact_house_price, "rent": model.fact_rent, "earnings": model.fact_earnings}[measure]
    return avg_by_level(fact, level, m.time_col, m.value_col, m.out_cols[level], model.dim_region, model.bridge,
                        fact_rows=_fact_rows(model, measure), tasks=_tasks(model, measure, level),
                        region_rows=model.row_bound("dim_region"), with_regions=with_regions)


FACT_TABLE = {"price": "fact_house_price", "rent": "fact_rent", "earnings": "fact_earnings"}


def _fact_rows(model: Model, measure: str) -> int | None:
    return model.row_bound(FACT_TABLE[measure])


def _year_of(time_col: str) -> Column:
    return F.year(time_col) if time_col == "YearMonth" else F.col(time_col)


def _district_ratio(model: Model, numerator: str, out_col: str, factor: float) -> DataFrame:
    """District-level ratio with a single fan-out.

    Both district means are sums over the district's region rows. The two reduced facts are
    first paired at region level — every numerator time value with the denominator rows of its
    year, full outer, so a region contributing to only one side still counts for that side —
    which stays bounded by |regions| x |time values|. That table is broadcast into the bridge
    (partitioned by district), and one in-place aggregate yields both district means: the
    district fan-out is never shuffled and never joined with another fan-out.
    """
    num_m, den_m = MEASURES[numerator], MEASURES["earnings"]
    fact = {"price": model.fact_house_price, "rent": model.fact_rent}[numerator]
    t = num_m.time_col
    num = per_region(fact, t, num_m.value_col).withColumn("_hn", F.lit(1))
    den = per_region(model.fact_earnings, den_m.time_col, den_m.value_col).select(
        F.col("Year").alias("_y"), "RegionKey", F.col("_s").alias("_es"), F.col("_n").alias("_en"),
        F.lit(1).alias("_hd"))
    times = num.select(t).distinct()
    den_at = times.join(den, _year_of(t) == F.col("_y")).drop("_y")
    pairs = num.join(den_at, [t, "RegionKey"], "full_outer").fillna(0, ["_n", "_en", "_hn", "_hd"])
    # pairs: the numerator rows plus, per numerator time value, at most one earnings row per
    # region — the reduced earnings come out of a group-by on (year, region) and their keys are
    # dimension keys — so the bound n_num * (1 + n_regions) holds by construction
    n_num, n_reg = _fact_rows(model, numerator), model.row_bound("dim_region")
    bound = n_num * (1 + n_reg) if n_num is not None and n_reg is not None else None
    g = districts_by_name(model.bridge, _tasks(model, numerator, "lad")).join(size_checked_broadcast(pairs, bound), "RegionKey").groupBy(
        t, "LADName").agg(
        *[F.sum(_times_copies(c)).alias(c) for c in ("_s", "_n", "_es", "_en", "_hn", "_hd")])
    num_col, den_col = num_m.out_cols["lad"], den_m.out_cols["lad"]
    # the two district means are joined on the name in the source: a NULL name never matches
    g = g.filter((F.col("_hn") > 0) & (F.col("_hd") > 0) & F.col("LADName").isNotNull()).select(
        t, "LADName", exact_mean("_s", "_n").alias(num_col), exact_mean("_es", "_en").alias(den_col))
    value = F.col(num_col) * F.lit(factor) if factor != 1.0 else F.col(num_col)
    return g.select(t, "LADName", num_col, den_col, nullif_ratio(value, den_col).alias(out_col))


def ratio_by_level(model: Model, numerator: str, level: str, out_col: str, factor: float = 1.0) -> DataFrame:
    """``numerator mean x factor / earnings mean`` joined on year (and member name).

    Division by a zero mean yields NULL instead of an error.
    """
    if level == "lad":
        return _district_ratio(model, numerator, out_col, factor)
    num_m = MEASURES[numerator]
    den_m = MEASURES["earnings"]
    num = measure_by_level(model, numerator, level)
    den = measure_by_level(model, "earnings", level)
    member = MEMBER_COL[level]
    num_col, den_col = num_m.out_cols[level], den_m.out_cols[level]
    cond = _year_of(num_m.time_col) == den["Year"]
    if member:
        cond = cond & (num[member] == den[member])
    value = num[num_col] * F.lit(factor) if factor != 1.0 else num[num_col]
    cols = [num[num_m.time_col]] + ([num[member]] if member else []) + [num[num_col], den[den_col]]
    return num.join(den, cond).select(*cols, nullif_ratio(value, den[den_col]).alias(out_col))
