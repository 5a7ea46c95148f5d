"""Map the TPC-H-shaped test tables onto the five raw housing inputs.

Region = nation (the nations of one continent play the country's regions), district =
customer, a district's monthly price = an order's total, rents and earnings = yearly means of
line-item prices per supplier nation. All text columns are rendered the way the publishers'
files look (currency signs, thousands separators, padding, upper-case names), so the whole
cleaning pipeline runs on them.

With ``dirty=True`` (the default) a deterministic set of defects is injected so that every
data-quality check has something to find; the rules are plain functions of the keys, so they
scale with the tables and the DuckDB oracle reproduces them exactly.

Scale notes: line items are pre-aggregated to (year, supplier) *before* the supplier join, so
the shuffle carries one row per supplier-year instead of one per line item, and a hot supplier
is collapsed map-side. ``nation`` and ``region`` are fixed-size in TPC-H (25 and 5 rows at every
scale factor), which is the proven bound that justifies broadcasting them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions.measures import MONEY, exact_mean
from hearth.operators.joins import heavy_key_join, within_limit

# Fixed values of the test mapping.
COUNTRY = "EUROPE"                      # plays the role of the source's 'ENGLAND' filter
RENT_DIVISOR = 20                       # monthly rent = yearly mean line price / 20
REMAP = {"N18": "NATION_18"}            # label fix applied after the first rent load
TREND_YEARS = (1996, 1997, 1998)        # years of the national trend report

# Injected defects (dirty variant).
MONEY_FAIL_MOD = 7                      # n_nationkey % 7 = 0 -> money text 'n/a'
BLANK_NATION = 24                       # rent rows of this nation become ('', ' ', NULL)
RENAMED_NATION, RENAMED_LABEL = "NATION_18", "n18"
UNLISTED_NATION, UNLISTED_LABEL = "NATION_23", "Unlisted"  # rent label that matches no region
NO_RENT_BEFORE = 1997                   # earlier rent medians are text that does not convert
DUP_ORDER_MOD = 500                     # o_orderkey % 500 = 0 -> price row appears twice
NULL_PRICE_MOD = 777                    # o_orderkey % 777 = 0 -> NULL price
BLANK_NAME_MOD = 778                    # o_orderkey % 778 = 0 -> blank district name
ATLANTIS_MOD = 100                      # c_custkey % 100 = 0 -> unknown region 'Atlantis'
BAD_PERIOD_NATION, BAD_PERIOD_YEAR = 3, 1999  # rent label 'unknown'


@dataclass(frozen=True)
class RawInputs:
    regions: DataFrame    # RegionCode, RegionName, Country
    lad: DataFrame        # ObjectId, LAD23CD, LAD23NM, RGN23CD, RGN23NM
    prices: DataFrame     # Date, RegionName, AveragePrice
    rents: DataFrame      # Region, PeriodLabel, Median, throwaway1, throwaway2
    earnings: DataFrame   # Year, Region_name, Median_Annual_Earnings


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Parquet scan pruned to ``cols`` (the ReadSchema holds only these columns)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def _region_code(nationkey: F.Column) -> F.Column:
    return F.concat(F.lit("E"), F.lpad(nationkey.cast("string"), 8, "0"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        _region_code(F.col("n_nationkey")).alias("RegionCode"),
        F.col("n_name").alias("RegionName"),
        F.col("r_name").alias("Country"),
    )


def lad_lookup(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    rgn = F.col("n_name")
    if dirty:
        rgn = F.when(F.col("c_custkey") % ATLANTIS_MOD == 0, F.lit("Atlantis")).otherwise(rgn)
    return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").cast("bigint").alias("ObjectId"),
        F.concat(F.lit("C"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("LAD23CD"),
        F.col("c_name").alias("LAD23NM"),
        _region_code(F.col("n_nationkey")).alias("RGN23CD"),
        rgn.alias("RGN23NM"),
    )


def prices(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    if dirty:
        # duplicate a slice of rows in the same pass (no second scan or join)
        copies = F.when(F.col("o_orderkey") % DUP_ORDER_MOD == 0, 2).otherwise(1)
        o = o.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("_copy")
    name = F.upper(F.col("c_name"))
    price = F.col("o_totalprice").cast(MONEY)
    if dirty:
        name = F.when(F.col("o_orderkey") % BLANK_NAME_MOD == 0, F.lit("")).otherwise(name)
        price = F.when(F.col("o_orderkey") % NULL_PRICE_MOD == 0, F.lit(None).cast(MONEY)).otherwise(price)
    return _with_customers(o, c).select(
        F.col("o_orderdate").cast("date").alias("Date"),
        name.alias("RegionName"),
        price.alias("AveragePrice"),
    )


def _with_customers(orders: DataFrame, customers: DataFrame, customer_rows: int | None = None) -> DataFrame:
    """Orders with their customer. Customers of a checked size (counted from the Parquet footers) are
    joined map-side; beyond it only the customers with a large share of the orders are."""
    rows = customers.count() if customer_rows is None else customer_rows
    if within_limit(customers, rows):
        return orders.join(F.broadcast(customers), F.col("o_custkey") == F.col("c_custkey"))
    return heavy_key_join(orders, customers, "o_custkey", "c_custkey")


def nation_year_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(y, n_nationkey, n_name, mean line price) with an exact mean."""
    li = read_table(spark, sf_dir, "lineitem", "l_suppkey", "l_extendedprice", "l_shipdate")
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    price = F.col("l_extendedprice").cast(MONEY)
    per_supplier = li.groupBy(F.year("l_shipdate").alias("y"), "l_suppkey").agg(
        F.sum(price).alias("s"), F.count(price).alias("n")
    )
    return (
        per_supplier.join(s, per_supplier.l_suppkey == s.s_suppkey)
        .join(F.broadcast(n), F.col("s_nationkey") == n.n_nationkey)
        .groupBy("y", "n_nationkey", "n_name")
        .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        .select("y", "n_nationkey", "n_name", exact_mean("s", "n").alias("mean_price"))
    )


def rents(means: DataFrame, dirty: bool = True) -> DataFrame:
    y, key, name = F.col("y"), F.col("n_nationkey"), F.col("n_name")
    label = F.concat(F.lit("Apr "), (y - 1).cast("string"), F.lit(" to Mar "), y.cast("string"))
    median = F.concat(F.lit(" "), F.format_number(F.floor(F.col("mean_price") / RENT_DIVISOR), 0))
    region = name
    if dirty:
        region = F.when(name == RENAMED_NATION, F.lit(RENAMED_LABEL)).when(
            name == UNLISTED_NATION, F.lit(UNLISTED_LABEL)).otherwise(name)
        label = F.when((key == BAD_PERIOD_NATION) & (y == BAD_PERIOD_YEAR), F.lit("unknown")).otherwise(label)
        median = F.when((key % MONEY_FAIL_MOD == 0) | (y < NO_RENT_BEFORE), F.lit("n/a")).otherwise(median)
    region = F.concat(F.lit("  "), region, F.lit(" "))
    if dirty:
        blank = key == BLANK_NATION
        region = F.when(blank, F.lit("")).otherwise(region)
        label = F.when(blank, F.lit(" ")).otherwise(label)
        median = F.when(blank, F.lit(None).cast("string")).otherwise(median)
    return means.select(
        region.alias("Region"),
        label.alias("PeriodLabel"),
        median.alias("Median"),
        F.lit("import").alias("throwaway1"),
        y.cast("string").alias("throwaway2"),
    )


def earnings(means: DataFrame, dirty: bool = True) -> DataFrame:
    money = F.concat(F.lit("£"), F.format_number(F.floor(F.col("mean_price")), 0))
    if dirty:
        money = F.when(F.col("n_nationkey") % MONEY_FAIL_MOD == 0, F.lit("n/a")).otherwise(money)
    return means.select(
        F.col("y").cast("int").alias("Year"),
        F.col("n_name").alias("Region_name"),
        money.alias("Median_Annual_Earnings"),
    )


def raw_inputs(spark: SparkSession, sf_dir: str, dirty: bool = True, means: DataFrame | None = None) -> RawInputs:
    """The five raw inputs. ``means`` may be a written copy of :func:`nation_year_means` (one
    row per nation-year) so that line items are scanned once for both rents and earnings."""
    means = nation_year_means(spark, sf_dir) if means is None else means
    return RawInputs(
        regions=regions(spark, sf_dir),
        lad=lad_lookup(spark, sf_dir, dirty),
        prices=prices(spark, sf_dir, dirty),
        rents=rents(means, dirty),
        earnings=earnings(means, dirty),
    )
