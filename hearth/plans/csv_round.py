"""The price import through CSV files, over the test tables.

Orders are written as publishers' files would come - two folders with different column orders and a
column nobody asked for, names with separators and quotes, some dates and amounts that do not parse -
and imported again by their headers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions.measures import MONEY
from hearth.session import new_run_dir
from hearth.sources.csv_import import CsvImport
from hearth.sources.files import import_raw
from hearth.sources.tpch import read_table

# Injected defects, by order key.
BAD_DATE_MOD = 501
BAD_PRICE_MOD = 502


def write_price_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the prices of all orders as CSV files under ``path``."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    key = F.col("o_orderkey")
    date = F.when(key % BAD_DATE_MOD == 0, F.lit("not a date")).otherwise(F.col("o_orderdate").cast("date").cast("string"))
    price = F.when(key % BAD_PRICE_MOD == 0, F.lit("12x")).otherwise(F.col("o_totalprice").cast(MONEY).cast("string"))
    name = F.concat(F.lit('District "'), F.col("o_custkey").cast("string"), F.lit('", somewhere'))
    rows = o.select(key, date.alias("Date"), name.alias("RegionName"), price.alias("AveragePrice"), F.lit("n/a").alias("Note"))
    for folder, rest, order in (("a", 0, ["AveragePrice", "Note", "RegionName", "Date"]), ("b", 1, ["RegionName", "Date", "AveragePrice"])):
        rows.where(key % 2 == rest).select(*order).write.option("header", True).csv(f"{path}/{folder}")


def import_prices(spark: SparkSession, sf_dir: str) -> CsvImport:
    """Write the price files and import them by their headers."""
    root = new_run_dir(spark, "csv")
    write_price_files(spark, sf_dir, f"{root}/files")
    return import_raw(spark, "district_prices", f"{root}/files", f"{root}/imported")


def imported_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows whose every field parses."""
    return import_prices(spark, sf_dir).good


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of rejected lines by the columns that failed."""
    return import_prices(spark, sf_dir).rejected.groupBy("failed_columns").agg(F.count(F.lit(1)).alias("lines"))
