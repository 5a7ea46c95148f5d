"""Readers for the raw housing inputs as they arrive from the publishers (CSV or Parquet).

Schemas are declared, never inferred: the money/count columns are *text* on purpose (they
carry currency signs and thousands separators that the cleaning operators remove).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hearth.sources.csv_import import CsvImport, import_csv, read_csv

RAW_SCHEMAS: dict[str, T.StructType] = {
    "earnings": T.StructType(
        [
            T.StructField("Year", T.IntegerType()),
            T.StructField("Region_name", T.StringType()),
            T.StructField("Median_Annual_Earnings", T.StringType()),
        ]
    ),
    "rents": T.StructType(
        [
            T.StructField("Region", T.StringType()),
            T.StructField("PeriodLabel", T.StringType()),
            T.StructField("Median", T.StringType()),
            T.StructField("throwaway1", T.StringType()),
            T.StructField("throwaway2", T.StringType()),
        ]
    ),
    "regions": T.StructType(
        [
            T.StructField("RegionCode", T.StringType()),
            T.StructField("RegionName", T.StringType()),
            T.StructField("Country", T.StringType()),
        ]
    ),
    "district_prices": T.StructType(
        [
            T.StructField("Date", T.DateType()),
            T.StructField("RegionName", T.StringType()),
            T.StructField("AveragePrice", T.DecimalType(18, 2)),
        ]
    ),
    "district_region_lookup": T.StructType(
        [
            T.StructField("ObjectId", T.LongType()),
            T.StructField("LAD23CD", T.StringType()),
            T.StructField("LAD23NM", T.StringType()),
            T.StructField("RGN23CD", T.StringType()),
            T.StructField("RGN23NM", T.StringType()),
        ]
    ),
}


def read_raw(spark: SparkSession, table: str, path: str, fmt: str = "csv", bad: str = "fail", **options) -> DataFrame:
    """Read one raw input with its declared schema. CSV columns are found by their names in the
    header, and a line that does not parse stops the job, or (``bad="null"``) has nulls; to set such
    lines aside use :func:`import_raw`."""
    schema = RAW_SCHEMAS[table]
    if fmt == "csv":
        return read_csv(spark, schema, path, bad, **options)
    reader = spark.read.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.format(fmt).load(path)


def import_raw(spark: SparkSession, table: str, path: str, into: str | None = None, **options) -> CsvImport:
    """Import one raw CSV input with its declared schema: good rows, rejected lines and their counts."""
    return import_csv(spark, RAW_SCHEMAS[table], path, into, **options)


def write_table(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Full rebuild of a table: overwrite ``path`` with ``df`` and return a reader of the written
    copy (with the known schema, so no footer is read). For tables that are replaced while they are
    read see ``hearth.sources.versions``."""
    df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.schema(df.schema).format(fmt).load(path)
