"""The monthly price fact kept up to date month by month.

The fact's mean is a sum and a count, so a table of (month, region, sum, count), partitioned by
month, is all that has to be kept: a changed month is summed again from its own prices and replaces
one partition, and the means are read off the sums.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.functions.measures import round_half_up_cents
from hearth.functions.text import month_start
from hearth.operators.model import enforce, price_sums
from hearth.session import file_names, remove_folder

STATES = T.StructType([T.StructField("RegionKey", T.LongType()), T.StructField("s", T.DecimalType(38, 2)),
                       T.StructField("n", T.LongType()), T.StructField("YearMonth", T.DateType())])


def month_marks(prices: DataFrame) -> DataFrame:
    """(YearMonth, rows, mark) of imported prices: two imports of a month with equal marks hold the same rows."""
    row = F.xxhash64("Date", "RegionName", "AveragePrice").cast("decimal(38,0)")
    return prices.where("Date IS NOT NULL").groupBy(month_start("Date").alias("YearMonth")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row).cast("decimal(38,0)").alias("mark"))


def changed_months(before: DataFrame, after: DataFrame) -> list[dt.date]:
    """Months whose rows differ between two imports (a calendar's worth of values at most)."""
    a, b = month_marks(before), month_marks(after)
    both = a.alias("a").join(b.alias("b"), "YearMonth", "full_outer")
    differs = ~(F.col("a.rows").eqNullSafe(F.col("b.rows")) & F.col("a.mark").eqNullSafe(F.col("b.mark")))
    return sorted(r.YearMonth for r in both.where(differs).select("YearMonth").collect())


class MonthlyPrices:
    """``fact_house_price`` over partial states under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")

    def rebuild(self, prices: DataFrame, bridge: DataFrame, dim: DataFrame, bridge_rows: int | None = None,
                dim_rows: int | None = None) -> None:
        """Sum all months."""
        self._write(price_sums(prices, bridge, dim, bridge_rows, dim_rows), "static")

    def refresh(self, months: Iterable[dt.date], prices: DataFrame, bridge: DataFrame, dim: DataFrame,
                bridge_rows: int | None = None, dim_rows: int | None = None) -> None:
        """Sum these months again; only their partitions are written, and only their prices are read
        as far as the files allow. A month without prices loses its partition."""
        months = sorted({m.replace(day=1) for m in months})
        if not months:
            return
        date, inside = F.col("Date").cast("date"), F.lit(False)
        for m in months:
            after = (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
            inside = inside | ((date >= F.lit(m)) & (date < F.lit(after)))
        self._write(price_sums(prices.where(inside), bridge, dim, bridge_rows, dim_rows), "dynamic")
        have = {r.YearMonth for r in self.states().where(F.col("YearMonth").isin(months)).select("YearMonth").distinct().collect()}
        present = {r.YearMonth for r in prices.where(inside).select(month_start("Date").alias("YearMonth")).distinct().collect()}
        for m in sorted(have - present):
            remove_folder(self._spark, f"{self._path}/YearMonth={m.isoformat()}", self._path)

    def _write(self, sums: DataFrame, mode: str) -> None:
        rows = sums.where("YearMonth IS NOT NULL").select(
            "RegionKey", F.col("_s").cast("decimal(38,2)").alias("s"), F.col("_n").cast("bigint").alias("n"), "YearMonth")
        # few rows for a month: one file a partition
        (rows.repartition("YearMonth").write.mode("overwrite").option("partitionOverwriteMode", mode)
         .partitionBy("YearMonth").parquet(self._path))

    def states(self) -> DataFrame:
        """(RegionKey, s, n, YearMonth); empty before the first build."""
        if not any(name.startswith("YearMonth=") for name in file_names(self._spark, self._path)):
            return self._spark.createDataFrame([], STATES)
        return self._spark.read.schema(STATES).parquet(self._path)

    def fact(self) -> DataFrame:
        """``(YearMonth, RegionKey, AveragePrice)`` with its NOT NULL rules applied."""
        means = self.states().select("YearMonth", "RegionKey", round_half_up_cents("s", "n").alias("AveragePrice"))
        return enforce(means, "fact_house_price")
