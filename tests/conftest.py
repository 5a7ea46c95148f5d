from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("hearth-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # use the session's checkpoint folder; set one only where none is configured
    if not s.conf.get("spark.checkpoint.dir", None) and s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hearth-test-ckpt-"))
    yield s
    s.stop()


def money(x) -> Decimal | None:
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def month(y: int, m: int = 1) -> dt.date:
    return dt.date(y, m, 1)


def literal_model(spark, regions, prices=(), rents=(), earnings=(), bridge=None,
                  date_start="1995-01-01", date_end="2025-12-31"):
    """A Model from literal rows.

    regions: [(key, name)]; prices: [(date, key, price)]; rents: [(year, key, rent)];
    earnings: [(year, key, earnings)]; bridge: [(lad_code, lad_name, key)] (default: one
    district per region named ``<region>-D``).
    """
    from hearth.operators import model as M
    from hearth.plans.pipeline import Model

    dim = spark.createDataFrame(
        [(k, f"E{k:08d}", n, "England") for k, n in regions],
        "RegionKey bigint, RegionCode string, RegionName string, Country string")
    names = dict(regions)
    if bridge is None:
        bridge = [(f"D{k:08d}", f"{n}-D", k) for k, n in regions]
    br = spark.createDataFrame(
        [(c, n, k, f"E{k:08d}", names[k]) for c, n, k in bridge],
        "LAD23CD string, LAD23NM string, RegionKey bigint, RegionCode string, RegionName string")
    fhp = spark.createDataFrame([(d, k, money(p)) for d, k, p in prices],
                                "YearMonth date, RegionKey bigint, AveragePrice decimal(18,2)")
    fr = spark.createDataFrame([(y, k, money(r)) for y, k, r in rents],
                               "PeriodEndYear int, RegionKey bigint, MedianMonthlyRent decimal(18,2)")
    fe = spark.createDataFrame([(y, k, money(e)) for y, k, e in earnings],
                               "Year int, RegionKey bigint, Median_Annual_Earnings decimal(18,2)")
    return Model(dim, M.dim_date(spark, date_start, date_end), br, fe, fr, fhp)


def rows(df, *cols):
    """Rows as tuples in a deterministic order (sorted on all selected columns)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))
