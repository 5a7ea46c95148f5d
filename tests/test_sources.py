"""The test mapping: every injected defect is present exactly as specified, checked against a
brute-force computation on the Parquet files with pandas."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hearth.sources import RAW_SCHEMAS, tpch

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw(spark):
    return tpch.raw_inputs(spark, SF_SMALL)


@pytest.fixture(scope="module")
def tables():
    return {t: pd.read_parquet(f"{SF_SMALL}/{t}.parquet") for t in ("orders", "customer", "nation", "region")}


def test_schemas_are_the_declared_raw_schemas(raw):
    for name, df in {"regions": raw.regions, "district_region_lookup": raw.lad, "district_prices": raw.prices,
                     "rents": raw.rents, "earnings": raw.earnings}.items():
        assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == \
               [(f.name, f.dataType.simpleString()) for f in RAW_SCHEMAS[name].fields], name


def test_price_defects(raw, tables):
    o = tables["orders"].merge(tables["customer"], left_on="o_custkey", right_on="c_custkey")
    dup = (o.o_orderkey % tpch.DUP_ORDER_MOD == 0).sum()
    assert raw.prices.count() == len(o) + dup
    assert raw.prices.filter(F.col("AveragePrice").isNull()).count() == \
        ((o.o_orderkey % tpch.NULL_PRICE_MOD == 0) * (1 + (o.o_orderkey % tpch.DUP_ORDER_MOD == 0))).sum()
    assert raw.prices.filter(F.col("RegionName") == "").count() == \
        ((o.o_orderkey % tpch.BLANK_NAME_MOD == 0) * (1 + (o.o_orderkey % tpch.DUP_ORDER_MOD == 0))).sum()


def test_lookup_and_regions(raw, tables):
    c = tables["customer"]
    assert raw.lad.count() == len(c)
    assert raw.lad.filter(F.col("RGN23NM") == "Atlantis").count() == (c.c_custkey % tpch.ATLANTIS_MOD == 0).sum()
    europe = tables["nation"].merge(tables["region"], left_on="n_regionkey", right_on="r_regionkey")
    expected = set(europe[europe.r_name == tpch.COUNTRY].n_name)
    got = {r[0] for r in raw.regions.filter(F.upper("Country") == tpch.COUNTRY).select("RegionName").collect()}
    assert got == expected and len(got) == 5


def test_rent_and_earnings_defects(raw):
    rents = raw.rents.toPandas()
    assert not rents.Region.str.contains("NATION_23").any()                      # dropped region
    assert (rents.Region.str.strip() == tpch.RENAMED_LABEL).any()                 # label to fix
    assert (rents.PeriodLabel == "unknown").sum() == 1                            # bad period
    blank = rents[rents.Region == ""]
    assert len(blank) > 0 and (blank.PeriodLabel == " ").all() and blank.Median.isna().all()
    assert (rents.Median == "n/a").any()                                          # unparseable count
    earn = raw.earnings.toPandas()
    assert (earn.Median_Annual_Earnings == "n/a").any()
    assert earn.Median_Annual_Earnings.str.startswith("£").sum() + (earn.Median_Annual_Earnings == "n/a").sum() \
        == len(earn)


def test_salted_customer_join_equals_the_plain_one(spark):
    from pyspark.sql import functions as F

    from conftest import rows
    from hearth.sources import tpch

    o = spark.range(300).select(F.col("id").alias("o_orderkey"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 11).alias("o_custkey"))
    c = spark.range(9).select(F.col("id").alias("c_custkey"), F.concat(F.lit("c"), "id").alias("c_name"))
    cols = ["o_orderkey", "o_custkey", "c_name"]
    salted = tpch._with_customers(o, c, 10**9).select(*cols)
    assert rows(salted) == rows(tpch._with_customers(o, c).select(*cols)) == rows(o.join(c, o.o_custkey == c.c_custkey).select(*cols))
