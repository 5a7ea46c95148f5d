"""Cleaning steps and star-schema builders on literal frames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from hearth.operators import cleaning as C
from hearth.operators import model as M
from hearth.operators import quality as Q

from conftest import rows


def test_drop_blank_rows(spark):
    df = spark.createDataFrame([(None, " ", None), (None, "x", None), ("", "", 5), ("a", "b", 1)],
                               "Region string, PeriodLabel string, Median_int int")
    out = C.drop_blank_rows(df, ["Region", "PeriodLabel"], ["Median_int"])
    assert rows(out) == sorted([(None, "x", None), ("", "", 5), ("a", "b", 1)],
                               key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


def test_remap_value(spark):
    df = spark.createDataFrame([(" east ",), ("East Midlands",), ("EAST",), (None,)], "Region string")
    out = C.remap_value(df, "Region", {"EAST": "East of England"})
    assert [r[0] for r in out.collect()] == ["East of England", "East Midlands", "East of England", None]


def test_upper_trim_and_swap(spark):
    df = spark.createDataFrame([(" Hartlepool ", "1,250")], "RegionName string, Median string")
    assert C.upper_trim(df, "RegionName").first()["RegionName"] == "HARTLEPOOL"
    swapped = C.swap_clean_column(C.add_clean_count_int(df, "Median"), "Median", "Median_int")
    assert swapped.columns == ["RegionName", "Median"]
    assert swapped.first()["Median"] == 1250


def test_failed_conversions(spark):
    df = spark.createDataFrame([("£1,000",), ("n/a",), ("",), (None,)], "m string")
    df = C.add_clean_money_int(df, "m")
    assert C.failed_conversion_count(df, "m", "m_int").first()["failed_rows"] == 2  # 'n/a' and ''
    assert [r["m"] for r in C.failed_conversion_rows(df, "m", "m_int").collect()] == ["n/a"]


def test_dim_date_bounds(spark):
    d = M.dim_date(spark)
    assert d.count() == 11323
    first = d.orderBy("DateValue").first()
    last = d.orderBy(F.desc("DateValue")).first()
    assert tuple(first) == (dt.date(1995, 1, 1), 1995, 1, "January", 199501)
    assert tuple(last) == (dt.date(2025, 12, 31), 2025, 12, "December", 202512)


def test_dim_region_keys_follow_code_order(spark):
    regions = spark.createDataFrame(
        [("E3", "Gamma", "England"), ("E1", "Alpha", "england"), ("W1", "Wales", "Wales"), ("E2", "Beta", "ENGLAND")],
        "RegionCode string, RegionName string, Country string")
    got = rows(M.dim_region(regions, "England"), "RegionKey", "RegionCode")
    assert got == [(1, "E1"), (2, "E2"), (3, "E3")]


def test_fact_house_price_matches_names_case_insensitively(spark):
    dim = spark.createDataFrame([(1, "E1", "North", "England"), (2, "E2", "South", "England")],
                                "RegionKey bigint, RegionCode string, RegionName string, Country string")
    lad = spark.createDataFrame(
        [(1, "C1", "Hartlepool", "E1", " north "), (2, "C2", "Darlington", "E1", "NORTH"),
         (3, "C3", "Dover", "E2", "South"), (4, "C4", "Atlantis", "X", "Atlantis")],
        "ObjectId bigint, LAD23CD string, LAD23NM string, RGN23CD string, RGN23NM string")
    bridge = M.bridge_lad_region(lad, dim)
    assert bridge.count() == 3
    prices = spark.createDataFrame(
        [(dt.date(2023, 5, 17), "HARTLEPOOL", Decimal("100.00")),
         (dt.date(2023, 5, 2), "DARLINGTON ", Decimal("101.00")),
         (dt.date(2023, 5, 9), "DARLINGTON", None),
         (dt.date(2023, 5, 9), "DOVER", Decimal("0.01")),
         (dt.date(2023, 5, 9), "DOVER", Decimal("0.02")),
         (dt.date(2023, 6, 1), "ATLANTIS", Decimal("5.00"))],
        "Date date, RegionName string, AveragePrice decimal(18,2)")
    fhp = M.fact_house_price(prices, bridge, dim)
    assert rows(fhp) == [(dt.date(2023, 5, 1), 1, Decimal("100.50")), (dt.date(2023, 5, 1), 2, Decimal("0.02"))]


def test_key_and_not_null_reports(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], "k bigint, v string")
    rep = Q.key_violations({"t": (df, ["k"]), "t.v": (df, ["v"])})
    assert rows(rep) == [("t", "k", 1, 1), ("t.v", "v", 0, 1)]
    nn = Q.not_null_violations({"t": (df, ["k", "v"])})
    assert rows(nn) == [("t", "k", 1), ("t", "v", 1)]
    assert Q.null_profile(df.limit(0), ["k"]).first()[0] is None  # SUM over no rows


def test_unmatched_and_orphans(spark):
    dim = spark.createDataFrame([(1, "North")], "RegionKey bigint, RegionName string")
    df = spark.createDataFrame([(" north",), ("n18",), ("n18",), (None,)], "Region string")
    assert rows(Q.unmatched_names(df, "Region", dim, "RegionName")) == [("n18",), (None,)]
    child = spark.createDataFrame([(1,), (7,)], "RegionKey bigint")
    assert rows(Q.orphans(child, dim, "RegionKey")) == [(7,)]


def test_dense_key_equals_global_row_number(spark):
    from pyspark.sql import Window

    from hearth.operators.keys import dense_key

    df = spark.range(0, 1500).select(
        F.format_string("E%08d", (F.col("id") * 7919) % 100003).alias("RegionCode"), F.col("id").alias("v"))
    expected = rows(df.select(F.row_number().over(Window.orderBy("RegionCode")).cast("bigint").alias("k"),
                              "RegionCode"))
    got = dense_key(df, ["RegionCode"], "k", num_partitions=8)
    assert got.columns == ["k", "RegionCode", "v"]
    assert rows(got, "k", "RegionCode") == expected


def test_dim_region_distributed_key_matches_window(spark):
    regions = spark.createDataFrame([(f"E{i:03d}", f"R{i}", "England") for i in (5, 1, 9, 3, 7)],
                                    "RegionCode string, RegionName string, Country string")
    assert rows(M.dim_region(regions, "england", distributed_key=True)) == rows(M.dim_region(regions, "england"))


def test_dense_key_spreads_a_hot_code(spark):
    from hearth.operators.keys import dense_key

    # a third of the rows share one code: they must not all land in one range partition
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.format_string("C%05d", "id")).alias("code"), "id")
    got = dense_key(df, ["code"], "k", num_partitions=8)
    keys = [r["k"] for r in got.collect()]
    assert sorted(keys) == list(range(1, 3001))
    hot = got.filter(F.col("code") == "HOT").select(F.min("k"), F.max("k")).first()
    assert hot[1] - hot[0] == 999           # tied rows still take a contiguous block of numbers
    per_partition = got.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_partition) < 1000


def test_raw_csv_round_trip_with_declared_schema(spark, tmp_path):
    """Raw inputs read from publisher-style CSV with the declared schemas clean to the same
    model rows as the in-memory inputs."""
    from hearth.plans.pipeline import build_model, clean_inputs
    from hearth.sources import tpch
    from hearth.sources.files import RAW_SCHEMAS, read_raw
    from hearth.sources.tpch import RawInputs

    from conftest import SF_SMALL

    raw = tpch.raw_inputs(spark, SF_SMALL)
    tables = {"regions": raw.regions, "district_region_lookup": raw.lad, "district_prices": raw.prices,
              "rents": raw.rents, "earnings": raw.earnings}
    back = {}
    for name, df in tables.items():
        assert df.schema.fieldNames() == RAW_SCHEMAS[name].fieldNames()
        path = str(tmp_path / name)
        # quote empty strings so a blank label stays '' and is not read back as NULL
        df.write.option("header", "true").option("emptyValue", '""').csv(path)
        back[name] = read_raw(spark, name, path, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    again = RawInputs(back["regions"], back["district_region_lookup"], back["district_prices"], back["rents"],
                      back["earnings"])
    m1 = build_model(spark, clean_inputs(raw, tpch.REMAP), tpch.COUNTRY)
    m2 = build_model(spark, clean_inputs(again, tpch.REMAP), tpch.COUNTRY)
    for t in ("fact_house_price", "fact_rent", "fact_earnings", "bridge"):
        assert rows(getattr(m1, t)) == rows(getattr(m2, t)), t

    # the whole workspace over the files answers every query as the test-table workspace does
    from hearth.plans.context import Housing
    from hearth.plans.registry import QUERIES, run_query

    h = Housing.from_raw(spark, again, tpch.COUNTRY, tpch.REMAP, tpch.TREND_YEARS)
    for name in ("q5_growth_rank", "q10_national_trend", "vw_lad_price_ratios", "dq_not_null", "dq_rent_bad_period"):
        assert rows(run_query(h, name)) == rows(QUERIES[name](spark, SF_SMALL)), name


def test_key_report_on_empty_tables_and_repeated_key_sets(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", None), (2, None, "y")], "k bigint, v string, w string")
    rep = Q.key_violations({"t.k": (df, ["k"]), "t.kv": (df, ["k", "v"]), "t.k again": (df, ["k"]),
                            "t.w": (df, ["w"]), "empty": (df.limit(0), ["k"])})
    assert rows(rep) == sorted([("t.k", "k", 1, 0), ("t.kv", "k,v", 1, 1), ("t.k again", "k", 1, 0),
                                ("t.w", "w", 0, 1), ("empty", "k", 0, 0)])
