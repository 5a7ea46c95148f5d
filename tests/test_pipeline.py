"""End-to-end over the smallest test tables: every registered query against the DuckDB oracle,
cross-query invariants, and physical-plan properties."""

from __future__ import annotations

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry
from hearth.plans.registry import QUERIES
from oracle import oracle_sql
from conftest import SF_SMALL, rows

sys_tools = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools")

ORACLE = oracle_sql()


def q(spark, name):
    return QUERIES[name](spark, SF_SMALL)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["RegionName", "Year", "AvgHousePrice", "PrevYearPrice", "YoY_GrowthPercent", "GrowthRank"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    import sys

    sys.path.insert(0, sys_tools)
    from compare import digest

    sdf = q(spark, name)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows, sdf.columns) == digest(drows, dcols)


# ---------------------------------------------------------------- invariants

def test_q4_equals_q8_when_earnings_unique(spark):
    a = rows(q(spark, "q4_price_to_earnings"), "Year", "RegionName", "AvgHousePrice", "PriceToEarningsRatio")
    b = rows(q(spark, "q8_price_to_income"), "Year", "RegionName", "AvgHousePrice", "PriceToIncomeRatio")
    assert a == b


def test_q1b_subset_of_q1a(spark):
    a = set(rows(q(spark, "q1a_price_vs_rent_left")))
    b = set(rows(q(spark, "q1b_price_vs_rent_inner")))
    assert b <= a and len(a) > len(b)


def test_district_views_carry_region_values(spark):
    df = q(spark, "vw_lad_price_ratios")
    assert df.filter(F.col("LAD_vs_Region_Ratio") != 1.0).count() == 0
    assert df.count() == q(spark, "vw_lad_avg_house_prices").count()


def test_q6_ranks_mirror_without_ties(spark):
    df = q(spark, "q6_rent_rank")
    n = df.groupBy("Year").count().withColumnRenamed("count", "n")
    bad = df.join(n, "Year").filter(F.col("RentRank_Highest") + F.col("RentRank_Lowest") != F.col("n") + 1)
    assert bad.count() == 0


def test_dirty_inputs_are_detected(spark):
    assert q(spark, "dq_rent_bad_period").count() >= 1
    assert q(spark, "dq_price_dupes").count() >= 1
    assert q(spark, "failed_conversion_count").first()["failed_rows"] > 0
    assert "Atlantis" in {r[0] for r in q(spark, "dq_lad_unmatched_regions").collect()}
    missing = {r[0] for r in q(spark, "dq_regions_without_rent").collect()}
    assert {"NATION_18", "NATION_23"} <= missing          # before the label fix
    fixed = q(spark, "fact_rent").join(q(spark, "dim_region"), "RegionKey")
    assert fixed.filter(F.col("RegionName") == "NATION_18").count() > 0  # after it


# ---------------------------------------------------------------- plans

def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_product_or_python(spark, name):
    text = plan_text(q(spark, name))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert bad not in text, f"{name}: {bad}"


def test_anti_joins_are_planned_as_anti_joins(spark):
    for name in ("dq_regions_without_rent", "dq_rent_orphans", "dq_price_unmatched_names", "dq_price_no_date"):
        assert "LeftAnti" in plan_text(q(spark, name)), name


def test_scans_are_pruned(spark):
    from hearth.sources import tpch

    # the duplicate check reads two columns of the imported prices, not the price
    text = plan_text(q(spark, "dq_price_dupes"))
    assert "ReadSchema: struct<Date:date,RegionName:string>" in text
    assert "orders.parquet" not in text
    # the import itself reads only the order and customer columns it maps
    text = plan_text(tpch.prices(spark, SF_SMALL).select("Date", "RegionName"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in text


def test_district_fan_out_is_not_shuffled(spark):
    """On the district path the only exchanges move bridge rows or bounded region-level rows:
    no exchange is keyed by (time, district)."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("vw_lad_avg_house_prices", "vw_lad_price_income_ratio", "vw_lad_rent_income_ratio",
                     "vw_lad_price_ratios"):
            text = plan_text(q(spark, name))
            exchanges = [ln for ln in text.splitlines() if "hashpartitioning(" in ln]
            assert exchanges, name
            for ln in exchanges:
                assert not ("LADName" in ln and ("YearMonth" in ln or "PeriodEndYear" in ln or "Year" in ln)), ln
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_limit_falls_back_to_planner_with_same_results(spark):
    """Data-derived sides are broadcast only under a checked row bound; with the limit at 0 the
    planner chooses the joins and the results are unchanged."""
    from hearth.operators.joins import LIMIT_CONF

    names = ("vw_lad_avg_house_prices", "vw_lad_price_income_ratio", "vw_lad_price_ratios",
             "q1a_price_vs_rent_left", "q4_price_to_earnings", "q7_price_rent_corr", "q7b_overlap_years",
             "q8_price_to_income", "q8n_national_price_to_income", "q10_national_trend")
    before = {n: rows(q(spark, n)) for n in names}
    assert "BroadcastExchange" in plan_text(q(spark, "vw_lad_price_income_ratio"))
    spark.conf.set(LIMIT_CONF, "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(q(spark, "vw_lad_price_income_ratio"))
        assert "BroadcastExchange" not in text and "SortMergeJoin" in text
        # beyond the limit the insights pre-aggregate the prices before a sort-merge join
        assert "SortMergeJoin" in plan_text(q(spark, "q8_price_to_income"))
        for n in names:
            assert rows(q(spark, n)) == before[n], n
    finally:
        spark.conf.unset(LIMIT_CONF)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


def test_column_types_match_oracle(spark, duck):
    """Same column types on both sides (decimal(p,s) <-> DECIMAL(p,s), int <-> INTEGER, ...)."""
    bad = []
    for name in sorted(QUERIES):
        spark_types = {f.name: f.dataType.simpleString() for f in q(spark, name).schema.fields}
        rel = duck.sql(ORACLE[name])
        duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
        for col, t in spark_types.items():
            if SPARK_TO_DUCK.get(t, t.upper()) != duck_types.get(col):
                bad.append((name, col, t, duck_types.get(col)))
    assert bad == []


def test_batch_job_writes_results(spark, tmp_path):
    import pyarrow.parquet as pq

    from hearth.plans.run import main

    out = str(tmp_path / "out")
    assert main(["--sf-dir", SF_SMALL, "--out", out, "--query", "q5_growth_rank", "--query", "dq_lad_total_rows"]) == 0
    assert pq.read_table(f"{out}/q5_growth_rank").num_rows == q(spark, "q5_growth_rank").count()
    assert pq.read_table(f"{out}/dq_lad_total_rows").num_rows == 1


def test_batch_job_over_raw_csv_files(spark, tmp_path):
    import pyarrow.parquet as pq

    from hearth.plans.run import RAW_FILES, main
    from hearth.sources import tpch

    raw = tpch.raw_inputs(spark, SF_SMALL)
    frames = dict(zip(RAW_FILES, (raw.regions, raw.lad, raw.prices, raw.rents, raw.earnings)))
    for name, df in frames.items():
        df.write.option("header", "true").option("emptyValue", '""').csv(str(tmp_path / "raw" / name))
    out = str(tmp_path / "out")
    args = ["--raw-dir", str(tmp_path / "raw"), "--out", out, "--country", tpch.COUNTRY,
            "--years", ",".join(str(y) for y in tpch.TREND_YEARS), "--query", "q10_national_trend",
            "--query", "dq_rent_unmatched_regions"]
    args += [a for k, v in tpch.REMAP.items() for a in ("--remap", f"{k}={v}")]
    assert main(args) == 0
    def none_safe(t):
        return tuple((v is None, v if v is not None else 0) for v in t)

    for name in ("q10_national_trend", "dq_rent_unmatched_regions"):
        got = sorted((tuple(r.values()) for r in pq.read_table(f"{out}/{name}").to_pylist()), key=none_safe)
        assert got == sorted((tuple(r) for r in q(spark, name).collect()), key=none_safe), name


SF_LARGER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("vw_lad_")))
def test_district_fan_out_is_spread(spark, name):
    """The fan-out's partitions follow its rows, not the bridge's few bytes."""
    df = QUERIES[name](spark, SF_LARGER)
    assert df.rdd.getNumPartitions() > 1


def test_price_ratios_deal_the_bridge_once(spark):
    text = plan_text(QUERIES["vw_lad_price_ratios"](spark, SF_LARGER))
    assert len({ln for ln in text.splitlines() if "REPARTITION_BY_NUM" in ln and "LADName" in ln}) == 1


def _exchanges(text):
    return [ln for ln in text.splitlines() if "hashpartitioning(" in ln]


def test_house_prices_are_shuffled_once(spark):
    """A lookup of checked size is joined map-side: the prices' only exchange carries sums per month
    and region. Beyond the limit both sides shuffle by district; the results are equal."""
    from hearth.operators import model as M
    from hearth.plans.context import housing

    h = housing(spark, SF_SMALL)
    m, prices = h.model, h.cleaned.prices
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = M.fact_house_price(prices, m.bridge, m.dim_region, m.bridge.count(), m.dim_region.count())
        by = _exchanges(plan_text(one))
        assert not any("_dk" in ln and "YearMonth" in ln for ln in by) and sum("YearMonth" in ln for ln in by) == 1
        two = M.fact_house_price(prices, m.bridge, m.dim_region)
        text = plan_text(two)
        assert "SortMergeJoin" in text and any("YearMonth" in ln and "_dk" in ln for ln in _exchanges(text))
        assert rows(one) == rows(two)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_correlation_has_full_precision(spark):
    from hearth.plans.context import housing
    from hearth.plans.insights import q7_price_rent_corr

    full = dict(rows(q7_price_rent_corr(housing(spark, SF_SMALL).model)))
    short = dict(rows(q(spark, "q7_price_rent_corr")))
    assert {k: None if v is None else round(v, 6) for k, v in full.items()} == short
    assert any(v is not None and round(v, 6) != v for v in full.values())


def test_only_what_a_query_needs_is_written(spark, tmp_path):
    import os

    from hearth.plans.context import Housing
    from hearth.plans.registry import run_query

    with Housing(spark, SF_SMALL) as h:
        run_query(h, "dq_lad_total_rows").collect()
        assert sorted(os.listdir(f"{h.run_dir}/import")) == ["lad"] and not os.path.exists(f"{h.run_dir}/model")
        run_query(h, "fact_earnings").collect()
        assert sorted(os.listdir(f"{h.run_dir}/model")) == ["dim_region", "fact_earnings"]
        assert "prices" not in os.listdir(f"{h.run_dir}/import")
    assert not os.path.exists(h.run_dir)


def test_a_changed_input_file_gives_a_new_workspace(spark, tmp_path):
    import os
    import shutil

    from hearth.plans.context import housing

    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        shutil.copyfile(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    first = housing(spark, str(tmp_path))
    assert housing(spark, f"{tmp_path}/") is first
    os.utime(tmp_path / "orders.parquet", (1, 1))
    assert housing(spark, str(tmp_path)) is not first


def test_concurrent_queries_write_each_table_once(spark, monkeypatch):
    from concurrent.futures import ThreadPoolExecutor

    import hearth.plans.pipeline as pipeline
    from hearth.plans.context import Housing
    from hearth.plans.registry import run_query

    written = []
    write = pipeline.WrittenModel._write
    monkeypatch.setattr(pipeline.WrittenModel, "_write", lambda self, name, *a: written.append(name) or write(self, name, *a))
    with Housing(spark, SF_SMALL) as h, ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: run_query(h, n).count(), ["fact_rent", "fact_earnings", "bridge_lad_region", "dim_region"] * 2))
        assert len(written) == len(set(written))
