"""Monthly states, published views, joins with hot keys, exact moments."""

from __future__ import annotations

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from hearth.functions.measures import merge_moments, moments, pearson, scaled_mean
from hearth.operators import joins
from hearth.operators import model as M
from hearth.operators.incremental import MonthlyPrices, changed_months
from hearth.plans import catalog
from hearth.plans.context import Housing
from hearth.plans.insights import q7_price_rent_corr
from hearth.plans.views import VIEWS
from hearth.session import new_run_dir

from conftest import SF_SMALL, literal_model, month, rows


@pytest.fixture(scope="module")
def h(spark):
    with Housing(spark, SF_SMALL) as own:
        yield own


def test_one_changed_month_rewrites_one_partition(spark, h):
    prices, bridge, dim = h.cleaned.prices, h.model.bridge, h.model.dim_region
    path = new_run_dir(spark, "months")
    monthly = MonthlyPrices(spark, path)
    assert monthly.fact().count() == 0
    monthly.rebuild(prices, bridge, dim)
    assert rows(monthly.fact()) == rows(h.model.fact_house_price)
    files = lambda: {(d, f): os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}
    written = files()
    months = sorted(r[0] for r in monthly.states().select("YearMonth").distinct().collect())
    changed, gone = months[3], months[5]
    after = prices.where(F.trunc("Date", "MM") != F.lit(gone)).withColumn(
        "AveragePrice", F.when(F.trunc("Date", "MM") == F.lit(changed), F.col("AveragePrice") * 2).otherwise(F.col("AveragePrice")).cast("decimal(18,2)"))
    assert changed_months(prices, prices) == [] and changed_months(prices, after) == [changed, gone]
    monthly.refresh(changed_months(prices, after), after, bridge, dim)
    now = files()
    touched = {d.rsplit("=", 1)[1] for d, f in set(written) ^ set(now)}
    assert touched == {changed.isoformat(), gone.isoformat()}
    assert all(now[k] == v for k, v in written.items() if k in now)
    assert rows(monthly.fact()) == rows(M.fact_house_price(after, bridge, dim))
    monthly.refresh([], after, bridge, dim)
    monthly.refresh([gone], prices, bridge, dim)  # and back again
    assert rows(monthly.fact().where(F.col("YearMonth") == F.lit(gone))) == rows(
        h.model.fact_house_price.where(F.col("YearMonth") == F.lit(gone)))


def test_other_sessions_read_the_published_views(spark, h):
    names = catalog.publish(spark, h.model, "hearth_test")
    assert sorted(names) == sorted(VIEWS) and len(names) == 23
    other = spark.newSession()
    for name in names:
        got, want = other.table(f"hearth_test.{name}"), VIEWS[name](h.model)
        assert got.columns == want.columns, name
        assert rows(got) == rows(want), name
    # a reload moves the tables to their newest version, a second publication is idempotent
    one = h.model.fact_earnings.limit(1)
    for _ in range(3):
        h.model.table("fact_earnings").load(one)
        assert catalog.publish(spark, h.model, "hearth_test") == names
        assert other.table("hearth_test.fact_earnings").count() == other.table("hearth_test.vw_fact_earnings").count() == 1
        one = h.model.table("fact_earnings").read()
    assert other.sql("SHOW TABLES IN hearth_test LIKE 'fact_earnings__*'").count() == 2
    spark.sql("DROP DATABASE hearth_test CASCADE")


def test_published_views_on_repeated_and_missing_names(spark):
    m = literal_model(spark, [(1, "A"), (2, "B"), (3, None)],
                      prices=[(month(2020), 1, 10), (month(2020), 2, 20), (month(2020, 2), 3, 7), (month(2021), 1, 0)],
                      rents=[(2020, 1, 1), (2020, 2, 3)], earnings=[(2020, 1, 100), (2020, 2, 0), (2021, 3, 5)],
                      bridge=[("d1", "X", 1), ("d2", "X", 1), ("d3", "X", 2), ("d4", None, 2), ("d5", "Y", 3)])
    for name, df in {"dim_region": m.dim_region, "bridge_lad_region": m.bridge, "fact_earnings": m.fact_earnings, "fact_rent": m.fact_rent,
                     "fact_house_price": m.fact_house_price, "dim_date": m.dim_date}.items():
        df.createOrReplaceTempView(name)
    try:
        for name, text in catalog.view_sql().items():
            spark.sql(text).createOrReplaceTempView(name)
            assert rows(spark.table(name)) == rows(VIEWS[name](m)), name
    finally:
        for name in [*catalog.view_sql(), "dim_region", "bridge_lad_region", "fact_earnings", "fact_rent", "fact_house_price", "dim_date"]:
            spark.catalog.dropTempView(name)


def test_only_hot_keys_are_joined_map_side(spark):
    left = spark.range(6000).select(F.col("id").alias("a"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("k"))
    right = spark.range(0, 6000, 2).select(F.col("id").alias("r"), F.concat(F.lit("n"), "id").alias("name")).union(
        spark.createDataFrame([(7, "seven"), (7, "again"), (None, "none")], "r bigint, name string"))
    assert 7 in joins.hot_keys(left, "k", 0.05) and len(joins.hot_keys(left, "k", 0.05)) <= 20
    got = joins.heavy_key_join(left, right, "k", "r", 0.05)
    assert rows(got) == rows(left.join(right, F.col("k") == F.col("r")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.heavy_key_join(left, right, "k", "r", 0.05)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" in plan and "explode" not in plan
    flat = spark.range(100).withColumnRenamed("id", "k")
    assert joins.heavy_key_join(flat, right, "k", "r", 0.5).count() == 52
    assert joins.heavy_key_join(flat.limit(0), right, "k", "r").count() == 0


def test_correlation_does_not_depend_on_partitions(spark):
    prices = [(month(y, m), k, (y % 7) * 1000.37 + m * 13.11 + k) for y in range(2000, 2024) for m in (1, 2, 3) for k in (1, 2, 3)]
    rents = [(y, k, (y % 5) * 100.13 + k * (y % 3)) for y in range(2000, 2024) for k in (1, 2)] + [(2001, 3, 5)]
    m = literal_model(spark, [(1, "A"), (2, "B"), (3, "C")], prices=prices, rents=rents)
    want = None
    for n in ("1", "8", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = rows(q7_price_rent_corr(m))
        assert want in (None, got)
        want = got
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert [r[0] for r in want] == ["A", "B", "C"] and want[2][1] is None
    for key, name in ((1, "A"), (2, "B")):
        x = [sum(p for d, k, p in prices if d.year == y and k == key) / 3 for y in range(2000, 2024)]
        y = [r for yy, k, r in rents if k == key]
        mx, my = sum(x) / 24, sum(y) / 24
        r = sum((a - mx) * (b - my) for a, b in zip(x, y)) / math.sqrt(sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y))
        assert dict(want)[name] == pytest.approx(r, abs=1e-7)


def test_moments_merge_in_any_grouping(spark):
    df = spark.range(200).select((F.col("id") % 4).alias("g"), (F.col("id") * 10**9 - 7).alias("x"), F.when(F.col("id") % 9 > 0, -F.col("id") * 3).alias("y"))
    at_once = df.agg(*moments("x", "y"))
    merged = df.groupBy("g").agg(*moments("x", "y")).agg(*merge_moments())
    assert at_once.first() == merged.first() and merged.select(pearson()).first()[0] == -1.0
    assert spark.range(1).agg(*moments(F.lit(1), F.lit(2))).select(pearson()).first()[0] is None


def test_means_are_rounded_half_away_from_zero(spark):
    got = spark.sql("SELECT CAST(v AS DECIMAL(38,2)) AS s, n FROM VALUES (1.00, 3), (-1.00, 3), (0.01, 8), (-0.01, 8), (5.00, 0) t(v, n)").select(
        scaled_mean("s", F.col("n").cast("bigint"), 3)).collect()
    assert [None if r[0] is None else int(r[0]) for r in got] == [333, -333, 1, -1, None]
    assert month(2020) == dt.date(2020, 1, 1)
