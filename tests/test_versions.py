"""Tables replaced in one step, rules checked while they are written, keys that stay."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from hearth.operators import gate as G
from hearth.operators import model as M
from hearth.operators.keys import KNOWN_KEYS, stable_key
from hearth.plans.context import Housing
from hearth.plans.pipeline import WrittenModel
from hearth.session import new_run_dir
from hearth.sources import RawInputs, VersionedTable, versions

from conftest import SF_SMALL, rows


def table(spark, keep=2):
    return VersionedTable(spark, new_run_dir(spark, "versions"), keep)


def test_a_load_replaces_all_rows_and_readers_keep_theirs(spark):
    t = table(spark)
    assert t.current() is None and t.versions() == []
    with pytest.raises(FileNotFoundError):
        t.read()
    t.load(spark.range(3))
    before = t.read()
    assert rows(t.load(spark.range(5, 7))) == rows(t.read()) == [(5,), (6,)]
    assert rows(before) == [(0,), (1,), (2,)]
    t.load(t.read().where("id = 6"))  # may read the table it replaces
    assert rows(t.read()) == [(6,)]
    assert len(t.versions()) == 2 and not os.path.exists(before.inputFiles()[0].removeprefix("file://"))


def test_a_load_that_does_not_end_changes_nothing(spark):
    t = table(spark)
    t.load(spark.range(3))
    with pytest.raises(Exception, match="(?i)boom"):
        t.load(spark.range(5).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id")))
    with pytest.raises(RuntimeError, match="refused"):
        t.load(spark.range(9), check=lambda: (_ for _ in ()).throw(RuntimeError("refused")))
    # killed between the rows and the commit: a folder nobody points to; killed while committing: half a file
    spark.range(4).write.parquet(f"{t.root}/v-lost")
    open(f"{t.root.removeprefix('file:')}/_commits/{9:020d}", "w").write("v-lost")
    assert rows(t.read()) == [(0,), (1,), (2,)] and len(t.versions()) == 1


def test_of_two_loads_one_is_refused(spark):
    t = table(spark)
    t.load(spark.range(1))
    with pytest.raises(versions.ConcurrentLoad):
        t.load(spark.range(2), check=lambda: t.load(spark.range(3)))
    assert rows(t.read()) == [(0,), (1,), (2,)]
    with pytest.raises(ValueError):
        VersionedTable(spark, t.root, keep=0)


def test_the_gate_counts_in_one_pass(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "A ", 1), (None, "b", 1), (4, None, 2), (4, "c", 3)], "k int, t string, u int")
    rules = G.Rules(("k", "t"), (("k",), ("t",), ("k", "u")))
    gate = G.Gate("t", rules)
    t = table(spark)
    scans = []
    through = gate.through(df)
    assert rows(t.load(through, lambda: scans.append(gate.report()))) == rows(df)
    (report,) = scans
    assert report == G.Report("t", 5, {"k": 1, "t": 1}, {("k",): 1, ("t",): 1, ("k", "u"): 0}) and report.broken
    assert str(report) == "t: 1 null k; 1 null t; 1 repeated (k); 1 repeated (t) in 5 rows"
    plan = through._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1 and "CollectMetrics" in plan
    with pytest.raises(G.RulesBroken, match="1 null k"):
        strict = G.Gate("t", rules)
        t.load(strict.through(df.limit(3)), strict.check)
    assert rows(t.read()) == rows(df)
    empty = G.Gate("e", rules)
    t.load(empty.through(df.limit(0)), empty.check)
    assert empty.report() == G.Report("e", 0, {"k": 0, "t": 0}, {("k",): 0, ("t",): 0, ("k", "u"): 0})


def housing(spark, rules):
    return Housing(spark, SF_SMALL, rules=rules)


def test_a_model_filters_reports_or_fails(spark):
    with housing(spark, "filter") as a, housing(spark, "report") as b, housing(spark, "fail") as c:
        nulls = a.model.unchecked["fact_rent"].where(M.NOT_NULL["fact_rent"][0] + " IS NULL OR MedianMonthlyRent IS NULL").count()
        assert nulls and a.model.reports["fact_rent"].broken
        assert a.model.fact_rent.count() == a.model.rows("fact_rent") - nulls
        assert b.model.fact_rent.count() == b.model.rows("fact_rent") == a.model.rows("fact_rent")
        assert sum(b.model.reports["fact_rent"].nulls.values()) >= nulls
        assert c.model.dim_region.count() == 5  # holds its rules
        with pytest.raises(G.RulesBroken) as told:
            c.model.fact_rent  # noqa: B018
        assert told.value.report.table == "fact_rent" and told.value.report.nulls == b.model.reports["fact_rent"].nulls
        # only the load before the label fix is there: what broke the rules was not published
        assert len(c.model.table("fact_rent").versions()) == 1
    with pytest.raises(ValueError):
        WrittenModel(spark, a.cleaned, rules="sometimes")


@pytest.mark.parametrize("rules", ["filter", "report", "fail"])
def test_lazy_models_take_the_same_modes(spark, rules):
    with Housing(spark, SF_SMALL, materialize=False, rules=rules) as h:
        if rules == "fail":
            with pytest.raises(Exception, match="NOT NULL"):
                h.model.fact_rent.collect()
        else:
            kept = h.model.fact_rent.where("MedianMonthlyRent IS NULL").count()
            assert (kept > 0) == (rules == "report")


def test_clean_inputs_pass_the_strict_gate(spark):
    raw = RawInputs(
        regions=spark.createDataFrame([("E1", "London", "England"), ("E2", "East", "England")], "RegionCode string, RegionName string, Country string"),
        lad=spark.createDataFrame([(1, "D1", "Camden", "E1", "London")], "ObjectId bigint, LAD23CD string, LAD23NM string, RGN23CD string, RGN23NM string"),
        prices=spark.sql("SELECT DATE '2020-01-05' AS Date, 'CAMDEN' AS RegionName, CAST(5 AS DECIMAL(18,2)) AS AveragePrice"),
        rents=spark.createDataFrame([("London", "Apr 2019 to Mar 2020", "1,000", "", "")], "Region string, PeriodLabel string, Median string, throwaway1 string, throwaway2 string"),
        earnings=spark.createDataFrame([(2020, "London", "£1")], "Year int, Region_name string, Median_Annual_Earnings string"))
    with Housing.from_raw(spark, raw, rules="fail") as h:
        for name in ("dim_region", "bridge", "fact_earnings", "fact_rent", "fact_house_price", "dim_date"):
            assert getattr(h.model, name).count() > 0
        assert not any(r.broken for r in h.model.reports.values()) and len(h.model.reports) == 6


def test_keys_stay_when_regions_are_added(spark):
    def regions(*codes):
        return spark.createDataFrame([(c, f"name {c}", "England") for c in codes], "RegionCode string, RegionName string, Country string")

    known = table(spark)
    first = {r.RegionCode: r.RegionKey for r in M.dim_region(regions("E3", "E5", "E4"), known=known).collect()}
    assert first == {"E3": 1, "E4": 2, "E5": 3}
    later = {r.RegionCode: r.RegionKey for r in M.dim_region(regions("E1", "E3", "E2", "E5"), known=known).collect()}
    assert later == {"E1": 4, "E2": 5, "E3": 1, "E5": 3}
    assert len(known.versions()) == 2
    assert M.dim_region(regions("E4"), known=known).collect()[0].RegionKey == 2
    assert len(known.versions()) == 2  # nothing new, nothing written
    got = stable_key(spark.createDataFrame([("x",), (None,), ("x",)], "c string"), "c", "k", table(spark))
    assert rows(got, "c", "k") == [("x", 1), ("x", 1), (None, None)]
    assert known.read(KNOWN_KEYS).columns == ["code", "key"]
    none = table(spark)
    assert stable_key(regions(), "RegionCode", "k", none).count() == 0 and none.read(KNOWN_KEYS).count() == 0
