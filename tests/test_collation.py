"""Text is compared as the source's collation does: without case and trailing spaces; and the
strict conversions, the reload and the failing NOT NULL rule."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import literal_model, rows
from hearth.functions.text import clean_count_int, clean_money_int, strict_int
from hearth.operators import cleaning as C
from hearth.operators import model as M
from hearth.operators import quality as Q
from hearth.operators.joins import within_limit
from hearth.operators.levels import FAN_OUT_ROWS, MAX_FAN_OUT_TASKS, fan_out_tasks
from hearth.session import new_run_dir
from hearth.sources.versions import VersionedTable


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n string")


def test_grouping_ignores_case_and_trailing_spaces(spark):
    df = names(spark, "London", "LONDON", "London  ", " London", None, None, "Leeds")
    assert rows(Q.rows_per(df, ["n"], "c")) == [(" London", 1), ("LONDON", 3), ("Leeds", 1), (None, 2)]
    assert rows(Q.duplicates(df, ["n"])) == [("LONDON", 3), (None, 2)]
    assert rows(Q.distinct_values(df, "n")) == [(" London",), ("LONDON",), ("Leeds",), (None,)]
    report = Q.key_violations({"t": (df, ["n"])}).collect()
    assert [(r.duplicate_keys, r.null_keys) for r in report] == [(2, 2)]


def test_unmatched_names_come_once(spark):
    df = names(spark, "Leeds", "LEEDS ", "york", "York", None)
    assert rows(Q.unmatched_names(df, "n", names(spark, "YORK "), "n")) == [("LEEDS ",), (None,)]


def test_padded_country_keeps_its_regions(spark):
    regions = spark.createDataFrame([("E1", "A", "England "), ("E2", "B", "ENGLAND"), ("W1", "C", "Wales"), ("X", "D", " England")],
                                    "RegionCode string, RegionName string, Country string")
    assert [r.RegionCode for r in M.dim_region(regions, "England ").orderBy("RegionKey").collect()] == ["E1", "E2"]


def test_one_earnings_row_for_each_region_of_a_name(spark):
    """Case variants inside the dimension: the report shows them, as the join finds both."""
    model = literal_model(spark, [(1, "London"), (2, "LONDON ")])
    assert rows(Q.duplicates(model.dim_region, ["RegionName"])) == [("LONDON ", 2)]


@pytest.mark.parametrize("text", ["123\n", "12\r", "\n5", "1 2", "+", "", "99999999999"])
def test_line_breaks_and_junk_do_not_convert(spark, text):
    df = names(spark, text).select(strict_int("n"), clean_money_int(F.concat(F.col("n"), F.lit("x"))), clean_count_int(F.col("n")))
    assert tuple(df.first()) == (None, None, None)


def test_orphans_make_the_parent_distinct_first(spark):
    parent = spark.createDataFrame([(1,)] * 50 + [(2,)], "k int")
    child = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    assert rows(Q.orphans(child, parent, "k")) == [(3,), (None,)]


def test_not_null_can_fail(spark):
    df = names(spark, "a", None)
    assert C.enforce_not_null(df, ["n"]).count() == 1
    with pytest.raises(Exception, match="NOT NULL"):
        C.enforce_not_null(df, ["n"], fail=True).collect()
    assert C.enforce_not_null(names(spark, "a"), ["n"], fail=True).count() == 1


def test_reload_replaces_all_rows(spark):
    table = VersionedTable(spark, new_run_dir(spark, "reload"))
    table.load(names(spark, "old", "older"))
    before = table.read()
    assert rows(C.reload_after_fix(table, names(spark, "new"))) == [("new",)]
    assert rows(table.read()) == [("new",)] and rows(before) == [("old",), ("older",)]


def test_broadcasts_are_checked_in_rows_and_bytes(spark):
    df = names(spark, "a")
    assert within_limit(df, 10) and not within_limit(df, None) and not within_limit(df, 10**7)
    spark.conf.set("hearth.broadcast.maxBytes", "100")
    try:
        assert within_limit(df, 1) and not within_limit(df, 2)
    finally:
        spark.conf.unset("hearth.broadcast.maxBytes")


def test_fan_out_tasks_follow_the_rows_made():
    assert fan_out_tasks(None, 5, 5, 8) == 8
    assert fan_out_tasks(400, 3000, 5, 8) == -(-3000 * 80 // FAN_OUT_ROWS)
    assert fan_out_tasks(10, 10, 5, 8) == 1 and fan_out_tasks(10**9, 10**9, 1, 8) == MAX_FAN_OUT_TASKS
