"""CSV imports: columns by header name, bad lines set aside."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from hearth.sources import HeaderError, import_raw, read_raw
from hearth.sources.csv_import import header_of, match_header

from conftest import rows


def put(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(tmp_path)


def test_columns_are_found_by_name(spark, tmp_path):
    path = put(tmp_path, a="Country,RegionName,Note,RegionCode\nEngland,London,x,E1\n",
               b=b"\xef\xbb\xbfregioncode , RegionName,COUNTRY\r\nE2,\"North, \"\"West\"\"\",England\r\n".replace(b'""', b'\\"'),
               empty="", header_only="RegionCode,RegionName,Country\n")
    want = [("E1", "London", "England"), ("E2", 'North, "West"', "England")]
    assert rows(read_raw(spark, "regions", path)) == want
    got = import_raw(spark, "regions", path)
    assert rows(got.good) == want and got.rejected.count() == 0 and (got.rows, got.rejected_rows) == (2, 0)


@pytest.mark.parametrize("header", ["RegionCode,RegionName", "RegionCode,RegionName,Country,country", "a,b,c"])
def test_wrong_headers_stop(spark, tmp_path, header):
    path = put(tmp_path, a=header + "\nE1,London,England\n")
    for read in (read_raw, import_raw):
        with pytest.raises(HeaderError, match="Country"):
            read(spark, "regions", path)


def test_bad_lines_are_set_aside(spark, tmp_path):
    path = put(tmp_path, prices="AveragePrice,RegionName,Date\n100.50,A,2020-01-01\n12x,B,2020-02-01\n7,C,not a date\n"
                                "8,D\n9,E,2020-03-01,more\nx,F,y\n,G,\n\"5\",\"H, I\",2020-04-01\n")
    got = import_raw(spark, "district_prices", path)
    assert rows(got.good) == [(dt.date(2020, 1, 1), "A", Decimal("100.50")), (dt.date(2020, 4, 1), "H, I", Decimal("5.00")),
                              (None, "G", None)]
    assert rows(got.rejected, "line", "failed_columns") == [
        ("12x,B,2020-02-01", "AveragePrice"), ("7,C,not a date", "Date"), ("8,D", "*"), ("9,E,2020-03-01,more", "*"), ("x,F,y", "Date,AveragePrice")]
    assert {r.file.rsplit("/", 1)[-1] for r in got.rejected.collect()} == {"prices.csv"}
    assert (got.rows, got.rejected_rows) == (8, 5)
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        read_raw(spark, "district_prices", path).collect()
    assert read_raw(spark, "district_prices", path, bad="null").count() == 8
    # a line is bad whichever columns are asked for
    assert import_raw(spark, "district_prices", path).good.select("RegionName").count() == 3


def test_no_files(spark, tmp_path):
    got = import_raw(spark, "earnings", str(tmp_path))
    assert got.good.columns == ["Year", "Region_name", "Median_Annual_Earnings"] and got.good.count() == got.rows == got.rejected_rows == 0


def test_other_separators(spark, tmp_path):
    path = put(tmp_path, a="Year;Median_Annual_Earnings;Region_name\n2020;'£1;2';London\n20x0;5;Leeds\n")
    got = import_raw(spark, "earnings", path, sep=";", quote="'")
    assert rows(got.good) == [(2020, "London", "£1;2")]
    assert rows(got.rejected, "line", "failed_columns") == [("20x0;5;Leeds", "Year")]


def test_headers():
    assert header_of('﻿"a b", c ,"d,e"') == ("a b", "c", "d,e") and header_of("") == header_of(None) == ()
    schema = T.StructType([T.StructField("B", T.StringType())])
    assert match_header(("a", "b"), schema) == {"B": 1}
