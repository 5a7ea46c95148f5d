"""Batch job: build the workspace and write every registered query's result as Parquet.

    python -m hearth.plans.run --raw-dir DIR --out DIR [--country England] [--remap EAST=East of England]
    python -m hearth.plans.run --sf-dir /root/testdata/sf0.01 --out DIR

``--raw-dir`` holds the five raw inputs as CSV folders or files named ``regions``,
``district_region_lookup``, ``district_prices``, ``rents`` and ``earnings`` (schemas in
``hearth.sources.files.RAW_SCHEMAS``; CSV columns in any order, found by their names). Each result is written by its own distributed job to
``OUT/<query>``; nothing is collected to the driver.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from hearth.operators.gate import MODES
from hearth.plans.context import Housing
from hearth.plans.registry import HOUSING_QUERIES, run_query
from hearth.sources.files import import_raw, read_raw
from hearth.sources.tpch import RawInputs

RAW_FILES = ("regions", "district_region_lookup", "district_prices", "rents", "earnings")


def read_raw_dir(spark: SparkSession, raw_dir: str, fmt: str = "csv", rejects: str | None = None) -> RawInputs:
    """The raw inputs under ``raw_dir``. CSV lines that do not parse stop the job, or, given a folder
    ``rejects``, are written there as ``<input>`` (file, line, failed_columns) and counted on standard error."""
    root = raw_dir.rstrip("/")
    if fmt == "csv" and rejects is not None:
        t = {}
        for name in RAW_FILES:
            got = import_raw(spark, name, f"{root}/{name}")
            got.rejected.write.mode("overwrite").parquet(f"{rejects.rstrip('/')}/{name}")
            print(f"{name}: {got.rows} lines, {got.rejected_rows} rejected", file=sys.stderr)
            t[name] = got.good
    else:
        t = {name: read_raw(spark, name, f"{root}/{name}", fmt=fmt) for name in RAW_FILES}
    return RawInputs(regions=t["regions"], lad=t["district_region_lookup"], prices=t["district_prices"],
                     rents=t["rents"], earnings=t["earnings"])


def write_all(h: Housing, out_dir: str, names=None) -> list[str]:
    """Write the named queries (default: all) under ``out_dir``; returns the names written."""
    written = []
    for name in names or HOUSING_QUERIES:
        run_query(h, name).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{name}")
        written.append(name)
    return written


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw-dir", help="folder with the five raw inputs")
    src.add_argument("--sf-dir", help="folder with the TPC-H-shaped test tables")
    ap.add_argument("--format", default="csv", help="format of the raw inputs (csv or parquet)")
    ap.add_argument("--rejects", help="folder for CSV lines that do not parse; without it the first one stops the job")
    ap.add_argument("--rules", choices=MODES, default="filter", help="rows that break a NOT NULL rule: report (keep), filter "
                    "(leave out, the default) or fail (publish nothing)")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--country", help="default: England; with --sf-dir, the test mapping's")
    ap.add_argument("--remap", action="append", help="LABEL=Canonical name (repeatable); default: EAST=East of "
                    "England, the source's label fix; with --sf-dir, the test mapping's")
    ap.add_argument("--years", help="years of the national trend report; default: 2023,2024; with --sf-dir, the test mapping's")
    ap.add_argument("--query", action="append", help="only these queries (repeatable)")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("hearth").getOrCreate()
    given = {"rules": args.rules}
    if args.country is not None:
        given["country"] = args.country
    if args.remap is not None:
        given["remap"] = {k.strip().upper(): v for k, v in (kv.split("=", 1) for kv in args.remap)}
    if args.years is not None:
        given["trend_years"] = tuple(int(y) for y in args.years.split(","))
    if args.sf_dir:
        h = Housing(spark, args.sf_dir.rstrip("/"), **given)
    else:
        source = {"country": "England", "remap": {"EAST": "East of England"}, "trend_years": (2023, 2024)}
        h = Housing.from_raw(spark, read_raw_dir(spark, args.raw_dir, args.format, args.rejects), **(source | given))
    with h:
        for name in write_all(h, args.out, args.query):
            print(name)
    return 0


if __name__ == "__main__":
    sys.exit(main())
