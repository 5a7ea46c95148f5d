"""CSV imports whose columns are found by name and whose bad lines are set aside.

A publisher's file may hold the declared columns in any order, with others in between. The header of
every file is read and checked first; files with the same header are read together, each declared
column from the place where the header names it. A line is bad if it has too many or too few fields
or if a typed field does not parse. One pass writes the import, partitioned into good rows and
rejected lines (with file, line and the columns that failed), and counts both while it writes.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.session import list_files, new_run_dir

LINE = "_line"
_BYTE_ORDER_MARK = "﻿"


class HeaderError(ValueError):
    """A file's header does not name every declared column exactly once."""


@dataclass(frozen=True)
class CsvImport:
    """``good`` has the declared columns; ``rejected`` has file, line and failed_columns (comma-joined;
    ``*`` where the number of fields is wrong)."""

    good: DataFrame
    rejected: DataFrame
    rows: int
    rejected_rows: int


def header_of(line: str | None, sep: str = ",", quote: str = '"') -> tuple[str, ...]:
    """Column names in a header line."""
    if not line:
        return ()
    (names,) = csv.reader([line.removeprefix(_BYTE_ORDER_MARK)], delimiter=sep, quotechar=quote)
    return tuple(n.strip() for n in names)


def match_header(names: Sequence[str], schema: T.StructType, file: str = "") -> dict[str, int]:
    """Place of every declared column in a header; names are compared without case."""
    places: dict[str, list[int]] = {}
    for i, n in enumerate(names):
        places.setdefault(n.lower(), []).append(i)
    missing = [f.name for f in schema if f.name.lower() not in places]
    double = [f.name for f in schema if len(places.get(f.name.lower(), ())) > 1]
    if missing or double:
        told = [f"{what}: {', '.join(cols)}" for what, cols in (("missing", missing), ("named twice", double)) if cols]
        raise HeaderError(f"header of {file or 'the file'} ({'; '.join(told)}): {list(names)}")
    return {f.name: places[f.name.lower()][0] for f in schema}


def _by_header(spark: SparkSession, path: str, sep: str, quote: str) -> dict[tuple[str, ...], list[str]]:
    """Files under ``path`` by their headers; empty files have none. One short job a file, as each
    publisher's import is a few files; a folder that a Spark job wrote is read by its first file that has a header."""
    found: dict[tuple[str, ...], list[str]] = {}
    for file in list_files(spark, path):
        first = spark.read.option("lineSep", "\n").text(file).limit(1).collect()
        if first:
            found.setdefault(header_of(first[0].value.rstrip("\r"), sep, quote), []).append(file)
    return found


def _failed(schema: T.StructType, names: Sequence[str], sep: str, quote: str) -> Column:
    """Names of the columns of a bad line that do not parse, ``*`` if the number of fields is wrong."""
    at = match_header(names, schema)
    texts = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"sep": sep, "quote": quote, "mode": "PERMISSIVE"}
    fields = F.from_csv(F.col(LINE), f"{texts}, surplus string", options)
    wrong = [F.when(fields[f"c{at[f.name]}"].isNotNull()
                    & F.from_csv(F.col(LINE), ", ".join(
                        f"c{i} {f.dataType.simpleString() if i == at[f.name] else 'string'}" for i in range(len(names))), options)
                    [f"c{at[f.name]}"].isNull(), F.lit(f.name))
             for f in schema if not isinstance(f.dataType, T.StringType)]
    listed = F.concat_ws(",", *wrong) if wrong else F.lit("")
    return F.coalesce(F.nullif(listed, F.lit("")), F.lit("*"))


def read_csv(spark: SparkSession, schema: T.StructType, path: str, bad: str = "fail", **options) -> DataFrame:
    """The declared columns of the CSV files under ``path``, found by name. ``bad`` lines stop the
    job (``fail``), or come with nulls for what does not parse (``null``), or with the line itself
    and the file in columns ``_line`` and ``_file`` (``keep``; null in good rows)."""
    sep, quote = options.get("sep", ","), options.get("quote", '"')
    out = None
    for names, files in sorted(_by_header(spark, path, sep, quote).items()):
        at = match_header(names, schema, files[0])
        of = {i: n for n, i in at.items()}
        types = {f.name: f.dataType for f in schema}
        full = [T.StructField(f"_c{i}", types[of[i]] if i in of else T.StringType()) for i in range(len(names))]
        reader = (spark.read.schema(T.StructType([*full, T.StructField(LINE, T.StringType())])).option("header", "true")
                  .option("enforceSchema", "true").option("encoding", "UTF-8").option("columnNameOfCorruptRecord", LINE)
                  .option("columnPruning", "false")  # a line is judged by all of its fields
                  .option("mode", "FAILFAST" if bad == "fail" else "PERMISSIVE"))
        for k, v in options.items():
            reader = reader.option(k, v)
        got = reader.csv(files)
        own = [F.col(f"_c{at[f.name]}").alias(f.name) for f in schema]
        if bad == "keep":
            failed = F.when(F.col(LINE).isNotNull(), _failed(schema, names, sep, quote))
            own += [F.col(LINE), F.col("_metadata.file_path").alias("_file"), failed.alias("_failed")]
        got = got.select(*own)
        out = got if out is None else out.unionByName(got)
    if out is None:
        extra = [T.StructField(c, T.StringType()) for c in (LINE, "_file", "_failed")] if bad == "keep" else []
        out = spark.createDataFrame([], T.StructType([*schema.fields, *extra]))
    return out


def import_csv(spark: SparkSession, schema: T.StructType, path: str, into: str | None = None, **options) -> CsvImport:
    """Import the CSV files under ``path``: one pass writes good rows and rejected lines to ``into``
    (a fresh folder under the shared one) and counts them."""
    into = into or new_run_dir(spark, "import")
    seen = Observation()
    is_bad = F.col(LINE).isNotNull()
    split = read_csv(spark, schema, path, "keep", **options).withColumn("_rejected", is_bad)
    split = split.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(is_bad).alias("rejected"))
    split.write.partitionBy("_rejected").parquet(into)
    whole = spark.read.schema(split.schema).parquet(into)
    good = whole.where("NOT _rejected").select(*schema.names)
    rejected = whole.where("_rejected").select(F.col("_file").alias("file"), F.col(LINE).alias("line"),
                                               F.col("_failed").alias("failed_columns"))
    return CsvImport(good, rejected, seen.get["rows"], seen.get["rejected"])
