"""Generic data-quality operators. Each returns a DataFrame report (never collects):
counts are one-row global aggregates, everything else is a distributed filter, anti-join or
grouped count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions.text import collated, norm


def count_where(df: DataFrame, cond: Column | None, alias: str) -> DataFrame:
    """One row: number of rows satisfying ``cond`` (0 when none; always one row)."""
    d = df if cond is None else df.filter(cond)
    return d.agg(F.count(F.lit(1)).alias(alias))


def _grouped(df: DataFrame, keys: Sequence[str]):
    """``df`` grouped on ``keys`` as the source's collation groups them (text without case and
    trailing spaces), and the aggregates that give each text key's smallest spelling."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    by = [collated(k).alias(f"_{k}") if k in text else F.col(k) for k in keys]
    return df.groupBy(*by), [F.min(k).alias(k) for k in keys if k in text]


def duplicates(df: DataFrame, keys: Sequence[str], alias: str = "c") -> DataFrame:
    """Key values that occur more than once, with their count (a uniqueness violation report)."""
    return rows_per(df, keys, alias).filter(F.col(alias) > 1)


def rows_per(df: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """Row count per key (coverage report)."""
    groups, names = _grouped(df, keys)
    return groups.agg(*names, F.count(F.lit(1)).alias(alias)).select(*keys, alias)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column under the source's collation (each in its smallest spelling)."""
    groups, names = _grouped(df, [col])
    return groups.agg(*names).select(col)


def null_profile(df: DataFrame, cols: Sequence[str], prefix: str = "Null_") -> DataFrame:
    """One row, one ``<prefix><col>`` count per column, in a single pass.

    ``SUM(CASE ...)`` rather than ``count_if`` so an empty table gives NULLs, as in the source.
    """
    return df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"{prefix}{c}") for c in cols])


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent row (``LEFT JOIN ... IS NULL`` as an anti-join). The
    parent's keys are made distinct first, map-side: a parent with many rows for each key shuffles
    few."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def unmatched_names(df: DataFrame, col: str, dim: DataFrame, dim_col: str, normalise_left: bool = True) -> DataFrame:
    """Distinct values of ``df.col`` with no normalised match in ``dim.dim_col``.

    Distinct first (one grouping under the collation, whose partial aggregation collapses repeated
    and hot names map-side), then the anti-join runs on one row per name: the same result as
    anti-joining every row. A group's key holds all that its spellings share, so the normalised name
    follows from it; without ``normalise_left`` leading spaces count.
    """
    group = F.col("_g")
    names = df.groupBy(collated(col).alias("_g")).agg(F.min(col).alias(col)).withColumn("_k", F.ltrim(group) if normalise_left else group)
    keys = dim.select(norm(dim_col).alias("_k"))
    return names.join(keys.distinct(), "_k", "left_anti").select(col)


def top_n(df: DataFrame, order: Sequence[Column], n: int = 10) -> DataFrame:
    """First ``n`` rows in ``order`` (planned as TakeOrderedAndProject: a per-partition top-n,
    then a merge of n rows per partition)."""
    return df.orderBy(*order).limit(n)


def key_violations(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per declared key: ``(table_name, key_columns, duplicate_keys, null_keys)``.

    Replaces the source's primary-key / unique-index enforcement with a report. All keys declared
    on the same table are counted in one pass: a grouping-sets aggregation groups the rows by
    every key at once (``grouping_id`` tells the key sets apart), then one global aggregate folds
    the groups into the report (so an empty table still gets its rows).
    """
    by_table: dict[int, tuple[DataFrame, list[tuple[str, list[str]]]]] = {}
    for name, (df, keys) in tables.items():
        by_table.setdefault(id(df), (df, []))[1].append((name, list(keys)))
    out = None
    for df, entries in by_table.values():
        cols = list(dict.fromkeys(k for _, keys in entries for k in keys))
        text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
        df = df.select(*[collated(c).alias(c) if c in text else F.col(c) for c in cols])
        sets = [list(s) for s in dict.fromkeys(tuple(keys) for _, keys in entries)]
        groups = df.groupingSets(sets, *cols).agg(F.count(F.lit(1)).alias("_c"), F.grouping_id().alias("_gid"))
        folds = []
        for i, (_, keys) in enumerate(entries):
            mine = F.col("_gid") == sum(1 << (len(cols) - 1 - j) for j, c in enumerate(cols) if c not in keys)
            any_null = F.lit(False)
            for k in keys:
                any_null = any_null | F.col(k).isNull()
            folds += [
                F.count_if(mine & (F.col("_c") > 1)).alias(f"_d{i}"),
                F.coalesce(F.sum(F.when(mine & any_null, F.col("_c"))), F.lit(0).cast("bigint")).alias(f"_n{i}"),
            ]
        stack = ", ".join(f"'{name}', '{','.join(keys)}', _d{i}, _n{i}" for i, (name, keys) in enumerate(entries))
        rows = groups.agg(*folds).selectExpr(
            f"stack({len(entries)}, {stack}) as (table_name, key_columns, duplicate_keys, null_keys)")
        out = rows if out is None else out.unionByName(rows)
    return out


def not_null_violations(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per (table, column) under a NOT NULL rule with its violation count, one pass per
    table."""
    out = None
    for name, (df, cols) in tables.items():
        prof = null_profile(df, cols, prefix="")
        stack = ", ".join(f"'{c}', coalesce(`{c}`, 0L)" for c in cols)
        row = prof.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, null_rows)").select(
            F.lit(name).alias("table_name"), "column_name", F.col("null_rows").cast("bigint").alias("null_rows")
        )
        out = row if out is None else out.unionByName(row)
    return out
