"""Cleaning operators: the source's in-place UPDATE / DELETE / ALTER steps as immutable
DataFrame transforms. All are narrow (row-local) — no shuffle, no UDF."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions.text import blank_to_null as _blank_to_null
from hearth.functions.text import clean_count_int as _clean_count_int
from hearth.functions.text import clean_money_int as _clean_money_int
from hearth.functions.text import is_blank, norm
from hearth.functions.text import upper_trim as _upper_trim
from hearth.sources.versions import VersionedTable


def add_clean_money_int(df: DataFrame, src: str, dst: str | None = None, blank_as_zero: bool = False) -> DataFrame:
    """Add ``<src>_int``: money text -> INT (``£``, commas and spaces removed)."""
    return df.withColumn(dst or f"{src}_int", _clean_money_int(src, blank_as_zero))


def add_clean_count_int(df: DataFrame, src: str, dst: str | None = None, blank_as_zero: bool = False) -> DataFrame:
    """Add ``<src>_int``: count text with thousands separators -> INT."""
    return df.withColumn(dst or f"{src}_int", _clean_count_int(src, blank_as_zero))


def failed_conversion_count(df: DataFrame, src: str, dst: str, alias: str = "failed_rows") -> DataFrame:
    """One row: how many source values are present but did not convert."""
    return df.filter(F.col(src).isNotNull() & F.col(dst).isNull()).agg(F.count(F.lit(1)).alias(alias))


def failed_conversion_rows(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Rows whose source text is non-blank but whose converted value is NULL."""
    return df.filter(F.col(dst).isNull() & _blank_to_null(src).isNotNull())


def swap_clean_column(df: DataFrame, raw: str, clean: str) -> DataFrame:
    """Drop the raw column and give the cleaned one its name (keeps the column position of
    the cleaned column, as drop + rename does)."""
    return df.drop(raw).withColumnRenamed(clean, raw)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def blank_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Trim the named columns; empty strings become NULL."""
    return df.withColumns({c: _blank_to_null(c) for c in cols})


def any_null(cols: Sequence[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows that break a NOT NULL rule on any of ``cols``."""
    return df.filter(any_null(cols))


def drop_blank_rows(df: DataFrame, text_cols: Sequence[str], value_cols: Sequence[str] = ()) -> DataFrame:
    """Delete rows in which every text column is blank/NULL and every value column is NULL.

    The predicate is never NULL (``is_blank`` is total), so ``filter(~p)`` keeps every row the
    source's ``DELETE ... WHERE p`` keeps.
    """
    cond = F.lit(True)
    for c in text_cols:
        cond = cond & is_blank(c)
    for c in value_cols:
        cond = cond & F.col(c).isNull()
    return df.filter(~cond)


def remap_value(df: DataFrame, col: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace labels whose normalised form is a key of ``mapping`` by the canonical label.

    ``mapping`` keys are given normalised (upper-case, trimmed). Few labels: a CASE chain kept
    in codegen; the mapping is a parameter, so its size is bounded by the caller.
    """
    key = norm(col)
    out = F.col(col)
    for k, v in mapping.items():
        out = F.when(key == F.lit(k), F.lit(v)).otherwise(out)
    return df.withColumn(col, out)


def upper_trim(df: DataFrame, col: str) -> DataFrame:
    """Standardise a name column in place: ``UPPER(TRIM(x))``."""
    return df.withColumn(col, _upper_trim(col))


def enforce_not_null(df: DataFrame, cols: Sequence[str], fail: bool = False) -> DataFrame:
    """Keep only rows that satisfy the NOT NULL rule (report first with ``null_violations``), or,
    with ``fail``, stop the job at the first row that breaks it, as a table constraint does."""
    if fail:
        bad = F.raise_error(F.concat(F.lit("NULL in a NOT NULL column of "), F.lit(", ".join(cols))))
        return df.filter(F.when(any_null(cols), bad.cast("boolean")).otherwise(F.lit(True)))
    return df.filter(~any_null(cols))


def reload_after_fix(loaded: VersionedTable, rebuilt: DataFrame, check: Callable[[], None] | None = None) -> DataFrame:
    """Delete all rows of the table ``loaded`` and load ``rebuilt`` in their place, in one step:
    readers see the old rows or the new ones, and the old ones stay if the load does not end or
    ``check`` (run once the rows are written) raises."""
    return loaded.load(rebuilt, check)


def widen_decimal(df: DataFrame, cols: Sequence[str], dtype: str = "decimal(18,2)") -> DataFrame:
    """Retype measures to a fixed-point money type."""
    return df.withColumns({c: F.col(c).cast(dtype) for c in cols})
