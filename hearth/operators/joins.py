"""Size-checked broadcast.

A broadcast hint is given only for a side whose row count is bounded by a number known before
the join runs — the row count of a written table, or a product of such counts. Beyond the limit
no hint is given: the planner and adaptive execution choose from runtime statistics (a
sort-merge join for large sides), so results never depend on the choice.

Fixed-size inputs (the region list, the calendar, the nation and continent tables) are broadcast
directly where they are used; this helper is for sides derived from the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest row bound hinted for broadcast (narrow rows: a key, a time value, a sum and a count).
BROADCAST_ROW_LIMIT = 1_000_000
# ... and their bytes: names count as 64 bytes, the width limit assumed for a name column.
BROADCAST_BYTE_LIMIT = 256 << 20
BYTES_CONF = "hearth.broadcast.maxBytes"
_WIDTH = {"integer": 8, "long": 8, "date": 8, "double": 8, "decimal": 24, "string": 64}
LIMIT_CONF = "hearth.broadcast.maxRows"


def row_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(LIMIT_CONF, str(BROADCAST_ROW_LIMIT)))


def within_limit(df: DataFrame, row_bound: int | None) -> bool:
    """Whether ``row_bound`` (an upper bound of ``df``'s rows) is known and allows a broadcast: at
    most the row limit, and at most the byte limit at the planner's width of a row."""
    if row_bound is None or row_bound > row_limit(df):
        return False
    width = sum(_WIDTH.get(f.dataType.typeName(), 64) for f in df.schema.fields)
    return row_bound * width <= int(df.sparkSession.conf.get(BYTES_CONF, str(BROADCAST_BYTE_LIMIT)))


def size_checked_broadcast(df: DataFrame, row_bound: int | None) -> DataFrame:
    """``broadcast(df)`` when ``row_bound`` allows it (:func:`within_limit`); otherwise ``df``
    unchanged."""
    return F.broadcast(df) if within_limit(df, row_bound) else df


#: Share of the rows from which a key counts as hot.
HOT_SHARE = 0.01


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """All keys that more than ``share`` of the rows have, and perhaps some others: at most 1 / share
    values, from a frequent-items sketch whose states are merged (one pass, no shuffle of rows)."""
    found = df.select(F.col(key).alias("k")).where("k IS NOT NULL").stat.freqItems(["k"], share).first()
    return [v for v in found[0] if v is not None] if found is not None and found[0] is not None else []


def heavy_key_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, share: float = HOT_SHARE) -> DataFrame:
    """Inner join of ``left``, whose keys may be skewed, with ``right``, which has few rows for a key.

    Rows of hot keys meet their side of ``right`` - the rows of at most 1 / share keys, counted
    before they are broadcast - map-side, so a key with a third of all rows stays spread over the tasks
    that read it. All other rows are shuffled by key; no key of theirs has more than ``share`` of them,
    and no row of ``right`` is copied.
    """
    hot = hot_keys(left, left_key, share)
    on = F.col(left_key) == F.col(right_key)
    if not hot:
        return left.join(right, on)
    few = right.where(F.col(right_key).isin(hot))
    warm = left.where(F.col(left_key).isin(hot)).join(size_checked_broadcast(few, few.count()), on)
    cold = left.where(~F.col(left_key).isin(hot)).join(right.where(~F.col(right_key).isin(hot)), on)
    return cold.unionByName(warm)
