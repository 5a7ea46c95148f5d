"""Dense surrogate keys for dimensions too large for a single-partition window.

``row_number() OVER (ORDER BY code)`` without a partition key sends every row to one task. For
a large dimension the same numbers are produced in parallel:

1. range-partition on the order columns and sort inside each partition, so partition ``i``
   holds a contiguous, ordered slice of the key space;
2. record each row's partition id and its position inside the partition, and checkpoint to the
   shared folder, so positions never change on recomputation (a lost executor re-reads the
   checkpoint instead of re-sampling the range bounds);
3. count rows per partition — one row per partition — and turn the counts into starting
   offsets with a running sum over that small frame;
4. key = starting offset of the partition + position inside it + 1.

Only step 3's frame (one row per partition, bounded by the partition count) is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.session import shared_dir
from hearth.sources.versions import VersionedTable

#: Columns of a table of known keys.
KNOWN_KEYS = "code string, key bigint"

# monotonically_increasing_id() puts the partition id in the upper 31 bits and the record
# number inside the partition in the lower 33 bits.
_RECORD_BITS = 33


def dense_key(df: DataFrame, order_cols: Sequence[str], key_col: str, num_partitions: int | None = None) -> DataFrame:
    """``df`` with a 1-based ``key_col`` numbering rows in ``order_cols`` order (BIGINT)."""
    spark = df.sparkSession
    shared_dir(spark)  # make sure a checkpoint folder is configured
    n = int(num_partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    # a deterministic hash of the whole row breaks ties, so even a code shared by a third of
    # the rows is spread over several range partitions (tied rows may take any order, as with
    # ROW_NUMBER)
    order = [F.col(c) for c in order_cols] + [F.xxhash64(*[F.col(c) for c in df.columns]).alias("_tie")]
    ranged = df.withColumn("_tie", order[-1]).repartitionByRange(n, *order_cols, "_tie").sortWithinPartitions(
        *order_cols, "_tie")
    placed = ranged.select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")
    ).checkpoint(eager=True)
    counts = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_c").over(before), F.lit(0)).cast("bigint").alias("_off"))
    position = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), _RECORD_BITS)
    return placed.join(F.broadcast(offsets), "_pid").select(
        (F.col("_off") + position + 1).alias(key_col), *[F.col(c) for c in df.columns]
    )


def stable_key(df: DataFrame, natural: str, key_col: str, known: VersionedTable, num_partitions: int | None = None) -> DataFrame:
    """``df`` with a ``key_col`` (BIGINT) that a value of ``natural`` keeps from load to load.

    ``known`` holds every value numbered so far; values that it lacks are numbered after its largest
    key, in order and in parallel, and become known in one commit (of two loads at the same time one
    is refused). Null has no key.
    """
    values = df.select(F.col(natural).alias("code")).where("code IS NOT NULL").distinct()
    if known.current() is None:
        last, unseen = 0, values
    else:
        seen = known.read(KNOWN_KEYS)
        last = seen.agg(F.max("key")).first()[0] or 0
        unseen = values.join(seen, "code", "left_anti")
    new = dense_key(unseen, ["code"], "key", num_partitions).select("code", (F.col("key") + last).alias("key"))
    if not new.isEmpty():
        known.load(new if last == 0 else known.read(KNOWN_KEYS).unionByName(new))
    elif known.current() is None:
        known.load(new)
    keys = known.read(KNOWN_KEYS).select(F.col("code").alias("_code"), F.col("key").alias(key_col))
    return df.join(keys, F.col(natural) == F.col("_code"), "left").select(key_col, *[F.col(c) for c in df.columns])
