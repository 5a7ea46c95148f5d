"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Documents with equal texts form a group that is never divided. Groups are sorted by size, largest
first, and each enters the bin with the least remaining capacity that still holds it; the bins are
kept in a balanced tree by remaining capacity, so a step costs the logarithm of the bin count.

The packing is done in two levels, so that no task and not the driver sees more than a bounded
number of items:

1. groups smaller than ``1 / PARTS`` of a shard are dealt to buckets by hash; every bucket packs its
   groups best-fit-decreasing into as few parcels of that size as possible;
2. the parcels and the larger groups (a few thousand items for each shard count, whatever the
   input) are packed best-fit-decreasing into shards. For a fixed shard count the capacity is the
   smallest that suffices, found by halving; for a fixed capacity the shard count is what results.

Slots number a shard's rows without gaps: rows are numbered inside units (a parcel, or a slice of a
large group), and units get running offsets, so one group with a third of all rows is numbered by
many tasks.

Edge cases: a null text counts as an empty one; repeated rows are rows of their own in the same
group; a null doc_id is an ordinary row, numbered first; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearth.llm.common import materialize, table

#: Parcels in a shard: groups below 1 / PARTS of a shard are packed into parcels of that size.
PARTS = 128
#: Groups that one bucket of the first level packs, about.
BUCKET_GROUPS = 50_000
#: Rows numbered by one task, about.
UNIT_ROWS = 200_000
#: Bytes counted for each row besides its text.
ROW_BYTES = 16


class CapacityTree:
    """Bins by remaining capacity in an AVL tree; equal capacities by bin number.

    ``take(need)`` removes and returns the bin with the least remaining capacity of at least
    ``need``; ``put`` adds one."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None  # [key, left, right, height]

    def put(self, key: tuple[int, int]) -> None:
        self.root = _insert(self.root, key)

    def take(self, need: int) -> tuple[int, int] | None:
        node, best, want = self.root, None, (need, -1)
        while node is not None:
            if node[0] >= want:
                best, node = node[0], node[1]
            else:
                node = node[2]
        if best is not None:
            self.root = _delete(self.root, best)
        return best


def _height(n) -> int:
    return n[3] if n is not None else 0


def _fix(n):
    n[3] = 1 + max(_height(n[1]), _height(n[2]))
    tilt = _height(n[1]) - _height(n[2])
    if tilt > 1:
        if _height(n[1][1]) < _height(n[1][2]):
            n[1] = _rotate(n[1], 2, 1)
        return _rotate(n, 1, 2)
    if tilt < -1:
        if _height(n[2][2]) < _height(n[2][1]):
            n[2] = _rotate(n[2], 1, 2)
        return _rotate(n, 2, 1)
    return n


def _rotate(n, up: int, down: int):
    top = n[up]
    n[up], top[down] = top[down], n
    for x in (n, top):
        x[3] = 1 + max(_height(x[1]), _height(x[2]))
    return top


def _insert(n, key):
    if n is None:
        return [key, None, None, 1]
    side = 1 if key < n[0] else 2
    n[side] = _insert(n[side], key)
    return _fix(n)


def _delete(n, key):
    if key < n[0]:
        n[1] = _delete(n[1], key)
    elif key > n[0]:
        n[2] = _delete(n[2], key)
    elif n[1] is None or n[2] is None:
        return n[1] if n[1] is not None else n[2]
    else:
        least = n[2]
        while least[1] is not None:
            least = least[1]
        n[0] = least[0]
        n[2] = _delete(n[2], least[0])
    return _fix(n)


def best_fit_decreasing(sizes: Sequence[int], capacity: int, max_bins: int | None = None) -> list[int] | None:
    """Bin number of every item. An item above the capacity gets a bin of its own. None if more
    than ``max_bins`` bins would be needed."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    tree, bins, out = CapacityTree(), 0, [0] * len(sizes)
    for i in order:
        found = tree.take(sizes[i])
        if found is None:
            found = (max(capacity, sizes[i]), bins)
            bins += 1
            if max_bins is not None and bins > max_bins:
                return None
        out[i] = found[1]
        if found[0] > sizes[i]:
            tree.put((found[0] - sizes[i], found[1]))
    return out


def fewest_capacity(sizes: Sequence[int], bins: int) -> list[int]:
    """Best-fit-decreasing into at most ``bins`` bins with the smallest capacity that suffices."""
    low = max(1, -(-sum(sizes) // bins)) if sizes else 1
    high = low + max(sizes, default=0)
    best = best_fit_decreasing(sizes, high, bins)
    while low < high:
        mid = (low + high) // 2
        got = best_fit_decreasing(sizes, mid, bins)
        if got is None:
            low = mid + 1
        else:
            best, high = got, mid
    return best if best is not None else [0] * len(sizes)


def shard_by_size(rows: DataFrame, shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """``rows`` (with columns group_key string, size bigint, doc_id) with ``shard`` and ``slot``.

    Give either a shard count, or a capacity in bytes for as few shards as best fit gives."""
    spark = rows.sparkSession
    rows = materialize(rows, "shard-rows")
    groups = materialize(rows.groupBy("group_key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-groups")
    n_groups, total, n_rows = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0)),
                                         F.coalesce(F.sum("n"), F.lit(0))).first()
    parcel = max(1, (capacity or -(-total // (shards or 1))) // PARTS)
    buckets = max(1, -(-n_groups // BUCKET_GROUPS))

    small = groups.where(F.col("bytes") < parcel).withColumn("bucket", F.pmod(F.xxhash64("group_key"), F.lit(buckets)))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("group_key")
        frame["bin"] = best_fit_decreasing(frame["bytes"].tolist(), parcel)
        return frame[["group_key", "bucket", "bin", "bytes", "n"]]

    parcels = small.groupBy("bucket").applyInPandas(pack, "group_key string, bucket bigint, bin bigint, bytes bigint, n bigint")
    large = groups.where(F.col("bytes") >= parcel).select("group_key", F.lit(-1).cast("bigint").alias("bucket"),
                                                          F.xxhash64("group_key").alias("bin"), "bytes", "n")
    placed = materialize(parcels.unionByName(large), "shard-parcels")
    # a few thousand items: every parcel but the last of a bucket is nearly full, every large group
    # holds at least a parcel
    items = sorted(tuple(r) for r in placed.groupBy("bucket", "bin").agg(F.sum("bytes"), F.sum("n")).collect())
    sizes = [r[2] for r in items]
    shard_of = fewest_capacity(sizes, shards) if shards else best_fit_decreasing(sizes, capacity)
    units, offset = [], {}
    slices = {}
    for (bucket, bin_, _, n), shard in zip(items, shard_of, strict=True):
        slices[bucket, bin_] = -(-n // UNIT_ROWS)
        units.append((bucket, bin_, int(shard), slices[bucket, bin_]))
    told = spark.createDataFrame(units, "bucket bigint, bin bigint, shard int, slices bigint") if units else \
        spark.range(0).selectExpr("id AS bucket", "id AS bin", "cast(id AS int) AS shard", "id AS slices")
    unit = ["bucket", "bin", "slice"]
    dealt = (rows.join(placed.select("group_key", "bucket", "bin"), "group_key")
             .join(told, ["bucket", "bin"])
             .withColumn("slice", F.pmod(F.xxhash64("doc_id", "size"), F.col("slices"))))
    dealt = materialize(dealt, "shard-dealt")
    counts = dealt.groupBy("shard", *unit).agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("shard").orderBy(*unit).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", *unit, F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", *unit).orderBy("doc_id", "group_key")
    return (dealt.withColumn("position", F.row_number().over(inside) - 1)
            .join(starts, ["shard", *unit])
            .withColumn("slot", (F.col("start") + F.col("position")).cast("bigint"))
            .drop(*unit, "slices", "start", "position"))


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, group_key, shard, slot of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("group_key"))
    return shard_by_size(rows, shards)


SHARDS = 40


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
