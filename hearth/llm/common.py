"""Helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import hashlib
import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.session import new_run_dir, remove_folder, trim_driver


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SCRATCH: list[tuple[SparkSession, str]] = []
_TABLES: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder, removed when the application ends."""
    if not _SCRATCH:
        atexit.register(_clear)
    path = new_run_dir(spark, name)
    _SCRATCH.append((spark, path))
    return path


def _clear() -> None:
    for spark, path in _SCRATCH:
        own = path.rsplit("/", 1)[-1].replace("-", "_")
        if own in _TABLES:
            with contextlib.suppress(Exception):
                spark.sql(f"DROP TABLE IF EXISTS `{own}`")
        with contextlib.suppress(Exception):  # the session may have ended before
            remove_folder(spark, path)
    _SCRATCH.clear()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again: lineage ends at files
    that every executor can read, so a lost executor costs at most one stage. What planning and
    running it left in the driver's allocator is given back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    trim_driver(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """``df`` written as a table in buckets of ``key`` (as many as shuffles have partitions) under the
    shared folder: a join or grouping by ``key`` does not shuffle its rows again. The table is
    dropped, and its folder removed, when the application ends."""
    spark = df.sparkSession
    path, buckets = scratch(spark, name), int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = path.rsplit("/", 1)[-1].replace("-", "_")
    (df.write.bucketBy(buckets, key).option("path", path).option("compression", "zstd")
     .option("parquet.block.size", 32 << 20).option("parquet.block.size.row.check.min", 1).saveAsTable(own))
    _TABLES.append(own)
    return spark.table(own)


def release() -> None:
    """Give memory that Arrow and the allocator keep for later back to the machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(each: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``each``, which frees what a task held when it ends: Spark's Python workers live on, several
    for each core, and wait with all that they have once used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from each(batches)
        finally:
            release()

    return run


class Remote:
    """An object that was made in a task. The driver holds it pickled only; a worker unpickles it
    once (``value``)."""

    _seen: dict[str, object] = {}

    def __init__(self, spark: SparkSession, data: bytes):
        self._data, self._key = spark.sparkContext.broadcast(data), hashlib.sha256(data).hexdigest()

    @property
    def value(self):
        if self._key not in Remote._seen:
            Remote._seen.clear()  # one at a time: models are large
            Remote._seen[self._key] = pickle.loads(self._data.value)
        return Remote._seen[self._key]

    def free(self) -> None:
        """Give up the object: driver and executors hold it no longer, and no task may need it."""
        self._data.destroy()


def made_in_task(rows: DataFrame, make: Callable[[pd.DataFrame], object]) -> Remote | None:
    """``make`` of all ``rows`` - a sample whose bound the caller states - run in one task, so that
    neither the rows nor what is made of them take the driver's memory. None if it makes None."""

    def once(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = list(frames)
        made = make(pd.concat(own, ignore_index=True)) if own else None
        yield pd.DataFrame({"made": [pickle.dumps(made, protocol=5)]})

    data = b"".join(bytes(r.made) for r in rows.repartition(1).mapInPandas(once, "made binary").collect())
    return None if not data or data == pickle.dumps(None, protocol=5) else Remote(rows.sparkSession, data)


def free(columns: Sequence[str], name: str) -> str:
    """``name``, with underscores in front until no column has it (columns of the caller that share
    an operator's names are carried along untouched)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def col(name: str) -> Column:
    """The column of exactly this name."""
    return F.col("`" + name.replace("`", "``") + "`")


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Runs of equal non-null integer ``keys`` in batches that are sorted by them; a run may span
    several batches. Only one run is held at a time."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(int(c[0]) for c in cols)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for i, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
            held.append(b.slice(a, z - a))
            if i < len(cuts) - 2:
                yield pa.Table.from_batches(held)
                held = []
        last = tuple(int(c[-1]) for c in cols)
    if held:
        yield pa.Table.from_batches(held)
