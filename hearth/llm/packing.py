"""Sequence packing by Karmarkar-Karp multiway differencing.

Every document is tokenized, ended by a separator id, and cut: whole sequences are taken off long
documents, and what remains is packed with the remains of its neighbours. A block of remains is
divided among k windows by multiway differencing: every piece starts as a partial partition (one
window with the piece, k - 1 empty ones); the two partial partitions with the largest imbalance are
merged again and again, the fullest window of one with the emptiest of the other, until one
partition is left whose windows are nearly equal. k starts at the least possible count and rises
whenever a window exceeds the capacity. So that the windows can be made nearly full, every few
documents are cut into small pieces, which differencing places last.

Blocks follow the input's own partitions: nothing is shuffled, a task holds one block, and a lost
task is packed again from the same rows. Sequence ids hold the partition number.

Edge cases: a null or empty text is the separator alone; repeated rows are packed as often as they
occur; a null doc_id is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import table, tidy
from hearth.llm.tokens import MEMO, memo
from hearth.llm.words import arrow_bytes, groups

#: Tokens of a sequence, and the id that ends a document.
CAPACITY = 1024
SEPARATOR = 0
#: Bytes of text tokenized at once.
GROUP_BYTES = 8 << 20
#: Remains packed together.
BLOCK = 128
#: Every FINE-th remain is cut into pieces of FINE_TOKENS.
FINE = 8
FINE_TOKENS = 16


def difference(sizes: Sequence[int], k: int) -> list[tuple[int, list[int]]]:
    """Multiway differencing of ``sizes`` into at most k windows: (sum, item numbers) of each
    non-empty window. A partial partition keeps its non-empty windows only, fullest first."""
    heap = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        over = len(a) + len(b) - k
        if over > 0:  # the emptiest windows of a meet the emptiest of b in opposite order
            keep = len(a) - over
            met = [(x + y, p + q) for (x, p), (y, q) in zip(a[keep:], reversed(b[len(b) - over:]), strict=True)]
            c = a[:keep] + b[:len(b) - over] + met
        else:
            c = a + b
        c.sort(key=lambda w: -w[0])
        n += 1
        heapq.heappush(heap, ((c[-1][0] if len(c) == k else 0) - c[0][0], n, c))
    return heap[0][2] if heap else []


def pack(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Windows (item numbers) of at most ``capacity``, as few as differencing finds, going up."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = difference(sizes, k)
        if not windows or windows[0][0] <= capacity:
            return [items for _, items in windows]
        k += max(1, k // 256)


SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint")


def _arrow_schema(ids: bool) -> pa.Schema:
    own = pa.schema([(c, pa.int64()) for c in _COLUMNS])
    return own.append(pa.field("ids", pa.list_(pa.int32()))) if ids else own


_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, separator: int = SEPARATOR,
                   ids: bool = False, group_bytes: int = GROUP_BYTES, remembered: int = MEMO) -> DataFrame:
    """Pieces of all documents: where each lies in its document and in its sequence, with the
    token ids themselves if ``ids``. ``tokenizer`` is a file that every executor can open. Less
    text tokenized at once, and fewer cuts remembered, take less memory and more time; the pieces
    are the same."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = memo(tokenizer, remembered), np.array([separator], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        made = 0  # sequences so far
        rest: list[tuple] = []  # (document, start, length); a document: (doc_id, tokens, ids as little-endian bytes)
        out: list[list] = [[] for _ in _COLUMNS]
        found: list[np.ndarray] = []  # ids of the pieces in out

        def put(document: tuple, start: int, length: int, offset: int) -> None:
            doc, total, own = document
            span = own[4 * start:4 * (start + length)]
            for column, value in zip(out, (doc, start, length, zlib.crc32(span), total, (part << 36) + made, offset), strict=True):
                column.append(value)
            if ids:
                found.append(np.frombuffer(span, "<u4"))

        def documents(b: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
            """Id and tokens with the separator, as little-endian bytes, of every document; texts are tokenized in groups."""
            names, texts = b.column("doc_id").to_pylist(), b.column("text")
            _, offsets = arrow_bytes(texts)
            for i, j in groups(offsets, group_bytes):
                flat, at = words.ids_of(texts.slice(i, j - i))
                for k, (a, e) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True), i):
                    yield names[k], flat[a:e].astype("<u4").tobytes() + end

        def flush() -> None:
            nonlocal made
            pieces = []
            for i, (document, start, length) in enumerate(rest):
                step = FINE_TOKENS if i % FINE == 0 else capacity
                pieces += [(document, a, min(step, start + length - a)) for a in range(start, start + length, step)]
            rest.clear()
            for window in pack([p[2] for p in pieces], capacity):
                offset = 0
                for i in window:
                    put(*pieces[i], offset)
                    offset += pieces[i][2]
                made += 1

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in out]
            if ids:
                ends = np.cumsum([0, *map(len, found)])
                flat = np.concatenate([*found, np.zeros(0, np.uint32)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
                found.clear()
            for c in out:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, schema=_arrow_schema(ids))

        for b in batches:
            for doc, own in documents(b):
                document, total, start = (doc, len(own) // 4, own), len(own) // 4, 0
                while total - start >= capacity:
                    put(document, start, capacity, 0)
                    made += 1
                    start += capacity
                if start < total:
                    rest.append((document, start, total - start))
                if len(rest) >= BLOCK:
                    flush()
                if len(out[0]) >= 20_000:
                    yield batch()
        flush()
        yield batch()

    schema = SCHEMA + (", ids array<int>" if ids else "")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        tidy(each), schema)


def tokenizer_path() -> str:
    """The public byte-level vocabulary that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
