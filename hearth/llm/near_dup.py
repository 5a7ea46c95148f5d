"""Near-duplicate documents by a multi-index Hamming join over b-bit MinHash signatures.

1. Every text becomes its set of distinct word shingles (64-bit hashes) and a signature: one
   16-bit value from each of ``K`` independent MinHash functions. Documents with equal sets collapse
   to the smallest doc_id, so a group of copies of any size is one node from here on.
2. Two sets of similarity s disagree in about (1 - s) * K components. All pairs that disagree in at
   most ``2 * CHUNKS - 1`` components are wanted: cut into CHUNKS chunks, such a pair has a chunk
   with at most one disagreement (pigeonhole). The chunk errors are enumerated as keys: every chunk
   is emitted once for each component left out, so two signatures share a key exactly if some chunk
   has at most one disagreement. At similarity 0.8 a pair stays below the distance with probability
   over 0.9998.
3. Rows with a key of their own go. Within a key, everything is compared with the smallest member
   (a star, not all pairs); signatures within the distance give blocks of possible links
   (connected components). Keys that still hold members of several blocks are compared member by
   member, in squares of a bounded size, and join blocks where a pair is within the distance. After
   that, every wanted pair lies inside one block.
4. Blocks are confirmed on full shingle sets. A small block is one task's work. A large one is cut
   into parts; every part meets a few fixed members (hubs) first, and then only the members that
   are not yet with the block's largest class are sent to every part. Pairs inside a class need no
   further test, so a large group of copies costs links, not pairs. Only tree edges leave a task.
5. The confirmed links' connected components are the classes.

Edge cases: a null or empty text, or one without words, has no shingles and is linked with nothing;
a text with fewer words than a shingle is one shingle; repeated rows get a row each; different
texts under one doc_id are linked with each other, and a text without words among them goes along; a row without doc_id has no component and is
kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import words as W
from hearth.llm.common import materialize, runs, table, tidy
from hearth.llm.components import components

#: Signature components, and chunks of the pigeonhole (keys = K, distance = 2 * CHUNKS - 1).
K = 64
CHUNKS = 13
#: Members on one side of a square of pairwise signature comparisons.
SQUARE = 2_048
#: Shingles that one task compares at once: a block with more is cut into parts of about as many.
PART = 2_000_000
#: Sets are linked from this similarity on, in percent.
PERCENT = 80
#: Members that every part of a large block is compared with first.
HUBS = 8
#: Candidate documents whose ids may be broadcast (8 bytes each) to read their texts again.
BROADCAST_IDS = 1_000_000

_CHAIN = np.uint64(0xA24BAED4963EE407)
_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, K, dtype=np.uint64) | np.uint64(1)
_BOUNDS = np.linspace(0, K, CHUNKS + 1).astype(int)
DISTANCE = 2 * CHUNKS - 1


def _sets(buf: np.ndarray, off: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row."""
    _, _, h, at = W.words(buf, off)
    n = len(h)
    chained = h
    if n >= width:
        chained = h[:n - width + 1].copy()
        for k in range(1, width):
            chained = W.mix(chained * _CHAIN + h[k:n - width + 1 + k])
    out = []
    for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if z - a >= width:
            out.append(np.unique(chained[a:z - width + 1]))
        elif z > a:  # the whole sequence as one
            x = h[a:a + 1]
            for k in range(a + 1, z):
                x = W.mix(x * _CHAIN + h[k:k + 1])
            out.append(W.mix(x + np.uint64(z - a)))
        else:
            out.append(h[:0])
    return out


def _each_group(batches: Iterator[pa.RecordBatch], width: int):
    """(row range's other columns, sets) for bounded ranges of rows."""
    for b in batches:
        buf, off = W.arrow_bytes(b.column("text"))
        for i, j in W.groups(off):
            yield b.slice(i, j - i), _sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], width)


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of a 2-d array."""
    rows = np.ascontiguousarray(rows)
    n, size = len(rows), rows.strides[0] if len(rows) else 0
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, (n + 1) * max(size, 1), max(size, 1), dtype=np.int32)[:n + 1].tobytes()),
                                                  pa.py_buffer(rows.tobytes())])


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit fingerprint of the set (f1, f2) and the signature."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sets in _each_group(batches, width):
            n = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(n)
            f1, f2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            sig = np.zeros((len(n), K), np.uint16)
            if len(full):
                u = np.concatenate([sets[i] for i in full])
                at = np.concatenate([[0], np.cumsum(n[full])[:-1]])
                m = W.mix(u + np.uint64(1))
                f1[full], f2[full] = np.add.reduceat(m, at), np.add.reduceat(W.mix(m), at)
                for k in range(K):
                    sig[full, k] = np.minimum.reduceat(u * _FACTORS[k], at) >> np.uint64(8)
            yield pa.record_batch([rows.column("doc_id"), pa.array(n), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                                   _binary(sig)], names=["doc_id", "n_shingles", "f1", "f2", "sig"])

    return docs.select("doc_id", "text").mapInArrow(tidy(each), "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, sig binary")


def _signature_array(column) -> np.ndarray:
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    buf, off = col.buffers()[2], col.offset
    return np.frombuffer(buf, np.uint16)[off * K:(off + len(col)) * K].reshape(-1, K) if len(col) else np.zeros((0, K), np.uint16)


def _keys(nodes: DataFrame) -> DataFrame:
    """(key, node): every chunk of the signature with one component left out."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig, node = _signature_array(b.column("sig")).astype(np.uint64), b.column("node").to_numpy()
            for i in range(0, len(node), 4096):
                s, out = sig[i:i + 4096], []
                for a, z in zip(_BOUNDS[:-1], _BOUNDS[1:], strict=True):
                    for drop in range(a, z):
                        x = np.full(len(s), drop + 1, np.uint64)
                        for q in range(a, z):
                            if q != drop:
                                x = W.mix(x * _CHAIN + s[:, q])
                        out.append(x)
                yield pa.record_batch([pa.array(np.concatenate(out).view(np.int64)), pa.array(np.tile(node[i:i + 4096], K))],
                                      names=["key", "node"])

    return nodes.select("node", "sig").mapInArrow(tidy(each), "key bigint, node bigint")


def _close(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures are within the distance and whose set sizes allow it."""
    n = nodes.select("node", "sig", "n")
    left = n.select(F.col("node").alias("a"), F.col("sig").alias("sa"), F.col("n").alias("na"))
    right = n.select(F.col("node").alias("b"), F.col("sig").alias("sb"), F.col("n").alias("nb"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = (_signature_array(b.column("sa")) != _signature_array(b.column("sb"))).sum(1) <= DISTANCE
            yield b.select(["a", "b"]).filter(pa.array(near))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(tidy(each), "a bigint, b bigint")


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join the same nodes without a cycle."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            parent[p] = q
            out.append((x, y))
    return out


def _join_blocks(open_rows: DataFrame) -> DataFrame:
    """Block pairs (a, b) that hold a pair within the distance, from rows (key, i, j, side, block,
    sig) sorted into runs of one square: side 0 meets side 1, or in a diagonal square itself."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["key", "i", "j"]):
            side, block, sig = run["side"].to_numpy(), run["block"].to_numpy(), _signature_array(run["sig"])
            left = np.flatnonzero(side == 0)
            right = np.flatnonzero(side == 1) if (side == 1).any() else left
            found_a, found_b = [], []
            for x in left.tolist():
                y = right[block[right] != block[x]]
                y = y[(sig[y] != sig[x]).sum(1) <= DISTANCE]
                if len(y):
                    other = np.unique(block[y])
                    found_a.append(np.full(len(other), block[x]))
                    found_b.append(other)
            if found_a:
                links = _forest(np.concatenate(found_a), np.concatenate(found_b))
                if links:
                    yield pa.record_batch([pa.array([p[0] for p in links], pa.int64()), pa.array([p[1] for p in links], pa.int64())],
                                          names=["a", "b"])

    return open_rows.mapInArrow(tidy(each), "a bigint, b bigint")


def _squares(rows: DataFrame, key: str, size: str, seed: str) -> DataFrame:
    """Rows of a key with ``size`` members dealt to squares (i, j): each of the key's parts meets
    itself and every other part once."""
    return (rows.withColumn("parts", F.ceil(F.col(size) / SQUARE).cast("int"))
            .withColumn("own", F.pmod(F.xxhash64(seed), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
            .withColumn("side", (F.col("own") > F.col("other")).cast("int")))


def blocks(nodes: DataFrame) -> DataFrame:
    """(node, block) such that all pairs within the signature distance share a block; nodes
    without a close one are left out."""
    keys = _keys(nodes)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("hub")).where("c > 1")
    rows = materialize(keys.join(shared, "key").select("key", "node", "c", "hub"), "dup-keys")
    pairs = rows.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    close = materialize(_close(pairs, nodes), "dup-close")
    first = materialize(components(close), "dup-blocks")
    # keys whose members lie in several blocks
    told = rows.join(first, "node", "left").select("key", "node", "c", F.coalesce("component", "node").alias("block"))
    several = told.groupBy("key").agg(F.min("block").alias("x"), F.max("block").alias("y")).where("x <> y")
    # a key of two was compared above
    rest = told.where("c > 2").join(several.select("key"), "key", "left_semi")
    rest = _squares(rest, "key", "c", "node").join(nodes.select("node", "sig"), "node").select("key", "i", "j", "side", "block", "sig")
    rest = rest.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    more = materialize(_join_blocks(rest), "dup-more")
    top = components(more).withColumnRenamed("node", "block").withColumnRenamed("component", "top")
    return first.select("node", F.col("component").alias("block")).unionByName(
        # a node that only now got company
        _lone(more, first)).join(top, "block", "left").select("node", F.coalesce("top", "block").alias("block"))


def _lone(more: DataFrame, first: DataFrame) -> DataFrame:
    ends = more.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return ends.join(first, "node", "left_anti").select("node", F.col("node").alias("block"))


def _block_sets(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """node, set (sorted 64-bit hashes, 8 bytes each) and the other columns of ``members``.

    The texts are read again for the members only. Their ids are broadcast if few; otherwise texts
    and ids meet by a shuffle."""
    few = members.count() <= BROADCAST_IDS
    own = members.withColumnRenamed("node", "doc_id")
    rows = docs.select("doc_id", "text").join(F.broadcast(own) if few else own, "doc_id")
    carried = [c for c in own.columns if c != "doc_id"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sets in _each_group(batches, width):
            off = np.concatenate([[0], np.cumsum([8 * len(s) for s in sets])]).astype(np.int32)
            data = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
            packed = pa.Array.from_buffers(pa.binary(), len(sets), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(data.tobytes())])
            yield pa.record_batch([rows.column("doc_id"), packed, *[rows.column(c) for c in carried]], names=["node", "set", *carried])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema.fields if f.name != "node")
    return rows.select("doc_id", "text", *carried).mapInArrow(tidy(each), f"node bigint, set binary, {fields}")


class _Sets:
    """Sets of one task's members, as numbers of a common dictionary."""

    def __init__(self, column) -> None:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in column]
        self.n = np.array([len(s) for s in sets], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.n)])
        values, ids = np.unique(np.concatenate(sets), return_inverse=True)
        self.ids, self.marks = ids, np.zeros(len(values), bool)

    def linked(self, x: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` whose set is similar enough to that of x."""
        n, nx = self.n[others], self.n[x]
        others = others[100 * np.minimum(n, nx) >= PERCENT * np.maximum(n, nx)]
        if not len(others):
            return others
        own = self.ids[self.at[x]:self.at[x + 1]]
        self.marks[own] = True
        if len(others) > len(self.n) // 2:
            common = np.add.reduceat(self.marks[self.ids], self.at[:-1], dtype=np.int64)[others]
        else:
            common = np.array([np.count_nonzero(self.marks[self.ids[self.at[y]:self.at[y + 1]]]) for y in others.tolist()], np.int64)
        self.marks[own] = False
        return others[100 * common >= PERCENT * (self.n[others] + nx - common)]


def _tree(sets: _Sets, label: np.ndarray, heads: list[int], against: np.ndarray) -> list[tuple[int, int]]:
    """Edges (member numbers) found by comparing ``heads`` with the members ``against`` that are
    not in the same class yet; ``label`` is updated."""
    out = []
    for x in heads:
        other = against[label[against] != label[x]]
        if not len(other):
            continue
        for y in sets.linked(x, other).tolist():
            if label[y] != label[x]:
                out.append((x, y))
                label[label == label[y]] = label[x]
    return out


def _largest(label: np.ndarray) -> int:
    values, counts = np.unique(label, return_counts=True)
    return int(values[np.argmax(counts)])


_EDGES = "a bigint, b bigint"


def _edge_batch(node: np.ndarray, edges: list[tuple[int, int]]) -> pa.RecordBatch:
    e = np.array(edges, np.int64).reshape(-1, 2)
    return pa.record_batch([pa.array(node[e[:, 0]]), pa.array(node[e[:, 1]])], names=["a", "b"])


def _confirm_small(sets: DataFrame) -> DataFrame:
    """Tree edges of confirmed links inside blocks that one task can hold."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["block"]):
            node, own = run["node"].to_numpy(), _Sets(run["set"])
            label, every = np.arange(len(node)), np.arange(len(node))
            edges = _tree(own, label, np.unique(np.linspace(0, len(node) - 1, HUBS).astype(int)).tolist(), every)
            # a pair of two classes has a member outside the class that is the largest now; which
            # one is visited must not change when another class overtakes it
            edges += _tree(own, label, every[label != _largest(label)].tolist(), every)
            if edges:
                yield _edge_batch(node, edges)

    return sets.repartition("block").sortWithinPartitions("block", "node").mapInArrow(tidy(each), _EDGES)


def _confirm_squares(rows: DataFrame) -> DataFrame:
    """Tree edges of confirmed links in squares (block, i, j): members of side 1 are compared with
    everything else of the square that has another label."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["block", "i", "j"]):
            node, side = run["node"].to_numpy(), run["side"].to_numpy()
            if not (side == 1).any():
                continue
            own = _Sets(run["set"])
            _, label = np.unique(run["label"].to_numpy(), return_inverse=True)
            edges = _tree(own, label, np.flatnonzero(side == 1).tolist(), np.arange(len(node)))
            if edges:
                yield _edge_batch(node, edges)

    dealt = rows.select("block", "i", "j", "side", "node", "label", "set").repartition("block", "i", "j")
    return dealt.sortWithinPartitions("block", "i", "j").mapInArrow(tidy(each), _EDGES)


def _confirm_large(sets: DataFrame) -> DataFrame:
    """Tree edges of confirmed links inside large blocks."""
    sets = materialize(sets, "dup-sets")
    sizes = sets.select("block", "node", "parts")
    hubs = sizes.groupBy("block", "parts").agg(*[F.min(F.struct(F.xxhash64("node", F.lit(k)), "node")).alias(f"h{k}") for k in range(HUBS)])
    hubs = materialize(hubs.select("block", F.explode(F.array_distinct(F.array(*[F.col(f"h{k}.node") for k in range(HUBS)]))).alias("node")),
                       "dup-hubs")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    zero, label = F.lit(0), F.col("node").alias("label")
    members = sets.join(hubs, ["block", "node"], "left_anti").select(
        "block", own.alias("i"), zero.alias("j"), zero.alias("side"), "node", label, "set")
    heads = sets.join(hubs, ["block", "node"], "left_semi").select(
        "block", F.explode(F.sequence(zero, F.col("parts").cast("int") - 1)).alias("i"), zero.alias("j"), F.lit(1).alias("side"),
        "node", label, "set")
    first = materialize(_confirm_squares(members.unionByName(heads)), "dup-star")
    classes = materialize(components(first).withColumnRenamed("component", "label"), "dup-classes")
    told = sets.join(classes, "node", "left").withColumn("label", F.coalesce("label", "node"))
    counts = told.groupBy("block", "label").agg(F.count(F.lit(1)).alias("c"))
    largest = counts.groupBy("block").agg(F.max(F.struct("c", "label"))["label"].alias("most"))
    left = told.join(largest, "block").where("label <> most")
    spread = left.groupBy("block").agg(F.sum(F.length("set") / 8).alias("s")).select(
        "block", F.ceil(F.col("s") / PART).cast("int").alias("heads"))
    members = told.join(spread, "block").select(
        "block", own.alias("i"), F.explode(F.sequence(zero, F.col("heads") - 1)).alias("j"), zero.alias("side"), "node", "label", "set")
    heads = left.join(spread, "block").select(
        "block", F.explode(F.sequence(zero, F.col("parts").cast("int") - 1)).alias("i"),
        F.pmod(F.xxhash64("node", F.lit(1)), F.col("heads")).cast("int").alias("j"), F.lit(1).alias("side"), "node", "label", "set")
    return first.unionByName(_confirm_squares(members.unionByName(heads)))


def _several(sigs: DataFrame, nodes: DataFrame, same: list[str]) -> DataFrame | None:
    """(doc_id, node) of every doc_id that has rows with different sets; None if there are none."""
    given = sigs.where("doc_id IS NOT NULL").select("doc_id", *same)
    ids = materialize(given.groupBy("doc_id").agg(F.min(F.struct(*same)).alias("x"), F.max(F.struct(*same)).alias("y")).where("x <> y")
                      .select("doc_id"), "dup-several")
    if ids.isEmpty():
        return None
    return materialize(given.join(ids, "doc_id").distinct().join(nodes.select(*same, "node"), same).select("doc_id", "node"), "dup-several")


def near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links of at least PERCENT
    similarity of ``width``-word shingle sets) and kept (doc_id is that one) of every document."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sigs = materialize(signatures(docs, width), "dup-sigs")
    same = ["n_shingles", "f1", "f2"]
    nodes = materialize(
        sigs.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(F.min("doc_id").alias("node"), F.first("sig").alias("sig"))
        .withColumn("n", F.col("n_shingles")), "dup-nodes")
    found = materialize(blocks(nodes), "dup-members")
    sized = found.join(nodes.groupBy("node").agg(F.sum("n").alias("n")), "node")
    total = sized.groupBy("block").agg(F.sum("n").alias("s")).withColumn("parts", F.ceil(F.col("s") / PART))
    members = materialize(sized.join(total, "block").select("node", "block", "parts"), "dup-sized")
    links = _confirm_small(_block_sets(docs, members.where("parts = 1"), width))
    large = members.where("parts > 1")
    if not large.isEmpty():
        links = links.unionByName(_confirm_large(_block_sets(docs, large, width)))
    several = _several(sigs, nodes, same)
    if several is not None:
        least = several.groupBy("doc_id").agg(F.min("node").alias("first"))
        links = links.unionByName(several.join(least, "doc_id").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")))
    classes = components(links)
    told = nodes.select(*same, "node").join(classes, "node", "left").select(*same, F.coalesce("component", "node").alias("component"))
    rows = sigs.select("doc_id", *same).join(told, same, "left")
    if several is not None:  # a row without shingles goes with the other rows of its doc_id
        own = least.join(classes, F.col("first") == F.col("node"), "left").select("doc_id", F.coalesce("component", "first").alias("own"))
        rows = rows.join(own, "doc_id", "left").withColumn("component", F.coalesce("own", "component"))
    return rows.select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)
