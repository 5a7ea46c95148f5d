"""Byte-level BPE encoding and decoding of whole texts, every distinct word encoded once.

Encoding. Texts are split into pre-tokens by the public pattern; byte-level merges never cross
them. Neighbouring texts form a *block* of a bounded size, which holds each of its distinct
pre-tokens once, numbered by first appearance, and the texts as positions in that list. The lists
are exploded with positions to (block, number, word) and shuffled by word: all occurrences of a
word in any block become one sorted run, and the word is encoded once, at the head of its run. The
ids go back to their block by a second shuffle and are joined to the block's texts, which are put
together by position. Blocks are written bucketed by block number, so the texts themselves are
never shuffled: only distinct words and their ids are.

A word that makes up a third of all text is one row for each block, at most one in as many rows as a
block has distinct words; runs are streamed, so not even they are held by a task.

Decoding. The distinct ids of a run of rows go, ahead of these rows, through a map-side join with
the token-byte table (its size is the vocabulary's); the rows that follow find all their tokens'
bytes in front of them and are put together by position. Nothing is shuffled.

Edge cases: a null or empty text has no ids, and no ids decode to no bytes; null ids decode to null,
and so do ids of which one (or a null entry) is not in the vocabulary; special tokens are ordinary
text; a very long text is a block of its own; repeated rows are repeated in the result; an empty
table gives an empty result. The caller names the columns to carry along; a result column whose
name is taken gets underscores in front.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from hearth.llm.common import bucketed, col, free, release, table, tidy
from hearth.llm.words import spans, strings

#: Bytes of text in a block (a longer text is a block of its own).
BLOCK_BYTES = 32 << 20
#: Bytes of text whose pre-tokens are found at once.
GROUP_BYTES = 2 << 20
#: Words whose ids are sent back together, and ids decoded with one set of look-ups.
GROUP_WORDS = 1 << 17
GROUP_IDS = 1 << 18

#: Texts are cut at spaces; those with a space before another white space are cut before ``_CUTS`` only.
_ODD = r" [\s\v\x1c-\x1f\x{85}\p{Z}]"
_CUTS = re.compile(r"(?= \S)")


class _Numbers(dict):
    """pre-token -> its number, by first appearance."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def of(self, cut: str) -> list[int]:
        """Numbers of a cut's pre-tokens."""
        word = cut[1:] if cut[:1] == " " else cut
        if word.isalpha():
            return [self.setdefault(cut, len(self))]
        if word[:-1].isalpha() and not (word[-1].isalnum() or word[-1].isspace()):  # a word and one mark
            return [self.setdefault(cut[:-1], len(self)), self.setdefault(cut[-1], len(self))]
        return [self.setdefault(w, len(self)) for w in self.find(cut)]


class _Cuts:
    """Distinct cuts and the numbers of their pre-tokens; what is not one word of letters is split
    one by one."""

    def __init__(self, cuts: pa.Array, numbers: _Numbers):
        whole = np.asarray(pc.utf8_is_alpha(pc.utf8_ltrim(cuts, " ")))
        single = strings(cuts.filter(pa.array(whole)))
        rest = [numbers.of(c) for c in strings(cuts.filter(pa.array(~whole)))]
        self.widths, self.starts = np.ones(len(cuts), np.int64), np.zeros(len(cuts), np.int64)
        self.widths[~whole] = [len(r) for r in rest]
        self.starts[whole] = np.arange(len(single))
        self.starts[~whole] = np.cumsum(self.widths[~whole]) - self.widths[~whole] + len(single)
        self.flat = np.array([*[numbers.setdefault(w, len(numbers)) for w in single], *[n for r in rest for n in r]], np.uint32)

    def expanded(self, at: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the cuts ``at``, one after the other, and how many each list of cuts has."""
        count = self.widths[at]
        return self.flat[spans(self.starts[at], count)], np.diff(np.concatenate([[0], np.cumsum(count)])[offsets])


def _offsets(lists: pa.ListArray) -> np.ndarray:
    own = lists.offsets.to_numpy().astype(np.int64)
    return own - own[0]


def _number(parts: list[pa.Array], find) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pre-tokens of some texts by first appearance, the texts as numbers in that list, one
    after the other, and the number of them in each text."""
    numbers = _Numbers(find)
    odd = [np.asarray(pc.match_substring_regex(texts, _ODD)) for texts in parts]
    lists = [pc.split_pattern(texts.filter(pa.array(~o)), " ") for texts, o in zip(parts, odd, strict=True)]
    # a text's first cut has no space in front, all others have lost theirs
    heads = [_offsets(x)[:-1][np.asarray(x.value_lengths()) > 0] for x in lists]
    cuts = [x.flatten() for x in lists]
    coded = pa.chunked_array(cuts, pa.string()).dictionary_encode().unify_dictionaries()
    known = _Cuts(pc.binary_join_element_wise(" ", coded.chunk(0).dictionary, ""), numbers)
    found = []
    for texts, o, own, head, code in zip(parts, odd, lists, heads, coded.chunks, strict=True):
        at = code.indices.to_numpy().astype(np.int64)
        first = _Cuts(own.flatten().take(pa.array(head)), numbers)
        merged = _joined(known, first)
        at[head] = np.arange(len(known.widths), len(known.widths) + len(head))
        plain, sizes = merged.expanded(at, _offsets(own))
        if not o.any():
            found.append((plain, sizes))
            continue
        rest = pa.array([[c for c in _CUTS.split(t) if c] for t in texts.filter(pa.array(o)).to_pylist()], pa.list_(pa.string()))
        their = rest.flatten().dictionary_encode()
        others, their_sizes = _Cuts(their.dictionary, numbers).expanded(their.indices.to_numpy().astype(np.int64), _offsets(rest))
        count, start = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        count[~o], count[o] = sizes, their_sizes
        start[~o] = np.cumsum(sizes) - sizes
        start[o] = np.cumsum(their_sizes) - their_sizes + len(plain)
        found.append((np.concatenate([plain, others])[spans(start, count)], count))
    flat, counts = (np.concatenate(x) for x in zip(*found, strict=True))
    return list(numbers), flat, counts


def _joined(a: _Cuts, b: _Cuts) -> _Cuts:
    both = object.__new__(_Cuts)
    both.widths, both.starts = np.concatenate([a.widths, b.widths]), np.concatenate([a.starts, b.starts + len(a.flat)])
    both.flat = np.concatenate([a.flat, b.flat])
    return both


def _by_frequency(words: list[str], numbers: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words in order; the numbers as ranks by frequency, which take little space; and the place
    in order of each rank."""
    own = pa.array(words, pa.string())
    order = pc.array_sort_indices(own)
    place = np.empty(len(own), np.uint32)
    place[order.to_numpy()] = np.arange(len(own), dtype=np.uint32)
    frequent = np.argsort(-np.bincount(numbers, minlength=len(own)), kind="stable")
    rank = np.empty(len(own), np.uint32)
    rank[frequent] = np.arange(len(own), dtype=np.uint32)
    return own.take(order), rank[numbers], place[frequent]


def _squeeze(*columns: np.ndarray) -> bytes:
    """Columns of unsigned integers in few bytes: the same byte of all values together."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns]
    return pa.compress(b"".join(planes), "zstd", asbytes=True)


def _expand(packed: bytes, *columns: tuple[str, int]) -> list[np.ndarray]:
    """The columns again, from their kinds and lengths."""
    sizes = [np.dtype(kind).itemsize * n for kind, n in columns]
    data, at, out = pa.decompress(packed, sum(sizes), "zstd", asbytes=True), 0, []
    for (kind, n), size in zip(columns, sizes, strict=True):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8, size, at).reshape(width, n).T).view(kind).reshape(n))
        at += size
    return out


class _Vocabulary:
    """The tokens of a rank file (a token in base64 and its rank on each line)."""

    _known: dict[tuple[str, str], _Vocabulary] = {}

    def __init__(self, path: str, pattern: str):
        import tiktoken

        self.encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={}).encode_ordinary

    @classmethod
    def of(cls, path: str, pattern: str) -> _Vocabulary:
        """This worker's copy."""
        if (path, pattern) not in cls._known:
            cls._known[path, pattern] = cls(path, pattern)
        return cls._known[path, pattern]


def ranks(path: str) -> dict[bytes, int]:
    """token bytes -> id of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def token_bytes(spark: SparkSession, path: str) -> DataFrame:
    """The token-byte table (token, bytes) of a rank file."""
    known = ranks(path)
    return spark.createDataFrame(pa.table({"token": pa.array(known.values(), pa.int32()), "bytes": pa.array(known, pa.binary())}))


def _rows(parts: list[pa.RecordBatch], counts: np.ndarray, name: str) -> pa.ListArray:
    """One list that holds the rows of ``parts``, with their pre-token counts in front."""
    own = pa.Table.from_batches(parts).combine_chunks()
    columns = [pa.array(counts, pa.int32()), *[c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in own.columns]]
    struct = pa.StructArray.from_arrays(columns, names=[name, *own.column_names])
    return pa.ListArray.from_arrays(pa.array([0, len(struct)], pa.int32()), struct)


def _blocks(docs: DataFrame, text: str, carry: Sequence[str], pattern: str, count: str, limit: int) -> DataFrame:
    """One row for each block: its rows (carried columns and pre-token counts), the ranks of their
    pre-tokens one after the other, the place of each rank in the list of words, and that list."""
    source = free(carry, "text")
    kept = docs.select(*[col(c) for c in carry], col(text).cast("string").alias(source))
    row = StructType([StructField(count, IntegerType()), *kept.drop(source).schema.fields])
    schema = (StructType().add("block", LongType()).add("rows", ArrayType(row)).add("numbers", BinaryType())
              .add("places", BinaryType()).add("words", ArrayType(StringType())))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        part, made, held, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal made
            found, numbers, counts = _number(texts, find)
            words, ranks_, places = _by_frequency(found, numbers)
            own = _rows(held, counts, count)
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 33) + made], pa.int64()), own, pa.array([_squeeze(ranks_)], pa.binary()),
                 pa.array([_squeeze(places)], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)], names=schema.names)

        for b in batches:
            text, rest = b.column(len(carry)).fill_null(""), b.select(list(range(len(carry))))
            ends = np.asarray(pc.binary_length(text)).astype(np.int64).cumsum()
            i = 0
            while i < b.num_rows:  # rows that fill the block, in groups of bounded size
                before = ends[i - 1] if i else 0
                room = before + min(GROUP_BYTES, limit - size)
                j = min(b.num_rows, int(np.searchsorted(ends, room, "left")) + 1)
                held.append(rest.slice(i, j - i))
                texts.append(text.slice(i, j - i))
                size += int(ends[j - 1] - before)
                if size >= limit:
                    yield block()
                    held, texts, size = [], [], 0
                    release()
                i = j
        if held:
            yield block()

    return kept.mapInArrow(tidy(each), schema)


def _pack(numbers: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """Rising positions, the number of ids of each and the ids, in few bytes."""
    kind = "<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4"
    steps = np.diff(numbers, prepend=0).astype("<u4")
    head = np.array([len(numbers), len(ids), int(kind[2])], "<u4")
    return head.tobytes() + _squeeze(steps, counts.astype("<u4"), ids.astype(kind))


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, total, wide = np.frombuffer(packed, "<u4", 3).tolist()
    steps, counts, ids = _expand(packed[12:], ("<u4", n), ("<u4", n), (f"<u{wide}", total))
    return np.cumsum(steps), counts.astype(np.int64), ids.astype(np.int32)


def _encode_words(words: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(block, number, word) sorted by word -> (block, found): each distinct word of a partition is
    encoded once; what goes to the same block is packed together."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _Vocabulary.of(vocabulary, pattern).encode
        last, ids = None, []  # the word of the last row and its ids
        held: list[pa.RecordBatch] = []

        def send() -> pa.RecordBatch:
            nonlocal last, ids
            own = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            word = own.column("word").combine_chunks()
            new = np.ones(len(word), bool)
            new[1:] = np.asarray(pc.not_equal(word[1:], word[:-1]))
            heads = strings(word.filter(pa.array(new)))
            found = [ids if heads[0] == last else encode(heads[0]), *map(encode, heads[1:])]
            last, ids = heads[-1], found[-1]
            of = np.cumsum(new) - 1  # the head of each row's run
            widths = np.array([len(f) for f in found])
            starts, flat = np.cumsum(widths) - widths, np.array([t for f in found for t in f], np.uint32)
            block, number = own.column("block").to_numpy(), own.column("number").to_numpy()
            order = np.argsort(block, kind="stable")
            block, number, of = block[order], number[order], of[order]
            cuts = np.flatnonzero(np.diff(block, prepend=block[0] - 1))
            count = widths[of]
            tokens, ends = flat[spans(starts[of], count)], np.concatenate([[0], np.cumsum(count)])
            bounds = [*cuts.tolist(), len(block)]
            packed = [_pack(number[i:j], count[i:j], tokens[ends[i]:ends[j]]) for i, j in zip(bounds, bounds[1:], strict=False)]
            return pa.RecordBatch.from_arrays([pa.array(block[cuts], pa.int64()), pa.array(packed, pa.binary())], names=["block", "found"])

        for b in batches:
            if b.num_rows:
                held.append(b)
            if sum(h.num_rows for h in held) >= GROUP_WORDS:
                yield send()
        if held:
            yield send()

    return words.mapInArrow(tidy(each), "block bigint, found binary")


def _distinct(ids: np.ndarray) -> np.ndarray:
    """The distinct ids, in order."""
    if not len(ids) or ids.min() < 0 or ids.max() >= 1 << 22:
        return np.unique(ids)
    seen = np.zeros(int(ids.max()) + 1, bool)
    seen[ids] = True
    return np.flatnonzero(seen)


class _LookUp:
    """Bytes of the tokens that some rows hold."""

    def __init__(self, rows: pa.Table | None, token: str, found: str):
        if rows is None:
            rows = pa.table({token: pa.array([], pa.int32()), found: pa.array([], pa.binary())})
        self.tokens = rows.column(token).to_numpy()  # in order
        data = rows.column(found).to_pylist()
        self.known = np.array([d is not None for d in data], bool)
        self.widths = np.array([len(d or b"") for d in data], np.int64)
        self.starts = np.cumsum(self.widths) - self.widths
        self.bytes = np.frombuffer(b"".join([d or b"" for d in data]), np.uint8)
        self.place = None  # place of each token in the lists, where tokens are small enough for a table
        if len(self.tokens) and 0 <= self.tokens[0] and self.tokens[-1] < 1 << 22:
            self.place = np.zeros(int(self.tokens[-1]) + 1, np.int64)
            self.place[self.tokens] = np.arange(len(self.tokens))

    def joined(self, lists: pa.ListArray) -> pa.Array:
        """The bytes of each list, null where the list or one of its entries is null or unknown."""
        flat = lists.flatten()
        sizes = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        missing = np.asarray(flat.is_null())
        ids = flat.fill_null(0).to_numpy() if len(flat) else np.zeros(0, np.int32)
        if not len(self.tokens):
            at = np.zeros(0, np.int64)
            bad = np.cumsum(np.ones(len(ids), np.int64))
        else:
            at = (self.place[np.where(missing, self.tokens[0], ids)] if self.place is not None
                  else np.searchsorted(self.tokens, np.where(missing, self.tokens[0], ids)))
            bad = np.cumsum(missing | ~self.known[at])
        bad = np.concatenate([[0], bad])
        void = (bad[ends[1:]] > bad[ends[:-1]]) | np.asarray(lists.is_null())
        widths = self.widths[at]
        data = self.bytes[spans(self.starts[at], widths)]
        bounds = np.concatenate([[0], np.cumsum(widths)])[ends] if len(at) else np.zeros(len(ends), np.int64)
        got = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])
        return pc.if_else(pa.array(~void), got, pa.scalar(None, pa.binary()))


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", carry: Sequence[str] = ("doc_id",),
           ids: str = "ids", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The columns ``carry`` and the token ids of every row's ``text``: each match of ``pattern`` is
    encoded by the ranks of the file ``vocabulary``, which every executor can open."""
    ids, count = free(carry, ids), free(carry, "pre_tokens")
    blocks = bucketed(_blocks(docs, text, carry, pattern, count, block_bytes), "bpe-blocks", "block")
    words = (blocks.select("block", F.posexplode("words").alias("number", "word"))
             .repartition("word").sortWithinPartitions("word"))
    found = _encode_words(words, vocabulary, pattern).groupBy("block").agg(
        F.collect_list("found").alias("found"))
    kept = docs.select(*[col(c) for c in carry])
    schema = StructType([*kept.schema.fields, StructField(ids, ArrayType(IntegerType()))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, packed, places, found in zip(*map(b.column, ("rows", "numbers", "places", "found")), strict=True):
                struct = rows.values
                wide = np.asarray(struct.field(0)).astype(np.int64)
                own = [struct.field(i + 1) for i in range(len(carry))]
                total = int(wide.sum())
                if total:
                    (numbers,) = _expand(packed.as_py(), ("<u4", total))
                    at, counts, tokens = (np.concatenate(x) for x in zip(*map(_unpack, found.as_py()), strict=True))
                    count, start = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
                    count[at], start[at] = counts, np.cumsum(counts) - counts
                    (place,) = _expand(places.as_py(), ("<u4", len(at)))
                    count, start = count[place], start[place]
                ends = np.concatenate([[0], np.cumsum(wide)])
                i = 0
                while i < len(wide):  # rows of so many pre-tokens at once
                    j = max(i + 1, int(np.searchsorted(ends, ends[i] + GROUP_WORDS, "right")) - 1)
                    if ends[j] > ends[i]:
                        n = numbers[ends[i]:ends[j]]
                        flat = tokens[spans(start[n], count[n])]
                        offsets = np.concatenate([[0], np.cumsum(count[n])])[ends[i:j + 1] - ends[i]]
                    else:
                        flat, offsets = np.zeros(0, np.int32), np.zeros(j - i + 1, np.int64)
                    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, pa.int32()))
                    yield pa.RecordBatch.from_arrays([*[c.slice(i, j - i) for c in own], lists], names=[*carry, ids])
                    i = j

    return blocks.select("block", "rows", "numbers", "places").join(found.hint("merge"), "block", "left").select(
        "rows", "numbers", "places", "found").mapInArrow(tidy(each), schema)


def decode(rows: DataFrame, tokens: DataFrame, ids: str = "ids", carry: Sequence[str] = ("doc_id",),
           name: str = "decoded") -> DataFrame:
    """The columns ``carry`` and the bytes of each row's token ``ids`` by the token-byte table
    ``tokens`` (token, bytes), whose size is that of a vocabulary."""
    name, source, step, token, found = (free(carry, c) for c in (name, "ids", "step", "token", "bytes"))
    kept = rows.select(*[col(c) for c in carry], col(ids).cast("array<int>").alias(source))
    stream = StructType([*[StructField(f.name, f.dataType) for f in kept.schema], StructField(step, LongType()), StructField(token, IntegerType())])

    def ahead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The distinct ids of some rows, then these rows; ``step`` counts on."""
        held, size, made = [], 0, 0

        def send() -> Iterator[pa.RecordBatch]:
            nonlocal made
            own = _distinct(np.concatenate([b.column(source).flatten().drop_null().to_numpy() for b in held]))
            none = [pa.nulls(len(own), b_type) for b_type in held[0].schema.types]
            yield pa.RecordBatch.from_arrays([*none, pa.array(np.arange(made, made + len(own))), pa.array(own, pa.int32())],
                                             names=stream.names)
            made += len(own)
            for b in held:
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(np.arange(made, made + b.num_rows)), pa.nulls(b.num_rows, pa.int32())], names=stream.names)
                made += b.num_rows

        for b in batches:
            ends = np.asarray(b.column(source).value_lengths().fill_null(0)).cumsum()
            i = 0
            while i < b.num_rows:
                before = ends[i - 1] if i else 0
                j = min(b.num_rows, max(i, int(np.searchsorted(ends, before + GROUP_IDS - size, "left"))) + 1)
                held.append(b.slice(i, j - i))
                size += int(ends[j - 1] - before)
                if size >= GROUP_IDS:
                    yield from send()
                    held, size = [], 0
                i = j
        if held:
            yield from send()

    schema = StructType([*stream.fields[:len(carry)], StructField(name, BinaryType())])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: list[pa.RecordBatch] = []  # the look-ups in front of the rows
        look = None
        expected = 0
        for b in batches:
            steps = b.column(step).to_numpy()
            if not (steps == np.arange(expected, expected + len(steps))).all():
                raise RuntimeError("the map-side join changed the order of its rows")
            expected += len(steps)
            is_row = np.asarray(b.column(token).is_null())
            for run in np.split(np.arange(b.num_rows), np.flatnonzero(np.diff(is_row)) + 1):
                if not len(run):
                    continue
                own = b.slice(int(run[0]), len(run))
                if not is_row[run[0]]:
                    if look is not None:
                        heads, look = [], None
                    heads.append(own.select([token, found]))
                    continue
                look = look or _LookUp(pa.Table.from_batches(heads) if heads else None, token, found)
                yield pa.RecordBatch.from_arrays([*[own.column(c) for c in carry], look.joined(own.column(source))], names=[*carry, name])

    bytes_of = F.broadcast(tokens.select(F.col("token").alias(free([*stream.names, found], "known")), F.col("bytes").alias(found)))
    known = bytes_of.columns[0]
    joined = kept.mapInArrow(tidy(ahead), stream).join(bytes_of, F.col(token) == F.col(known), "left").drop(known)
    return joined.mapInArrow(tidy(together), schema)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN).select(
        "doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"))
    return decode(encoded, token_bytes(spark, path), carry=("doc_id", "n_tokens", "ids_sha256")).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
