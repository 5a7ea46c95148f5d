"""Benchmark decontamination with a generalised suffix automaton.

Items are normalised to words and inserted, one after the other, into one suffix automaton: its
states are the classes of word sequences that occur in the items. A document's words are streamed
through it; after each word, the automaton's depth is the longest suffix of the document so far that
occurs in an item. Every point with a depth of a whole window (``window`` words, or all words of a
shorter item) is a hit over those words, and the state tells the items. Runs of words that cannot
matter are left out beforehand: a match of n words needs n - 1 neighbouring word pairs that occur in
items, which one vectorised look-up finds.

Items are dealt by hash to automata of about ``PART_WORDS`` words, each built in a task and laid out
in flat arrays. As many of them as hold ``MAX_WORDS`` words are broadcast together and scan the documents in one
pass; a larger benchmark takes several passes, whose hits are united by document. At each word the
window's state and its shorter items are looked up, not searched along the automaton's links.

Spans of hits that are longer than ``max_span`` are cut from a text; a text whose share of hit words
exceeds ``max_coverage`` is rejected as a whole.

Edge cases: a null text or item, or one without words, has no words and matches nothing; repeated
rows are rows of their own; repeated items count each; a null item_id is no item, a null doc_id is
an ordinary row; empty tables give no hits, or an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from array import array
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import words as W
from hearth.llm.common import Remote, col, free, materialize, table

#: Words of a window.
WINDOW = 10
#: Item words in one automaton, and in all that are broadcast together (about; an item is never divided).
PART_WORDS = 200_000
MAX_WORDS = 2_000_000


class SuffixAutomaton:
    """Generalised suffix automaton over word hashes, built item by item."""

    def __init__(self, items: Sequence[tuple[str, Sequence[int]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.depth = [0]
        for _, own in items:
            last = 0
            for w in own:
                last = self._extend(last, w)

    def _state(self, depth: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.depth.append(depth)
        return len(self.depth) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The state of the sequences of q that end p's sequences with w."""
        if self.depth[p] + 1 == self.depth[q]:
            return q
        copy = self._state(self.depth[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w, self.next[last][w])
        new = self._state(self.depth[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w, self.next[p][w])
        return new


class Automaton:
    """A suffix automaton in flat arrays, with the items of its window states."""

    def __init__(self, items: Sequence[tuple[str, Sequence[int]]], window: int = WINDOW):
        built = SuffixAutomaton(items, window)
        self.window = window
        self.link, self.depth = array("i", built.link), array("i", built.depth)
        sizes = np.array([len(f) for f in built.next])
        #: transitions of state s, by word: word[at[s]:at[s + 1]] to states to[...]
        self.at = array("i", np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32).tobytes())
        word, to = array("Q"), array("i")
        for s, following in enumerate(built.next):
            for w in sorted(following):
                word.append(w)
                to.append(following[w])
            built.next[s] = None  # a state's table goes once it is laid out
        self.word, self.to = word, to
        #: the state of the last ``window`` words of a state's sequences (-1: shorter ones)
        self.window_of = array("i", [-1]) * len(self.depth)
        for s in np.argsort(np.array(self.depth), kind="stable").tolist():
            if self.depth[s] >= window:
                self.window_of[s] = s if self.depth[self.link[s]] < window else self.window_of[self.link[s]]
        self.names = [name for name, _ in items]
        found: dict[int, set[int]] = {}  # items by window state, or by the state of a whole shorter item
        short: dict[int, int] = {}
        for i, (_, own) in enumerate(items):
            state = 0
            for k, w in enumerate(own, 1):
                state = self.follow(state, w)  # the item occurs, so it can be followed
                if k >= window:
                    found.setdefault(self.window_of[state], set()).add(i)
            if 0 < len(own) < window:
                while self.depth[self.link[state]] >= len(own):
                    state = self.link[state]
                found.setdefault(state, set()).add(i)
                short[state] = len(own)
        self.found_at = array("i", [0]) * (len(self.depth) + 1)
        self.found = array("i")
        for s in range(len(self.depth)):
            self.found.extend(sorted(found.get(s, ())))
            self.found_at[s + 1] = len(self.found)
        #: length of the whole shorter item that ends in a state (0: none), and the nearest state with
        #: one along the links, itself included (-1: none)
        self.short = array("i", [0]) * len(self.depth)
        self.short_of = array("i", [-1]) * len(self.depth)
        for s, n in short.items():
            self.short[s] = n
        if short:
            for s in np.argsort(np.array(self.depth), kind="stable").tolist():
                self.short_of[s] = s if self.short[s] else self.short_of[self.link[s]] if s else -1
        self.any_short = bool(short)

    def follow(self, state: int, w: int) -> int:
        """The state after a word; -1 if no item goes on like this."""
        end = self.at[state + 1]
        i = bisect_left(self.word, w, self.at[state], end)
        return self.to[i] if i < end and self.word[i] == w else -1

    def items_of(self, state: int) -> array:
        return self.found[self.found_at[state]:self.found_at[state + 1]]

    def scan(self, own: Sequence[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans (first, after last; possibly overlapping) of a word sequence, and the items
        whose windows occur in it."""
        follow, link, depth, window = self.follow, self.link, self.depth, self.window
        spans: list[tuple[int, int]] = []
        states: set[int] = set()
        state = length = 0
        for i, w in enumerate(own):
            to = follow(state, w)
            while to < 0 and state:
                state = link[state]
                length = depth[state]
                to = follow(state, w)
            if to >= 0:
                state = to
                length += 1
            if length >= window:
                spans.append((i + 1 - length, i + 1))
                states.add(self.window_of[state])
            if self.any_short:
                s = self.short_of[state]
                while s > 0:  # at most one for each length below a window
                    if self.short[s] <= length:
                        spans.append((i + 1 - self.short[s], i + 1))
                        states.add(s)
                    s = self.short_of[link[s]]
        return spans, {self.names[i] for s in states for i in self.items_of(s)}


class Part:
    """An automaton, and the word pairs that occur in its items."""

    def __init__(self, items: Sequence[tuple[str, np.ndarray]], window: int = WINDOW):
        self.automaton = Automaton([(name, own.tolist()) for name, own in items], window)
        hashes = [np.asarray(own, np.uint64) for _, own in items if len(own)]
        pairs = [pair_hashes(h) for h in hashes if len(h) > 1]
        self.singles = np.unique(np.array([h[0] for h in hashes if len(h) == 1], np.uint64))
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64)
        lengths = [min(window, len(h)) for h in hashes if len(h) > 1]
        #: neighbouring pairs that the shortest window of two or more words needs
        self.least = min(lengths, default=window) - 1


class Scanner:
    """Automata that scan together; the word pairs of all of them tell where."""

    def __init__(self, parts: Sequence[Part]):
        self.automata = [p.automaton for p in parts]
        self.singles = np.unique(np.concatenate([np.zeros(0, np.uint64), *[p.singles for p in parts]]))
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.uint64), *[p.pairs for p in parts]]))
        self.least = min((p.least for p in parts), default=WINDOW - 1)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.pairs >> np.uint64(44)).astype(np.int64)] = True

    def scan(self, own: Sequence[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans and items of a word sequence, over all automata."""
        spans, items = [], set()
        for a in self.automata:
            s, i = a.scan(own)
            spans += s
            items |= i
        return spans, items

    def runs(self, h: np.ndarray, begins: np.ndarray) -> list[tuple[int, int]]:
        """Word ranges that may hold a window; none crosses a row (``begins``: first words)."""
        out: list[tuple[int, int]] = []
        if len(self.singles):
            hit = np.flatnonzero(np.isin(h, self.singles))
            out += [(int(i), int(i) + 1) for i in hit]
        if len(h) > 1 and len(self.pairs):
            p = pair_hashes(h)
            may = np.flatnonzero(self.bits[(p >> np.uint64(44)).astype(np.int64)])
            at = np.searchsorted(self.pairs, p[may])
            at[at == len(self.pairs)] = 0
            known = np.zeros(len(p), bool)
            known[may[self.pairs[at] == p[may]]] = True
            inner = begins[(begins > 0) & (begins < len(h))]
            known[inner - 1] = False
            edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
            first, after = edge[::2], edge[1::2]
            long = after - first >= self.least
            out += list(zip(first[long].tolist(), (after[long] + 1).tolist(), strict=True))
        return out


def pair_hashes(h: np.ndarray) -> np.ndarray:
    return W.mix(h[:-1] * np.uint64(0x9E6C63D0676A9A99) + h[1:])


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def _item_words(texts: list[str | None]) -> list[np.ndarray]:
    buf, off = W.arrow_bytes(pa.array(texts, pa.string()))
    _, _, h, at = W.words(buf, off, W.ALNUM)
    return [h[a:z] for a, z in zip(at[:-1], at[1:], strict=True)]


def scanners(items: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS, part_words: int = PART_WORDS) -> list[Remote]:
    """Scanners over all ``items`` (item_id, text), each over at most about ``max_words`` words. Equal
    items count once; automata are built in tasks, by the hash of their items, and only their arrays
    pass through the driver, one scanner at a time."""
    items = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"),
                                                      F.col("text").cast("string").alias("text")).distinct()
    # an upper bound of the words of a text: half its bytes, and one
    total = int(items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0)
    part_words = min(part_words, max_words)
    count, together = max(1, -(-total // part_words)), max(1, max_words // part_words)

    def build(own: pa.Table) -> pa.Table:
        rows = list(zip(own.column("item_id").to_pylist(), _item_words(own.column("text").to_pylist()), strict=True))
        made = pickle.dumps(Part(sorted(rows, key=lambda r: (r[0], r[1].tolist())), window), protocol=5)
        return pa.table({"part": own.column("part").slice(0, 1), "made": pa.array([made], pa.binary())})

    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)).cast("int"))
    built = materialize(dealt.repartition(count, "part").groupBy("part").applyInArrow(build, "part int, made binary"), "automata")
    out = []
    for k in range(0, count, together):
        own = built.where(F.col("part").between(k, k + together - 1)).orderBy("part").collect()
        out.append(Remote(items.sparkSession, pickle.dumps(Scanner([pickle.loads(bytes(r.made)) for r in own]), protocol=5)))
    return out


HITS = {"n_words": "bigint", "first": "array<int>", "after": "array<int>", "items": "array<string>"}


def hits(docs: DataFrame, scanner, carry: Sequence[str], clean: bool = False, max_span: int = 0) -> DataFrame:
    """The columns ``carry`` and ``text``'s word count, united hit spans (in words) and item ids of
    every document for one broadcast scanner; with ``clean``, also the text without hit spans of
    more than ``max_span`` words (``cleaned``). New columns get free names."""
    added = HITS | ({"cleaned": "string"} if clean else {})
    names = [*carry, *[free(carry, c) for c in added]]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        know = scanner.value
        for b in batches:
            buf, off = W.arrow_bytes(b.column("text"))
            for i, j in W.groups(off):
                starts, ends, h, at = W.words(buf[off[i]:off[j]], off[i:j + 1] - off[i], W.ALNUM)
                found: dict[int, tuple[list, set]] = {}
                for a, z in know.runs(h, at[:-1]):
                    spans, items = know.scan(h[a:z].tolist())
                    if spans:
                        row = int(np.searchsorted(at, a, "right")) - 1
                        own = found.setdefault(row, ([], set()))
                        own[0].extend((x + a - int(at[row]), y + a - int(at[row])) for x, y in spans)
                        own[1].update(items)
                spans = {r: _united(s) for r, (s, _) in found.items()}
                n = j - i
                out = [*[b.column(c).slice(i, n) for c in carry], pa.array(np.diff(at)),
                       pa.array([[x for x, _ in spans.get(r, ())] for r in range(n)], pa.list_(pa.int32())),
                       pa.array([[y for _, y in spans.get(r, ())] for r in range(n)], pa.list_(pa.int32())),
                       pa.array([sorted(found[r][1]) if r in found else [] for r in range(n)], pa.list_(pa.string()))]
                if clean:
                    texts = b.column("text").slice(i, n)
                    cut = {r: _without(texts[r].as_py(), starts[at[r]:at[r + 1]] - (off[i + r] - off[i]),
                                       ends[at[r]:at[r + 1]] - (off[i + r] - off[i]), s, max_span) for r, s in spans.items()}
                    out.append(texts if not cut else pa.array([cut[r] if r in cut else t for r, t in enumerate(texts.to_pylist())], pa.string()))
                yield pa.record_batch(out, names=names)

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, [*[kinds[c] for c in carry], *added.values()], strict=True))
    return docs.select(*[col(c) for c in dict.fromkeys([*carry, "text"])]).mapInArrow(each, schema)


def _without(text: str, starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]], max_span: int) -> str:
    """``text`` without the hit spans of more than ``max_span`` words (byte offsets per word)."""
    raw, at, out = text.encode(), 0, []
    for a, z in spans:
        if z - a > max_span:
            out.append(raw[at:int(starts[a])])
            at = int(ends[z - 1])
    out.append(raw[at:])
    return b"".join(out).decode()


_ROW = "_row"


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """doc_id, n_words, first/after (united hit spans) and items of every document."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    all_ = scanners(items, window, max_words)
    if len(all_) == 1:
        return hits(docs, all_[0], ["doc_id"])
    found = _hits_of_all(docs.withColumn(_ROW, F.monotonically_increasing_id()), all_, _ROW, ["doc_id"])
    return found.drop(_ROW)


def _hits_of_all(docs: DataFrame, all_: list, row: str, carry: Sequence[str] = ()) -> DataFrame:
    """``row``, ``carry`` and what :func:`hits` adds, over several scanners: every row (numbered by
    ``row``) once, with the hits of all of them united."""
    parts = None
    for s in all_:
        one = materialize(hits(docs, s, [*carry, row]), "hits")
        parts = one if parts is None else parts.unionByName(one)
    # spans of several automata are put end to end and united again, in each row
    one = parts.groupBy(row).agg(*[F.first(c).alias(c) for c in carry], F.max("n_words").alias("n_words"),
                                 F.array_sort(F.flatten(F.collect_list(F.arrays_zip("first", "after")))).alias("s"),
                                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    reach = "transform(s, (x, i) -> struct(x.first, array_max(transform(slice(s, 1, i + 1), y -> y.after)) AS after))"
    one = one.withColumn("s", F.expr(reach))
    return one.select(row, *carry, "n_words",
                      F.expr("transform(filter(s, (x, i) -> i = 0 OR x.first > get(s, i - 1).after), x -> x.first)").alias("first"),
                      F.expr("transform(filter(s, (x, i) -> i = size(s) - 1 OR get(s, i + 1).first > x.after), x -> x.after)").alias("after"),
                      "items")


def _n_hit(first: str = "first", after: str = "after"):
    return F.expr(f"aggregate(zip_with({after}, {first}, (z, a) -> z - a), 0L, (x, y) -> x + y)")


#: Pipeline limits: hit spans longer than this many words are cut (0: all), and a document with a
#: larger share of hit words is rejected.
MAX_SPAN = 0
MAX_COVERAGE = 0.05


def _cut(found: DataFrame, carry: Sequence[str], first: str, after: str, cleaned: str, max_span: int) -> DataFrame:
    """The columns ``carry`` (``text`` among them), and the text without the spans (in words, columns
    ``first`` and ``after``) of more than ``max_span`` words (``cleaned``)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, off = W.arrow_bytes(b.column("text"))
            for i, j in W.groups(off):
                starts, ends, _, at = W.words(buf[off[i]:off[j]], off[i:j + 1] - off[i], W.ALNUM)
                own = b.slice(i, j - i)
                texts, begin = own.column("text").to_pylist(), off[i:j + 1] - off[i]
                for r, (f, a) in enumerate(zip(own.column(first).to_pylist(), own.column(after).to_pylist(), strict=True)):
                    if f:
                        here = slice(at[r], at[r + 1])
                        texts[r] = _without(texts[r], starts[here] - begin[r], ends[here] - begin[r], list(zip(f, a, strict=True)), max_span)
                yield pa.record_batch([*[own.column(c) for c in carry], pa.array(texts, pa.string())], names=[*carry, cleaned])

    kinds = dict(found.dtypes)
    schema = ", ".join(f"`{c}` {t}" for c, t in [*[(c, kinds[c]) for c in carry], (cleaned, "string")])
    return found.select(*[col(c) for c in dict.fromkeys([*carry, first, after])]).mapInArrow(each, schema)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_span: int = MAX_SPAN,
                  max_coverage: float = MAX_COVERAGE, max_words: int = MAX_WORDS) -> DataFrame:
    """``docs`` (all its columns) without rejected documents and without the cut spans; n_chars, if
    there, is that of the new text. Cutting goes on until nothing more is found: the words around a
    cut may have become neighbours in a new window. Each round judges and cuts the united spans of
    all automata."""
    first, after, n_words, cleaned = (free(docs.columns, c) for c in ("first", "after", "n_words", "cleaned"))
    row = free(docs.columns, _ROW)
    cut = F.expr(f"exists(zip_with({after}, {first}, (z, a) -> z - a), n -> n > {int(max_span)})")
    new = {"text": F.col(cleaned), "n_chars": F.when(cut, F.length(cleaned)).otherwise(F.col("n_chars")).cast("bigint")}
    all_ = scanners(items, window, max_words)
    again = True
    while again:
        if len(all_) == 1:
            found = hits(docs, all_[0], docs.columns, clean=True, max_span=max_span)
        else:
            numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
            spans = _hits_of_all(numbered, all_, row).select(
                row, F.col("n_words").alias(n_words), F.col("first").alias(first), F.col("after").alias(after))
            found = _cut(numbered.join(spans, row), [*docs.columns, n_words, first, after], first, after, cleaned, max_span)
        found = materialize(found, "cleaned")
        kept = found.where(_n_hit(first, after) <= max_coverage * F.col(n_words))
        docs = kept.select(*[new[c].alias(c) if c in new else col(c) for c in docs.columns])
        again = not kept.where(cut).isEmpty()
    return docs


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", _n_hit().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (_n_hit() > 0).alias("contaminated"))


# Windows of both sides meet by their text; a document word is hit if a window's occurrence covers it.
ORACLE_SQL = r"""
WITH lo AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents, lo),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark, lo WHERE item_id IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS x
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS x
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lengths WHERE len(w) >= n)),
hit AS (SELECT dw.r, dw.p, dw.n, iw.item_id FROM dw JOIN iw USING (n, x)),
cover AS (SELECT r, count(DISTINCT q)::BIGINT AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + n)) AS q FROM hit) GROUP BY r),
found AS (SELECT r, count(*)::BIGINT AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM hit) GROUP BY r)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (r) LEFT JOIN found USING (r)
"""
