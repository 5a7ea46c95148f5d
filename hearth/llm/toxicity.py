"""Toxicity by a convolutional text classifier, trained in numpy.

Words (ASCII-case folded) are hashed to rows of an embedding table, once as a whole and once by
their first bytes, so that inflected words share a part of their embedding; filters of several widths slide
over the whole text, each gives its largest response (max pooling over rectified responses), and a
logistic layer turns these into a logit. Training is mini-batch gradient descent with Adagrad; only
the window where a filter responds most receives its gradient, so embedding updates are sparse.
Words whose cell never received one have no embedding (zero).

All labelled documents that are not held out are learned from. A bounded sample gives the network to
begin with, in one task; then ROUNDS passes follow over every labelled document outside the fourth
that calibrates. In a pass each partition goes on from the common network over its own rows, and the
changes that partitions made to a cell (or filter) are averaged over those that made any.

Thresholds are calibrated by language on every document of the remaining fourth, which no step learns
from: logits are counted on a grid of STEP. The language is guessed from the text itself (function
words), never read from a column. The logit is shifted by its language's threshold, so a score of 0.5
is the calibrated threshold everywhere.

Edge cases: a null, empty or wordless text has no response and gets the score of an empty text;
null labels and null ids are not learned from; repeated rows are rows of their own, but learned from
once; different texts of a doc_id are all learned from; a null doc_id is an ordinary row; without a labelled document of each class every score is 0; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import words as W
from hearth.llm.common import Remote, col, free, made_in_task, materialize, table, tidy
from hearth.llm.langid import held_out
from hearth.operators.joins import size_checked_broadcast

#: Embedding rows (hash cells) and size; filter widths and filters of each width.
CELL_BITS = 20
SIZE = 8
#: Bytes of the word prefix that is embedded beside the word.
PREFIX = 4
WIDTHS = (1, 2, 3)
FILTERS = 16
#: Labelled documents, toxic and other, that the network to begin with is learned from at most.
TOXIC, OTHER = 2_000, 4_000
#: Passes over all labelled documents after that, and bytes of text that are shuffled together there.
ROUNDS, SHUFFLED = 3, 1 << 22
#: Of so many documents one calibrates (by hash of the id) instead of being learned from.
CALIBRATE = 4
#: Logits are counted in steps of STEP up to MOST_STEPS of them to either side.
STEP, MOST_STEPS = 1 / 256, 1 << 16
EPOCHS, BATCH, RATE, DECAY = 8, 32, 0.1, 1e-4
#: A small sample is gone over until so many batches have been learned from.
STEPS = 1_200
#: Words whose responses are held at once.
PIECE_WORDS = 1 << 15
#: A language with fewer toxic documents among those that calibrate takes the common threshold.
LEAST_TOXIC = 8

# Function words that tell the language of a text.
FUNCTION_WORDS: dict[str, tuple[str, ...]] = {
    "de": ("der", "die", "und", "das", "den", "mit", "ist", "nicht", "auf", "zu"),
    "en": ("the", "of", "and", "to", "that", "is", "for", "with", "was", "are"),
    "es": ("el", "los", "que", "y", "las", "por", "con", "una", "del", "para"),
    "fr": ("le", "les", "et", "des", "est", "pour", "une", "dans", "qui", "pas"),
}
_LANGS = sorted(FUNCTION_WORDS)


def _guesses(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of the language whose function words a row has most of; -1 if it has none."""
    counts = np.zeros((len(at) - 1, len(_LANGS)), np.int64)
    for k, lang in enumerate(_LANGS):
        own = np.array(sorted(W.word_hash(w) for w in FUNCTION_WORDS[lang]), np.uint64)
        hit = np.concatenate([[0], np.cumsum(np.isin(h, own))])
        counts[:, k] = hit[at[1:]] - hit[at[:-1]]
    return np.where(counts.max(1, initial=0) > 0, counts.argmax(1), -1)


_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[0x41:0x5B] += 0x20


@dataclass
class Texts:
    """Words of texts: hashes, cells of the word and of its first PREFIX bytes, row offsets."""

    h: np.ndarray
    cells: np.ndarray  # 2 x words
    at: np.ndarray

    @staticmethod
    def of(buf: np.ndarray, off: np.ndarray) -> Texts:
        """All rows, read in bounded groups."""
        parts = [Texts._group(buf[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in W.groups(off)]
        if len(parts) == 1:
            return parts[0]
        at = [np.zeros(1, np.int64)]
        for p in parts:
            at.append(p.at[1:] + at[-1][-1])
        return Texts(np.concatenate([p.h for p in parts] or [np.zeros(0, np.uint64)]),
                     np.concatenate([p.cells for p in parts] or [np.zeros((2, 0), np.int32)], axis=1), np.concatenate(at))

    @staticmethod
    def _group(buf: np.ndarray, off: np.ndarray) -> Texts:
        starts, ends, h, at = W.words(buf, off, W.ALNUM)
        head = np.zeros(len(h), np.uint32)
        for k in range(PREFIX):
            head = head * np.uint32(257) + np.where(starts + k < ends, _LOWER[buf[np.minimum(starts + k, len(buf) - 1)]], 0).astype(np.uint32) \
                if len(buf) else head
        shift = np.uint64(64 - CELL_BITS)
        return Texts(h, np.stack([h >> shift, W.mix(head.astype(np.uint64) + np.uint64(1)) >> shift]).astype(np.int32), at)

    def take(self, rows: Sequence[int]) -> Texts:
        """Only these rows."""
        spans = [(self.at[i], self.at[i + 1]) for i in rows]
        index = np.concatenate([np.arange(a, z) for a, z in spans]) if spans else np.zeros(0, np.int64)
        return Texts(self.h[index], self.cells[:, index], np.concatenate([[0], np.cumsum([z - a for a, z in spans])]).astype(np.int64))


@dataclass
class Network:
    """Embedding rows of trained cells, filters, output layer and thresholds by language."""

    row_of: np.ndarray  # cell -> row of `embedding`; row 0 is zero
    embedding: np.ndarray
    filters: list[np.ndarray]  # by shift j: (filters of width over j) x SIZE, widest filters last
    bias: np.ndarray
    out: np.ndarray
    constant: float
    thresholds: dict[int, float]

    def responses(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Filter responses (filters x words, before bias). A window that reaches past the end of
        its text meets zeros there."""
        x = np.ascontiguousarray((self.embedding[rows[0]] + self.embedding[rows[1]]).T)
        z = self.filters[0] @ x
        for j, f in enumerate(self.filters[1:], 1):
            y = (f @ x)[:, j:]
            ends = at[1:-1]  # words that begin a text have nothing to add to the text before
            for k in range(j):
                e = ends + k
                y[:, e[(e >= j) & (e - j < y.shape[1])] - j] = 0
            z[len(z) - len(f):, :z.shape[1] - j] += y
        return z

    def peak(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of every filter in one text, and the word where its window starts. A
        long text is read in pieces that overlap by a window."""
        top = np.full(len(self.bias), -np.inf, np.float32)
        where = np.zeros(len(self.bias), np.int64)
        gap, n = max(WIDTHS) - 1, rows.shape[1]
        for p in range(0, n, PIECE_WORDS):
            part = rows[:, p:p + PIECE_WORDS + gap]
            z = self.responses(part, np.array([0, part.shape[1]]))[:, :PIECE_WORDS]
            at = z.argmax(1)
            value = z[np.arange(len(z)), at]
            more = value > top
            top[more], where[more] = value[more], at[more] + p
        return top, where

    def pooled(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Largest rectified response of every filter in every text; 0 for texts without words.
        At most about PIECE_WORDS words are looked at together."""
        n = np.diff(at)
        out = np.zeros((len(n), len(self.bias)), np.float32)
        full = np.flatnonzero(n)
        i = 0
        while i < len(full):
            j = max(i + 1, int(np.searchsorted(at[full + 1], at[full[i]] + PIECE_WORDS, "right")))
            some = full[i:j]
            a, e = at[some[0]], at[some[-1] + 1]
            if j == i + 1:
                best = self.peak(rows[:, a:e])[0][None]
            else:
                z = self.responses(rows[:, a:e], np.append(at[some], e) - a)
                best = np.maximum.reduceat(z, at[some] - a, axis=1).T
            out[some] = np.maximum(best + self.bias, 0)
            i = j
        return out

    def logits(self, texts: Texts, calibrated: bool = True) -> np.ndarray:
        logit = self.pooled(self.row_of[texts.cells], texts.at).astype(np.float64) @ self.out + self.constant
        if calibrated:
            base = self.thresholds[-1]
            logit -= np.array([self.thresholds.get(int(g), base) for g in _guesses(texts.h, texts.at)])
        return logit


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def _flat(parts: Sequence[np.ndarray]) -> np.ndarray:
    """All numbers in rows of SIZE, zeros behind the last."""
    x = np.concatenate([np.ravel(p) for p in parts])
    return np.append(x, np.zeros(-len(x) % SIZE)).reshape(-1, SIZE)


def _like(flat: np.ndarray, parts: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The numbers of ``flat`` in the shapes and types of ``parts``."""
    cuts = np.cumsum([p.size for p in parts])[:-1]
    some = np.split(np.ravel(flat)[:sum(p.size for p in parts)], cuts)
    return [x.reshape(p.shape).astype(p.dtype) for x, p in zip(some, parts, strict=True)]


def _fresh() -> np.ndarray:
    """Embedding of every cell before training, behind the zero row."""
    x = np.zeros(((1 << CELL_BITS) + 1, SIZE), np.float32)
    np.random.default_rng(5).standard_normal(out=x[1:], dtype=np.float32)
    x *= np.float32(0.1)
    return x


@dataclass
class State:
    """What training goes on from: trained cells with their embeddings and the sums of squares of
    their gradients; the other parameters (filters, bias, output layer, constant) and theirs."""

    cells: np.ndarray  # sorted
    embedding: np.ndarray
    seen: np.ndarray
    dense: list[np.ndarray]
    sums: list[np.ndarray]

    def network(self) -> Network:
        """The network for scoring, not calibrated; cells that were not trained are zero."""
        row_of = np.zeros(1 << CELL_BITS, np.int32)
        row_of[self.cells] = np.arange(1, len(self.cells) + 1)
        *filters, bias, out, constant = self.dense
        return Network(row_of, np.concatenate([np.zeros((1, SIZE), np.float32), self.embedding]), filters, bias, out, float(constant[0]), {-1: 0.0})

    def of(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embeddings and sums of squares of these cells (sorted), trained or not."""
        embedding, seen = _fresh()[cells + 1], np.full((len(cells), SIZE), 1e-6, np.float32)
        _, own, given = np.intersect1d(self.cells, cells, assume_unique=True, return_indices=True)
        embedding[given], seen[given] = self.embedding[own], self.seen[own]
        return embedding, seen

    def training(self) -> Training:
        """Training of all cells."""
        embedding = _fresh()
        embedding[self.cells + 1] = self.embedding
        seen = np.full(embedding.shape, 1e-6, np.float32)
        seen[self.cells + 1] = self.seen
        *filters, bias, out, constant = [x.copy() for x in self.dense]
        net = Network(np.arange(1, (1 << CELL_BITS) + 1, dtype=np.int32), embedding, filters, bias, out, float(constant[0]), {-1: 0.0})
        return Training(net, seen, [x.copy() for x in self.sums], np.zeros(len(embedding), bool))


@dataclass
class Training:
    """A network in training, with Adagrad's sums of squares (of embedding rows; of filters, bias,
    output layer and constant) and the embedding rows that received a gradient."""

    net: Network
    seen: np.ndarray
    sums: list[np.ndarray]
    touched: np.ndarray

    @staticmethod
    def begin(known: np.ndarray, rng: np.random.Generator) -> Training:
        """A network for these cells."""
        row_of = np.zeros(1 << CELL_BITS, np.int32)
        row_of[known] = np.arange(1, len(known) + 1)
        n_filters = FILTERS * len(WIDTHS)
        net = Network(row_of, 0.1 * rng.standard_normal((len(known) + 1, SIZE), np.float32),
                      [rng.normal(0, 0.3, (FILTERS * sum(w > j for w in WIDTHS), SIZE)).astype(np.float32) for j in range(max(WIDTHS))],
                      np.zeros(n_filters, np.float32), rng.normal(0, 0.3, n_filters), 0.0, {-1: 0.0})
        net.embedding[0] = 0
        sums = [np.full(x.shape, 1e-6) for x in (*net.filters, net.bias, net.out, np.zeros(1))]
        return Training(net, np.full(net.embedding.shape, 1e-6, np.float32), sums, np.zeros(len(net.embedding), bool))

    def dense(self) -> list[np.ndarray]:
        return [*self.net.filters, self.net.bias, self.net.out, np.array([self.net.constant])]

    def state(self) -> State:
        cells = np.flatnonzero(self.touched[self.net.row_of]).astype(np.int32)
        rows = self.net.row_of[cells]
        return State(cells, self.net.embedding[rows], self.seen[rows], self.dense(), self.sums)

    def learn(self, texts: Texts, toxic: np.ndarray, order: np.ndarray, weight: np.ndarray) -> None:
        """Mini-batches of the texts ``order``, all with words; ``weight`` is that of other and toxic ones."""
        net = self.net
        n_filters = len(net.bias)
        *ada_filters, ada_bias, ada_out, ada_constant = self.sums
        for b in range(0, len(order), BATCH):
            batch = order[b:b + BATCH]
            own = texts.take(batch.tolist())
            rows, at = net.row_of[own.cells], own.at
            peaks = [net.peak(rows[:, a:e]) for a, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            best = np.stack([w for _, w in peaks]) + at[:-1, None]  # texts x filters
            top = np.stack([v for v, _ in peaks]) + net.bias
            pooled = np.maximum(top, 0)
            y = toxic[batch]
            g = (sigmoid(pooled @ net.out + net.constant) - y) * weight[y] / len(batch)
            d_out, d_constant = pooled.T @ g + DECAY * net.out, float(g.sum())
            d_top = np.where(top > 0, g[:, None] * net.out, 0).astype(np.float32)
            rows_hit, d_rows = [], []
            for j, f in enumerate(net.filters):
                first = n_filters - len(f)
                p = best[:, first:] + j  # where shift j of each filter's best window lies
                d = np.where(p < at[1:, None], d_top[:, first:], 0)
                two = rows[:, np.minimum(p, rows.shape[1] - 1)]
                x = net.embedding[two].sum(0)  # texts x filters x SIZE
                d_f = np.einsum("tk,tks->ks", d, x) + DECAY * f
                ada_filters[j] += d_f * d_f
                d_x = (d[:, :, None] * f[None]).reshape(-1, SIZE)
                rows_hit += [two[0].ravel(), two[1].ravel()]
                d_rows += [d_x, d_x]
                net.filters[j] = (f - RATE * d_f / np.sqrt(ada_filters[j])).astype(np.float32)
            hit, where = np.unique(np.concatenate(rows_hit), return_inverse=True)
            d_e = np.zeros((len(hit), SIZE), np.float32)
            np.add.at(d_e, where, np.concatenate(d_rows))
            self.seen[hit] += d_e * d_e
            self.touched[hit[d_e.any(1)]] = True
            net.embedding[hit] -= RATE * d_e / np.sqrt(self.seen[hit])
            d_bias = d_top.sum(0)
            ada_bias += d_bias * d_bias
            net.bias -= (RATE * d_bias / np.sqrt(ada_bias)).astype(np.float32)
            ada_out += d_out * d_out
            net.out -= RATE * d_out / np.sqrt(ada_out)
            ada_constant += d_constant * d_constant
            net.constant -= RATE * d_constant / float(ada_constant[0]) ** 0.5


def _weights(other: int, toxic: int) -> np.ndarray:
    """Weights of other and toxic texts, by which both classes weigh the same."""
    return np.array([0.5 / max(1, other), 0.5 / max(1, toxic)]) * (other + toxic)


def _begin(texts: Texts, toxic: np.ndarray, calibrate: np.ndarray, seed: int = 1) -> Training:
    """Training by the texts that do not calibrate."""
    rng = np.random.default_rng(seed)
    training = Training.begin(np.unique(texts.cells), rng)
    learn = np.flatnonzero(~calibrate & (np.diff(texts.at) > 0))
    weight = _weights(int((toxic[learn] == 0).sum()), int((toxic[learn] == 1).sum()))
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // max(1, len(learn)))) if len(learn) else 0):
        rng.shuffle(learn)
        training.learn(texts, toxic, learn, weight)
    return training


def train(texts: Texts, toxic: np.ndarray, seed: int = 1) -> Network:
    """Fit a network to whole texts and 0/1 labels, in this process; each fourth text calibrates."""
    calibrate = np.arange(len(toxic)) % CALIBRATE == CALIBRATE - 1
    net = _begin(texts, toxic, calibrate, seed).net
    own, y = texts.take(np.flatnonzero(calibrate).tolist()), toxic[calibrate]
    net.thresholds = _thresholds(net.logits(own, calibrated=False), _guesses(own.h, own.at), y, np.ones(len(y), np.int64))
    return net


def _best_threshold(logit: np.ndarray, toxic: np.ndarray, n: np.ndarray | None = None) -> float:
    """The logit threshold with the best F1; the middle of the widest range of equally good ones.
    An entry stands for ``n`` texts (1), ``toxic`` of them toxic."""
    order = np.argsort(-logit, kind="stable")
    x, y = logit[order], toxic[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.cumsum(np.ones(len(x), np.int64) if n is None else n[order]) + y.sum())
    cuts = np.append((x[:-1] + x[1:]) / 2, x[-1] - 1.0)
    gaps = np.append(x[:-1] - x[1:], 2.0)
    good = np.flatnonzero((f1 >= f1.max() - 1e-9) & (gaps > 0))
    return float(cuts[good[np.argmax(gaps[good])]]) if len(good) else 0.0


def _thresholds(logit: np.ndarray, guess: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> dict[int, float]:
    """The common threshold (-1) and that of every language with enough toxic texts, from entries
    of ``n`` texts, ``toxic`` of them toxic."""
    if not toxic.sum() or toxic.sum() == n.sum():
        return {-1: 0.0}
    found = {-1: _best_threshold(logit, toxic, n)}
    for k in range(len(_LANGS)):
        own = guess == k
        if LEAST_TOXIC <= toxic[own].sum() < n[own].sum():
            found[k] = _best_threshold(logit[own], toxic[own], n[own])
    return found


def _train_frame(rows: pd.DataFrame) -> State | None:
    rows = rows.assign(text=rows["text"].fillna("")).sort_values(["h", "doc_id", "y", "text"])
    y = rows["y"].to_numpy().astype(np.int64)
    if not len(y) or y.all() or not y.any():
        return None
    calibrate = rows["h"].to_numpy() % CALIBRATE == CALIBRATE - 1
    return _begin(Texts.of(*W.arrow_bytes(pa.array(rows["text"].tolist(), pa.large_string()))), y, calibrate).state()


_NUMBERS = [f"{c}{k}" for c in "vs" for k in range(SIZE)]


def _changes(rows: DataFrame, begun: Remote, weight: np.ndarray, number: int) -> DataFrame:
    """Changes that each partition's training makes: id (a cell; from -1 down, rows of the other
    parameters), v0... (of the parameters) and s0... (of the sums of squares)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, training, rng = begun.value, None, np.random.default_rng(number)
        for b in batches:
            buf, off = W.arrow_bytes(b.column("text"))
            y = b.column("y").to_numpy().astype(np.int64)
            for i, j in W.groups(off, SHUFFLED):
                texts = Texts.of(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                order = np.flatnonzero(np.diff(texts.at))
                if len(order):
                    training = training or state.training()
                    rng.shuffle(order)
                    training.learn(texts, y[i:j], order, weight)
        if training is None:
            return
        hit = np.flatnonzero(training.touched)
        embedding, seen = state.of(hit - 1)
        dense, sums = _flat(training.dense()) - _flat(state.dense), _flat(training.sums) - _flat(state.sums)
        ids = np.concatenate([hit - 1, -1 - np.arange(len(dense))]).astype(np.int32)
        v = np.concatenate([training.net.embedding[hit] - embedding, dense.astype(np.float32)])
        s = np.concatenate([training.seen[hit] - seen, sums.astype(np.float32)])
        for i in range(0, len(ids), 1 << 14):
            some = slice(i, i + (1 << 14))
            columns = [np.ascontiguousarray(x[some, k]) for x in (v, s) for k in range(SIZE)]
            yield pa.record_batch([pa.array(ids[some]), *map(pa.array, columns)], names=["id", *_NUMBERS])

    return rows.select("text", "y").mapInArrow(tidy(each), "id int, " + ", ".join(f"{c} float" for c in _NUMBERS))


def _go_on(rows: DataFrame, begun: Remote, weight: np.ndarray, number: int) -> Remote:
    """One pass over all ``rows``. A row for each cell at most reaches the task that adds up."""

    def add(changes: pd.DataFrame) -> State:
        state, ids = begun.value, changes["id"].to_numpy()
        v, s = changes[_NUMBERS[:SIZE]].to_numpy(), changes[_NUMBERS[SIZE:]].to_numpy()
        dense, sums = _flat(state.dense), _flat(state.sums)
        other, hit = ids < 0, ids[ids >= 0]
        dense[-1 - ids[other]] += v[other]
        sums[-1 - ids[other]] += s[other]
        cells = np.union1d(state.cells, hit)
        embedding, seen = state.of(cells)
        at = np.searchsorted(cells, hit)
        embedding[at] += v[~other]
        seen[at] += s[~other]
        return State(cells, embedding, seen, _like(dense, state.dense), _like(sums, state.sums))

    mean = _changes(rows, begun, weight, number).groupBy("id").agg(*[F.avg(c).cast("float").alias(c) for c in _NUMBERS])
    return made_in_task(mean, add) or begun


def _calibrated(rows: DataFrame, begun: Remote) -> Remote:
    """The network with thresholds from all ``rows``, counted by guessed language and logit."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = begun.value.network()
        for b in batches:
            buf, off = W.arrow_bytes(b.column("text"))
            y = b.column("y").to_numpy().astype(np.int64)
            for i, j in W.groups(off, 1 << 20):
                texts = Texts.of(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                step = np.clip(np.rint(net.logits(texts, calibrated=False) / STEP), -MOST_STEPS, MOST_STEPS).astype(np.int64)
                yield pa.record_batch([pa.array(_guesses(texts.h, texts.at).astype(np.int64)), pa.array(step), pa.array(y[i:j])],
                                      names=["guess", "step", "y"])

    def add(counts: pd.DataFrame) -> Network:
        net = begun.value.network()
        step, guess, toxic, n = (counts.sort_values(["guess", "step"])[c].to_numpy() for c in ("step", "guess", "toxic", "n"))
        net.thresholds = _thresholds(step[n > 0] * STEP, guess[n > 0], toxic[n > 0], n[n > 0])
        return net

    counts = rows.select("text", "y").mapInArrow(tidy(each), "guess bigint, step bigint, y bigint").groupBy("guess", "step").agg(
        F.sum("y").alias("toxic"), F.count(F.lit(1)).alias("n"))
    none = rows.sparkSession.range(1).selectExpr("-1L AS guess", "0L AS step", "0L AS toxic", "0L AS n")
    return made_in_task(counts.unionByName(none), add)


def fit_documents(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, other: int = OTHER) -> Remote | None:
    """A network from all labelled documents that are not held out; None without one of each class.

    It begins with at most ``toxic`` + ``other`` of them, in one task: ids chosen from the labels
    alone, by hash, a class's candidates thinned before they are ranked. All of them are then written
    once, in the order of a hash, for the passes and the thresholds."""
    may = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("y")).distinct()
    keyed = may.withColumn("h", F.xxhash64("doc_id", F.lit("toxic")))
    counts = {r.y: r.n for r in may.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for y, most in ((0, other), (1, toxic)):
        share = min(1.0, 2.0 * most / max(1, counts.get(y, 0)) + 0.001)
        part = keyed.where(f"y = {y} AND pmod(h, 1000003) / 1000003D <= {share}").orderBy("h", "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = F.broadcast(chosen)
    given = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # one text of a doc_id, the smallest: rows that share an id do not fill the sample
    texts = given.join(chosen, "doc_id")
    begun = made_in_task(texts.groupBy("doc_id", "y", "h").agg(F.min("text").alias("text")), _train_frame)
    if begun is None:
        return None
    rows = given.join(size_checked_broadcast(keyed, sum(counts.values())), "doc_id").distinct()
    rows = materialize(rows.sortWithinPartitions("h", "doc_id", "y", "text"), "toxicity-rows")
    learn = rows.where(f"pmod(h, {CALIBRATE}) <> {CALIBRATE - 1}")
    sizes = {r.y: r.n for r in learn.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = _weights(sizes.get(0, 0), sizes.get(1, 0))
    for k in range(ROUNDS):
        before, begun = begun, _go_on(learn, begun, weight, k)
        if begun is not before:
            before.free()
    net = _calibrated(rows.where(f"pmod(h, {CALIBRATE}) = {CALIBRATE - 1}"), begun)
    begun.free()
    return net


def classify(docs: DataFrame, net: Network | Remote | None, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry``, ``score`` and ``predicted`` (under free names) of every document."""
    score_name, predicted_name = free(carry, "score"), free(carry, "predicted")
    told = net if isinstance(net, Remote) else docs.sparkSession.sparkContext.broadcast(net)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = told.value
        for b in batches:
            buf, off = W.arrow_bytes(b.column("text"))
            for i, j in W.groups(off, 1 << 20):
                if own is None:
                    score = np.zeros(j - i)
                else:
                    score = sigmoid(own.logits(Texts.of(buf[off[i]:off[j]], off[i:j + 1] - off[i])))
                yield pa.record_batch([*[b.column(c).slice(i, j - i) for c in carry], pa.array(score),
                                       pa.array((score >= 0.5).astype(np.int32))], names=[*carry, score_name, predicted_name])

    kinds = dict(docs.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in carry], f"{score_name} double, {predicted_name} int"])
    return docs.select(*[col(c) for c in dict.fromkeys([*carry, "text"])]).mapInArrow(tidy(each), schema)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = fit_documents(docs, table(spark, sf_dir, "labels"))
    return classify(docs.select("doc_id", "text"), net).select("doc_id", held_out().alias("held_out"), "score", "predicted")
