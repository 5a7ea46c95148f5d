"""Language identification by a blended-spectrum string kernel.

The kernel of two texts counts the distinct character n-grams (n = 1 to 4 in one blend) that both
hold, normalised: k(x, y) = |G(x) & G(y)| / sqrt(|G(x)| |G(y)|). With m landmark texts, Nyström's
feature of a text is its kernel row against the landmarks times K(L, L) ** -1/2; one-versus-rest ridge
regression on these features gives a weight vector for each language.

A kernel row is itself a product of presence vectors, so landmarks, Nyström map and ridge weights
fold into one matrix from n-grams to languages: scores of a batch are its sparse presence matrix times
that matrix, scaled. n-grams are hashed to ``CELLS`` cells, so the matrix has a fixed size however
many texts are scored.

The model is fitted on a bounded sample of labelled texts (``PER_LANGUAGE`` for each language, chosen
by a hash of their id); whole texts are read, in training and in scoring.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; a null lang is not
learned from; without any labelled text everything is ``und``; a null doc_id takes part in scoring
only; repeated rows are rows of their own; an empty table gives an empty result; other columns are
ignored. Ties between languages go to the first in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearth.llm.common import Remote, col, free, made_in_task, table

#: n-gram lengths of the blend, and cells they are hashed to.
ORDERS = (1, 2, 3, 4)
CELLS = 1 << 17
#: Labelled texts learned from, and landmarks among them, for each language; languages at most (the
#: most frequent by documents; texts in others get the language that is most like theirs).
PER_LANGUAGE = 300
LANDMARKS = 60
LANGUAGES = 200
#: Ridge.
RIDGE = 1e-3
#: Weights (cells x languages) gathered at once when texts are scored.
GATHERED = 1 << 22

UNKNOWN = "und"
_MULT = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


def cells(text: str, flags: np.ndarray) -> np.ndarray:
    """Sorted distinct cells of the text's n-grams; ``flags`` is CELLS falses, and is so again
    afterwards. Long texts are read in pieces that overlap."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    piece, over = 1 << 18, max(ORDERS) - 1
    for p in range(0, len(code), piece):
        c = code[p:p + piece + over]
        h = np.zeros(len(c), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            if len(c) < n:
                break
            h = (h[:len(c) - n + 1] if n > 1 else h) * np.uint32(0x01000193) + c[n - 1:] * np.uint32(_MULT[0]) + np.uint32(n)
            if n in ORDERS:
                x = h * np.uint32(_MULT[1])
                flags[(x ^ (x >> np.uint32(15))) & np.uint32(CELLS - 1)] = True
    found = np.flatnonzero(flags)
    flags[found] = False
    return found


@dataclass
class Model:
    """Languages, and the matrix from cells to their ridge scores."""

    languages: list[str]
    weights: np.ndarray  # CELLS x languages, float32

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        """Ridge scores (texts x languages): a batched sparse-times-dense product."""
        flags = np.zeros(CELLS, bool)
        own = [cells(t, flags) for t in texts]
        n = np.array([len(x) for x in own])
        out = np.zeros((len(own), len(self.languages)))
        full = np.flatnonzero(n)
        if len(full):
            flat, owner = np.concatenate([own[i] for i in full]), np.repeat(full, n[full])
            step = max(1, GATHERED // max(1, len(self.languages)))
            for a in range(0, len(flat), step):  # so many weights are gathered at once
                of = owner[a:a + step]
                cuts = np.flatnonzero(np.diff(of, prepend=-1))
                out[of[cuts]] += np.add.reduceat(self.weights[flat[a:a + step]], cuts, axis=0, dtype=np.float64)
            out[full] /= np.sqrt(n[full])[:, None]
        return out

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of every text."""
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return lang, score
        able = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
        if able:
            s = self.scores([texts[i] for i in able])
            best = s.argmax(1)
            for i, b, v in zip(able, best.tolist(), s[np.arange(len(able)), best].tolist(), strict=True):
                lang[i], score[i] = self.languages[b], min(1.0, max(0.0, v))
        return lang, score


def train(texts: Sequence[str], langs: Sequence[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nyström map and one-versus-rest ridge regression; the first ``landmarks`` texts of each
    language are the landmarks."""
    languages = sorted(set(langs))
    if not languages:
        return Model([], np.zeros((CELLS, 0), np.float32))
    flags = np.zeros(CELLS, bool)
    own = [cells(t, flags) for t in texts]
    lang = np.array([languages.index(x) for x in langs])
    keep = np.array([len(x) > 0 for x in own])
    chosen = np.concatenate([np.flatnonzero((lang == k) & keep)[:landmarks] for k in range(len(languages))])
    if not len(chosen):
        return Model([], np.zeros((CELLS, 0), np.float32))

    def row(x: np.ndarray) -> np.ndarray:
        flags[x] = True
        got = np.array([np.count_nonzero(flags[own[i]]) for i in chosen]) / np.sqrt(max(len(x), 1) * lens)
        flags[x] = False
        return got

    lens = np.array([len(own[i]) for i in chosen], float)
    kernel = np.stack([row(own[i]) for i in chosen])
    values, vectors = np.linalg.eigh(kernel)
    good = values > 1e-8 * values.max()
    root = (vectors[:, good] / np.sqrt(values[good])) @ vectors[:, good].T  # K(L, L) ** -1/2
    features = np.stack([row(x) for x in own]) @ root
    target = (lang[:, None] == np.arange(len(languages))).astype(float)
    # every language weighs the same
    weight = (1.0 / np.bincount(lang, minlength=len(languages)))[lang][:, None]
    gram = features.T @ (features * weight) + ridge * np.eye(features.shape[1])
    beta = root @ np.linalg.solve(gram, features.T @ (target * weight))  # landmarks x languages
    fold = np.zeros((CELLS, len(languages)))
    for i, b, n in zip(chosen, beta, lens, strict=True):
        fold[own[i]] += b / np.sqrt(n)
    return Model(languages, fold.astype(np.float32))


def held_out(column="doc_id"):
    """The documents never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _train_frame(rows: pd.DataFrame) -> Model | None:
    rows = rows.sort_values(["lang", "h", "doc_id", "text"])
    return train(rows["text"].tolist(), rows["lang"].tolist()) if len(rows) else None


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES) -> Remote | None:
    """A model from a bounded sample of ``labelled`` (doc_id, text, lang), fitted in one task; None
    without a row. At most ``per_language`` texts are taken of each of the ``languages`` most
    frequent languages (by documents): one text of a doc_id and language, the smallest, so that rows
    that share an id neither fill the sample nor thin their language away. The sample's ids are
    chosen without the texts; a language's candidates are thinned before they are ranked."""
    ids = labelled.select("lang", "doc_id").distinct().withColumn("h", F.xxhash64("doc_id", F.lit("lang")))
    counts = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    # a share of each language's documents that holds per_language of them many times over
    thin = ids.join(F.broadcast(counts), "lang").where("pmod(h, 1000003) / 1000003D <= " + f"{8.0 * per_language} / n")
    ranked = thin.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).where(f"r <= {per_language}")
    chosen = F.broadcast(ranked.select("lang", "doc_id", "h"))
    rows = labelled.join(chosen, ["lang", "doc_id"]).groupBy("lang", "h", "doc_id").agg(F.min("text").alias("text"))
    return made_in_task(rows, _train_frame)


def identify(docs: DataFrame, model: Model | Remote | None, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry``, ``lang_pred`` and ``score`` (under free names) of every document."""
    lang_name, score_name = free(carry, "lang_pred"), free(carry, "score")
    if model is None:
        model = Model([], np.zeros((CELLS, 0), np.float32))
    told = model if isinstance(model, Remote) else docs.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                lang, score = told.value.predict(part.column("text").to_pylist())
                yield pa.record_batch([*[part.column(c) for c in carry], pa.array(lang, pa.string()), pa.array(score)],
                                      names=[*carry, lang_name, score_name])

    kinds = dict(docs.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in carry], f"{lang_name} string, {score_name} double"])
    return docs.select(*[col(c) for c in dict.fromkeys([*carry, "text"])]).mapInArrow(each, schema)


def fit_documents(docs: DataFrame, **limits) -> Remote | None:
    """A model from the documents that may be learned from: text and a non-null lang, not held out."""
    may = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    return fit(may.select("doc_id", "text", "lang"), **limits)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit_documents(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
