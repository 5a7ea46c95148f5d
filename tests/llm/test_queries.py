"""The registered queries on the smallest tables: against DuckDB where SQL expresses them, else
against a direct computation of their contract."""

from __future__ import annotations

import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from hearth.llm import common, langid, packing, toxicity, words
from hearth.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.test_near_dup import classes

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    got = QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, want))


@pytest.fixture(scope="module")
def docs(con):
    return dict(con.sql("SELECT doc_id, text FROM documents").fetchall())


def test_near_dup(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op1_near_dup"](spark, SF).collect()}
    assert {d: r.component_id for d, r in got.items()} == classes(list(docs.items()), 2)


def is_held_out(doc):
    return zlib.crc32(str(doc).encode()) % 5 == 0


def test_language_equals_a_plain_kernel_regression(spark, docs, monkeypatch):
    """The registered query against dense kernels over sets of n-gram cells, on its own sample."""
    sample = []
    learn = langid.made_in_task
    monkeypatch.setattr(langid, "made_in_task", lambda rows, make: (sample.extend(rows.collect()), learn(rows, make))[1])
    got = {r.doc_id: r for r in QUERIES["op4_string_kernel"](spark, SF).collect()}
    assert sorted(got) == sorted(docs) and not any(is_held_out(r.doc_id) for r in sample)
    assert {(r.doc_id, r.text) for r in sample} <= set(docs.items())
    sample.sort(key=lambda r: (r.lang, r.h, r.doc_id, r.text))
    flags = np.zeros(langid.CELLS, bool)
    cells = lambda t: set(langid.cells(t, flags).tolist())
    own, langs = [cells(r.text) for r in sample], sorted({r.lang for r in sample})
    marks = [x for name in langs for x in [c for c, r in zip(own, sample, strict=True) if r.lang == name and c][:langid.LANDMARKS]]
    kernel = lambda a: np.array([len(a & m) / np.sqrt(max(1, len(a)) * len(m)) for m in marks])
    values, vectors = np.linalg.eigh(np.stack([kernel(m) for m in marks]))
    good = values > 1e-8 * values.max()
    root = vectors[:, good] / np.sqrt(values[good]) @ vectors[:, good].T
    x = np.stack([kernel(c) for c in own]) @ root
    y = np.array([[float(r.lang == name) for name in langs] for r in sample])
    w = (y / y.sum(0)).sum(1)[:, None]
    beta = np.linalg.solve(x.T @ (x * w) + langid.RIDGE * np.eye(x.shape[1]), x.T @ (y * w))
    for doc, text in docs.items():
        r = got[doc]
        assert r.held_out == is_held_out(doc)
        if not any(map(str.isalpha, text or "")):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        score = kernel(cells(text)) @ root @ beta
        assert abs(r.score - min(1.0, max(0.0, score.max()))) < 1e-3
        assert r.lang_pred == langs[score.argmax()] or np.sort(score)[-1] - np.sort(score)[-2] < 1e-3


def test_toxicity_equals_a_direct_convolution(spark, docs):
    """The registered query against the network's formula, word by word, on a part of the texts."""
    tables = [common.table(spark, SF, t) for t in ("documents", "labels")]
    net = toxicity.fit_documents(*tables).value
    got = {r.doc_id: r for r in QUERIES["op7_toxicity_cnn"](spark, SF).collect()}
    assert sorted(got) == sorted(docs)
    for doc, text in sorted(docs.items())[::7]:
        own = toxicity.Texts.of(*words.arrow_bytes(pa.array([text or ""])))
        rows = net.row_of[own.cells]
        e = net.embedding[rows[0]] + net.embedding[rows[1]] if rows.shape[1] else np.zeros((0, toxicity.SIZE))
        z = np.zeros((len(e), len(net.bias)))
        for j, f in enumerate(net.filters):
            for k in range(len(e) - j):
                z[k, len(net.bias) - len(f):] += f @ e[k + j]
        top = np.maximum(z.max(0) + net.bias, 0) if len(e) else np.zeros(len(net.bias))
        logit = top @ net.out + net.constant - net.thresholds.get(int(toxicity._guesses(own.h, own.at)[0]), net.thresholds[-1])
        r = got[doc]
        assert abs(r.score - 1 / (1 + np.exp(-logit))) < 1e-4 and r.predicted == int(r.score >= 0.5) and r.held_out == is_held_out(doc)


def test_shards(spark, docs):
    got = QUERIES["op5_shard_bins"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs) and {r.shard for r in got} <= set(range(40))
    shard, slots, size = {}, {}, {}
    for r in got:
        text = docs[r.doc_id] or ""
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text.encode()) + 16, zlib.crc32(text.encode()), "bytes", None)
        assert shard.setdefault(text, r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
        size[r.shard] = size.get(r.shard, 0) + r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = {}
    for r in got:
        groups.setdefault(docs[r.doc_id], []).append(r.size)
    # no shard is larger than the even share and the largest group that cannot be divided
    assert max(size.values()) <= max(sum(size.values()) / 40 * 1.05, max(map(sum, groups.values())))


def test_packing(spark, docs):
    got = QUERIES["op6_pack_differencing"](spark, SF).collect()
    library = Tokenizer.from_file(packing.tokenizer_path())
    library.encode_special_tokens = True
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 0] for d, t in docs.items()}
    pieces, sequences = {}, {}
    for r in got:
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert len(own) == r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    gapless = lambda spans: [a for a, _ in sorted(spans)] == [sum(n for _, n in sorted(spans)[:i]) for i in range(len(spans))]
    assert pieces.keys() == ids.keys() and all(gapless(p) and sum(n for _, n in p) == len(ids[d]) for d, p in pieces.items())
    assert all(gapless(s) and sum(n for _, n in s) <= 1024 for s in sequences.values())
    assert sum(map(len, ids.values())) > 0.98 * 1024 * len(sequences)  # fill


def test_differencing_equals_a_plain_one():
    """Every partial partition as a full list of windows; the two with the largest imbalance merge."""
    r = random.Random(3)
    for n, k in ((1, 4), (7, 3), (30, 5), (60, 8)):
        sizes = [r.randint(1, 50) for _ in range(n)]
        parts = [([s] + [0] * (k - 1), i) for i, s in enumerate(sizes)]
        made = n
        while len(parts) > 1:
            parts.sort(key=lambda p: (-(max(p[0]) - min(p[0])), p[1]))
            (a, _), (b, _) = parts[:2]
            made += 1
            parts = [*parts[2:], ([x + y for x, y in zip(sorted(a, reverse=True), sorted(b), strict=True)], made)]
        assert sorted(s for s, _ in packing.difference(sizes, k)) == sorted(s for s in parts[0][0] if s)
