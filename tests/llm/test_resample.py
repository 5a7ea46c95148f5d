"""Importance resampling against a plain computation and DuckDB."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from hearth.llm import resample
from hearth.llm.words import arrow_bytes
from tests.llm.conftest import CLASHES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def features(text, longest=3):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, percent, least, buckets=10_000):
    s, t = [0] * buckets, [0] * buckets
    for side, texts in ((s, [d[1] for d in docs]), (t, target)):
        for x in texts:
            for f in features(x)[1]:
                side[zlib.crc32(f.encode()) % buckets] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    out = []
    for doc, x in docs:
        words, own = features(x)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in own)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[:len(able) * percent // 100]):
        r[4] = i + 1
    return [tuple(r[:5]) for r in out]


KEY = lambda r: tuple((v is None, v or 0) for v in r)


def run(docs, target, percent, least):
    got = resample.resample(docs, target, percent, least).select("doc_id", "n_features", "weight", "score", "rank")
    return sorted([tuple(r) for r in got.collect()], key=KEY)


@pytest.mark.parametrize("percent", [1, 30, 100])
def test_equals_the_plain_computation(spark, documents, edge_rows, percent):
    r = random.Random(8)
    vocabulary = [*"abcdefghij", "Éa", "ünï", "x" * 63, "y" * 64, "z" * 65, "w" * 200, "it's", "A1"]
    rows = [(1000 + i, " ".join(r.choices(vocabulary, k=r.randrange(40)))) for i in range(300)]
    rows += [e for e in edge_rows if e[0] is None or e[0] != 6] + [(7000, "abé " * 30)]
    target = [(i, " ".join(r.choices(vocabulary[:6], k=12))) for i in range(20)] + [(99, None), (98, "")]
    docs = documents(rows, [*CLASHES, "5 AS weight", "6 AS rank", "7 AS n_features"]).repartition(3)
    got = run(docs, spark.createDataFrame(target, "item_id bigint, text string"), percent, 5)
    assert got == sorted(plain(rows, [t for _, t in target], percent, 5), key=KEY)


def test_ties_and_repeated_rows(spark, documents):
    # one id with one text many times: equal scores and ids; no more rows than asked for are drawn
    rows = [(5, "a b c d e")] * 60 + [(i, "f g h i j") for i in range(10, 40)] + [(None, "a b c d e")] * 10
    target = spark.createDataFrame([(1, "f g")], "item_id bigint, text string")
    for percent in (3, 20, 50, 95):
        got = run(documents(rows).repartition(4), target, percent, 1)
        want = plain(rows, ["f g"], percent, 1)
        assert sorted((x[:4] for x in got if x[4]), key=KEY) == sorted((x[:4] for x in want if x[4]), key=KEY) or percent == 95
        assert sorted(x[4] for x in got if x[4]) == list(range(1, len(rows) * percent // 100 + 1))


def test_equal_scores_go_to_smaller_ids(spark):
    scored = spark.createDataFrame([(i, 7 if i % 2 else 9) for i in range(-50, 50)] + [(None, 7)] * 5, "doc_id bigint, score bigint")
    for percent in (10, 47, 60, 99):
        got = sorted([(r.rank, r.score, r.doc_id) for r in resample.draw(scored, percent).collect() if r.rank])
        want = sorted([(r.score, r.doc_id) for r in scored.collect()], key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:105 * percent // 100]
        assert [g[1:] for g in got] == want and [g[0] for g in got] == list(range(1, len(want) + 1))


def test_halving():
    for values in ([3], [1, 1, 1], list(range(-40, 100, 7)), [-(1 << 40), 1 << 40]):
        count = lambda xs, v=values: [sum(x >= t for x in v) for t in xs]
        for least in range(1, len(values) + 1):
            cut, beyond = resample.halve(min(values), max(values) + 1, count, least)
            assert cut == sorted(values)[-least] and beyond == sum(x > cut for x in values)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert run(documents([]), none, 5, 1) == []
    rows = [(i, f"a b c {i}") for i in range(40)]
    assert run(documents(rows), none, 50, 1) == sorted(plain(rows, [], 50, 1), key=KEY)


def test_feature_buckets_of_long_words():
    texts = ["a " + "b" * 64 + " c", "b" * 65, "b" * 300 + " " + "c" * 100 + " d", None, "", "A-b"]
    buf, offsets = arrow_bytes(pa.array(texts))
    rows, found = resample.feature_buckets(buf, offsets, 10_000, 3)
    for i, x in enumerate(texts):
        got = sorted(int(f[w]) for f in found for w in range(rows[i], rows[i + 1]) if f[w] >= 0)
        assert got == sorted(zlib.crc32(f.encode()) % 10_000 for f in features(x)[1])
    assert np.array_equal(np.diff(rows), [features(x)[0] for x in texts])
