"""Decontamination against a direct search for windows."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from hearth.llm import decontaminate as D
from tests.llm.conftest import CLASHES


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def direct(text, items, window=10):
    own, hit, found = words(text), set(), set()
    for name, item in items:
        it = words(item)
        n = min(window, len(it))
        wins = {tuple(it[i:i + n]) for i in range(len(it) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if n and tuple(own[i:i + n]) in wins:
                hit.update(range(i, i + n))
                found.add(str(name))
    return len(own), hit, sorted(found)


def case(seed=1):
    r = random.Random(seed)
    v = ["a", "b", "c", "d", "E", "f"]
    items = [(i, " ".join(r.choice(v) for _ in range(r.choice([0, 1, 2, 3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(40, items[5][1]), (41, None), (None, "a b")]
    docs = []
    for d in range(60):
        parts = []
        for _ in range(r.randint(0, 6)):
            it = (r.choice(items)[1] or "").split()
            a = r.randint(0, max(0, len(it) - 1))
            parts += it[a:a + r.randint(1, 14)] + [r.choice(v + ["zzz", "yy"]) for _ in range(r.randint(0, 4))]
        docs.append((d, ", ".join(parts)))
    return docs, items


@pytest.mark.parametrize("max_words", [D.MAX_WORDS, 40])
@pytest.mark.parametrize("window", [3, 10])
def test_hits_equal_a_direct_search(spark, documents, max_words, window):
    docs, items = case()
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: r for r in D.contamination(documents(docs), table, window, max_words).collect()}
    for d, text in docs:
        n, hit, found = direct(text, [i for i in items if i[0] is not None], window)
        own = got[d]
        assert own.n_words == n
        assert {i for a, z in zip(own.first, own["after"], strict=True) for i in range(a, z)} == hit
        assert own["items"] == found
        assert all(z < a for z, a in zip(own["after"], own.first[1:], strict=False))  # united


def test_cut_texts_hold_no_window(spark, documents):
    docs, items = case(2)
    known = [i for i in items if i[0] is not None]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    clean = D.decontaminate(documents(docs, CLASHES), table, max_coverage=1.0)
    assert clean.columns == documents(docs, CLASHES).columns
    rows = clean.collect()
    assert len(rows) == len(docs)
    texts = dict(docs)
    for r in rows:
        assert not direct(r.text, known)[1]
        assert r.n_chars == len(r.text)
        if not direct(texts[r.doc_id], known)[1]:
            assert r.text == texts[r.doc_id]
    kept = {r.doc_id for r in D.decontaminate(documents(docs), table, max_coverage=0.3).collect()}
    assert {d for d, t in docs if len(direct(t, known)[1]) > 0.3 * len(words(t))}.isdisjoint(kept)
    assert {d for d, t in docs if not direct(t, known)[1]} <= kept


@pytest.mark.parametrize("max_coverage", [0.05, 0.3, 0.6, 1.0])
def test_several_automata_judge_and_cut_like_one(spark, documents, max_coverage):
    docs, items = case(3)
    # two long items that overlap in a text, and one half of a text each: coverage counts both
    a, b = ([f"{x}{i}" for i in range(30)] for x in "ab")
    items += [(50 + i, " ".join([*a[20:], *b[:15]] if i % 2 else a)) for i in range(4)]
    filler = [f"q{i}" for i in range(45)]
    docs += [(100, " ".join([*filler, *a, *b[:15], *filler])), (101, " ".join([*a, *filler, *b[:15]])), (None, " ".join(a[:20]))]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    assert len(D.scanners(table, max_words=40)) > 3
    own = documents(docs, CLASHES)
    one, several = (D.decontaminate(own, table, max_coverage=max_coverage, max_words=m) for m in (D.MAX_WORDS, 40))
    assert several.columns == own.columns
    assert sorted(several.collect(), key=str) == sorted(one.collect(), key=str)


def test_edge_rows_and_empty_tables(spark, documents, edge_rows):
    items = spark.createDataFrame([(1, "ONE"), (2, ""), (3, None)], "item_id bigint, text string")
    got = D.contamination(documents(edge_rows, CLASHES), items).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, len(r["items"])) for r in got) == sorted(
        (d is None, d or 0, int("one" in words(t))) for d, t in edge_rows)
    none = items.where(F.lit(False))
    assert all(not r["items"] for r in D.contamination(documents(edge_rows), none).collect())
    assert D.contamination(documents([]), items).collect() == []
    assert D.decontaminate(documents([]), items).collect() == []


def test_automata_are_flat_and_hold_no_more_than_their_words():
    r = random.Random(7)
    items = [(str(i), [r.randrange(1, 1 << 40) for _ in range(400)]) for i in range(50)]
    a = D.Automaton(items)
    assert len(a.depth) <= 2 * 20_000 and len(a.word) <= 3 * 20_000
    held = sum(x.itemsize * len(x) for x in vars(a).values() if hasattr(x, "itemsize"))
    assert held < 60 * 20_000  # bytes a word
    own = items[7][1][100:150]
    assert a.scan([1, *own, 2]) == ([(1, 1 + k) for k in range(10, 51)], {"7"})


def test_repetitive_items_take_one_look_at_each_word():
    took = []
    for n in (4_000, 32_000):
        one = [5] * n
        a = D.Automaton([("x", one), ("y", [5, 5, 5])])
        steps = time.perf_counter()
        spans, found = a.scan(one)
        took.append(time.perf_counter() - steps)
        assert found == {"x", "y"} and D._united(spans) == [(0, n)]
    assert took[1] < 40 * took[0]  # 8 times the words


def test_many_parts_scan_in_one_pass(spark, documents):
    docs, items = case(4)
    table = spark.createDataFrame(items * 3, "item_id bigint, text string")
    known = [i for i in items if i[0] is not None]
    all_ = D.scanners(table, part_words=40)
    assert len(all_) == 1 and len(all_[0].value.automata) >= 3
    for d, text in docs:
        own = [D.W.word_hash(w) for w in words(text)]
        spans, found = all_[0].value.scan(own)
        _, hit, want = direct(text, known)
        assert sorted(found) == want and {i for a, z in spans for i in range(a, z)} == hit
