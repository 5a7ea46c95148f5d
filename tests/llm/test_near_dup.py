"""Near duplicates against a direct computation over full shingle sets."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from hearth.llm import near_dup as N
from hearth.llm import words as W
from hearth.llm.components import components
from tests.llm.conftest import CLASHES


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def classes(rows, width):
    """doc_id -> smallest reachable doc_id, by all pairs."""
    sets = {}
    for doc, text in rows:
        if doc is not None:
            sets.setdefault(doc, []).append(shingles(text, width))
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if any(s and t and 100 * len(s & t) >= 80 * len(s | t) for s in sets[a] for t in sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def corpus(seed=5, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, doc = [], 1
    for _ in range(n):
        base = [r.choice(vocabulary) for _ in range(r.randint(1, 120))]
        for _ in range(r.choice([1, 1, 1, 2, 5])):
            own = list(base)
            for _ in range(r.randint(0, max(1, len(own) // 12))):
                own[r.randrange(len(own))] = r.choice(vocabulary)
            rows.append((doc, " ".join(own)))
            doc += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_classes_equal_all_pairs(documents, width):
    rows = corpus()
    got = {r.doc_id: r for r in N.near_duplicates(documents(rows), width).collect()}
    want = classes(rows, width)
    assert {d: r.component_id for d, r in got.items()} == want
    assert all(r.n_shingles == len(shingles(t, width)) for (d, t) in rows for r in [got[d]])
    assert all(r.kept == (want[d] == d) for d, r in got.items())


def test_large_blocks_and_squares_give_the_same_classes(documents, monkeypatch):
    r = random.Random(3)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for doc in range(1, 90):  # one diffuse group: many members are not linked with each other
        own = list(base)
        for _ in range(r.randint(0, 22)):
            own[r.randrange(len(own))] = f"c{r.randrange(10_000)}"
        rows.append((doc, " ".join(own)))
    rows += [(1000 + i, rows[0][1]) for i in range(30)]
    want = classes(rows, 2)
    monkeypatch.setattr(N, "PART", 2_000)
    monkeypatch.setattr(N, "SQUARE", 4)
    monkeypatch.setattr(N, "HUBS", 2)
    got = {x.doc_id: x.component_id for x in N.near_duplicates(documents(rows), 2).collect()}
    assert got == want


def on_a_line(first, at, step=100, size=1_000):
    """(doc_id, text) of sets that are windows of a line of words: those up to 1.1 apart are linked."""
    return [(first + i, " ".join(f"x{first}_{k}" for k in range(int(p * step), int(p * step) + size))) for i, p in enumerate(at)]


def test_blocks_whose_largest_class_changes(documents):
    # two stars (0 with 1 and 2; 3 with 4, 5 and 6) joined by the link of 2 and 6 alone
    rows = on_a_line(0, [0, -1, 1, 3, 4, 3.9, 2])
    # one star after the other, the larger ones later, joined by their ends alone
    r = random.Random(3)
    rows += on_a_line(100, [0, 0.5, -1, 1, *[3 + r.random() for _ in range(12)], *[5.5 + r.random() for _ in range(20)], 2, 4.9])
    for k in range(6):
        rows += on_a_line(1_000 * (k + 1), [r.uniform(0, 12) for _ in range(25)])
    got = {x.doc_id: x.component_id for x in N.near_duplicates(documents(rows), 1).collect()}
    want = {}
    for _, own in itertools.groupby(sorted(rows), lambda x: (x[0] >= 100, x[0] // 1_000)):
        want |= classes(list(own), 1)
    assert {want[i] for i in range(7)} == {0}
    assert got == want


def test_different_texts_under_one_doc_id_are_one_class(documents):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(7, a), (7, b), (5, a), (9, b), (9, b), (7, ""), (7, None), (20, c), (20, ""), (21, c), (30, ""), (30, None), (None, a), (40, "d e f"), (40, "g h i")]
    got = N.near_duplicates(documents(rows), 5).collect()
    assert len(got) == len(rows)
    want = {5: 5, 7: 5, 9: 5, 20: 20, 21: 20, 30: 30, 40: 40, None: None}
    assert {(r.doc_id, r.component_id) for r in got} == set(want.items())
    assert all(r.kept == (r.doc_id in (5, 20, 30, 40, None)) for r in got)


def test_edge_rows(documents, edge_rows):
    got = N.near_duplicates(documents(edge_rows, CLASHES), 5).collect()
    assert len(got) == len(edge_rows)
    by = {}
    for x in got:
        by.setdefault(x.doc_id, []).append(x)
    assert [x.n_shingles for d in (1, 2, 3) for x in by[d]] == [0, 0, 0]
    assert by[3][0].kept and by[3][0].component_id == 3
    assert by[5][0].component_id == 5 and {x.component_id for x in by[6]} == {5}
    assert by[8][0].component_id == 7 and not by[8][0].kept
    assert all(x.component_id is None and x.kept for x in by[None])
    assert by[9][0].n_shingles == 1


def test_empty_table(documents):
    assert N.near_duplicates(documents([])).collect() == []


def test_pairs_within_the_distance_share_a_key():
    """The pigeonhole: any DISTANCE changed components leave a chunk with at most one change."""
    r = np.random.default_rng(0)
    for _ in range(200):
        changed = np.zeros(N.K, bool)
        changed[r.choice(N.K, N.DISTANCE, replace=False)] = True
        assert any(changed[a:z].sum() <= 1 for a, z in zip(N._BOUNDS[:-1], N._BOUNDS[1:], strict=True))


def written_folders(name):
    from hearth.llm import common

    return sum(f"/hearth-{name}-" in path for _, path in common._SCRATCH)


def test_components_of_stars_or_nothing_take_no_round(spark):
    """The driver plans and runs no round that changes nothing."""
    for edges, want in (([], {}), ([(1, 5), (1, 6), (2, 9)], {1: 1, 5: 1, 6: 1, 2: 2, 9: 2})):
        before = written_folders("cc")
        got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
        assert got == want
        assert written_folders("cc") - before == 1


def test_components_against_union_find_of_random_edges(spark):
    rng = np.random.default_rng(11)
    for n, m in ((60, 40), (200, 230), (30, 90)):
        edges = [(int(a), int(b)) for a, b in rng.integers(-n // 2, n, (m, 2))]
        want = {x: x for e in edges if e[0] != e[1] for x in e}
        changed = True
        while changed:
            changed = False
            for a, b in edges:
                if a != b and want[a] != want[b]:
                    want[a] = want[b] = min(want[a], want[b])
                    changed = True
        got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
        assert got == want


def test_written_stages_give_the_drivers_freed_memory_back(spark, monkeypatch):
    from hearth.llm import common
    from hearth.session import trim_driver

    told = []
    monkeypatch.setattr(common, "trim_driver", lambda s: told.append(trim_driver(s)))
    assert common.materialize(spark.range(3), "trimmed").count() == 3
    assert len(told) == 1 and "Trim native heap" in told[0]


def test_components_of_chains_cycles_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7)] + [(200, 200 + i) for i in range(1, 30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 102: 100} | {200 + i: 200 for i in range(30)}


@pytest.mark.parametrize("table,pattern", [(W.SPACED, r"[^\x20\x09-\x0D]+"), (W.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_equal_the_pattern(table, pattern, monkeypatch):
    monkeypatch.setattr(W, "PIECE", 7)  # words cross piece boundaries
    texts = ["Ab  cd", None, "", "é_ü x-9", "\tend ", "nospaceatallinthisverylongword", "Ab", "\x0b", "zß 漢字 q"]
    buf, off = W.arrow_bytes(pa.array(texts, pa.string()))
    starts, ends, h, at = W.words(buf, off, table)
    for i, t in enumerate(texts):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        want = re.findall(pattern, low)
        raw = buf.tobytes()
        assert [re.sub("[A-Z]", lambda m: m[0].lower(), raw[a:z].decode()) for a, z in zip(starts[at[i]:at[i + 1]], ends[at[i]:at[i + 1]], strict=True)] == want
        assert h[at[i]:at[i + 1]].tolist() == [W.word_hash(w) for w in want]
