"""The corpus pipeline: each stage's decisions, whole and against brute force."""

from __future__ import annotations

import random

import corpus_pipeline as P
from hearth.llm import decontaminate, langid, packing
from hearth.llm.common import table
from tests.llm.conftest import CLASHES
from tests.llm.test_decontaminate import direct
from tests.llm.test_near_dup import classes

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    docs = table(spark, SF, "documents")
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    rows = docs.collect()
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in rows]
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        rows = docs.collect()
        kept = {r.doc_id: r.text for r in rows}
        if name == "near_duplicates":
            want = classes(before, P.SHINGLE_WORDS)
            assert set(kept) == {d for d, c in want.items() if c == d}
        if name == "decontamination":
            for d, t in before:
                n, hit, _ = direct(t, items)
                if not hit:
                    assert kept[d] == t
                elif len(hit) > decontaminate.MAX_COVERAGE * n:
                    assert d not in kept
                else:
                    assert d not in kept or not direct(kept[d], items)[1]
        if name == "language":  # no document with a letter goes
            assert {d for d, t in before if any(c.isalpha() for c in t)} == set(kept)
    name, stage = P.STAGES[-1]
    pieces = stage(spark, docs, SF).collect()
    totals = {}
    for p in pieces:
        totals[p.doc_id] = totals.get(p.doc_id, 0) + p.length
    words = packing.memo(packing.tokenizer_path())
    assert totals == {d: len(words.ids(t)) + 1 for d, t in kept.items()}
    assert labels


def test_run_equals_the_stages(spark):
    docs = table(spark, SF, "documents")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    whole = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    by_doc = lambda df: {d: n for d, n in df.groupBy("doc_id").agg({"length": "sum"}).collect()}
    run = P.run(spark, SF)
    assert by_doc(run) == by_doc(docs) and len(whole(run)) > 0


def test_edge_rows_pass_every_stage(spark, documents, edge_rows):
    docs = documents(edge_rows, CLASHES)
    columns = docs.columns
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
    kept = [r.doc_id for r in docs.collect()]
    assert 6 not in kept or kept.count(6) == 1
    assert not {1, 2, 3} & set(kept)  # no letter
    empty = documents([], CLASHES)
    for _, stage in P.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.collect() == []


def test_the_language_stage_rejects_what_is_no_language(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    r = random.Random(5)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(2, 10)))
    odd = [(900_000 + i, " ".join(word(letters) for _ in range(n))) for i, (letters, n) in enumerate(
        [(a, n) for a in ("abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхц", "abcXYZ0189#$%") for n in (20, 60, 400) for _ in range(10)])]
    odd += [(990_000, "Nopea ruskea kettu hyppää laiskan koiran yli ja juoksee metsän läpi kotiin. " * 4), (990_001, "... 123 ..."), (990_002, None)]
    more = spark.createDataFrame([(d, t, None, "x", 0) for d, t in odd], docs.schema)
    kept = {x.doc_id for x in P.keep_known_language(spark, docs.unionByName(more), SF).collect()}
    assert not kept & {d for d, _ in odd}
    assert kept == {x.doc_id for x in docs.collect() if x.text and any(map(str.isalpha, x.text))}


def test_of_repeated_rows_the_same_one_stays(spark, documents):
    rows = [(1, "a b c d e f"), (1, "z y x w v u"), (1, "a b c d e f"), (2, "some other words are here today"), (3, "Some other words are here today"), (None, "q"), (None, "q")]
    kept = lambda df: sorted(((x.doc_id, x.text) for x in P.drop_near_duplicates(spark, df, SF).collect()), key=str)
    first = kept(documents(rows, CLASHES))
    assert [d for d, _ in first] == [1, 2, None, None]
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        assert kept(documents(rows, CLASHES).repartition(5)) == first
