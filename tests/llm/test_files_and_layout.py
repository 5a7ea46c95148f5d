"""WARC archives, sharding, packing, license scan, quality rules, chat formatting."""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import random
import textwrap
import zlib

import duckdb
import numpy as np
import pytest

from hearth.llm import chat, licenses, packing, quality, sharding, warc
from hearth.llm.tokens import memo
from hearth.session import new_run_dir
from tests.llm.conftest import CLASHES

TOKENIZER = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


# ------------------------------------------------------------------ WARC
def tricky_pages():
    nested = "x\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nbody\r\n\r\n"
    return [(1, "http://a", "p" * 300), (2, "http://b", "p" * 300), (3, None, None), (4, "u", ""), (5, "u", "é" * 40_000), (6, "v", "é" * 40_000),
            (7, "w", nested * 30), (8, "w", "WARC/1.1\r\n" * 500), (9, "x", "short"), (10, "y", "short"), (None, "z", "p" * 300),
            (11, "bad url\r\nX: y", "\n\r\n\r\n0\r\n\r\n" * 9_000), (12, "q", "q" * 99), (13, "q", "q" * 99), (14, "e", "𝄞" * 20_000)]


def test_archives_give_every_payload_back(spark):
    pages = spark.createDataFrame(tricky_pages(), "page_id bigint, url string, html string").selectExpr("*", *CLASHES).repartition(3)
    path = new_run_dir(spark, "warc-test")
    warc.write_archives(pages, path, segment_bytes=1_000, chunk_bytes=333)
    got = {r.page_id: r for r in warc.read_archives(spark, path).withColumn("page_id", warc._page(warc.F.col("record_id"))).collect()}
    assert len(got) == len(tricky_pages()) and all(r.ok for r in got.values())
    first = {}
    for p, _, html in sorted((t for t in tricky_pages() if t[0] is not None), key=lambda t: t[0]):
        data = (html or "").encode()
        r = got[p]
        whole = len(data) < 100 or first.setdefault(data, p) == p
        assert r.record_type == ("response" if whole else "revisit")
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert bytes(r.payload) == data if whole else r.refers_to == f"urn:page:{first[data]}:{r.payload_digest[:16]}" == got[first[data]].record_id
    assert got[None].record_type == "response"


def test_damaged_segments_are_told(spark):
    pages = spark.createDataFrame([(1, "u", "abc" * 900), (2, "u", "x")], "page_id bigint, url string, html string")
    path = new_run_dir(spark, "warc-test")
    warc.write_archives(pages, path, segment_bytes=500)
    records = warc.read_records(spark, path)
    missing = warc.payloads(warc.reassemble(records.where("segment IS NULL OR segment <> 3"))).collect()
    assert {warc_id.record_id.split(":")[2]: warc_id.ok for warc_id in missing} == {"1": False, "2": True}


def test_no_pages(spark):
    path = new_run_dir(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([], "page_id bigint, url string, html string"), path)
    assert warc.read_archives(spark, path).collect() == []


def test_chunks():
    assert warc.dechunk(warc.chunked("héllo".encode() * 100, 7)) == ("héllo" * 100).encode()
    for bad in (b"", b"5\r\nabc", b"zz\r\n", b"3\r\nabcX\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.dechunk(bad)


def other_record(version, kind, block, extra=(), length=None, end=b"\r\n\r\n", eol=b"\r\n"):
    head = [f"WARC/{version}".encode(), b"WARC-Type: " + kind, b"WARC-Record-ID: <urn:uuid:%d>" % len(extra), *extra,
            b"Content-Length: %d" % (len(block) if length is None else length), b"", b""]
    return eol.join(head) + block + end


def other_archive(version):
    """(type, payload, ok) wanted, and the records of a writer that is not this library's."""
    body = bytes(range(256)) * 9 + b"\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n\xff"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n" + body
    framed = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: Chunked\r\n\r\n" + warc.chunked(body, 100)
    kind = b"Content-Type: application/http; msgtype=response"
    sha1 = b"WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(body).digest())
    wrong = b"WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(b"x").digest())
    records = [
        other_record(version, b"warcinfo", b"software: other\r\nformat: WARC\r\n", [b"Content-Type: application/warc-fields"]),
        other_record(version, b"response", http, [kind, sha1, b"Folded: a\r\n b"]),
        other_record(version, b"response", framed, [kind, sha1]),
        other_record(version, b"response", http, [kind, wrong]),
        other_record(version, b"resource", b"", [b"Content-Type: text/plain"]),
        other_record(version, b"resource", b"\nWARC/", eol=b"\n"),
        other_record(version, b"resource", b"more than stated", length=4),
        other_record(version, b"resource", b"less than stated", length=400, end=b""),
    ]
    want = [("warcinfo", b"software: other\r\nformat: WARC\r\n", True), ("response", body, True), ("response", body, True), ("response", body, False),
            ("resource", b"", True), ("resource", b"\nWARC/", True), ("resource", b"more", True), (None, b" than stated\r\n\r", False),
            ("resource", b"less than stated", False)]
    return want, records


@pytest.mark.parametrize("version", ["0.18", "1.0", "1.1"])
@pytest.mark.parametrize("form", ["plain", "gzip", "members"])
def test_archives_of_other_writers(spark, tmp_path, version, form):
    want, records = other_archive(version)
    data = {"plain": lambda: b"".join(records), "gzip": lambda: gzip.compress(b"".join(records)),
            "members": lambda: b"".join(map(gzip.compress, records))}[form]()
    name = "a.warc" if form == "plain" else "a.warc.gz"
    (tmp_path / name).write_bytes(data)
    key = lambda r: (r[0] or "", r[1], r[2])
    got = [(r.record_type, bytes(r.payload), r.ok) for r in warc.read_archives(spark, str(tmp_path)).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_bytes_outside_records_are_told(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"junk \xff before\r\n" + other_record("1.0", b"resource", b"one"))
    (tmp_path / "b.warc").write_bytes(other_record("1.0", b"resource", b"two") + b"WARC/1.0\r\nWARC-Type: resource")
    (tmp_path / "c.warc").write_bytes(b"")
    got = {(r.record_type, bytes(r.block), r.ok) for r in warc.read_records(spark, str(tmp_path)).collect()}
    assert got == {(None, b"junk \xff before\r", False), ("resource", b"one", True), ("resource", b"two", True),
                   (None, b"WARC/1.0\r\nWARC-Type: resource", False)}


def test_written_records_have_a_date_and_their_own_ids(spark):
    rows = [(1, "u", "p" * 200)] * 3 + [(2, "u", "p" * 200)] * 2 + [(3, "u", "q" * 200), (4, "u", "q" * 200), (5, "u", "short")]
    path = new_run_dir(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3), path, date="2024-05-06T07:08:09Z")
    text = "".join(r.value for r in spark.read.option("wholetext", True).text(path).collect())
    assert text.count("WARC-Date: 2024-05-06T07:08:09Z") == text.count("WARC/1.1") == len(rows)
    got = warc.read_archives(spark, path).collect()
    assert len({r.record_id for r in got}) == len(rows) and all(r.ok for r in got)
    assert sorted(r.record_type for r in got) == ["response"] * 5 + ["revisit"] * 3


def test_segments_are_joined_in_any_number(spark):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + bytes(range(256)) * 4_000
    cut = [block[i:i + 100] for i in range(0, len(block), 100)]
    rows = [("r" if i == 0 else f"r{i}", "response" if i == 0 else "continuation", None, "application/http", None, None,
             None if i == 0 else "r", i + 1, len(block) if i == len(cut) - 1 else None, bytearray(c), True) for i, c in enumerate(cut)]
    random.Random(1).shuffle(rows)
    (r,) = warc.payloads(warc.reassemble(spark.createDataFrame(rows, warc.RECORDS).repartition(4))).collect()
    assert r.ok and bytes(r.payload) == bytes(range(256)) * 4_000


def test_payloads_are_not_shuffled(spark):
    pages = spark.createDataFrame(tricky_pages(), "page_id bigint, url string, html string")
    seen = []
    write = type(pages).mapInArrow
    try:
        type(pages).mapInArrow = lambda self, *a, **b: (seen.append(self), write(self, *a, **b))[1]
        warc.write_archives(pages, new_run_dir(spark, "warc-test"))
    finally:
        type(pages).mapInArrow = write
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


# ------------------------------------------------------------------ sharding
def test_balanced_tree_is_the_tightest_fit():
    r = random.Random(2)
    tree, plain = sharding.CapacityTree(), []
    for i in range(600):
        if r.random() < 0.6 or not plain:
            key = (r.randint(0, 50), i)
            tree.put(key)
            plain.append(key)
        else:
            need = r.randint(0, 55)
            want = min((k for k in plain if k[0] >= need), default=None)
            assert tree.take(need) == want
            if want:
                plain.remove(want)


def test_best_fit_decreasing():
    assert sharding.best_fit_decreasing([5, 7, 5, 2, 4, 2, 5], 10) == [1, 0, 1, 0, 2, 3, 2]
    assert sharding.best_fit_decreasing([5, 7], 6, 1) is None
    assert len(set(sharding.fewest_capacity([3] * 40, 10))) == 10


def test_shards_are_even_gapless_and_keep_groups(spark, documents):
    r = random.Random(4)
    rows = [(i, f"text {r.randrange(1500)} " + "y" * r.randrange(60)) for i in range(4000)] + [(5000 + i, "same") for i in range(150)]
    got = sharding.shard_documents(documents(rows, CLASHES), 10).collect()
    assert sorted(x.doc_id for x in got) == sorted(d for d, _ in rows)
    by, group = {}, {}
    text = dict(rows)
    for x in got:
        assert x.size == len(text[x.doc_id].encode()) + 16 and x.text_crc32 == zlib.crc32(text[x.doc_id].encode())
        by.setdefault(x.shard, []).append(x)
        assert group.setdefault(text[x.doc_id], x.shard) == x.shard
    sizes = [sum(x.size for x in s) for s in by.values()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) < 0.02 * max(sizes)
    assert all(sorted(x.slot for x in s) == list(range(len(s))) for s in by.values())


def test_capacity_and_edge_rows(spark, documents, edge_rows, monkeypatch):
    monkeypatch.setattr(sharding, "UNIT_ROWS", 2)
    monkeypatch.setattr(sharding, "BUCKET_GROUPS", 3)
    got = sharding.shard_documents(documents(edge_rows), 3).collect()
    assert len(got) == len(edge_rows)
    for s in {x.shard for x in got}:
        assert sorted(x.slot for x in got if x.shard == s) == list(range(sum(x.shard == s for x in got)))
    assert sharding.shard_documents(documents([]), 3).collect() == []
    rows = spark.createDataFrame([(i, f"g{i % 50}", 10) for i in range(500)], "doc_id bigint, group_key string, size bigint")
    packed = sharding.shard_by_size(rows, capacity=1000).collect()
    used = {}
    for x in packed:
        used[x.shard] = used.get(x.shard, 0) + x.size
    assert len(used) == 5 and max(used.values()) <= 1000


# ------------------------------------------------------------------ packing
def test_differencing_keeps_every_item():
    r = random.Random(1)
    for n, k in ((1, 1), (5, 3), (40, 7), (200, 30)):
        sizes = [r.randint(1, 900) for _ in range(n)]
        windows = packing.difference(sizes, k)
        assert len(windows) <= k and sorted(i for _, w in windows for i in w) == list(range(n))
        assert all(s == sum(sizes[i] for i in w) for s, w in windows)
    even = packing.difference([8, 7, 6, 5, 4], 2)
    assert sorted(s for s, _ in even) == [14, 16]  # the classical example
    assert all(sum([9, 9, 9][i] for i in w) <= 10 for w in packing.pack([9, 9, 9], 10))


def test_pieces_hold_every_token_once(spark, documents, edge_rows):
    r = random.Random(8)
    rows = [*[(d, t) for d, t in edge_rows if d is not None and d != 6], (6, "one")] + [
        (100 + i, " ".join(r.choice(["alpha", "beta,", "Gamma.", "δέλτα", "\n", "42"]) for _ in range(r.randrange(900)))) for i in range(300)]
    got = packing.pack_documents(documents(rows, CLASHES).repartition(4), TOKENIZER, ids=True).collect()
    tokenizer = memo(TOKENIZER).tokenizer
    by, seq = {}, {}
    for p in got:
        by.setdefault(p.doc_id, []).append(p)
        seq.setdefault(p.sequence_id, []).append(p)
    assert set(by) == {d for d, _ in rows}
    for d, text in rows:
        own = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        pieces = sorted(by[d], key=lambda p: p.start)
        assert [t for p in pieces for t in p["ids"]] == own
        assert all(p.doc_tokens == len(own) and p.length == len(p["ids"]) for p in pieces)
        assert all(p.ids_crc32 == zlib.crc32(np.array(p["ids"], "<u4").tobytes()) for p in pieces)
    for s in seq.values():
        s.sort(key=lambda p: p.offset)
        assert [p.offset for p in s] == np.cumsum([0, *[p.length for p in s[:-1]]]).tolist()
        assert sum(p.length for p in s) <= packing.CAPACITY
    assert sum(p.length for p in got) / (len(seq) * packing.CAPACITY) > 0.95
    assert packing.pack_documents(documents([]), TOKENIZER).collect() == []


def test_ids_equal_the_tokenizer_on_odd_texts():
    r = random.Random(3)
    letters = [" ", " ", "\n", "a", "B", "b'", "'s", "'ll", "1", "é", ".", ",", "\t", "日", " ", "́", "<|endoftext|>", "ǅ", "Ⅷ", "²"]
    words = memo(TOKENIZER)
    for text in ["", " ", "  a", "a  ", "don't 'S x' s", " \n x", *["".join(r.choices(letters, k=r.randint(1, 30))) for _ in range(3000)]]:
        assert words.ids(text).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


# ------------------------------------------------------------------ licenses and quality (against DuckDB)
def against_duckdb(docs_df, got, sql):
    con = duckdb.connect()
    con.register("documents", docs_df.toArrow())
    cols = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
    key = lambda t: tuple((v is None, str(v)) for v in t)
    have = sorted((tuple(r) for r in got.select(*cols).collect()), key=key)
    assert [key(t) for t in have] == sorted(map(key, want))


def test_licenses_are_found_in_any_dress(spark, documents, edge_rows):
    mit = dict((i, t) for i, t in licenses.KNOWN if i == "MIT" and len(t) > 500)["MIT"]
    rows = [(20, "Copyright (c) 2020 A. Person\nCopyright 2021 B. Person <b@x.org>\n\n" + mit.upper()),
            (21, "Some words.\n  LICENCED... under CC BY-NC 4.0 \nReleased under the MIT Licence!\n© 2024 someone"),
            (22, mit + " and more"), (23, "“Licensed under CC BY 4.0”"), (24, "licence licence")]
    docs = documents([*rows, *edge_rows], CLASHES)
    got = licenses.scan(docs)
    by = {r.doc_id: r for r in got.collect()}
    assert by[20].license_id == "MIT" and by[22].license_id is None and by[23].license_id == "CC-BY-4.0"
    assert by[21].notices == "CC-BY-NC-4.0,MIT" and by[21].notice_lines == 2
    assert by[1].canonical_sha256 is None and by[3].canonical_sha256 is None
    against_duckdb(docs, got, licenses.oracle_sql())
    assert licenses.scan(documents([])).collect() == []


COMMON = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0",
          "MPL-2.0": "MPL-2.0", "Artistic": "Artistic-1.0-Perl", "GFDL-1.3": "GFDL-1.3"}


def wrapped(text, width, indent=""):
    return "\n\n".join(textwrap.fill(" ".join(p.split()), width, initial_indent=indent, subsequent_indent=indent) for p in text.split("\n\n"))


def test_licenses_are_found_however_they_are_wrapped(documents):
    whole = [(i, t) for i, t in licenses.KNOWN if len(t) > 600 and i in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause")]
    head = ["", "Copyright (c) 2021, A. Holder <a@b.org>\nAll rights reserved.\n\n", "© 1999-2004 Someone.\nAll rights\nreserved.\n", "  Copyright by The Authors\n\n"]
    rows, want = [], {}
    for k, (name, text) in enumerate(whole):
        for width in range(40, 121):
            doc = 1000 * k + width
            rows.append((doc, head[width % 4] + wrapped(text, width, "" if width % 3 else " * ")))
            want[doc] = name
    for k, (file, name) in enumerate(COMMON.items()):
        path = f"/usr/share/common-licenses/{file}"
        if os.path.exists(path):
            text = open(path, encoding="utf-8").read()
            rows += [(90_000 + k, text), (91_000 + k, text.replace("\n", "\r\n"))]
            want |= {90_000 + k: name, 91_000 + k: name}
    docs = documents(rows)
    got = licenses.scan(docs)
    assert {r.doc_id: r.license_id for r in got.collect()} == want
    against_duckdb(docs, got, licenses.oracle_sql())


def test_copyright_lines():
    con = duckdb.connect()
    drop = lambda t: con.execute("SELECT " + licenses._sql_canonical("?::VARCHAR"), [t]).fetchone()[0]
    for line in ("Copyright (c) 2020 X", "copyright 2020 by X", "/* Copyright © X */", "(c) 1999 X", "© X by Y 2000", "Copyright by X", "Copyright [yyyy] [name]",
                 "# Copyright: 2011, X"):
        assert drop(f"a\n{line}\nb") == "a b", line
    for line in ("copyright holders be liable", "Copyright notice and this", "(c) You must retain", "copyright owner or", "the copyright (c) 2020"):
        assert drop(f"a\n{line}\nb") != "a b", line
    assert drop("X. All rights reserved.\nfoo") == drop("x\nfoo") == "x foo" and drop("All rights reserved.") is None


def test_a_catalogue_of_many_licenses(documents):
    known = [(f"L{i:03}", f"license text number {i}") for i in range(150)]
    got = licenses.scan(documents([(1, "License TEXT number 7\nlicense text number 140.\nother"), (2, "license text, number 99")]), known).collect()
    assert {r.doc_id: (r.license_id, r.notices) for r in got} == {1: (None, "L007,L140"), 2: ("L099", "L099")}


def test_quality_equals_sql_on_edge_rows(documents, edge_rows):
    r = random.Random(6)
    common = ["the", "of", "and", "house", "river", "green", "walked", "is", "that"]
    rows = [(30 + i, "\n".join(" ".join(r.choice(common) + r.choice(["", "", f"{r.randrange(500)}"]) for _ in range(30)) for _ in range(8)), "en") for i in range(12)]
    rows += [(60, "### $$$ %%% &&& 123 456 " * 60, "en"), (61, "THE END IS NEAR!! " * 40, "en"), (62, "same line\nsame line\n\nsame line", "fr"),
             (63, "a b c a b c a", None), (64, "x y", "xx")]
    docs = documents([*rows, *edge_rows], CLASHES)
    got = quality.quality(docs)
    by = {x.doc_id: x for x in got.collect()}
    assert by[62].n_dup_lines == 2 and by[63].n_repeat_words == 7 and by[1].base_failed
    assert not by[60].kept
    against_duckdb(docs, got, quality.oracle_sql())
    assert quality.quality(documents([])).collect() == []


# ------------------------------------------------------------------ chat
def naive(turns):
    return "".join(f"<{r}>{t}</{r}>" for r, t in turns)


def with_system_first(turns):
    """Rewrites history: the last user turn is marked."""
    last = max((i for i, t in enumerate(turns) if t[0] == "user"), default=-1)
    return "".join(("LAST " if i == last else "") + f"{r}: {t}\n" for i, (r, t) in enumerate(turns))


def test_spans_of_a_black_box_template():
    turns = [("user", "</assistant>"), ("assistant", "<"), ("user", ""), ("assistant", "</assistant>x")]
    f = chat.format_turns(turns, naive)
    assert f.output == naive(turns) and not f.rewrites_history
    assert [f.output[a:b] for a, b in f.texts] == [t for _, t in turns]
    assert [f.output[a:b] for a, b in f.spans] == [naive([t]) for t in turns]


def test_rewritten_history_is_told():
    turns = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    f = chat.format_turns(turns, with_system_first)
    assert f.rewrites_history and f.output == with_system_first(turns)
    assert [f.output[a:b] for a, b in f.texts] == ["a", "b", "c", "d"]


def test_long_conversations_are_linear_and_equal():
    turns = [("user" if i % 2 == 0 else "assistant", f"text {i} </s>") for i in range(400)]
    f = chat.format_turns(turns)
    assert f.output == chat.inst_template(turns) and chat.parse_inst(f.output) == turns
    assert all(chat.unescape(f.output[a:b]) == t for (a, b), (_, t) in zip(f.texts, turns, strict=True))


def numbered(turns):
    """Looks back to the first turn."""
    return "".join(f"[Round {i // 2 + 1}] {r}: {t}\n" for i, (r, t) in enumerate(turns))


def alternating(turns):
    """Refuses anything but user and assistant in turn after a leading system turn."""
    own = turns[1:] if turns and turns[0][0] == "system" else turns
    if any(r != ("user", "assistant")[i % 2] for i, (r, _) in enumerate(own)):
        raise ValueError("roles must alternate")
    return "".join(f"<{r}>{t}\n" for r, t in turns)


def elided(turns):
    """Rewrites history far back: only the last 90 texts are whole."""
    return "".join(f"<{r}>{t if len(turns) - i <= 90 else t[:1]}\n" for i, (r, t) in enumerate(turns))


@pytest.mark.parametrize("render", [numbered, alternating, elided])
@pytest.mark.parametrize("n", [64, 65, 66, 130, 131])
def test_long_conversations_equal_the_whole_rendering(render, n):
    turns = [("system", "be kind"), *[("user" if i % 2 == 0 else "assistant", f"text {i}") for i in range(n - 1)]]
    f = chat.format_turns(turns, render)
    assert f.output == render(turns)
    assert f.rewrites_history == (render is elided and n > 90)
    for (a, b), (_, text) in zip(f.texts, turns, strict=True):
        assert text.startswith(f.output[a:b]) and (f.rewrites_history or f.output[a:b] == text)
    if not f.rewrites_history:
        assert [f.output[a:b] for a, b in f.spans] == [render(turns[:i + 1])[len(render(turns[:i])):] for i in range(n)]


@pytest.mark.parametrize("seed", range(5))
def test_escaping_is_reversible(seed):
    r = random.Random(seed)
    parts = [*chat.CONTROL, "\\", "\\[INST]", "[", "INST]", "s>", "\n", "é", " "]
    turns = [(r.choice(["user", "assistant", "system", "to\nol</s>", ""]), "".join(r.choices(parts, k=r.randrange(9)))) for _ in range(20)]
    assert chat.parse_inst(chat.inst_template(turns)) == turns


def test_conversations_against_sql(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", "a\\b[INST]"), (None, 0, "user", "x"), (None, None, None, "y"),
            (2, 0, None, "<s>"), (2, 0, None, "<s>"), (3, 5, "assistant", "é" * 5000), (3, 2, "sys\ntem", "")]
    given = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = chat.digests(chat.format_conversations(given.selectExpr("*", *CLASHES)))
    con = duckdb.connect()
    con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = con.sql("SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewrites_history "
                   f"FROM ({chat.ORACLE_SQL}) WHERE conv_id IS DISTINCT FROM -1").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert chat.format_conversations(given.limit(0)).collect() == []


def test_package_is_not_imported_by_the_rest():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "hearth")):
        if "llm" in folder.split(os.sep):
            continue
        for n in names:
            if n.endswith(".py"):
                assert "hearth.llm" not in open(os.path.join(folder, n)).read()


def test_packing_in_little_memory_gives_the_same_pieces(spark, documents):
    from hearth.llm import tokens

    r = random.Random(6)
    word = lambda: "".join(r.choices("abcdefghij", k=r.randrange(2, 6)))
    texts = [None, "", " ", "a \n b"] + [" ".join(word() for _ in range(r.randrange(1, 900))) for _ in range(60)]
    docs = documents(list(enumerate(texts))).coalesce(1)
    pieces = lambda **given: sorted(tuple(p) for p in packing.pack_documents(docs, TOKENIZER, ids=True, **given).collect())
    assert pieces(group_bytes=1 << 10, remembered=50) == pieces()
    small = tokens.WordMemo(TOKENIZER, 50)
    for t in texts[4:]:
        assert small.ids(t).tolist() == small.tokenizer.encode(t, add_special_tokens=False).ids
        assert len(small) <= 50 and len(small.older) <= 50
