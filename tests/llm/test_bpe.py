"""Byte-level BPE against the tiktoken library on whole texts."""

from __future__ import annotations

import hashlib

import duckdb
import public_tokenizers as tokenizers
import pytest
import tiktoken

from hearth.llm import bpe
from hearth.llm.queries import QUERIES
from tests.llm.conftest import CLASHES

SF = "/root/testdata/sf0.001"
PATH = tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={})


def test_query_equals_the_library(spark, library):
    got = {r.doc_id: r for r in QUERIES["op11_bpe_words"](spark, SF).collect()}
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert len(rows) == len(got)
    for doc, text in rows:
        ids = library.encode_ordinary(text or "")
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("block", [bpe.BLOCK_BYTES, 40])
def test_edge_rows(spark, documents, edge_rows, library, block):
    odd = ["  two  spaces ", "tab\t\ttab \n\n line\r\n", "it's we'll '' 's", " \x1c \x1d x\x85y  z  q", "½ ² १२ abc123 \U0001f642 é",
           "<|endoftext|> <|endoftext|>", "᠎ ﻿ mixed​width", " ", "\n", "x" * 200]
    rows = [*edge_rows, *[(100 + i, t) for i, t in enumerate(odd)]]
    if block < 1000:  # every row a block of its own
        rows = [r for r in rows if len(r[1] or "") < 1000]
    docs = documents(rows, [*CLASHES, "1 AS ids", "2 AS pre_tokens", "3 AS token", "4 AS bytes", "5 AS step"]).repartition(3)
    keep = ["doc_id", "ids", "pre_tokens", "token", "bytes", "step", "text"]
    encoded = bpe.encode(docs, PATH, tokenizers.PATTERN, carry=keep, block_bytes=block)
    assert encoded.columns == [*keep, "_ids"]
    decoded = bpe.decode(encoded, bpe.token_bytes(spark, PATH), ids="_ids", carry=[*keep, "_ids"]).collect()
    key = lambda t: (t[0] is None, t[0] or 0, t[1] is None, t[1] or "")
    assert sorted([(r.doc_id, r.text) for r in decoded], key=key) == sorted(rows, key=key)
    for r in decoded:
        assert (r.ids, r.pre_tokens, r.token, r.bytes, r.step) == (1, 2, 3, 4, 5)
        assert r["_ids"] == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_empty_table(spark, documents):
    assert bpe.encode(documents([]), PATH, tokenizers.PATTERN).collect() == []
    none = spark.createDataFrame([], "doc_id bigint, ids array<int>")
    assert bpe.decode(none, bpe.token_bytes(spark, PATH)).collect() == []


def test_decoding_of_null_and_unknown_ids(spark, monkeypatch):
    monkeypatch.setattr(bpe, "GROUP_IDS", 3)  # several groups in a partition
    rows = spark.createDataFrame([(1, None), (2, []), (3, [1, 2, 99_999]), (4, [1, None]), (5, [64, 65] * 5), (6, [64])],
                                 "doc_id bigint, ids array<int>").coalesce(1)
    known = {i: b for b, i in bpe.ranks(PATH).items()}
    got = {r.doc_id: r.decoded for r in bpe.decode(rows, bpe.token_bytes(spark, PATH)).collect()}
    assert got[1] is got[3] is got[4] is None
    assert (bytes(got[2]), bytes(got[5]), bytes(got[6])) == (b"", (known[64] + known[65]) * 5, known[64])


def test_texts_are_not_shuffled_and_words_are_encoded_once(spark, documents):
    docs = documents([(i, f"some words {i % 7}") for i in range(50)]).repartition(4)
    plan = bpe.encode(docs, PATH, tokenizers.PATTERN)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if " Exchange " in line or "- Exchange" in line]
    assert len(shuffles) == 2 and "word" in shuffles[1] and "Bucketed: true" in plan
