from __future__ import annotations

import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows, extra=None):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, COLUMNS)
        return df if extra is None else df.selectExpr("*", *extra)

    return make


#: Columns that share names with what operators add.
CLASHES = ["1 AS n", "'x' AS score", "2 AS predicted", "'y' AS lang_pred", "3 AS n_words", "'z' AS first", "4 AS block",
           "5 AS node", "6 AS size", "7 AS digest", "8 AS cleaned", "'k' AS items", "9 AS shard"]


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, a very long one, ties and repeated rows."""
    long = " ".join(f"word{i % 997} x{i}" for i in range(60_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, "one"), (6, "one"), (6, "one"), (7, "one two three four five six"),
            (None, "one two three four five six"), (None, None), (8, "ONE two  three\nfour five six"), (9, "a" * 700_000)]
