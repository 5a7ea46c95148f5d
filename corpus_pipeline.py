"""Corpus pipeline: toxicity, language, near duplicates, benchmark passages, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and read again
as the next one's documents. All stages but the last return the columns of documents; the last
returns the packed pieces.

A stage works on whatever its predecessor kept: extra columns are carried along, an empty table
stays empty, null texts count as empty ones (and go at the language stage, which finds no letter),
and rows without doc_id are judged by their text but never grouped as duplicates. Repeated rows of
one document are one document at the near-duplicate stage, which keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import decontaminate as leaks
from hearth.llm import langid, near_dup, packing, toxicity
from hearth.llm.common import col, free, materialize, table
from hearth.operators.joins import size_checked_broadcast

#: A text of at least so many characters with a language score below this is rejected, like one
#: without a letter. Held-out documents score 0.36 and more, random letters 0.30 and less (README); a
#: shorter text holds too few n-grams to tell.
LEAST_LANGUAGE_SCORE = 0.3
LEAST_LANGUAGE_CHARS = 20
#: Text tokenized at once and cuts remembered at the packing stage: less than where packing is alone,
#: as executors' heaps are at their largest after the stages before.
PACKED_BYTES, PACKED_CUTS = 2 << 20, 150_000
#: Words of a shingle at the near-duplicate stage (similarity 0.8 or more).
SHINGLE_WORDS = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels`` of this corpus, does not find toxic."""
    net = toxicity.fit_documents(docs, table(spark, sf_dir, "labels"))
    told = toxicity.classify(docs, net, carry=docs.columns)
    return told.where(F.col(free(docs.columns, "predicted")) == 0).select(*[col(c) for c in docs.columns])


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus teaches: random letters and other languages go."""
    told = langid.identify(docs, langid.fit_documents(docs), carry=docs.columns)
    known = F.col(free(docs.columns, "lang_pred")) != langid.UNKNOWN
    told_apart = (F.col(free(docs.columns, "score")) >= LEAST_LANGUAGE_SCORE) | (F.length(col("text")) < LEAST_LANGUAGE_CHARS)
    return told.where(known & told_apart).select(*[col(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest doc_id.

    What goes is decided on ids and written; the documents meet it in one pass, map-side while the
    ids are within the limit for broadcasts. Of several rows of one doc_id the one with the smallest
    digest stays (in a further pass over such rows alone)."""
    found = near_dup.near_duplicates(docs, SHINGLE_WORDS)
    gone = materialize(found.where("NOT kept").select("doc_id").distinct(), "repeats")
    own = [col(c) for c in docs.columns]
    left = docs.join(size_checked_broadcast(gone, gone.count()), "doc_id", "left_anti").select(*own)
    several = materialize(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "several")
    n = several.count()
    if not n:
        return left
    several = size_checked_broadcast(several, n)
    # equal digests are equal rows but for columns other than the text: the smallest of these
    digest = F.xxhash64(*[col(c).cast("string") for c in docs.columns])
    row = F.min_by(F.struct(*own), F.struct(F.sha2(F.coalesce(col("text"), F.lit("")), 256), digest))
    one = left.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(row.alias("r")).select("r.*").select(*own)
    return left.join(several, "doc_id", "left_anti").select(*own).unionByName(one)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages: passages are cut, and a document goes if more than
    ``MAX_COVERAGE`` of its words are such passages."""
    return leaks.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack_documents(docs, packing.tokenizer_path(), group_bytes=PACKED_BYTES, remembered=PACKED_CUTS)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_known_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("packing", pack),
]

#: The classifiers and the tokenizer have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
