"""Importance resampling toward a target: the documents that look most like a target set.

Features are all runs of 1 to ``MAX_RUN`` words, hashed into buckets by CRC-32. Bucket counts of the
documents and of the target give every bucket an integer gain, the scaled logarithm of the ratio of
their smoothed shares, and a document's weight is the sum of its features' gains. With Gumbel noise
from a hash of its id added, the documents with the highest scores are a sample without replacement
in proportion to the weights.

CRC-32 is linear, so the CRC of a run of words follows from those of its words: shifting a CRC past
n bytes is four look-ups in a table for n, made for all features of a batch at once. Nothing but
bucket counts (one row for each bucket and task) is shuffled, and the gains, whose number is a
parameter, go to the tasks as one array.

Scores are written once. The cut is found by halving: exact counts of the rows at or above a score,
15 scores in each job (four halvings), until two neighbouring integers enclose the wanted count;
then the same by id among the rows with the score at the cut. Only the drawn rows are range-partitioned for their
ranks; no task sees more than a partition of them.

Edge cases: a null or empty text has no words, no features and weight 0; documents with fewer than
``least_words`` words are scored but never drawn; a null doc_id is hashed as an empty one and comes
last among equal scores; rows that share doc_id and score are drawn in any order, and no more than
asked for; with an empty target all gains come from the documents alone; an empty table gives an
empty result. Other columns are carried along if the caller names them; a result column whose name
is taken gets underscores in front.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hearth.llm.common import col, free, materialize, table, tidy
from hearth.llm.words import ALNUM, arrow_bytes, groups
from hearth.operators.keys import dense_key

BUCKETS = 10_000
#: Words of the longest feature.
MAX_RUN = 3
#: Scale of gains and noise, and the seed in front of the ids.
SCALE = 1000
SEED = 42
#: Words that a document needs to be drawn, and the share drawn in percent.
LEAST_WORDS = 20
PERCENT = 5
#: Longest word (bytes) whose CRC is shifted by table.
LONGEST = 64
#: Scores whose counts one job finds.
PROBES = 15

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _crc_table() -> np.ndarray:
    """CRC-32 register after one byte, for each low byte of the register."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & np.uint32(1), (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def _shift_tables(longest: int) -> np.ndarray:
    """[n, j * 256 + b]: what byte b at place j of a CRC becomes when n zero bytes follow."""
    out = np.zeros((longest + 1, 1024), np.uint32)
    now = np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])
    for n in range(longest + 1):
        out[n] = now
        now = _CRC[now & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    return out


_SHIFT = _shift_tables(LONGEST + 1)
_SPACE = np.uint32(zlib.crc32(b" "))
_FLAT = _SHIFT.ravel()


def _shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRCs with n[i] <= LONGEST + 1 zero bytes after them: crc(a + b) = shifted(crc(a), len(b)) ^ crc(b)."""
    at = n.astype(np.int64) << 10
    out = _FLAT[at + (crc & np.uint32(0xFF))]
    for j in (1, 2, 3):
        out ^= _FLAT[at + 256 * j + ((crc >> np.uint32(8 * j)) & np.uint32(0xFF))]
    return out


def _spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the word offsets of the rows; no word crosses a row."""
    word = ALNUM[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def _word_crcs(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of every word: byte after byte for all words that are long enough."""
    order = np.argsort(-np.minimum(lengths, LONGEST + 1).astype(np.int8), kind="stable")
    begin, length = starts[order], lengths[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    longer = len(order) - np.searchsorted(length[::-1], np.arange(LONGEST + 1), "right") if len(order) else []
    whole = int(np.searchsorted(-np.minimum(length, LONGEST + 1), -LONGEST, "left"))  # words beyond LONGEST come first
    if whole:
        crc[:whole] = [zlib.crc32(buf[s:s + n].tobytes()) ^ 0xFFFFFFFF for s, n in zip(begin[:whole], length[:whole], strict=True)]
    for k in range(LONGEST):
        m = int(longer[k]) if len(order) else 0
        if m <= whole:
            break
        part = crc[whole:m]
        crc[whole:m] = _CRC[(part ^ buf[begin[whole:m] + k]) & np.uint32(0xFF)] ^ (part >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def feature_buckets(buf: np.ndarray, offsets: np.ndarray, buckets: int, max_run: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Word offsets of the rows, and for each run length the buckets of the features that begin at
    each word (-1 where the row has no such run)."""
    buf = _LOWER[buf]
    starts, ends, rows = _spans(buf, offsets)
    lengths = ends - starts
    words = _word_crcs(buf, starts, lengths)
    left = np.repeat(rows[1:], np.diff(rows)) - np.arange(len(words))  # words from here to the row's end
    short = np.minimum(lengths, LONGEST)
    spaced = _shifted(np.full(len(words), _SPACE, np.uint32), short) ^ words  # CRCs of " " and the word
    long = np.flatnonzero(lengths > LONGEST)
    for i in long.tolist():
        spaced[i] = zlib.crc32(buf[starts[i]:ends[i]].tobytes(), int(_SPACE))
    found, run = [(words % np.uint32(buckets)).astype(np.int64)], words
    for k in range(1, max_run):
        n = len(run) - 1
        if n <= 0:
            found.append(np.full(len(words), -1))
            continue
        # a run and the word after it, which is k words on
        longer = _shifted(run[:n], short[k:k + n] + 1) ^ spaced[k:k + n]
        for i in long[long >= k].tolist():  # the table ends before such a word: go on byte by byte
            longer[i - k] = zlib.crc32(b" " + buf[starts[i]:ends[i]].tobytes(), int(run[i - k]))
        run = longer
        here = np.full(len(words), -1)
        here[:n] = np.where(left[:n] > k, (longer % np.uint32(buckets)).astype(np.int64), -1)
        found.append(here)
    return rows, found


def _each_group(texts: pa.Array, buckets: int, max_run: int) -> Iterator[tuple[int, int, np.ndarray, list[np.ndarray]]]:
    buf, offsets = arrow_bytes(texts)
    for i, j in groups(offsets):
        yield i, j, *feature_buckets(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], buckets, max_run)


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, max_run: int = MAX_RUN) -> DataFrame:
    """(bucket, n): features of all texts by bucket; buckets without features have no row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, _, found in _each_group(b.column(0), buckets, max_run):
                for f in found:
                    total += np.bincount(f[f >= 0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counts = texts.select(col(text).cast("string").alias("text")).mapInArrow(tidy(each), "bucket bigint, n bigint")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS, scale: int = SCALE) -> np.ndarray:
    """Integer gain of every bucket, from the (bucket, n) counts of the documents and the target."""
    s, t = np.zeros(buckets, object), np.zeros(buckets, object)
    for counts, of in ((source, s), (target, t)):
        for r in counts.collect():  # one row for each bucket at most
            of[r.bucket] = r.n
    all_s, all_t = int(sum(s)) + buckets, int(sum(t)) + buckets
    return np.array([math.floor(scale * math.log((float(b + 1) * all_s) / (float(a + 1) * all_t))) for a, b in zip(s, t, strict=True)],
                    np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", carry: Sequence[str] = ("doc_id",),
          max_run: int = MAX_RUN) -> DataFrame:
    """``carry`` and each row's n_words, n_features and weight."""
    source = free(carry, "text")
    made = [free(carry, c) for c in ("n_words", "n_features", "weight")]
    kept = docs.select(*[col(c) for c in carry], col(text).cast("string").alias(source))
    schema = StructType([*kept.drop(source).schema.fields, *[StructField(c, LongType()) for c in made]])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.append(gain, 0)  # [-1]: no feature
        for b in batches:
            out = np.zeros((3, b.num_rows), np.int64)
            for i, j, rows, found in _each_group(b.column(len(carry)), len(gain), max_run):
                words = np.diff(rows)
                out[0, i:j] = words
                out[1, i:j] = sum(np.maximum(words - k, 0) for k in range(max_run))
                total = np.concatenate([[0], np.cumsum(sum(known[f] for f in found))])
                out[2, i:j] = total[rows[1:]] - total[rows[:-1]]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(carry)], *map(pa.array, out)], names=schema.names)

    return kept.mapInArrow(tidy(each), schema)


def noise(doc_id: Column, seed: int = SEED, scale: int = SCALE) -> Column:
    """Integer Gumbel noise from the first 32 bits of a hash of the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0))))


def halve(low: int, high: int, count: Callable[[list[int]], list[int]], least: int) -> tuple[int, int]:
    """The largest x in [low, high) with count(x) >= ``least``, and the count beyond it, for a
    ``count`` that falls as x rises, is enough at ``low`` and too little at ``high``. ``count`` gets several values
    at once: each call halves the interval four times."""
    beyond = count([high])[0]
    while high - low > 1:
        inside = sorted({low + (high - low) * (i + 1) // (PROBES + 1) for i in range(PROBES)} - {low})
        for x, n in zip(inside, count(inside), strict=True):
            if n >= least:
                low = x
            else:
                high, beyond = x, n
                break
    return low, beyond


def _counts(rows: DataFrame, tests: list[Column]) -> list[int]:
    return [int(n or 0) for n in rows.agg(*[F.count_if(t).alias(f"c{i}") for i, t in enumerate(tests)]).first()]


def draw(scored: DataFrame, percent: int = PERCENT, score: str = "score", doc_id: str = "doc_id",
         eligible: Column | None = None, rank: str = "rank") -> DataFrame:
    """``scored`` (a written table: it is read by every count) with the ``rank`` of the highest
    ``percent`` of its eligible rows, ties to smaller ids; null for all other rows."""
    rank, tie, order = free(scored.columns, rank), free(scored.columns, "tie"), free(scored.columns, "order")
    ok = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    narrow = scored.select(col(score).alias("s"), col(doc_id).alias("d"), ok.alias("ok")).where("ok")
    n, low, high, least_id, most_id = narrow.agg(F.count(F.lit(1)), F.min("s"), F.max("s"), F.min("d"), F.max("d")).first()
    wanted = n * percent // 100
    if not wanted:
        return scored.withColumn(rank, F.lit(None).cast("bigint"))
    cut, above = halve(low, high + 1, lambda xs: _counts(narrow, [F.col("s") >= F.lit(x) for x in xs]), wanted)
    tied = narrow.where(F.col("s") == F.lit(cut))
    need = wanted - above
    drawn = col(score) > F.lit(cut)
    if least_id is not None and _counts(tied, [F.col("d").isNotNull()])[0] >= need:
        # from the largest id down, so that the count falls: ids at most -x
        last, _ = halve(-most_id, -least_id + 1, lambda xs: _counts(tied, [F.col("d") <= F.lit(-x) for x in xs]), need)
        drawn = drawn | ((col(score) == F.lit(cut)) & (col(doc_id) <= F.lit(-last)))
    else:
        drawn = drawn | (col(score) == F.lit(cut))
    drawn = F.coalesce(drawn & ok, F.lit(False))
    chosen = scored.where(drawn).withColumns({order: -col(score), tie: F.coalesce(col(doc_id), F.lit((1 << 63) - 1))})
    ranked = dense_key(chosen, [order, tie], rank)
    own = [col(c) for c in scored.columns]
    ranked = ranked.select(*own, F.when(F.col(rank) <= wanted, F.col(rank)).alias(rank))
    return scored.where(~drawn).select(*own, F.lit(None).cast("bigint").alias(rank)).unionByName(ranked)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, text: str = "text",
             doc_id: str = "doc_id", carry: Sequence[str] = (), buckets: int = BUCKETS, max_run: int = MAX_RUN,
             seed: int = SEED, scale: int = SCALE) -> DataFrame:
    """doc_id, the columns ``carry``, n_words, n_features, weight, score and rank of every row."""
    gain = gains(bucket_counts(docs, text, buckets, max_run), bucket_counts(target, text, buckets, max_run), buckets, scale)
    own = [doc_id, *[c for c in carry if c != doc_id]]
    weighed = weigh(docs, gain, text, own, max_run)
    n_words, _, weight = weighed.columns[-3:]
    score = free(weighed.columns, "score")
    scored = materialize(weighed.withColumn(score, col(weight) + noise(col(doc_id), seed, scale)), "scores")
    return draw(scored, percent, score, doc_id, col(n_words) >= least_words)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 is computed byte by byte over the distinct features; the register's table comes from its polynomial.
ORACLE_SQL = """
WITH RECURSIVE steps AS (
  SELECT b::BIGINT AS b, b::BIGINT AS c, 0 AS k FROM range(256) t(b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
texts AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
words AS (SELECT side, id, len(w) AS n_words, w, unnest(range(1, len(w) + 1)) AS i FROM texts),
runs AS (
  SELECT side, id, array_to_string(w[i:i + k - 1], ' ') AS feature
  FROM words, (VALUES (1), (2), (3)) r(k) WHERE i + k - 1 <= n_words),
features AS (SELECT side, id, feature, count(*) AS n FROM runs GROUP BY ALL),
hashes AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(octet_length(f)), lambda p: ('0x' || substr(hex(f), (2 * p + 1)::INT, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature, encode(feature) AS f FROM features), crc),
counts AS (
  SELECT b.bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 'b'), 0) AS t
  FROM range(10000) b(bucket) LEFT JOIN (hashes JOIN features USING (feature)) h ON h.bucket = b.bucket GROUP BY b.bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM counts, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts)),
weights AS (
  SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM features JOIN hashes USING (feature) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
scores AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM (SELECT id AS doc_id, w FROM texts WHERE side = 'd') d LEFT JOIN weights ON id = doc_id),
ranks AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scores LEFT JOIN ranks USING (doc_id)
"""
