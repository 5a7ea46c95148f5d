"""Quality rules by distribution divergence.

Each document's histograms over character classes and over common words are compared, by
Jensen-Shannon distance (base 2, so 0 to 1), with those of its language: the sums over all documents
that carry the same ``lang``. A document too far from its language is rejected; guards leave texts
alone that are too short for their histogram to mean anything, and texts without a known language.
Base rules (too few words, too much repetition) come first. Only built-in column functions are used;
everything about one document is computed inside its row, so nothing but per-language sums is
shuffled.

Edge cases: a null text has no words and fails the base rules; a null lang or a language without a
single word has no reference, so only the base rules decide; repeated rows are rows of their own; a
null doc_id is an ordinary row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import materialize, table

# The commonest words of English, German, French and Spanish.
COMMON_WORDS: tuple[str, ...] = tuple("""
the of and to in is that it for was on are as with at be this by from or have not an
der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es an
de la le et les des en un du une que est pour qui dans par plus pas au sur avec
que el en y los se del las por con no una su al lo para como más
""".split())

#: Greatest distance from the language's histogram that is kept.
MAX_CHAR_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.75
#: Shorter texts are not compared (characters; words).
MIN_CHARS = 200
MIN_WORDS = 100
#: Base rules.
BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PERCENT = 50

#: Languages whose references are broadcast; more are joined by shuffle.
MAX_BROADCAST_LANGS = 10_000

_SPACE = r"[\\x20\\x09-\\x0D]+"
CLASSES = ("lower", "upper", "digit", "space", "mark", "beyond")


def features(docs: DataFrame) -> DataFrame:
    """Base counts, character-class counts and common-word counts (``runs``) of every document."""
    listed = ", ".join(f"'{w}'" for w in sorted(set(COMMON_WORDS)))
    gone = lambda pattern: f"length(regexp_replace(text, '{pattern}', ''))"
    d = docs.selectExpr("doc_id", "cast(lang as string) AS lang", "coalesce(text, '') AS text")
    d = d.selectExpr("doc_id", "lang", "text", f"filter(split(text, '{_SPACE}'), x -> x <> '') AS w",
                     r"filter(split(text, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]') AS lines")
    d = d.selectExpr(
        "doc_id", "lang", "w", "size(w) AS n", "length(text) AS chars",
        f"{gone('[a-z]+')} AS not_lower", f"{gone('[A-Z]+')} AS not_upper", f"{gone('[0-9]+')} AS not_digit",
        f"{gone(_SPACE)} AS not_space", rf"{gone(r'[\\x00-\\x7F]+')} AS beyond", f"{gone('[^#*$%&|<>]+')} AS symbols",
        "size(lines) - size(array_distinct(lines)) AS dup_lines")
    d = d.selectExpr(
        "* EXCEPT (w)",
        # 3-word windows by hash, sorted: a window found twice has an equal neighbour
        "sort_array(if(n < 3, array(), transform(sequence(0, greatest(n, 3) - 3), "
        "i -> named_struct('h', xxhash64(get(w, i), get(w, i + 1), get(w, i + 2)), 'p', i)))) AS s",
        f"sort_array(filter(w, x -> x IN ({listed}))) AS c")
    d = d.selectExpr(
        "* EXCEPT (s)",
        "sort_array(transform(filter(s, (x, i) -> coalesce(get(s, i - 1).h = x.h, false) OR coalesce(get(s, i + 1).h = x.h, false)), "
        "x -> x.p)) AS p",
        "filter(transform(c, (x, i) -> if(i = 0 OR get(c, i - 1) <> x, i, -1)), i -> i >= 0) AS st")
    return d.selectExpr(
        "doc_id", "lang", "cast(n AS bigint) AS n_words", "cast(not_space AS bigint) AS word_chars",
        "cast(symbols AS bigint) AS n_symbols", "cast(dup_lines AS bigint) AS n_dup_lines",
        # words covered by repeated windows: 3 for the first, then what each adds
        "cast(aggregate(transform(p, (x, i) -> if(i = 0, 3, least(3, x - get(p, i - 1)))), 0, (a, b) -> a + b) AS bigint) AS n_repeat_words",
        "chars", "chars - not_lower AS lower", "chars - not_upper AS upper", "chars - not_digit AS digit",
        "chars - not_space AS space",
        "chars - (chars - not_lower) - (chars - not_upper) - (chars - not_digit) - (chars - not_space) - beyond AS mark",
        "beyond",
        "transform(st, (i, k) -> named_struct('word', get(c, i), 'n', coalesce(get(st, k + 1), size(c)) - i)) AS runs")


def references(found: DataFrame) -> DataFrame:
    """Per language, the histograms of all its documents: one row with the class counts, the word
    count and the share of each common word."""
    known = found.where("lang IS NOT NULL")
    classes = known.groupBy("lang").agg(*[F.sum(c).alias(f"r_{c}") for c in CLASSES], F.sum("chars").alias("r_chars"),
                                        F.sum("n_words").alias("r_words"))
    words = (known.select("lang", F.explode("runs").alias("r")).groupBy("lang", "r.word").agg(F.sum("r.n").alias("n"))
             .groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("r_counts"),
                                  F.sum("n").alias("r_listed")))
    return classes.join(words, "lang", "left").where("r_words > 0").selectExpr(
        "lang AS r_lang", "* EXCEPT (lang, r_counts, r_listed)", "coalesce(r_counts, map()) AS r_counts",
        "coalesce(r_listed, 0L) AS r_listed")


def _term(p: str, q: str) -> str:
    """One histogram cell's part of twice the divergence, in bits."""
    return (f"(if({p} > 0, {p} * log2(2 * {p} / ({p} + {q})), 0D) + if({q} > 0, {q} * log2(2 * {q} / ({p} + {q})), 0D))")


def judge(found: DataFrame, refs: DataFrame) -> DataFrame:
    """Verdicts of documents against the references of their languages."""
    small = refs.count() <= MAX_BROADCAST_LANGS
    d = found.join(F.broadcast(refs) if small else refs, F.col("lang") == F.col("r_lang"), "left")
    char = " + ".join(_term(f"({c} / cast(chars AS double))", f"(r_{c} / cast(r_chars AS double))") for c in CLASSES)
    q = "(coalesce(r_counts[r.word], 0L) / cast(r_words AS double))"
    d = d.selectExpr(
        "*", f"if(chars > 0 AND r_chars > 0, {char}, NULL) AS char_sum",
        "aggregate(runs, 0L, (a, r) -> a + r.n) AS listed",
        "aggregate(runs, 0L, (a, r) -> a + coalesce(r_counts[r.word], 0L)) AS seen",
        f"aggregate(runs, 0D, (a, r) -> a + {_term('(r.n / cast(n_words AS double))', q)}) AS word_part")
    rest = _term("((n_words - listed) / cast(n_words AS double))", "((r_words - r_listed) / cast(r_words AS double))")
    d = d.selectExpr(
        "*", f"if(n_words > 0 AND r_words > 0, word_part + {rest} + (r_listed - seen) / cast(r_words AS double), NULL) AS word_sum")
    distance = lambda s: f"round(sqrt(greatest(0D, least(1D, {s} / 2))), 4)"
    d = d.selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        f"n_words < {BASE_MIN_WORDS} OR 100 * n_repeat_words > {BASE_MAX_REPEAT_PERCENT} * n_words AS base_failed",
        f"if(chars >= {MIN_CHARS}, {distance('char_sum')}, NULL) AS char_distance",
        f"if(n_words >= {MIN_WORDS}, {distance('word_sum')}, NULL) AS word_distance")
    return d.withColumn("kept", F.expr(
        f"NOT base_failed AND coalesce(char_distance <= {MAX_CHAR_DISTANCE}, true) "
        f"AND coalesce(word_distance <= {MAX_WORD_DISTANCE}, true)"))


def quality(docs: DataFrame) -> DataFrame:
    """Counts, distances and verdict of every document. Its features are written once: the
    references are sums over them, and the verdicts read them again."""
    found = materialize(features(docs), "quality")
    return judge(found, materialize(references(found), "quality-refs"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def oracle_sql() -> str:
    listed = ", ".join(f"'{w}'" for w in sorted(set(COMMON_WORDS)))
    gone = lambda pattern: f"length(regexp_replace(text, '{pattern}', '', 'g'))"
    space = r"[\x20\x09-\x0D]+"
    term = lambda p, q: (f"(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END"  # noqa: E731
                         f" + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END)")
    char = " + ".join(term(f"(f.{c} / f.chars::DOUBLE)", f"(g.{c} / g.chars::DOUBLE)") for c in CLASSES)
    dist = lambda s: f"round(sqrt(greatest(0, least(1, ({s}) / 2))), 4)"
    sums = ", ".join(f"sum({c}) AS {c}" for c in (*CLASSES, "chars", "n_words"))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{space}'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
f0 AS (SELECT r, doc_id, lang, w, len(w)::BIGINT AS n_words, length(text) AS chars,
    length(text) - {gone('[a-z]+')} AS lower, length(text) - {gone('[A-Z]+')} AS upper,
    length(text) - {gone('[0-9]+')} AS digit, length(text) - {gone(space)} AS space,
    {gone(r'[\x00-\x7F]+')} AS beyond, {gone('[^#*$%&|<>]+')}::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines FROM w),
f AS (SELECT *, chars - lower - upper - digit - space - beyond AS mark, (chars - space)::BIGINT AS word_chars FROM f0),
win AS (SELECT r, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS x
    FROM (SELECT r, w, unnest(range(1, greatest(n_words - 1, 1))) AS p FROM f)),
rep AS (SELECT r, p FROM win QUALIFY count(*) OVER (PARTITION BY r, x) >= 2),
cover AS (SELECT r, count(DISTINCT q)::BIGINT AS n_repeat_words
    FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM rep) GROUP BY r),
runs AS (SELECT r, any_value(lang) AS lang, word, count(*) AS n
    FROM (SELECT r, lang, unnest(w) AS word FROM f) WHERE word IN ({listed}) GROUP BY r, word),
g AS (SELECT lang, {sums} FROM f WHERE lang IS NOT NULL GROUP BY lang HAVING sum(n_words) > 0),
gw AS (SELECT lang, word, sum(n) AS n FROM runs WHERE lang IS NOT NULL GROUP BY lang, word),
gl AS (SELECT lang, sum(n) AS listed FROM gw GROUP BY lang),
pairs AS (SELECT f.r, f.n_words, g.n_words AS r_words, gw.word, gw.n AS rn, coalesce(runs.n, 0) AS n
    FROM f JOIN g ON f.lang = g.lang JOIN gw ON gw.lang = f.lang
    LEFT JOIN runs ON runs.r = f.r AND runs.word = gw.word WHERE f.n_words > 0),
word AS (SELECT r, sum({term('(n / n_words::DOUBLE)', '(rn / r_words::DOUBLE)')}) AS part, sum(n) AS listed FROM pairs GROUP BY r),
z AS (SELECT f.doc_id, f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, coalesce(c.n_repeat_words, 0) AS n_repeat_words,
    f.n_words < {BASE_MIN_WORDS} OR 100 * coalesce(c.n_repeat_words, 0) > {BASE_MAX_REPEAT_PERCENT} * f.n_words AS base_failed,
    CASE WHEN f.chars >= {MIN_CHARS} AND g.chars > 0 THEN {dist(char)} END AS char_distance,
    CASE WHEN f.n_words >= {MIN_WORDS} AND g.n_words > 0 THEN {dist("coalesce(word.part, 0) + " + term(
        "((f.n_words - coalesce(word.listed, 0)) / f.n_words::DOUBLE)",
        "((g.n_words - coalesce(gl.listed, 0)) / g.n_words::DOUBLE)"))} END AS word_distance
  FROM f LEFT JOIN cover c USING (r) LEFT JOIN g ON g.lang = f.lang LEFT JOIN gl ON gl.lang = f.lang LEFT JOIN word ON word.r = f.r)
SELECT *, NOT base_failed AND coalesce(char_distance <= {MAX_CHAR_DISTANCE}, true)
  AND coalesce(word_distance <= {MAX_WORD_DISTANCE}, true) AS kept
FROM z
"""
