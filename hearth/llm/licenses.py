"""License scan by canonical digest.

A text is brought to a canonical form - case folded, copyright lines and "all rights reserved"
dropped, punctuation and white space collapsed, equivalent spellings replaced - and its SHA-256 is
hash-joined to the digests of known license texts. Each document is looked up as a whole, however its
lines are wrapped, and each of its lines as a text of its own, so that a license file, and a notice
line inside a longer document, are both found. A license text followed by other paragraphs is
neither. Only built-in column functions are used.

A line is a copyright line if it begins with the sign, or with "copyright" or "(c)" and a year, a year to
be filled in, a holder after "by" or another such mark follows at once; a wrapped line that begins
with "copyright holders" stays.

Edge cases: a null or blank text or line has no digest and no license; repeated rows give a row
each; a null doc_id is an ordinary row; an empty table gives an empty result; other columns are
ignored. The catalogue may hold any number of texts; several may name one license.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import table

# License texts and notices as their authors publish them, without copyright lines.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

#: (license id, text): whole licenses, file headers and one-line notices.
KNOWN: tuple[tuple[str, str], ...] = (
    ("MIT", _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("BSD-2-Clause", _BSD_TERMS + _BSD_END),
    ("BSD-3-Clause", _BSD_TERMS + _BSD_THIRD + _BSD_END),
    ("Apache-2.0", _APACHE_HEADER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)

# Fixed values.
#: (license id, SHA-256 of the canonical form): whole texts as published, with their preambles and appendices.
KNOWN_DIGESTS: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0", "98db0b473e0a45a62b04a39b6b864b4e079a58d513e2196f94fe7252fa8574a6"),
    ("GPL-2.0", "e95eb1718f9f373d56cc586a5f7d1bfa11668867f6e85e982d2b6108b97d90a1"),
    ("GPL-3.0", "5e06bcb7b8c914d3ffb433229937b503a624ae6c7bb9ac1cad01e35a324bcb6d"),
    ("LGPL-2.0", "e4deecd0730802431ad09f00ae3793f3703c8e4dba639586545d9f958405614d"),
    ("LGPL-2.1", "d3826e4e563a04a354453ff139a32b19d6c3fe283f518eb566107c54e18cd01f"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6"),
    ("MPL-2.0", "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
)

# Spellings taken as equal, replaced in this order; first those inside a word.
WORD_SPELLINGS: tuple[tuple[str, str], ...] = (
    ("licence", "license"), ("licencing", "licensing"), ("isation", "ization"), ("authoris", "authoriz"),
    ("favour", "favor"), ("labour", "labor"), ("whilst", "while"), ("https", "http"), ("programme", "program"),
)
SPELLINGS: tuple[tuple[str, str], ...] = (
    ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
    ("per cent", "percent"), ("copyright owner", "copyright holder"), ("all rights reserved ", ""),
)
#: Punctuation outside ASCII that counts as white space.
_MARKS = " «»‐‑‒–—‘’“”•…©"
_YEAR = r"([0-9]{4}|\[?yyyy|<year>|\[year)"
_COPYRIGHT = (rf"(^|\n)[^a-z0-9\n]*(copyright[^a-z0-9\n]*(\(c\)|©|{_YEAR}|by )"
              rf"|©|\(c\)[^a-z0-9\n]*(copyright|{_YEAR}|by ))[^\n]*")
_PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PUNCTUATION_IN_LINES = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def _spelled(x: Column, spellings: Sequence[tuple[str, str]]) -> Column:
    for a, b in spellings:
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def canonical_lines(text: Column) -> Column:
    """A text whose lines are canonical but for two-word spellings and white space at their ends."""
    x = F.regexp_replace(F.lower(text), _COPYRIGHT, "\n")
    # each mark on its own: a byte search per mark is far cheaper than mapping every character
    for m in _MARKS:
        x = F.replace(x, F.lit(m), F.lit(" "))
    return _spelled(F.regexp_replace(x, _PUNCTUATION_IN_LINES, " "), WORD_SPELLINGS)


def _finished(x: Column) -> Column:
    """The digest of a canonical line, or of all lines with single spaces between; null for nothing."""
    return F.sha2(F.nullif(F.trim(_spelled(F.concat(F.trim(x), F.lit(" ")), SPELLINGS)), F.lit("")), 256)


def whole_digest(lines: Column) -> Column:
    """SHA-256 of the canonical form of a whole text, from its canonical lines."""
    return _finished(F.regexp_replace(lines, "[ \n]+", " "))


def line_digest(line: Column) -> Column:
    """SHA-256 of the canonical form of one of the canonical lines."""
    return _finished(line)


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form of a text; null where that is empty."""
    return whole_digest(canonical_lines(text))


def scan(docs: DataFrame, known: Sequence[tuple[str, str]] = KNOWN,
         known_digests: Sequence[tuple[str, str]] = KNOWN_DIGESTS) -> DataFrame:
    """doc_id, canonical_sha256, license_id (the whole text is that license), notices (ids of lines
    that are a license or notice, sorted, comma-joined) and notice_lines of every document.

    One pass over the texts: a text is made canonical once, line by line; whole text and lines become
    (row, digest) pairs, joined to the catalogue - broadcast: it is a parameter, a few rows - and summed again per row before anything
    is shuffled (a row's pairs are neighbours)."""
    spark = docs.sparkSession
    ids = sorted({i for i, _ in (*known, *known_digests)})
    listed = spark.createDataFrame([(i, ids.index(i), t) for i, t in known], "license string, bit int, text string")
    listed = listed.select("license", "bit", digest(F.col("text")).alias("digest"))
    whole = spark.createDataFrame([(i, ids.index(i), d) for i, d in known_digests], "license string, bit int, digest string")
    # texts with one canonical form: the smallest id names it
    catalogue = listed.unionByName(whole).groupBy("digest").agg(F.min(F.struct("license", "bit")).alias("l")).select(
        "digest", "l.license", "l.bit")
    lined = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), canonical_lines(F.col("text")).alias("lines"))
    units = lined.select("doc_id", "row",
                         F.concat(F.array(F.struct(F.lit(True).alias("whole"), whole_digest(F.col("lines")).alias("digest"))),
                                  F.transform(F.split(F.coalesce(F.col("lines"), F.lit("")), "\n"),
                                              lambda x: F.struct(F.lit(False).alias("whole"), line_digest(x).alias("digest"))),
                                  ).alias("units"))
    units = units.select("doc_id", "row", F.explode("units").alias("u")).select("doc_id", "row", "u.whole", "u.digest")
    found = units.join(F.broadcast(catalogue), "digest", "left")
    line = ~F.col("whole") & F.col("bit").isNotNull()
    masks = [F.bit_or(F.when(line & F.expr(f"bit div 62 = {k}"), F.expr("shiftleft(1L, bit % 62)")))
             for k in range(-(-len(ids) // 62))]
    told = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max(F.when(F.col("whole"), F.col("digest"))).alias("canonical_sha256"),
        F.max(F.when(F.col("whole"), F.col("license"))).alias("license_id"),
        F.sum(line.cast("bigint")).alias("notice_lines"), *[m.alias(f"mask{k}") for k, m in enumerate(masks)])
    names = F.array(*[F.when(F.coalesce(F.col(f"mask{b // 62}"), F.lit(0)).bitwiseAND(1 << (b % 62)) != 0, F.lit(i))
                      for b, i in enumerate(ids)])
    return told.select("doc_id", "canonical_sha256", "license_id", F.concat_ws(",", F.array_compact(names)).alias("notices"),
                       "notice_lines")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql_canonical(x: str) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    x = f"regexp_replace(lower({x}), {quote(_COPYRIGHT)}, chr(10), 'g')"
    x = f"translate({x}, '{_MARKS}', '{' ' * len(_MARKS)}')"
    x = f"trim(regexp_replace({x}, {quote(_PUNCTUATION)}, ' ', 'g')) || ' '"
    for a, b in (*WORD_SPELLINGS, *SPELLINGS):
        x = f"replace({x}, {quote(a)}, {quote(b)})"
    return f"nullif(trim({x}), '')"


def oracle_sql(documents: str = "documents") -> str:
    values = ", ".join("('" + i + "', '" + t.replace("'", "''") + "')" for i, t in KNOWN)
    digests = ", ".join(f"('{i}', '{d}')" for i, d in KNOWN_DIGESTS)
    return f"""
WITH known AS (SELECT license, sha256({_sql_canonical('text')}) AS digest FROM (VALUES {values}) v(license, text)
  UNION ALL SELECT * FROM (VALUES {digests}) w(license, digest)),
catalogue AS (SELECT digest, min(license) AS license FROM known GROUP BY digest),
d AS (SELECT row_number() OVER () AS r, doc_id, text FROM {documents}),
w AS (SELECT r, doc_id, sha256({_sql_canonical('text')}) AS digest FROM d),
l AS (SELECT r, sha256({_sql_canonical('line')}) AS digest
      FROM (SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM d)),
n AS (SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS notice_lines
      FROM l JOIN catalogue USING (digest) GROUP BY r)
SELECT w.doc_id, w.digest AS canonical_sha256, c.license AS license_id, coalesce(n.notices, '') AS notices,
  coalesce(n.notice_lines, 0) AS notice_lines
FROM w LEFT JOIN catalogue c ON c.digest = w.digest LEFT JOIN n ON n.r = w.r
"""
