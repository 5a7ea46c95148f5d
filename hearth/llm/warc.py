"""WARC archives: writing pages as (segmented, chunk-framed) records and reassembling them.

Writing. Each page becomes one logical record whose block is an HTTP response with chunked
transfer framing. A block longer than ``segment_bytes`` is cut into a first record and
``continuation`` records that carry the origin's id and a segment number; the last one states the
total length. Of pages with equal payloads of at least ``min_revisit_bytes``, the one with the
smallest page_id is written in full (``response``) and the others as ``revisit`` records that name
it. Records go to Spark's text writer (committed per task, so lost executors leave no halves), one
record per row, ended by two line breaks.

Reading. Archives of any writer (any version, plain or gzip, whole files or one member a record)
are streamed as bytes, cut at line breaks before ``WARC/``, and put together by the length that each
record states: a piece that begins inside a block belongs to that block, whatever it looks like. No
task holds a file. Continuations are grouped by origin id, ordered by segment number, joined in one
pass, checked against the stated total length, and the chunked framing is then removed.

Edge cases: a null payload is empty; a null page_id is written as a response of its own and never
referred to; repeated rows are records of their own (page_id ties are all responses; a revisit
then names what its targets share, page and payload); an empty table gives an empty archive and an
empty result; other columns are ignored. Damaged input is told, never dropped: a missing segment, a
wrong total length, a short block, broken framing or a payload that does not have its stated digest
gives a row with ``ok`` false, and bytes that belong to no record (before the first one, behind a
block, or a head without end) are the block of a row without type and with ``ok`` false. A plain file
that Spark reads in several splits is cut at record starts only; there, a payload that itself holds
a whole record head behind a line break, just at the border of two splits, is told as damaged (gzip
files are never split).
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import materialize, scratch, table
from hearth.operators.joins import size_checked_broadcast

#: What starts a record; also where the reader cuts files (behind a line break).
_START = b"WARC/"
_BREAK = b"\r\n\r\n"

#: Bytes of a block in one record; longer blocks are segmented.
SEGMENT_BYTES = 32_768
#: Bytes of payload in one chunk.
CHUNK_BYTES = 8_192
#: Payloads shorter than this are always written in full.
MIN_REVISIT_BYTES = 100

#: Records in one archive file at most.
RECORDS_PER_FILE = 100_000


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in chunked transfer framing, with a chunk boundary inside anything that looks
    like the start of a record."""
    out, at = [], 0
    while at < len(payload):
        end = min(at + size, len(payload))
        start = payload.find(_START, at, end + 1)  # one byte more: a boundary must not come before the mark either
        if start >= 0:
            end = start + len(_START) - 1
        out.append(b"%x\r\n%b\r\n" % (end - at, payload[at:end]))
        at = end
    out.append(b"0\r\n\r\n")
    return b"".join(out)


def dechunk(body: bytes) -> bytes:
    """The payload of a chunk-framed body; ValueError when the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("no chunk size")
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        piece = body[end + 2:end + 2 + size]
        if len(piece) != size or body[end + 2 + size:end + 4 + size] != b"\r\n":
            raise ValueError("short chunk")
        out.append(piece)
        at = end + 4 + size


def _record(kind: str, record_id: str, date: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), *headers,
             ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *[f"{k}: {v}\r\n" for k, v in lines], "\r\n"]).encode() + block


def records_of(record_id: str, url, payload: bytes, digest: str, size: int, refers_to: str | None, date: str,
               segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> list[bytes]:
    """The record, or the segments, of one page."""
    uri = re.sub(r"[\x00-\x20]", "%20", url or "")
    head = [("WARC-Target-URI", uri), ("Content-Type", "application/http;msgtype=response"),
            ("WARC-Payload-Digest", f"sha256:{digest}")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        return [_record("revisit", record_id, date, [
            *head, ("WARC-Refers-To", f"<{refers_to}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")],
            http + b"Content-Length: %d\r\n\r\n" % size)]
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    # chunk-framed blocks hold no record start, so no segment begins with one either
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        return [_record("response", record_id, date, head, block)]
    out = [_record("response", record_id, date, [*head, ("WARC-Segment-Number", "1")], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        more = [("WARC-Segment-Origin-ID", f"<{record_id}>"), ("WARC-Segment-Number", str(n))]
        if n == len(parts):
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(_record("continuation", f"{record_id}:{n}", date, more, part))
    return out


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
                   min_revisit_bytes: int = MIN_REVISIT_BYTES, date: str | None = None) -> None:
    """Write ``pages`` (page_id, url, html) as WARC archives under ``path``; ``date`` (now) is every
    record's WARC-Date.

    Payload digests meet in one aggregation (digest -> smallest page_id) without the payloads. Only
    digests that occur twice are joined back: map-side while their number is within the limit for
    broadcasts, so that no payload is shuffled; beyond it by a join on the digest, whose other side
    has one row for each, so adaptive execution may split a digest that many rows share."""
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    own = own.withColumn("size", F.octet_length("html").cast("bigint")).withColumn("digest", F.sha2("html", 256))
    long = own.where((F.col("size") >= min_revisit_bytes) & F.col("page_id").isNotNull())
    first = (long.groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("digest").agg(F.min(F.struct("page_id", "n")).alias("first"), F.sum("n").alias("n"))
             .where("n > 1").select("digest", F.col("first.page_id").alias("first_id"), F.col("first.n").alias("ties")))
    first = materialize(first, "warc-digests")
    told = own.join(size_checked_broadcast(first, first.count()), "digest", "left")
    refers = F.when((F.col("first_id") != F.col("page_id")) & (F.col("size") >= min_revisit_bytes), F.col("first_id"))
    told = told.withColumn("refers_to", refers)
    mark = F.substring("digest", 1, 16)
    # a response that revisits may name is known by page and payload; all other records are numbered
    named = F.col("refers_to").isNull() & F.col("page_id").isNotNull() & (F.col("size") >= min_revisit_bytes) & (
        F.coalesce("ties", F.lit(1)) == 1)
    number = F.when(~named, F.monotonically_increasing_id().cast("string"))
    told = told.select(
        F.concat_ws(":", F.lit("urn:page"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), mark, number).alias("record_id"),
        "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "digest", "size",
        F.when(F.col("refers_to").isNotNull(), F.concat_ws(":", F.lit("urn:page"), F.col("refers_to"), mark)).alias("refers_to"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[bytes] = []
            for rid, u, h, d, n, r in zip(*[c.to_pylist() for c in b.columns], strict=True):
                out += records_of(rid, u, h or b"", d, n, r, date, segment_bytes, chunk_bytes)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    (told.mapInArrow(render, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", _BREAK.decode()).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


RECORDS = ("record_id string, record_type string, target_uri string, content_type string, payload_digest string, "
           "refers_to string, origin_id string, segment int, total_length bigint, block binary, ok boolean")
_RECORD_COLUMNS = [c.split()[0] for c in RECORDS.split(", ")]
_RECORD_ARROW = pa.schema([(c, {"segment": pa.int32(), "total_length": pa.int64(), "block": pa.binary(), "ok": pa.bool_()}.get(c, pa.string()))
                           for c in _RECORD_COLUMNS])


class _Assembler:
    """Records from the pieces of one file or split, in order: pieces are appended to a record until
    its stated length is reached."""

    def __init__(self):
        self.fields: dict[str, str] | None = None  # of the record that is being read
        self.parts: list[bytes] = []
        self.size = self.need = 0

    def add(self, piece: bytes, first: bool) -> list[tuple]:
        """Rows that are known to be complete once ``piece`` is seen. A piece lacks the line break
        and the mark it was cut at, but for the ``first`` one of a file."""
        if self.fields is not None and self.size < self.need:
            self.parts += [b"\n" + _START, piece]
            self.size += 1 + len(_START) + len(piece)
            return []
        done = self.end()
        if first:
            if not piece.startswith(_START):
                return done + ([_left(piece)] if piece.strip() else [])
            piece = piece[len(_START):]
        found = re.search(rb"\r?\n\r?\n", piece)
        fields = {}
        if found:
            lines = re.sub(rb"\r?\n[ \t]+", b" ", piece[:found.start()]).decode("utf-8", "replace").splitlines()[1:]
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        if not fields.get("content-length", "").isdigit():
            return [*done, _left(_START + piece)]
        self.fields, self.need = fields, int(fields["content-length"])
        self.parts = [piece[found.end():]]
        self.size = len(self.parts[0])
        return done

    def end(self) -> list[tuple]:
        """The record that was being read, and what lies behind its block."""
        if self.fields is None:
            return []
        f, whole = self.fields, b"".join(self.parts)
        self.fields, self.parts = None, []
        bare = lambda k: f[k].strip("<>") if k in f else None
        number = lambda k: int(f[k]) if f.get(k, "").isdigit() else None
        block, rest = whole[:self.need], whole[self.need:]
        row = (bare("warc-record-id"), f.get("warc-type"), bare("warc-target-uri"), f.get("content-type"), f.get("warc-payload-digest"),
               bare("warc-refers-to"), bare("warc-segment-origin-id"), number("warc-segment-number"),
               number("warc-segment-total-length"), block, len(block) == self.need and "warc-record-id" in f)
        return [row, _left(rest)] if rest.strip(b"\r\n") else [row]


def _left(data: bytes) -> tuple:
    """The row of bytes that belong to no record."""
    return (None,) * 9 + (data, False)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``, segments not yet joined."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), _RECORD_ARROW, strict=True)],
                                              schema=_RECORD_ARROW)

        own, at = _Assembler(), None
        for b in batches:
            found: list[tuple] = []
            for value, file, begin in zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if (file, begin) != at:
                    found += own.end()
                new, at = (file, begin) != at, (file, begin)
                found += own.add(value.as_py(), new and not begin)
            if found:
                yield rows(found)
        if last := own.end():
            yield rows(last)

    return (spark.read.option("lineSep", "\n" + _START.decode()).text(path)
            .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("begin")).mapInArrow(parse, RECORDS))


_LOGICAL = ("record_id", "record_type", "target_uri", "content_type", "payload_digest", "refers_to")


def reassemble(records: DataFrame) -> DataFrame:
    """Logical records: continuations grouped by origin id, ordered by segment number, joined and
    checked against the stated total length. Unsegmented records are not shuffled."""
    whole = records.where(F.col("segment").isNull())
    parts = records.where(F.col("segment").isNotNull()).withColumn("origin", F.coalesce("origin_id", "record_id"))
    head = F.when(F.col("segment") == 1, F.struct(*_LOGICAL[1:]))
    joined = parts.groupBy("origin").agg(
        F.max(head).alias("h"), F.expr("listagg(block) WITHIN GROUP (ORDER BY segment)").alias("block"),
        F.array_sort(F.collect_list("segment")).alias("numbers"), F.max("total_length").alias("total"), F.min("ok").alias("fine"))
    fine = (F.col("fine") & F.expr("numbers = sequence(1, size(numbers))")
            & F.coalesce(F.octet_length("block") == F.col("total"), F.lit(False)) & F.col("h").isNotNull())
    joined = joined.select(F.col("origin").alias("record_id"), *[F.col(f"h.{c}").alias(c) for c in _LOGICAL[1:]], "block",
                           F.coalesce(fine, F.lit(False)).alias("ok"))
    return whole.select(*_LOGICAL, "block", "ok").unionByName(joined)


PAYLOADS = ("record_id string, record_type string, target_uri string, refers_to string, payload binary, "
            "payload_bytes bigint, payload_digest string, ok boolean")
_PAYLOAD_ARROW = pa.schema([(c.split()[0], {"binary": pa.binary(), "bigint": pa.int64(), "boolean": pa.bool_()}.get(c.split()[1], pa.string()))
                            for c in PAYLOADS.split(", ")])


def _has_digest(stated: str | None, *data: bytes) -> bool:
    """Whether one of ``data`` has the stated digest ('algorithm:value', the value in hexadecimal or
    base 32); true for none and for unknown algorithms."""
    kind, _, value = (stated or "").partition(":")
    if kind.lower().replace("-", "") not in ("md5", "sha1", "sha256", "sha512"):
        return True
    for d in data:
        got = hashlib.new(kind.lower().replace("-", ""), d)
        if value.lower() == got.hexdigest() or value.upper().rstrip("=") == base64.b32encode(got.digest()).decode().rstrip("="):
            return True
    return False


def _payload(kind, content, stated, block: bytes) -> tuple:
    """(payload, its length, its SHA-256, whether framing and digest hold) of a logical record."""
    if not (content or "").lower().replace(" ", "").startswith("application/http"):
        return block, len(block), hashlib.sha256(block).hexdigest(), _has_digest(stated, block)
    head, _, body = block.partition(_BREAK)
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n"))}
    if kind == "revisit":
        size = fields.get(b"content-length", b"")
        alg, _, value = (stated or "").partition(":")
        return None, int(size) if size.isdigit() else None, value if alg.lower().replace("-", "") == "sha256" else None, True
    data = body
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        try:
            data = dechunk(body)
        except ValueError:
            return body, len(body), hashlib.sha256(body).hexdigest(), False
    digest = hashlib.sha256(data).hexdigest()
    # some writers state the digest of the payload, others of the framed one
    return data, len(data), digest, stated == f"sha256:{digest}" or _has_digest(stated, data, body)


def payloads(logical: DataFrame) -> DataFrame:
    """Payloads of logical records: of HTTP records what lies behind the head, transfer framing
    removed; of others the block. A revisit carries no payload: its length and digest are those its
    headers state (null if they state none). ``ok`` is false where framing, length or digest does not hold."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds, contents, stated, oks = (b.column(c).to_pylist() for c in ("record_type", "content_type", "payload_digest", "ok"))
            got = [_payload(k, c, s, x.as_py() or b"") for k, c, s, x in zip(kinds, contents, stated, b.column("block"), strict=True)]
            data, size, digest, fine = zip(*got, strict=True) if got else ((), (), (), ())
            columns = [*[b.column(c) for c in ("record_id", "record_type", "target_uri", "refers_to")], pa.array(data, pa.binary()),
                       pa.array(size, pa.int64()), pa.array(digest, pa.string()), pa.array([x and y for x, y in zip(fine, oks, strict=True)], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, schema=_PAYLOAD_ARROW)

    return logical.mapInArrow(each, PAYLOADS)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Logical records with their payloads, read from the archives under ``path``."""
    return payloads(reassemble(read_records(spark, path)))


def _page(column) -> F.Column:
    return F.regexp_extract(column, "^urn:page:(-?[0-9]+):", 1).try_cast("bigint")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    got = read_archives(spark, path)
    return got.select(_page(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      _page(F.col("refers_to")).alias("refers_to"), "ok")


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
), r AS (
  SELECT *, CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to FROM f
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, true AS ok
FROM r
"""
