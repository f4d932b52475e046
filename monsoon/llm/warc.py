"""WARC archives: writing records with revisits and segments, and reading them back.

Writing: a payload of more than `segment` bytes is split over a first record and continuations, which name the first as
their origin; payloads go out in HTTP responses with chunked transfer framing.  Archives are text files of Spark's writer
whose line separator is the empty lines that end a record, compressed by gzip; so they can lie in any store and survive lost executors.
Reading: archives are parsed by the lengths that records declare, piece by piece, so that a reader holds one record and
not an archive; continuations are grouped by origin, ordered by segment number, checked against the total length, joined,
and the chunked framing is taken off.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.llm.common import Scratch, _col_of, map_batches, rekey, trimmed

CRLF = b"\r\n"
END = b"\r\n\r\n"
_SIZE = re.compile(rb"[0-9A-Fa-f]{1,16}")
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes, size: int) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(payload[i : i + size]), payload[i : i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body, None if its framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            return None
        told = _SIZE.fullmatch(body[at:end].split(b";")[0].strip(b" \t"))
        if not told:
            return None
        size = int(told[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != CRLF:
            return None
        out.append(body[at : at + size])
        at += size + 2


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, ident: str, block: bytes, **headers: str | int) -> bytes:
    """A record without the empty lines that end it; header names have _ for -, null values are left out."""
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {ident}", f"Content-Length: {len(block)}"]
    lines += [f"{name.replace('_', '-')}: {value}" for name, value in headers.items() if value is not None]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def _headers(data: bytes) -> dict[str, str]:
    """The headers by lower-case name."""
    lines = data.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


class Parser:
    """Records from an archive's pieces, which are what lies between its empty lines (END), in order.

    A record's block ends where its Content-Length says.  A block that ends early is None.  What isn't a record is skipped.
    """

    def __init__(self) -> None:
        self.headers: dict[str, str] | None = None
        self.parts: list[bytes] = []
        self.size = self.need = 0

    def feed(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes | None]]:
        if self.headers is None:
            piece = piece.lstrip(CRLF)
            if not piece.startswith(b"WARC/"):
                return
            self.headers, self.parts, self.size = _headers(piece), [], -len(END)
            length = self.headers.get("content-length", "")
            self.need = int(length) if re.fullmatch("[0-9]{1,18}", length) else 0
            return
        self.parts.append(piece)
        self.size += len(END) + len(piece)
        if self.size >= self.need:
            block = END.join(self.parts)
            headers, self.headers, self.parts = self.headers, None, []
            yield headers, block[: self.need]
            # the block had empty lines' bytes of its own at its end, so that the next record's head lies in this piece
            yield from self.feed(block[self.need :])

    def close(self) -> Iterator[tuple[dict[str, str], bytes | None]]:
        """The record that the archive's end has cut off."""
        if self.headers is not None:
            headers, self.headers = self.headers, None
            yield headers, b"" if self.need == 0 else None


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """The headers (lower-case names) and block of each record of an archive."""
    parser = Parser()
    for piece in data.split(END):
        yield from parser.feed(piece)
    yield from parser.close()


def _clean(text: str | None) -> str | None:
    """A header value on one line."""
    return None if text is None else " ".join(text.split())


def _write(segment: int, chunk: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for row in batch.to_pylist():
            ident = f"<urn:page:{row['row']}>"
            common = {"WARC_Target_URI": _clean(row["url"]), "WARC_Payload_Digest": "sha1:" + digest(row["payload"]), "X_Page_ID": None if row["page"] is None else quote(str(row["page"]), safe="")}
            if row["refers"] is not None:
                out.append(record("revisit", ident, REVISIT_HEAD, **common, WARC_Profile=PROFILE, WARC_Refers_To=f"<urn:page:{row['refers']}>"))
                continue
            block = HTTP_HEAD + chunked(row["payload"], chunk)
            if len(block) <= segment:
                out.append(record("response", ident, block, **common))
                continue
            parts = [block[i : i + segment] for i in range(0, len(block), segment)]
            out.append(record("response", ident, parts[0], **common, WARC_Segment_Number=1))
            for n, part in enumerate(parts[1:], 2):
                last = {"WARC_Segment_Total_Length": len(block)} if n == len(parts) else {}
                out.append(record("continuation", f"<urn:page:{row['row']}:{n}>", part, WARC_Segment_Origin_ID=ident, WARC_Segment_Number=n, **last))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return run


def write(spark: SparkSession, pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, segment: int = 1 << 20, chunk: int = 1 << 14, archive: int = 1 << 25) -> None:
    """Writes a record for each row of pages to archives of about `archive` bytes under path, which must not exist.

    The payload is the html in UTF-8, empty for null.  Of rows with equal payloads of at least min_bytes, the one with the
    least id (of repeated ids, the first read) is the response and the others are revisits of it; a null id comes last.
    """
    scratch = Scratch(spark, "warc")
    payload = F.encode(F.coalesce(_col_of(html_col).cast("string"), F.lit("")), "UTF-8")
    plain = pages.select(_col_of(id_col).alias("page"), _col_of(url_col).cast("string").alias("url"), payload.alias("payload"), F.monotonically_increasing_id().alias("row"))
    rows = scratch.table(plain.withColumn("sha", F.sha1("payload")).withColumn("bytes", F.octet_length("payload")), "payloads")
    # which rows revisit which is found from digests alone
    large = rows.where(F.col("bytes") >= min_bytes).select("sha", "row", F.struct(F.col("page").isNull().alias("null"), "page", "row").alias("order"))
    first = large.groupBy("sha").agg(F.count("*").alias("n"), F.min("order").alias("first")).where("n > 1")
    first = first.select(rekey(F.conv(F.substring("sha", 1, 15), 16, 10).cast("long")).alias("k"), F.col("sha").alias("first_sha"), F.col("first.row").alias("refers"))
    asked = large.withColumn("k", rekey(F.conv(F.substring("sha", 1, 15), 16, 10).cast("long"))).join(first, "k").where("sha = first_sha and row <> refers")
    revisits = scratch.table(asked.select(F.col("row").alias("at"), "refers"), "revisits")
    size = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    files = max(1, -(-(size.b + 500 * size.n) // archive))
    # payloads are exchanged once, evenly by row, into as many parts as there are archives
    linked = rows.select("row", "page", "url", "payload").repartition(files, "row").join(revisits.repartition(files, "at"), F.col("row") == F.col("at"), "left")
    records = map_batches(linked.select("row", "page", "url", "refers", "payload"), _write(segment, chunk), "record binary", 64)
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END.decode()).text(path, compression="gzip")
    scratch.drop(rows)
    scratch.drop(revisits)


_NAMES = ["warc-type", "warc-record-id", "warc-target-uri", "warc-payload-digest", "warc-refers-to", "warc-segment-origin-id", "x-page-id"]


def _row(headers: dict[str, str], block: bytes | None) -> list:
    texts = [headers.get(n) for n in _NAMES]
    texts[-1] = None if texts[-1] is None else unquote(texts[-1])
    numbers = [headers.get(n, "") for n in ("warc-segment-number", "warc-segment-total-length")]
    return [*texts, *(int(x) if re.fullmatch("[0-9]{1,18}", x) else None for x in numbers), block]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the pieces (file, value) of one or more archives, each archive's in order."""
    parser, current, rows, size = Parser(), None, [], 0
    for batch in batches:
        for file, piece in zip(batch.column(0), batch.column(1), strict=True):
            found = []
            if file != current:
                found += parser.close()
                current = file
            found += parser.feed(piece.as_py() or b"")
            for headers, block in found:
                rows.append(_row(headers, block))
                size += len(block or b"")
            if size > 8 << 20 or len(rows) > 4096:
                yield _records(rows)
                rows, size = [], 0
    rows += [_row(*x) for x in parser.close()]
    yield _records(rows)


def _read_whole(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for data in batch.column(0).to_pylist():
        yield _records([_row(*x) for x in parse(data)])


def _records(rows: list[list]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 10
    kinds = [pa.string()] * 7 + [pa.int64()] * 2 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in RECORD.split(", ")])


RECORD = "type string, record_id string, uri string, digest string, refers string, origin string, page string, number long, total long, block binary"


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under path, as they lie there; a block is null where its archive ends before it.

    Archives named *.gz, which can't be split, are streamed through Spark's text reader with the records' empty lines as
    separator: a task holds a record of them at a time.  Others are read as one value each, so they must fit in memory.
    """
    pieces = spark.read.option("pathGlobFilter", "*.gz").option("lineSep", END.decode()).text(path)
    streamed = pieces.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value")).mapInArrow(trimmed(_read), RECORD)
    others = spark.read.format("binaryFile").load(path).where(~F.col("path").endswith(".gz") & (F.col("length") > 0)).select("content")
    return streamed.unionByName(map_batches(others, _read_whole, RECORD, 1))


def reassembled(all_records: DataFrame) -> DataFrame:
    """Records with continuations joined: block, complete (segments are there without a gap and of the total length).

    Segments of one origin are those of one payload; a group is as large as one document.  A continuation without its
    first record gives an incomplete row with the origin as record_id and null type.
    """
    whole = all_records.where("number is null").select("type", "record_id", "uri", "digest", "refers", "page", "block", F.lit(True).alias("complete"), F.lit(1).alias("segments"))
    parts = all_records.where("number is not null").withColumn("key", F.coalesce("origin", "record_id"))
    firsts = lambda c: F.max(F.when(F.col("origin").isNull(), F.col(c))).alias(c)
    grouped = parts.groupBy("key").agg(
        *[firsts(c) for c in ("type", "uri", "digest", "refers", "page")],
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("s"), F.max("total").alias("total"),
    )
    data = grouped.select("*", F.array_join(F.transform("s", lambda x: x.block.cast("string")), "").cast("binary").alias("joined"))
    numbers = F.col("s.number")
    complete = (numbers == F.sequence(F.lit(1).cast("long"), F.size("s").cast("long"))) & (F.octet_length("joined") == F.coalesce("total", F.lit(-1)))
    return whole.unionByName(data.select("type", F.col("key").alias("record_id"), "uri", "digest", "refers", "page", F.col("joined").alias("block"), complete.alias("complete"), F.size("s").alias("segments")))


def _payloads(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size, found, out = [], [], []
    for kind, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        head, _, body = (block or b"").partition(END)
        payload = None
        if kind == "response" and block is not None:
            payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
        out.append(payload)
        size.append(None if payload is None else len(payload))
        found.append(None if payload is None else digest(payload))
    rest = [batch.column(i) for i in range(2, batch.num_columns)]
    yield pa.RecordBatch.from_arrays([*rest, pa.array(out, pa.binary()), pa.array(size, pa.int64()), pa.array(found, pa.string())], [*batch.schema.names[2:], "payload", "payload_bytes", "payload_digest"])


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for each page: record_id, page, uri, record_type, refers_to, payload (of responses, if payloads), payload_bytes, payload_digest, valid, segments.

    refers_to is the page of the response; bytes and digest of a revisit are those of the response's payload.  valid tells
    that segments are complete, the framing is right and the payload has the digest that the record declares.  Damaged
    records are kept as invalid rows: blocks cut off by their archive's end, broken framing, missing segments.
    """
    joined = reassembled(records(spark, path)).select("type", "block", "record_id", "page", "uri", "digest", "refers", "complete", "segments")
    kinds = "record_id string, page string, uri string, digest string, refers string, complete boolean, segments int"
    typed = joined.select("type", "block", F.col("type").alias("record_type"), "record_id", "page", "uri", "digest", "refers", "complete", F.col("segments").cast("int"))
    rows = map_batches(typed, _payloads, f"record_type string, {kinds}, payload binary, payload_bytes long, payload_digest string", 64)
    # written once, since revisits join with it
    rows = Scratch(spark, "warc-read").table(rows if payloads else rows.drop("payload"), "payloads")
    refers = rows.where("refers is not null")
    asked = refers.select(F.col("refers").alias("asked")).distinct()
    target = rows.where("record_type = 'response'").select(F.col("record_id").alias("t"), F.col("page").alias("t_page"), F.col("payload_bytes").alias("t_bytes"), F.col("payload_digest").alias("t_digest"))
    target = target.join(asked, F.col("t") == F.col("asked"), "left_semi")
    # only what refers to something is joined: nulls would all meet in one task
    spread = F.xxhash64("refers")
    joined = refers.join(target, (rekey(spread) == rekey(F.xxhash64("t"))) & (F.col("refers") == F.col("t")), "left")
    all_rows = joined.unionByName(rows.where("refers is null").withColumns({"t": F.lit(None).cast("string"), "t_page": F.lit(None).cast("string"), "t_bytes": F.lit(None).cast("long"), "t_digest": F.lit(None).cast("string")}))
    found: Column = F.coalesce("payload_digest", "t_digest")
    return all_rows.select(
        "record_id", "page", "uri", "record_type", F.col("t_page").alias("refers_to"), *(["payload"] if payloads else []), F.coalesce("payload_bytes", "t_bytes").alias("payload_bytes"), found.alias("payload_digest"),
        F.coalesce(F.col("complete") & (F.concat(F.lit("sha1:"), found) == F.col("digest")), F.lit(False)).alias("valid"), "segments",
    )
