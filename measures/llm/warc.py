"""WARC archives with revisit resolution.

`write_archive` writes one WARC 1.1 record per row through Spark's text
writer (gzip streams in a shared folder, so any file system Spark knows
serves); `read_archive` reads the files back as whole files and walks their
records by Content-Length inside tasks.  `resolve_revisits` shuffles only
headers by payload digest and joins each later copy to the original response;
`write_deduplicated` writes new archives in which later copies are `revisit`
records with fresh headers and no payload.

Rules
- a null payload is empty; payloads shorter than `min_bytes` are always
  responses; of equal payloads the smallest page id is the response.
- a null page id never is an original and revisits the smallest known one;
  rows that share page id and payload are one page and stay responses.
- control characters and spaces in a URL are percent-encoded; a null URL
  leaves the header out.  An empty table makes an empty archive, no rows.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from measures.llm.common import cut_lineage, ship_package

MIN_BYTES = 100
FILE_RECORDS = 2_000
BROADCAST_REVISITS = 20_000  # at most a few MB of headers; more are joined by a shuffle
DATE = "2024-01-01T00:00:00Z"
# Fixed value of the format: the profile of a payload-digest revisit.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = ("kind string, page_id bigint, uri string, date string, record_id string, "
           "payload_digest string, payload_bytes bigint, refers_to bigint")
_BATCH_BYTES = 4 << 20


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def record_id(page_id: Column, uri: Column, kind: Column) -> Column:
    h = F.md5(F.concat_ws("\n", kind, page_id.cast("string"), uri))
    part = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *part), F.lit(">"))


def record_text(kind: Column, page_id: Column, uri: Column, date: Column, payload: Column,
                digest: Column, payload_bytes: Column, original: dict[str, Column] | None = None
                ) -> Column:
    """One whole record but for its last line break, which the writer adds."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    _line("Content-Length", payload_bytes), F.lit("\r\n"))
    block = F.concat(http, F.when(kind == "revisit", F.lit("")).otherwise(payload))
    lines = [F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind),
             _line("WARC-Record-ID", record_id(page_id, uri, kind)), _line("WARC-Date", date),
             _line("WARC-Target-URI", uri), _line("WARC-Payload-Digest",
                                                  F.concat(F.lit("sha256:"), digest)),
             _line("Page-Id", page_id)]
    if original:
        lines += [_line("WARC-Profile", F.when(kind == "revisit", F.lit(PROFILE)))]
        lines += [_line(name, F.when(kind == "revisit", value)) for name, value in original.items()]
    lines += [F.lit("Content-Type: application/http; msgtype=response\r\n"),
              _line("Content-Length", F.octet_length(block)), F.lit("\r\n")]
    return F.concat(*lines, block, F.lit("\r\n"))


def _save(records: DataFrame, path: str) -> None:
    (records.write.option("compression", "gzip").option("lineSep", "\r\n")
     .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", FILE_RECORDS)
     .text(path))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", date: str = DATE) -> None:
    """One response record per row."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    uri = F.expr(f"regexp_replace(`{url_col}`, '[\\\\x00-\\\\x20\\\\x7F]', '%20')")
    _save(pages.select(record_text(
        F.lit("response"), F.col(id_col), uri, F.lit(date), payload,
        F.sha2(payload.cast("binary"), 256), F.octet_length(payload)).alias("value")), path)


def read_archive(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record: its headers and, if asked for, the payload.  The
    digest of a response is that of the payload read, not of the header."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in HEADERS.split(", ")] + ["payload"] * payloads
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for header, payload in records(content.as_buffer()):
                    rows.append([*header, payload] if payloads else header)
                    size += len(payload) + 500
                    if size >= _BATCH_BYTES:
                        yield _batch(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, HEADERS + ", payload binary" * payloads)


_TYPES = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(),
          "payload": pa.binary()}


def _batch(rows: list, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.record_batch([pa.array(c, _TYPES.get(n, pa.string()))
                            for c, n in zip(columns, names, strict=True)], names=names)


class _Stream(io.RawIOBase):
    """The unpacked bytes of a gzip stream (of one or many members)."""

    def __init__(self, data):
        self.data, self.at, self.unpack, self.out = data, 0, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self.out:
            if self.unpack.eof:
                self.at -= len(self.unpack.unused_data)
                self.unpack = zlib.decompressobj(31)
            piece = self.data[self.at:self.at + (1 << 18)]
            if not len(piece):
                return 0
            self.at += len(piece)
            self.out = self.unpack.decompress(piece)
        n = min(len(target), len(self.out))
        target[:n], self.out = self.out[:n], self.out[n:]
        return n


def _headers(stream) -> dict[str, str]:
    out = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def records(data) -> Iterator[tuple[list, bytes]]:
    """(header row, payload) of every record of one archive file."""
    stream = io.BufferedReader(_Stream(memoryview(data)), 1 << 18)
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not at the start of a WARC record: {line[:40]!r}")
        head = _headers(stream)
        block = stream.read(int(head["content-length"]))
        http, _, payload = block.partition(b"\r\n\r\n")
        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n")
                    if x.lower().startswith(b"content-length:"))
        kind = head["warc-type"]
        digest = (hashlib.sha256(payload).hexdigest() if kind == "response"
                  else head["warc-payload-digest"].removeprefix("sha256:"))
        number = lambda name: int(head[name]) if name in head else None
        yield [kind, number("page-id"), head.get("warc-target-uri"), head["warc-date"],
               head["warc-record-id"], digest, size, number("refers-to-page-id")], payload


def resolve_revisits(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, payload_digest, original: its page id, record id, URI, date)
    of every record that repeats an earlier payload."""
    long = headers.where(F.col("payload_bytes") >= min_bytes)
    originals = (long.where("page_id IS NOT NULL").groupBy("payload_digest")
                 .agg(F.min(F.struct("page_id", "record_id", "uri", "date")).alias("original")))
    again = long.select("page_id", "payload_digest").hint("merge").join(originals, "payload_digest")
    return again.where("NOT page_id <=> original.page_id").distinct()


def write_deduplicated(spark: SparkSession, source: str, path: str,
                       min_bytes: int = MIN_BYTES) -> None:
    """Copy an archive; later copies of a payload become revisit records."""
    revisits = cut_lineage(resolve_revisits(read_archive(spark, source), min_bytes))
    if revisits.count() <= BROADCAST_REVISITS:
        revisits = F.broadcast(revisits)
    full = read_archive(spark, source, payloads=True).alias("r")
    both = full.join(revisits.alias("v"), F.expr(
        "r.page_id <=> v.page_id AND r.payload_digest = v.payload_digest"), "left")
    original = {"WARC-Refers-To": F.col("original.record_id"),
                "WARC-Refers-To-Target-URI": F.col("original.uri"),
                "WARC-Refers-To-Date": F.col("original.date"),
                "Refers-To-Page-Id": F.col("original.page_id")}
    kind = F.when(F.col("original").isNotNull(), "revisit").otherwise("response")
    _save(both.select(record_text(
        kind, F.col("r.page_id"), F.col("uri"), F.col("date"), F.col("payload").cast("string"),
        F.col("r.payload_digest"), F.col("payload_bytes"), original).alias("value")), path)
