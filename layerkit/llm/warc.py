"""WARC: archives as a chunked record table.

An archive is a table of rows (archive, record_id, chunk, chunks, data): the ``data``
of an archive's rows, in (record_id, chunk) order, is a valid WARC/1.1 file. A record
whose payload exceeds one chunk is streamed as several rows, so neither the writer nor
the reader ever builds a whole oversized record.

Writing: every payload's SHA-1 is taken where it is read; of records with equal
payloads of at least ``least`` bytes the one with the largest id is written as a
``response``, the others as ``revisit`` records that carry headers only. The payloads
are joined to one small row for each repeated digest, which adaptive execution can
split when one digest is hot.

Reading: records of one chunk are parsed where they are scanned; the chunks of
oversized records are brought together by record, sorted by chunk number, and passed
through an incremental SHA-1 one chunk at a time. The digest of what was read is
compared with the one in the header; a mismatch raises.

Defined results: a null html is an empty payload (a response of 0 bytes); a null id is
smaller than every other id and is written as an empty id in the header; rows that
repeat an id and payload are separate records, all of them responses if they hold the
largest id; a null url is ``urn:none``; line breaks in a url become spaces so they
cannot break a header; an empty table gives an empty archive. Only the columns named
are read, so extra columns cannot clash.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted

CHUNK = 1 << 16
LEAST = 1000
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = "archive int, record_id string, chunk int, chunks int, data binary"
READ = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def write(pages: DataFrame, *, key: str = "page_id", url: str = "url", payload: str = "html",
          archives: int = 64, chunk: int = CHUNK, least: int = LEAST) -> DataFrame:
    """Chunk rows of the archives for all pages."""
    body = F.coalesce(quoted(payload).cast("string"), F.lit("")).cast("binary")
    site = F.translate(F.coalesce(quoted(url).cast("string"), F.lit("urn:none")), "\r\n", "  ")
    base = pages.select(quoted(key).cast("long").alias("id"), site.alias("url"), body.alias("body")) \
        .select("*", F.sha1("body").alias("digest"), F.octet_length("body").cast("long").alias("size"))
    repeated = (base.where(F.col("size") >= least).groupBy("digest", "size")
                .agg(F.max("id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1")
                .select(F.col("digest").alias("d"), F.col("size").alias("s"), "keeper"))
    joined = base.join(repeated, (base["digest"] == repeated["d"]) & (base["size"] == repeated["s"]), "left")
    # a null id is smaller than any; a group of null ids only has no keeper and stays response
    again = F.col("keeper").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("keeper")))
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    http = F.when(F.col("revisit"), F.lit("")).otherwise(F.lit(HTTP))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), name, F.lit(">\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nX-Payload-Length: "), F.col("size").cast("string"),
        F.when(F.col("revisit"), F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"),
                                          F.col("keeper").cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("size") + len(HTTP)).cast("string"),
        F.lit("\r\n\r\n"), http)
    rows = (joined.withColumn("revisit", again)
            .withColumn("chunks", F.when(F.col("revisit"), 1).otherwise(F.greatest(F.lit(1), F.ceil(F.col("size") / chunk))).cast("int"))
            # made before the explode: all chunks of a record share it, repeated ids do not
            .withColumn("record_id", F.uuid())
            .withColumn("head", head.cast("binary"))
            .withColumn("archive", F.pmod(F.xxhash64("id", "url"), F.lit(archives)).cast("int")))
    chunks = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    part = F.when(F.col("revisit"), F.lit(b"")).otherwise(F.substring(F.col("body"), F.col("chunk") * chunk + 1, F.lit(chunk)))
    ends = F.when(F.col("chunk") == F.col("chunks") - 1, F.lit(b"\r\n\r\n")).otherwise(F.lit(b""))
    starts = F.when(F.col("chunk") == 0, F.col("head")).otherwise(F.lit(b""))
    return chunks.select("archive", "record_id", "chunk", "chunks", F.concat(starts, part, ends).alias("data"))


class Record:
    """One record while it streams by: header fields, and an incremental digest of
    the payload, of which only the current chunk is held."""

    def __init__(self, first: bytes):
        head, _, rest = first.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("a record does not begin with a WARC version line")
        self.fields = dict(line.split(": ", 1) for line in lines[1:])
        self.kind = self.fields["WARC-Type"]
        self.left = int(self.fields["Content-Length"])
        self.sha, self.size = hashlib.sha1(), 0
        if self.kind == "response":
            blank = rest.index(b"\r\n\r\n") + 4
            self.left -= blank
            rest = rest[blank:]
        self.add(rest)

    def add(self, data: bytes) -> None:
        part = data[:self.left]
        self.sha.update(part)
        self.size += len(part)
        self.left -= len(part)

    def row(self) -> tuple:
        name = lambda x: int(x[len("<urn:page:"):-1]) if len(x) > len("<urn:page:>") else None
        size, digest = int(self.fields["X-Payload-Length"]), self.fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if self.left or self.kind == "response" and (self.size, self.sha.hexdigest()) != (size, digest):
            raise ValueError(f"payload of {self.fields['WARC-Record-ID']} does not match its header")
        refers = self.fields.get("WARC-Refers-To")
        return name(self.fields["WARC-Record-ID"]), size, digest, self.kind, refers and name(refers)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_single(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        yield _frame([Record(data).row() for data in pdf["data"]])


def read_streamed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks sorted by (archive, record, repeat, chunk): one open record at a time."""
    open_ = None
    for pdf in frames:
        done = []
        for chunk, chunks, data in zip(pdf["chunk"], pdf["chunks"], pdf["data"]):
            if chunk == 0:
                open_ = Record(data)
            else:
                open_.add(data)
            if chunk == chunks - 1:
                done.append(open_.row())
        yield _frame(done)


def read(archive: DataFrame) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    single = archive.where("chunks = 1").select("data").mapInPandas(read_single, READ)
    streamed = (archive.where("chunks > 1").repartition("archive", "record_id")
                .sortWithinPartitions("archive", "record_id", "chunk").select("chunk", "chunks", "data").mapInPandas(read_streamed, READ))
    return single.unionByName(streamed)


SQL = r"""
WITH base AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
kept AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS keeper FROM base)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN keeper IS NOT NULL AND (page_id IS NULL OR page_id < keeper) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper IS NOT NULL AND (page_id IS NULL OR page_id < keeper) THEN keeper END AS refers_to
FROM kept
"""
