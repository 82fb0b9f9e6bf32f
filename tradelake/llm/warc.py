"""WARC archives without repeated payloads.

Method: shuffle record headers by payload digest, name the record with the largest id of
each digest the response, join the revisit records to it, and write archives with fresh
headers. Only responses carry their payload through a shuffle (the join on the record key).

An archive is a folder of gzip-compressed WARC 1.1 files written by Spark's own committed
text writer: a record is one value and the line separator is the record terminator CRLF CRLF.
``read_warc`` frames records by Content-Length, so payloads may hold any bytes.

Defined results
  null or empty html   an empty payload; it takes part like any other when ``min_bytes`` is 0
  null id              sorts below all ids; null url: no WARC-Target-URI header
  repeated rows        rows equal in id, url and payload: one record each; at most one is the response
  ties                 equal largest ids with different urls: the larger url is the response
  empty table          an archive without records, read back as no rows
  other columns        ignored
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_of

CRLF = "\r\n"
ID_PREFIX = "urn:x-page:"
READ_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
READ_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def base32_sha1(text: Column) -> Column:
    """Upper-case RFC 4648 base32 of the SHA-1 of a text: 160 bits as four groups of 40."""
    hexed = F.sha1(text)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def resolve_revisits(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0
) -> DataFrame:
    """One row per record: page_id, url, digest, bytes, copy, refers_to_id/_url and payload (null for revisits)."""
    url = F.col(url_col)
    payload = text_of(payload_col)
    work = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        url.alias("url"),
        payload.alias("payload"),
        base32_sha1(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"),
    ).withColumn(
        "key",
        F.concat(
            F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
            F.when(F.col("url").isNull(), " ").otherwise(F.concat(F.lit(" u"), F.col("url"))),
            F.lit(" "),
            F.col("digest"),
        ),
    )
    headers = (
        work.where(F.col("bytes") >= min_bytes)
        .groupBy("key", "page_id", "url", "digest", "bytes")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    winners = headers.groupBy("digest").agg(F.max(F.struct("page_id", "url", "key")).alias("w"))
    same = headers.join(winners, "digest")
    first = F.col("key") == F.col("w.key")
    revisits = (
        same.withColumn("n", F.col("copies") - first.cast("long"))
        .where(F.col("n") > 0)
        .select(
            "page_id",
            "url",
            "digest",
            "bytes",
            F.explode(F.sequence(F.col("copies") - F.col("n") + 1, F.col("copies"))).alias("copy"),
            F.lit("revisit").alias("type"),
            F.col("w.page_id").alias("to_id"),
            F.col("w.url").alias("to_url"),
            F.lit(None).cast("string").alias("payload"),
        )
    )
    one = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(1)))
    nothing = [F.lit("response").alias("type"), F.lit(None).cast("long").alias("to_id"), F.lit(None).cast("string").alias("to_url")]
    responses = (
        work.where(F.col("bytes") >= min_bytes)
        .join(winners.select(F.col("w.key").alias("key")), "key")
        .withColumn("copy", one.cast("long"))
        .where(F.col("copy") == 1)
        .select("page_id", "url", "digest", "bytes", "copy", *nothing, "payload")
    )
    out = responses.unionByName(revisits)
    if min_bytes > 0:
        short = work.where(F.col("bytes") < min_bytes).select("page_id", "url", "digest", "bytes", F.lit(1).cast("long").alias("copy"), *nothing, "payload")
        out = out.unionByName(short)
    return out


def _record_id(page_id: Column, copy: Column) -> Column:
    return F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), copy.cast("string"), F.lit(">"))


def record_text(date: str) -> Column:
    """The whole record without its terminator: fresh WARC headers, HTTP headers, payload."""
    clean = lambda c: F.regexp_replace(c, r"[\x00-\x20\x7f]", "%20")  # noqa: E731  a header value is one line
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(CRLF + CRLF),
    )
    revisit = F.col("type") == "revisit"
    block_bytes = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    optional = lambda name, c: F.coalesce(F.concat(F.lit(f"{name}: "), clean(c), F.lit(CRLF)), F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "),
        F.col("type"),
        F.lit(f"{CRLF}WARC-Record-ID: "),
        _record_id(F.col("page_id"), F.col("copy")),
        F.lit(f"{CRLF}WARC-Date: {date}{CRLF}"),
        optional("WARC-Target-URI", F.col("url")),
        F.lit("WARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.lit(CRLF),
        F.when(
            revisit,
            F.concat(
                F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}WARC-Refers-To: "),
                _record_id(F.col("to_id"), F.lit(1)),
                F.lit(f"{CRLF}WARC-Refers-To-Date: {date}{CRLF}"),
                optional("WARC-Refers-To-Target-URI", F.col("to_url")),
            ),
        ).otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        block_bytes.cast("string"),
        F.lit(CRLF + CRLF),
        http,
        F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )


def write_warc(records: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", records_per_file: int = 4000) -> None:
    """Write the rows of ``resolve_revisits``; ``records_per_file`` bounds a file, which a reader task holds whole."""
    (
        records.select(record_text(date).alias("value"))
        .write.option("lineSep", CRLF + CRLF)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record of one file; raises if a record is cut short."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data))
    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(n := int(headers["content-length"]))
        if len(block) != n or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('warc-record-id')} is cut short")
        yield headers, block


def _page_id(record_id: str | None) -> int | None:
    found = (record_id or "").strip("<>").removeprefix(ID_PREFIX).rpartition(":")[0]
    return int(found) if found and found != "none" else None


def _rows(data: bytes, with_payload: bool) -> Iterator[dict]:
    for headers, block in parse_records(data):
        head, _, payload = block.partition(b"\r\n\r\n")
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        kind = headers["warc-type"]
        if kind == "response":
            import base64

            size = len(payload)
            if (found := base64.b32encode(hashlib.sha1(payload).digest()).decode()) != digest:
                raise ValueError(f"record {headers['warc-record-id']}: payload digest {found} is not {digest}")
        else:  # the HTTP headers of the original tell the length of the payload left out
            size = next(int(x.partition(b":")[2]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        yield {
            "page_id": _page_id(headers["warc-record-id"]),
            "url": headers.get("warc-target-uri"),
            "payload_bytes": size,
            "payload_digest": digest,
            "record_type": kind,
            "refers_to": _page_id(headers.get("warc-refers-to")) if kind == "revisit" else None,
            "payload": payload if with_payload and kind == "response" else None,
        }


def read_warc(spark: SparkSession, path: str, with_payload: bool = False, rows_per_batch: int = 500) -> DataFrame:
    """The records of an archive folder; payload digests are computed again and checked."""
    schema = pa.schema(list(READ_ARROW)[: 7 if with_payload else 6])

    def read(batches):
        for batch in batches:
            for data in batch.column("content"):
                some = []
                for row in _rows(data.as_py(), with_payload):
                    some.append(row)
                    if len(some) == rows_per_batch:
                        yield pa.RecordBatch.from_pylist(some, schema=schema)
                        some = []
                if some:
                    yield pa.RecordBatch.from_pylist(some, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(read, READ_SCHEMA + (", payload binary" if with_payload else ""))
