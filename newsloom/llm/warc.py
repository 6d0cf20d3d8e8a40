"""Operator 9: legacy ARC archives to WARC.

ARC has no fixed header: the version block at the start of an archive says which fields
a record line has (version 1: five, version 2: ten), and the last field declares the
bytes that follow. Records are read by those lengths. Each becomes a WARC record with
an identifier made from its place and content, an ISO date, a type (response for HTTP
messages, resource for other content, revisit for a payload that another record holds
already) and SHA-256 digests of block and payload.

Archives are written by Spark's text writer, one record per row, so they go wherever
Spark writes; they are read whole, one file per row, and parsed as a stream. A file is
bounded by ``max_records`` on writing.

Defined cases: null content is an empty payload; a null address is ``-`` and reads as
null; spaces in an address are kept (lines are split from the right); lines that are no
record line are skipped; a record cut short by the end of a file is marked ``truncated``;
among equal payloads the smallest key is the response, null keys come last, and ties
are broken by archive and offset.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.common import ship

ship(__name__)

# Field names of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
END = "\r\n\r\n"


def _first_in_file(max_records: int) -> Column:
    """True for the first row of every file that a task writes; the head record is one of a file's ``max_records``."""
    if max_records < 2:
        raise ValueError("max_records must be at least 2: a head record and one more")
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) % (max_records - 1) == 0


def _binary(*parts: Column | str) -> Column:
    return F.concat(*((F.lit(p) if isinstance(p, str) else p).cast("binary") for p in parts))


def write_arc(
    pages: DataFrame, path: str, version: int = 1, key: str = "page_id", url: str = "url", content: str = "html",
    date: str = "20240101000000", max_records: int = 20_000,
) -> None:
    """Pages as gzip ARC files: an HTTP message per row, the key in a header of its own."""
    body = F.coalesce(F.col(content).cast("binary"), F.lit(b""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.coalesce(F.concat(F.lit("\r\nX-Key: "), F.col(key).cast("string")), F.lit("")), F.lit(END),
    )
    address = F.coalesce(F.regexp_replace(F.col(url).cast("string"), r"[\r\n]", ""), F.lit("-"))
    length = (F.octet_length(head) + F.octet_length(body)).cast("string")
    middle = " text/html " if version == 1 else " text/html 200 - - 0 pages.arc "
    record = _binary(F.when(address == "", F.lit("-")).otherwise(address), f" 0.0.0.0 {date}{middle}", length, "\n", head, body)
    block = f"{version} 0 newsloom\n{ARC_FIELDS[version]}\n"
    middle = " text/plain " if version == 1 else " text/plain 200 - - 0 pages.arc "
    about = _binary(f"filedesc://pages.arc 0.0.0.0 {date}{middle}{len(block)}\n{block}")
    rows = pages.select(F.explode(F.when(_first_in_file(max_records), F.array(about, record)).otherwise(F.array(record))).alias("r"))
    rows.select(F.col("r").cast("string").alias("value")).write.option("maxRecordsPerFile", max_records).text(
        path, compression="gzip", lineSep="\n"
    )


def _opened(content: bytes) -> io.BufferedReader | io.BytesIO:
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if content[:2] == b"\x1f\x8b" else raw


_DIGITS = re.compile(rb"\d{8,17}")


def arc_records(content: bytes) -> Iterator[dict]:
    """Records of one ARC file, the version block left out."""
    stream, version, offset = _opened(content), None, 0
    while line := stream.readline():
        at, offset = offset, offset + len(line)
        got = None
        for v in (version,) if version else (2, 1):
            fields = line.rstrip(b"\r\n").rsplit(b" ", len(ARC_FIELDS[v].split()) - 1)
            if len(fields) == len(ARC_FIELDS[v].split()) and fields[-1].isdigit() and _DIGITS.fullmatch(fields[2]):
                got = v
                break
        if got is None:
            continue
        size = int(fields[-1])
        block = stream.read(size)
        offset += len(block)
        if fields[0].startswith(b"filedesc:"):
            declared = block.split(b" ", 1)[0]
            version = int(declared) if declared in (b"1", b"2") else version
            continue
        head, gap, body = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
        text = [f.decode("utf-8", "replace") for f in fields]
        named = dict(zip(ARC_FIELDS[got].split(), text))
        yield {
            "offset": at, "version": got, "url": None if text[0] == "-" else text[0], "ip": text[1], "arc_date": text[2],
            "content_type": text[3], "result_code": named.get("Result-code"), "arc_length": size,
            "truncated": len(block) < size, "head": head + gap, "payload": body,
            "block_digest": hashlib.sha256(block).hexdigest(), "payload_digest": hashlib.sha256(body).hexdigest(),
        }


ARC_SCHEMA = (
    "archive string, offset long, version int, url string, ip string, arc_date string, content_type string, "
    "result_code string, arc_length long, truncated boolean, head binary, payload binary, block_digest string, "
    "payload_digest string"
)


def _parsed(spark: SparkSession, path: str, records, schema: str, arrow: pa.Schema) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                held, size = [], 0
                for record in records(content.as_py()):
                    held.append({"archive": name.as_py().rsplit("/", 1)[-1], **record})
                    size += len(record["payload"]) + 500
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_pylist(held, arrow)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, arrow)

    return files.mapInArrow(rows, schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    return _parsed(spark, path, arc_records, ARC_SCHEMA, _arrow(ARC_SCHEMA))


def header(name: str, head: Column) -> Column:
    """A field of an HTTP head, null where absent."""
    found = F.regexp_extract(head.cast("string"), rf"(?i)\r\n{name}: *([^\r\n]*)", 1)
    return F.when(found != "", found)


def convert(records: DataFrame, key: Column | None = None, min_bytes: int = 100) -> DataFrame:
    """ARC records with their WARC identity; equal payloads of ``min_bytes`` or more refer to the
    one with the smallest ``key`` (by default the first by date, archive and offset)."""
    rows = records.withColumn("key", (key if key is not None else F.lit(None)).cast("long"))
    stamp = F.rpad(F.substring("arc_date", 1, 14), 14, "0")
    place = F.concat_ws(" ", "archive", F.col("offset").cast("string"), "url", "arc_date", "block_digest")
    h = F.sha2(place, 256)
    part = lambda a, n: F.substring(h, a, n)
    rows = rows.select(
        "*",
        F.concat(F.lit("urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12)).alias("record_id"),
        F.regexp_replace(stamp, r"(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)", "$1-$2-$3T$4:$5:$6Z").alias("warc_date"),
        F.when(F.octet_length("head") > 0, "response").otherwise("resource").alias("base_type"),
    )
    rank = F.struct(F.col("key").isNull().alias("none"), "key", "arc_date", "archive", "offset", "record_id")
    firsts = (
        rows.where((F.col("base_type") == "response") & (F.octet_length("payload") >= min_bytes))
        .groupBy("payload_digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1")
        .select(F.col("payload_digest").alias("d"), F.col("first.record_id").alias("first_id"), F.col("first.key").alias("first_key"))
    )
    again = F.coalesce((F.col("base_type") == "response") & (F.col("first_id") != F.col("record_id")), F.lit(False))
    return rows.join(firsts, F.col("payload_digest") == F.col("d"), "left").select(
        *rows.drop("base_type").columns, F.when(again, "revisit").otherwise(F.col("base_type")).alias("warc_type"),
        F.when(again, F.col("first_id")).alias("refers_to_id"), F.when(again, F.col("first_key")).alias("refers_to_key"),
    )


def write_warc(records: DataFrame, path: str, max_records: int = 20_000) -> None:
    """Converted records as gzip WARC 1.0 files; a revisit keeps its HTTP head alone."""
    revisit = F.col("warc_type") == "revisit"
    block = F.when(revisit, F.col("head")).otherwise(F.concat("head", "payload"))
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value.cast("string")), F.lit(""))
    is_http = F.octet_length("head") > 0
    top = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.col("warc_type"),
        line("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        line("WARC-Date", F.col("warc_date")), line("WARC-Target-URI", F.col("url")), line("WARC-IP-Address", F.col("ip")),
        line("Content-Type", F.when(is_http, F.lit("application/http; msgtype=response")).otherwise(F.col("content_type"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.when(revisit, F.sha2("head", 256)).otherwise(F.col("block_digest")))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_to_id"), F.lit(">"))),
        line("WARC-Truncated", F.when(F.col("truncated"), F.lit("length"))),
        line("X-Payload-Length", F.octet_length("payload")), line("X-Key", F.col("key")), line("X-Refers-To-Key", F.col("refers_to_key")),
        line("Content-Length", F.octet_length(block)), F.lit(END),
    )
    about = "software: newsloom\r\nformat: WARC File Format 1.0\r\nconformsTo: http://bibnum.bnf.fr/WARC/WARC_ISO_28500_version1_latestdraft.pdf"
    info = _binary(
        "WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <", F.regexp_replace("record_id", "-8(...)-a", "-8$1-b"), ">\r\nWARC-Date: ",
        F.col("warc_date"), f"\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(about)}{END}{about}",
    )
    record = _binary(top, block)
    rows = records.select(F.explode(F.when(_first_in_file(max_records), F.array(info, record)).otherwise(F.array(record))).alias("r"))
    rows.select(F.col("r").cast("string").alias("value")).write.option("maxRecordsPerFile", max_records).text(
        path, compression="gzip", lineSep=END
    )


def warc_records(content: bytes) -> Iterator[dict]:
    """Records of one WARC file, warcinfo left out."""
    stream, offset = _opened(content), 0
    while line := stream.readline():
        at, offset = offset, offset + len(line)
        if not line.startswith(b"WARC/"):
            continue
        fields = {}
        while (line := stream.readline()).strip():
            offset += len(line)
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        offset += len(line)
        size = int(fields.get("content-length") or 0)
        block = stream.read(size)
        offset += len(block)
        kind = fields.get("warc-type")
        if kind == "warcinfo":
            continue
        http = "application/http" in fields.get("content-type", "")
        head, gap, body = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
        whole = kind != "revisit"
        number = lambda name: int(fields[name]) if fields.get(name) else None
        yield {
            "offset": at, "record_id": fields.get("warc-record-id", "").strip("<>"), "warc_type": kind,
            "warc_date": fields.get("warc-date"), "url": fields.get("warc-target-uri"), "key": number("x-key"),
            "payload_bytes": len(body) if whole else number("x-payload-length"),
            "payload_digest": hashlib.sha256(body).hexdigest() if whole else fields.get("warc-payload-digest", "").partition(":")[2],
            "declared_digest": fields.get("warc-payload-digest", "").partition(":")[2],
            "refers_to_id": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            "refers_to_key": number("x-refers-to-key"), "head": head + gap, "payload": body,
        }


WARC_SCHEMA = (
    "archive string, offset long, record_id string, warc_type string, warc_date string, url string, key long, "
    "payload_bytes long, payload_digest string, declared_digest string, refers_to_id string, refers_to_key long, "
    "head binary, payload binary"
)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    return _parsed(spark, path, warc_records, WARC_SCHEMA, _arrow(WARC_SCHEMA))
