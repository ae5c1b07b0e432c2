"""Legacy ARC archives to WARC: header lines by version, bodies by declared length, equivalent WARC records.

Records are cut out by their declared lengths alone, so a body may hold anything. Version 1 header lines have five
fields, version 2 ten; the version block at the head of a file says which. A record becomes `response` (HTTP) or
`resource`; of records with equal payloads of at least `REVISIT_FROM` bytes that with the smallest key (then file and
offset) stays, the others become `revisit` and keep their HTTP head only. Files are gzip; one file is read by one task,
so keep archives at their usual size (below 2 GB). Null payloads are empty; a null URL is written as an URN of the key.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes from which equal payloads are written once.
REVISIT_FROM = 100
#: Bytes of records that a task hands to Spark at once.
BATCH_BYTES = 4 << 20

# The two formats' field lists, and the header lines of WARC 1.1.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARC_SCHEMA = ("version int, url string, ip string, archive_date string, content_type string, http boolean, record_key string, file string, offset long, "
              "head binary, payload binary, payload_bytes long, payload_digest string")
WARC_SCHEMA = "record_type string, record_id string, url string, record_key string, refers_to_id string, payload_bytes long, payload_digest string, intact boolean"


def header_line(version: int, url: str, date: str, content_type: str, length: int) -> bytes:
    lead = f"{re.sub(r'[\x00-\x20]', lambda m: f'%{ord(m[0]):02X}', url)} 0.0.0.0 {date} {content_type}"
    return (f"{lead} {length}\n" if version == 1 else f"{lead} 200 - - 0 pages.arc {length}\n").encode()


def version_block(version: int) -> bytes:
    body = f"{version} 0 rivermill\n{ARC_FIELDS[version]}\n".encode()
    return header_line(version, "filedesc://pages.arc", "20260101000000", "text/plain", len(body)) + body


def arc_records(stream: io.BufferedIOBase) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(version, offset, header fields, block) of every record; the version block itself is not one."""
    version, at = 1, 0
    while line := stream.readline():
        offset, at = at, at + len(line)
        if not line.strip():
            continue
        fields = line.decode("utf-8", "replace").rstrip("\n").rsplit(" ", len(ARC_FIELDS[version].split()) - 1)
        if line.startswith(b"filedesc:"):  # its own line shows the version by its number of fields
            fields = line.decode().split()
        try:
            block = stream.read(int(fields[-1]))
        except ValueError as bad:
            raise ValueError(f"no declared length in ARC header line at byte {offset}: {line[:200]!r}") from bad
        if len(block) != int(fields[-1]):
            raise ValueError(f"ARC record at byte {offset} ends early")
        at += len(block)
        if line.startswith(b"filedesc:"):
            version = int(block.split(b" ", 1)[0])
            continue
        names = ARC_FIELDS[version].split()
        if len(fields) != len(names):
            raise ValueError(f"ARC header line at byte {offset} has {len(fields)} fields, version {version} has {len(names)}")
        yield version, offset, dict(zip(names, fields)), block


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Head with its blank line, and payload; a block that is no HTTP message is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    ends = [(block.find(mark), len(mark)) for mark in (b"\r\n\r\n", b"\n\n")]
    ends = [at + n for at, n in ends if at >= 0]
    cut = min(ends, default=len(block))
    return block[:cut], block[cut:]


def head_value(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


def _batches(rows: Iterator[tuple], columns: list[str], weight: int) -> Iterator[pd.DataFrame]:
    """Frames of about BATCH_BYTES by the bytes in column `weight`."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[weight] or b"") + 500
        if size >= BATCH_BYTES:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def write_arc(pages: DataFrame, path: str, key: str, url: str, payload: str, key_header: str, fetched: str = "20260101000000") -> None:
    """One gzip file per partition of `pages`, in turn of version 1 and 2, each led by its version block."""
    numbered = pages.select(F.spark_partition_id().alias("n"), F.col(key).cast("string").alias("k"), F.col(url).alias("u"), F.encode(F.coalesce(payload, F.lit("")), "UTF-8").alias("p"))

    def archive(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        version = 0
        for frame in frames:
            records = []
            for n, k, u, p in frame.itertuples(index=False):
                if not version:
                    version = 1 + int(n) % 2
                    records.append(version_block(version))
                known = f"{key_header}: {k}\r\n" if k is not None else ""
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{known}Content-Length: {len(p)}\r\n\r\n".encode() + p
                records.append(header_line(version, u or f"urn:x-record:{k}", fetched, "text/html", len(block)) + block)
            yield pd.DataFrame({"record": records})

    _write(numbered.mapInPandas(archive, "record binary"), path, "\n")


def _write(records: DataFrame, path: str, separator: str) -> None:
    """Raw bytes by the text writer: it puts nothing but the separator between rows."""
    bytes_ = records.select(F.col("record").cast("string"))
    bytes_.write.option("lineSep", separator).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").mode("overwrite").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")


def read_arc(spark: SparkSession, path: str, key_header: str) -> DataFrame:
    def parsed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for frame in frames:
                for name, content in frame.itertuples(index=False):
                    for version, offset, line, block in arc_records(gzip.GzipFile(fileobj=io.BytesIO(content))):
                        head, payload = split_http(block)
                        yield (version, line["URL"], line["IP-address"], line["Archive-date"], line["Content-type"], bool(head), head_value(head, key_header),
                               name, offset, head, payload, len(payload), hashlib.sha256(payload).hexdigest())

        yield from _batches(rows(), _names(ARC_SCHEMA), 10)

    return _files(spark, path).mapInPandas(parsed, ARC_SCHEMA)


def to_warc(arc: DataFrame, order: Column) -> DataFrame:
    """Adds `record_type`, `record_id`, the record it refers to, and `record`, the bytes to write. `order`: ascending, the first copy stays."""
    ranked = arc.withColumn("_at", F.struct(order.isNull().alias("n"), order.alias("k"), "file", "offset"))
    first = ranked.where(F.col("payload_bytes") >= REVISIT_FROM).groupBy("payload_digest").agg(F.min(F.struct("_at", "url", "archive_date", "record_key")).alias("_first"))
    typed = ranked.join(first, "payload_digest", "left").withColumn("_revisit", F.col("_first").isNotNull() & (F.col("_first._at") != F.col("_at")))
    when = lambda c: _iso(F.col(c))
    kind = F.when(F.col("_revisit"), "revisit").when(F.col("http"), "response").otherwise("resource")
    block = F.when(F.col("_revisit"), F.col("head")).otherwise(F.concat("head", "payload"))
    typed = typed.withColumns({
        "record_type": kind, "_block": block, "record_id": _urn(F.col("_at"), F.col("payload_digest")),
        "refers_to_id": F.when(F.col("_revisit"), _urn(F.col("_first._at"), F.col("payload_digest"))),
    })
    media = F.when(F.col("http"), "application/http; msgtype=response").otherwise(F.col("content_type"))
    lines = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), "record_type", F.lit("\r\nWARC-Record-ID: "), "record_id", F.lit("\r\nWARC-Target-URI: "), "url",
        F.lit("\r\nWARC-Date: "), when("archive_date"), F.lit("\r\nWARC-IP-Address: "), "ip",
        F.lit("\r\nWARC-Payload-Digest: sha256:"), "payload_digest", F.lit("\r\nWARC-Block-Digest: sha256:"), F.sha2("_block", 256),
        F.when(F.col("_revisit"), F.concat(
            F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), "refers_to_id", F.lit("\r\nWARC-Refers-To-Target-URI: "), "_first.url",
            F.lit("\r\nWARC-Refers-To-Date: "), when("_first.archive_date"),
            F.lit("\r\nX-Payload-Length: "), F.col("payload_bytes").cast("string"))).otherwise(""),
        F.lit("\r\nContent-Type: "), media, F.lit("\r\nContent-Length: "), F.octet_length("_block").cast("string"), F.lit("\r\n\r\n"),
    )
    return typed.withColumn("record", F.concat(F.encode(lines, "UTF-8"), "_block"))


def _urn(at: Column, digest: Column) -> Column:
    """A record id that a rerun gives again: equal place, equal id."""
    h = F.md5(F.concat_ws("|", digest, at["k"].cast("string"), F.element_at(F.split(at["file"], "/"), -1), at["offset"].cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _iso(digits: Column) -> Column:
    """14 digits as a WARC date; shorter ones are filled up to the start of what they name, anything else is 1970."""
    whole = F.when(digits.rlike(r"^\d{4,14}$"), F.concat(digits, F.substring(F.lit("00000101000000"), F.length(digits) + 1, F.lit(14)))).otherwise("19700101000000")
    part = lambda at, n: F.substring(whole, at, n)
    return F.concat(part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit("T"), part(9, 2), F.lit(":"), part(11, 2), F.lit(":"), part(13, 2), F.lit("Z"))


def write_warc(records: DataFrame, path: str) -> None:
    _write(records, path, "\r\n\r\n")


def warc_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should start: {line[:100]!r}")
        head = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        length = int(head["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("a WARC record ends early")
        yield head, block


def read_warc(spark: SparkSession, path: str, key_header: str) -> DataFrame:
    """What the archives hold; `intact`: block and, where stored, payload have the digests that the header states."""

    def parsed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for frame in frames:
                for content in frame["content"]:
                    for line, block in warc_records(gzip.GzipFile(fileobj=io.BytesIO(content))):
                        head, payload = split_http(block)
                        stated = line["warc-payload-digest"].removeprefix("sha256:")
                        intact = line["warc-block-digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
                        if line["warc-type"] == "revisit":
                            size, digest = int(line["x-payload-length"]), stated
                        else:
                            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                        yield (line["warc-type"], line["warc-record-id"], line["warc-target-uri"], head_value(head, key_header), line.get("warc-refers-to"), size, digest, intact and digest == stated)

        yield from _batches(rows(), _names(WARC_SCHEMA), 6)

    return _files(spark, path).mapInPandas(parsed, WARC_SCHEMA)
