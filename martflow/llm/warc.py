"""Web archives: ARC files are written, converted to WARC files, and read.

An ARC file begins with a version block that says which fields a record's header line has (five in
version 1, ten in version 2); each record is its header line and as many bytes as that declares.
The converter parses them and makes what WARC asks for: record ids, timestamps, types, digests.
Files are written and read by Spark, so that they may lie in any store it knows.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import materialize, run_folder, utf8

# The field lists of the two versions, as a version block states them.
ARC_FIELDS = {
    1: b"URL IP-address Archive-date Content-type Archive-length",
    2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: name space of addresses
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
SEGMENT = 4_000_000  # bytes of records behind one version block, or one longer record
ADDRESS, DAY = b"0.0.0.0", "20240101000000"


def sha1(data: bytes) -> str:
    return hashlib.sha1(data, usedforsecurity=False).hexdigest()


def one_token(text: str | None, other: bytes) -> bytes:
    """The text as a field of a header line: bytes that would end a field are escaped."""
    data = (text or "").encode()
    return re.sub(rb"[\x00-\x20%\x7f]", lambda m: b"%%%02X" % m[0][0], data) or other


def untoken(data: bytes) -> str:
    """What ``one_token`` escaped."""
    return re.sub(rb"%([0-9A-F]{2})", lambda m: bytes([int(m[1], 16)]), data).decode(errors="replace")


# -- ARC ---------------------------------------------------------------------------------


def version_block(version: int, name: bytes) -> bytes:
    body = b"%d 0 martflow\n%s\n" % (version, ARC_FIELDS[version])
    head = [b"filedesc://" + name, ADDRESS, DAY.encode(), b"text/plain"]
    if version == 2:
        head += [b"200", b"-", b"-", b"0", name]
    return b" ".join([*head, b"%d" % len(body)]) + b"\n" + body


def arc_record(version: int, key: str, url: bytes, payload: bytes, offset: int, name: bytes) -> bytes:
    """Header line and HTTP response; the key travels in a header of its own."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Key: %s\r\nContent-Length: %d\r\n\r\n" % (
        key.encode(),
        len(payload),
    )
    block += payload
    head = [url, ADDRESS, DAY.encode(), b"text/html"]
    if version == 2:
        head += [b"200", sha1(payload).encode(), b"-", b"%d" % offset, name]
    return b" ".join([*head, b"%d" % len(block)]) + b"\n" + block


def arc_segments(batches: Iterator[pa.RecordBatch], version: int) -> Iterator[pa.RecordBatch]:
    """(key, url, payload) -> (value): runs of records, each run behind a version block.

    Records are separated by a line end, which the writer of the file puts between segments too.
    """
    name = b"pages.arc"
    parts: list[bytes] = []
    size = 0
    for batch in batches:
        keys, urls, payloads = (batch.column(k).to_pylist() for k in range(3))
        for key, url, payload in zip(keys, urls, payloads):
            if not parts:
                parts = [version_block(version, name)]
                size = len(parts[0])
            record = arc_record(version, key, one_token(url, b"-"), payload or b"", size, name)
            parts.append(record)
            size += len(record) + 1
            if size >= SEGMENT:
                yield pa.RecordBatch.from_arrays([pa.array([b"\n".join(parts)], pa.binary())], names=["value"])
                parts = []
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array([b"\n".join(parts)], pa.binary())], names=["value"])


def inflated(data: bytes) -> bytes:
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def arc_records(data: bytes) -> Iterator[tuple[dict[str, bytes], bytes]]:
    """(fields, block) of each record; version blocks set the fields that follow.

    Before any version block, a header line's number of fields tells the version. Blank lines
    between records are skipped.
    """
    names = None
    at = 0
    while at < len(data):
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end].strip(b"\r")
        at = end + 1
        if not line:
            continue
        values = line.split(b" ")
        fields = names if names and len(names) == len(values) else None
        if fields is None:
            version = 1 if len(values) == 5 else 2 if len(values) == 10 else 0
            if not version:
                raise ValueError(f"no ARC header line: {line[:80]!r}")
            fields = ARC_FIELDS[version].split(b" ")
        size = int(values[-1])
        block = data[at : at + size]
        if len(block) < size:
            raise ValueError(f"record of {size} bytes is cut off")
        at += size
        if values[0].startswith(b"filedesc://"):
            names = block.split(b"\n")[1].split(b" ")
            continue
        yield {n.decode(): v for n, v in zip(fields, values)}, block


def http_parts(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(headers by lower-case name, header bytes with their end, payload) of an HTTP response."""
    end = block.find(b"\r\n\r\n")
    if end < 0:
        return {}, b"", block
    headers = {}
    for line in block[:end].split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        headers[name.strip().lower().decode()] = value.strip().decode(errors="replace")
    return headers, block[: end + 4], block[end + 4 :]


def parsed(batches: Iterator[pa.RecordBatch], with_block: bool) -> Iterator[pa.RecordBatch]:
    """(file content) -> (key, url, stamp, mime, digest, size, block): the records of ARC files."""
    names = ["key", "url", "stamp", "mime", "digest", "size", "block"]
    kinds = [pa.string(), pa.binary(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    for batch in batches:
        for content in batch.column(0).to_pylist():
            rows: list[tuple] = []
            held = 0
            for fields, block in arc_records(inflated(content)):
                headers, _, payload = http_parts(block)
                rows.append(
                    (headers.get("x-key"), fields["URL"], fields["Archive-date"].decode(), fields["Content-type"].decode(), sha1(payload), len(payload), block if with_block else None)
                )
                held += len(block) if with_block else 100
                if held > SEGMENT:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


# -- WARC --------------------------------------------------------------------------------


def record_id(key: str) -> str:
    """The same id for the same key in every run."""
    return f"urn:uuid:{uuid.uuid5(NAMES, key)}"


def warc_date(stamp: str) -> str:
    """Fourteen digits (or the first of them) as a WARC timestamp."""
    full = stamp + "00000101000000"[len(stamp) :]
    return datetime.strptime(full, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def warc_record(key: str, url: bytes, stamp: str, digest: str, block: bytes, original: str | None) -> bytes:
    """A response, or a revisit of the record with key ``original``; the two line ends that close it are left off."""
    _, head, payload = http_parts(block)
    body = block if original is None else head
    lines = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"response" if original is None else b"revisit"),
        b"WARC-Record-ID: <%s>" % record_id(key).encode(),
        b"WARC-Date: " + warc_date(stamp).encode(),
        b"WARC-Target-URI: " + url,
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"WARC-Block-Digest: sha1:" + sha1(body).encode(),
    ]
    if original is not None:
        lines += [b"WARC-Profile: " + REVISIT_PROFILE, b"WARC-Refers-To: <%s>" % record_id(original).encode()]
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(body)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + body


def warc_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, url, stamp, digest, block, original) -> (value)."""
    for whole in batches:
        for first in range(0, whole.num_rows, 256):
            rows = whole.slice(first, 256).to_pylist()
            made = [warc_record(r["key"], r["url"], r["stamp"], r["digest"], r["block"], r["original"]) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each WARC record, by the declared lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:80]!r}")
        headers = {}
        for line in lines[1:]:
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode()] = value.strip().decode(errors="replace")
        size = int(headers["content-length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) < size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError("record is cut off")
        at = end + 8 + size
        yield headers, block


def read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file content) -> (id, key, kind, size, digest, refers, good): the records of WARC files."""
    names = ["id", "key", "kind", "size", "digest", "refers", "good"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
    for batch in batches:
        for content in batch.column(0).to_pylist():
            rows = []
            for headers, block in read_records(inflated(content)):
                http, _, payload = http_parts(block)
                revisit = headers["warc-type"] == "revisit"
                declared = headers["warc-payload-digest"].removeprefix("sha1:")
                digest = declared if revisit else sha1(payload)
                size = int(http["content-length"]) if revisit else len(payload)
                good = digest == declared and headers["warc-block-digest"] == "sha1:" + sha1(block)
                rows.append((headers["warc-record-id"], http.get("x-key"), headers["warc-type"], size, digest, headers.get("warc-refers-to"), good))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


# -- Spark -------------------------------------------------------------------------------


def _files(spark: SparkSession, path: str, ending: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*{ending}").load(path).select("content")


def write_arc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", version: int = 1, segments: int = 8) -> None:
    """ARC files of ``pages``: each of at most ``segments`` runs of some 4 MB (before compression)."""
    if version not in ARC_FIELDS:
        raise ValueError(f"ARC version {version} is not known")
    rows = pages.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"),
        F.col(f"`{url}`").cast("string").alias("url"),
        utf8(F.col(f"`{payload}`")).alias("payload"),
    )
    made = rows.mapInArrow(lambda b: arc_segments(b, version), "value binary").select(F.col("value").cast("string"))
    made.write.option("compression", "gzip").option("maxRecordsPerFile", segments).text(path)


def read_arc(spark: SparkSession, path: str, with_block: bool = True) -> DataFrame:
    """One row for each record of the ARC files below ``path``."""
    schema = "key string, url binary, stamp string, mime string, digest string, size bigint, block binary"
    found = _files(spark, path, ".gz").mapInArrow(lambda b: parsed(b, with_block), schema)
    return found if with_block else found.drop("block")


def convert(spark: SparkSession, arc: str, warc: str, min_bytes: int = 1000, newest: Column | None = None) -> None:
    """WARC files of the ARC files below ``arc``.

    Of records with equal payloads of at least ``min_bytes`` bytes, the one with the greatest key (as a
    number) is the response and the others revisit it. Only digests are grouped; a payload is moved once,
    to meet the key it revisits; a key that has several payloads is met by each of them on its own.
    """
    index = materialize(read_arc(spark, arc, with_block=False).select("key", "digest", "size"), "arc-index")
    order = F.col("key").try_cast("bigint") if newest is None else newest
    large = index.where(F.col("size") >= min_bytes).select("key", "digest", order.alias("number")).where("number is not null")
    kept = large.groupBy("digest").agg(F.max("number").alias("last"), F.count("*").alias("copies")).where("copies > 1")
    target = large.join(kept, "digest").where("number <> last")
    target = target.select("key", "digest", F.col("last").cast("string").alias("original")).distinct()
    target = materialize(target, "arc-revisits")  # its size is known then, and decides how it is joined
    rows = read_arc(spark, arc).join(target, ["key", "digest"], "left").select("key", "url", "stamp", "digest", "block", "original")
    made = rows.mapInArrow(warc_records, "value binary").select(F.col("value").cast("string"))
    # The writer ends each value with what ends a WARC record.
    made.write.option("compression", "gzip").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", 10_000).text(warc)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the WARC files below ``path``: ``id, key, kind, size, digest, refers, good``.

    Sizes and digests of responses are those of the payload read; a revisit's are the ones it declares.
    """
    schema = "id string, key string, kind string, size bigint, digest string, refers string, good boolean"
    return _files(spark, path, ".gz").mapInArrow(read_files, schema)


def archive(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", version: int = 1, min_bytes: int = 1000) -> DataFrame:
    """Pages through ARC and WARC files and back: one row for each record read.

    Columns: ``key``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` (both keys of
    the type of ``key``), ``good`` (block and payload agree with their digests). Null payloads are
    empty. Keys are whole numbers, one for each page: rows that repeat a key stay rows of their own,
    but do not revisit each other; a null key is written as empty and read as null.
    """
    spark = pages.sparkSession
    arc, warc = run_folder(spark, "arc"), run_folder(spark, "warc")
    write_arc(pages, arc, key, url, payload, version)
    convert(spark, arc, warc, min_bytes)
    found = materialize(read_warc(spark, warc), "warc-records")
    kind = pages.schema[key].dataType.simpleString()
    firsts = found.where("kind = 'response'").select(F.col("id").alias("first"), F.col("key").alias("original")).distinct()
    met = found.join(firsts, found["refers"] == firsts["first"], "left")

    def back(name: str) -> Column:
        return F.when(F.col(name) != "", F.col(name)).cast(kind)

    return met.select(
        back("key").alias("key"),
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        back("original").alias("refers_to"),
        "good",
    )
