"""WARC archives of one gzip member per record, and a reader that splits them at any byte.

Writing: a Python step turns each row into a finished gzip member, and Spark's
own text writer, with its commit protocol, puts the members into files. That
writer ends each row with a separator; the separator here is a zero byte, and
a member always ends with one (the top byte of its length field), so the row
leaves it out. A record of 16 MiB or more gets an empty member behind it, as
the gzip format allows, to end the same way. The files are plain gzip.

Reading: the driver lists files and sizes, tasks take byte ranges. A task scans
its range for the gzip magic, inflates the start of each candidate and accepts
it if a WARC version line and headers follow; it reads the records that start
inside its range to their end, past the range's end if need be, and goes on
behind each one. So every record is read once, wherever the ranges are cut.

Payloads are told apart by SHA-256. Of the rows with one payload of at least
``least`` bytes, those with the smallest id hold it, the others become revisit
records that name it. Nulls: a null payload is empty, a null id is the largest
and makes its record a revisit only where the payload also comes with an id.
Repeated rows of the smallest id all hold the payload. Extra columns are
ignored; no rows make no records. A record must fit in a task's memory.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kliping.llm.shared import map_slices, schema_of, stored

MAGIC = b"\x1f\x8b\x08"
HEAD = 1 << 14  # bytes inflated to validate a candidate
BLOCK = 1 << 20  # bytes read at once
RANGE_BYTES = 8 << 20
LEAST = 100
RECORD = (
    "id string, url string, record_type string, refers_to string, payload_digest string, payload binary,"
    " payload_bytes long"
)


def record_kinds(pages: DataFrame, id_col: str, payload_col: str, url_col: str | None, least: int = LEAST) -> DataFrame:
    """``id``, ``url``, ``payload``, ``digest`` and ``refers_to`` (null for a record that holds its payload)."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"),
        (F.col(url_col) if url_col else F.lit(None).cast("string")).alias("url"),
        payload.alias("payload"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
    )
    repeated = stored(
        rows.filter(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and first is not null")
        .select("digest", "first"),
        "repeated-payloads",
    )
    refers = F.when(F.col("id").isNull() | (F.col("id") > F.col("first")), F.col("first"))
    return rows.join(repeated, "digest", "left").select("id", "url", "payload", "digest", refers.alias("refers_to"))


def gzip_member(data: bytes) -> bytes:
    """A gzip member that ends with a zero byte, without that byte."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    if out[-1]:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += packer.compress(b"") + packer.flush()
    return out[:-1]


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _members(columns: list[list]) -> list[list]:
    return [
        [
            gzip_member(record(i, url, payload.encode(), digest, refers))
            for i, url, payload, digest, refers in zip(*columns, strict=True)
        ]
    ]


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url",
    least: int = LEAST,
) -> None:
    """Write one record per row under ``path``."""
    kinds = record_kinds(pages, id_col, payload_col, url_col, least)
    members = map_slices(
        kinds.select("id", "url", "payload", "digest", "refers_to"), _members, schema_of(member="binary")
    )
    members.select(F.col("member").cast("string")).write.option("lineSep", "\x00").text(path)


def byte_ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``file``, ``first`` and ``end`` of the ranges that the archive's files are read in, each in a partition of its own."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    found = [(f.getPath().toString(), f.getLen()) for f in files if f.isFile() and f.getPath().getName()[0] not in "._"]
    rows = [(f, a, min(a + range_bytes, n)) for f, n in found for a in range(0, n, range_bytes)]
    ranges = spark.createDataFrame(rows, "file string, first long, end long")
    return ranges.repartitionByRange(max(1, len(rows)), "file", "first")


def _open(uri: str) -> pa.NativeFile:
    """The file system comes from the address; ``hdfs`` needs the Hadoop client library on the executors."""
    source, path = pafs.FileSystem.from_uri(re.sub(r"^file:/(?=[^/])", "file:///", uri))
    return source.open_input_file(path)


def _headers(text: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in text.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.lower(): value.strip() for name, _, value in pairs}


def _validated(file: pa.NativeFile, at: int, size: int) -> bool:
    """Whether a WARC record starts at that byte."""
    try:
        head = zlib.decompressobj(31).decompress(file.read_at(min(HEAD, size - at), at), HEAD)
    except zlib.error:
        return False
    return head.startswith(b"WARC/1.") and b"\r\nWARC-Record-ID:" in head.partition(b"\r\n\r\n")[0]


def _inflated(file: pa.NativeFile, at: int, size: int) -> tuple[bytes, int]:
    """The member that starts at that byte, and the byte behind it."""
    unpack, parts = zlib.decompressobj(31), []
    while not unpack.eof:
        if at >= size:
            raise ValueError("the archive ends inside a record")
        data = file.read_at(min(BLOCK, size - at), at)
        parts.append(unpack.decompress(data))
        at += len(data) - len(unpack.unused_data)
    return b"".join(parts), at


def members_in(file: pa.NativeFile, first: int, end: int) -> Iterator[bytes]:
    """The records that start at ``first`` or behind it and before ``end``."""
    size, at = file.size(), first
    while at < end:
        # A magic may straddle the end of the range, so two bytes more are read.
        data = file.read_at(min(BLOCK, end + 2 - at, size - at), at)
        found = data.find(MAGIC)
        if found < 0:
            at += max(1, len(data) - 2)
            continue
        at += found
        if at >= end:
            return
        if not _validated(file, at, size):
            at += 1
            continue
        while at < end:
            if not _validated(file, at, size):  # an empty member, or bytes that are no record: scan on
                break
            text, at = _inflated(file, at, size)
            yield text


def parsed(member: bytes) -> tuple:
    """Record id, url, kind, refers_to, digest header, payload (None for a revisit) and its full length."""
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = re.search(r"urn:page:([^>]*)", fields["warc-record-id"])[1]
    refers = re.search(r"urn:page:([^>]*)", fields.get("warc-refers-to", ""))
    kind = fields["warc-type"]
    return (
        page or None, fields.get("warc-target-uri"), kind, refers[1] if refers else None,
        fields["warc-payload-digest"].removeprefix("sha256:"),
        payload if kind == "response" else None, int(_headers(http)["content-length"]),
    )


def read_archive(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, id_type: str = "long") -> DataFrame:
    """``id``, ``url``, ``record_type``, ``refers_to``, ``payload_digest``, ``payload`` (binary) and ``payload_bytes``.

    The payload of a ``response`` is checked against its digest and length.
    """
    out = to_arrow_schema(StructType.fromDDL(RECORD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _open(row["file"]) as file:
                    kept, held = [], 0
                    for member in members_in(file, row["first"], row["end"]):
                        one = parsed(member)
                        if one[5] is not None and (len(one[5]) != one[6] or hashlib.sha256(one[5]).hexdigest() != one[4]):
                            raise ValueError(f"record {one[0]} does not match its digest")
                        kept.append(one)
                        held += len(member)
                        if held > 8 * BLOCK:
                            yield _batch(kept, out)
                            kept, held = [], 0
                    if kept:
                        yield _batch(kept, out)

    rows = byte_ranges(spark, path, range_bytes).mapInArrow(run, RECORD)
    return rows.withColumn("id", F.col("id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def _batch(rows: list[tuple], out: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)
