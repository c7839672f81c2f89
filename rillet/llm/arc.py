"""Web archives: write legacy ARC files, convert them to WARC, read WARC back.

Files are written by Spark's text writer, whose line separator ends each record, and read by its
binary reader; records are found by their declared lengths.  So archives can lie in any store that
Spark reaches.  One task reads one file as a whole: files are as large as the partitions written.
"""

import hashlib
import re
import uuid
import zlib
from base64 import b32encode
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.llm.common import checkpointed, group_totals, salts

#: The fields of an ARC header line by version of the file.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_END, WARC_END = "\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The header of a stored response that names the page.
PAGE_HEADER = "X-Page-Id"


@dataclass(frozen=True)
class Capture:
    """What a table of pages does not say about their capture; file n has version n of the list."""

    date: str = "20240101000000"
    address: str = "0.0.0.0"
    versions: tuple = (1, 2)
    origin: str = "rillet"


def as_text(values: list[bytes]) -> pa.Array:
    """A string column of raw bytes, which need not be UTF-8."""
    binary = pa.array(values, pa.binary())
    return pa.Array.from_buffers(pa.string(), len(binary), binary.buffers())


def digest(payload: bytes) -> str:
    return b32encode(hashlib.sha1(payload).digest()).decode()


# ---- ARC

def arc_header(version: int, url: str, address: str, date: str, kind: str, length: int) -> bytes:
    middle = {1: "", 2: " 200 - - 0 -"}[version]
    return f"{url} {address} {date} {kind}{middle} {length}\n".encode()


def version_block(version: int, capture: Capture) -> bytes:
    """The first record of a file, without the separator after it."""
    block = f"{version} 0 {capture.origin}\n{ARC_FIELDS[version]}\n".encode()
    return arc_header(version, "filedesc://pages.arc", "0.0.0.0", capture.date, "text/plain", len(block)) + block


def response_block(page_id, payload: bytes) -> bytes:
    """The page as a server's answer."""
    named = f"{PAGE_HEADER}: {page_id}\r\n" if page_id is not None else ""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{named}\r\n"
    return head.encode() + payload


def write_arc(pages: DataFrame, folder: str, capture: Capture = Capture()) -> None:
    """One ARC record per row of (page_id, url, html), one compressed file per partition."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = capture.versions[TaskContext.get().partitionId() % len(capture.versions)]
        values = [version_block(version, capture)]
        for batch in batches:
            for page_id, url, html in zip(*(batch.column(x).to_pylist() for x in ("page_id", "url", "html")), strict=True):
                block = response_block(page_id, (html or "").encode())
                name = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "-")
                values.append(arc_header(version, name, capture.address, capture.date, "text/html", len(block)) + block)
            yield pa.RecordBatch.from_arrays([as_text(values)], ["value"])
            values = []

    rows = pages.select("page_id", "url", "html").mapInArrow(records, "value string")
    rows.write.text(folder, compression="gzip", lineSep=ARC_END)


def unpacked(content: bytes) -> bytes:
    """A file's bytes; gzip files may have several members."""
    parts = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        parts.append(member.decompress(content))
        content = member.unused_data
    return b"".join(parts) if parts else content


def arc_records(content: bytes) -> Iterator[tuple[int, dict, bytes]]:
    """(offset, fields, block) of the records after the version block."""
    place, fields = 0, None
    while True:
        while content[place : place + 1] in (b"\n", b"\r"):
            place += 1
        if place >= len(content):
            return
        end = content.index(b"\n", place)
        line = content[place:end].rstrip(b"\r").decode("utf-8", "replace")
        # An address may hold spaces, the fields after it do not; the length is the last one.
        length = int(line.rsplit(" ", 1)[1])
        block = content[end + 1 : end + 1 + length]
        if len(block) < length:
            raise ValueError(f"the ARC record at {place} declares {length} bytes and has {len(block)}")
        if fields is None:
            version = int(block.split(b" ", 1)[0])
            fields = ARC_FIELDS[version].split(" ")
        else:
            yield place, dict(zip(fields, line.rsplit(" ", len(fields) - 1), strict=True)), block
        place = end + 1 + length


def http_parts(block: bytes) -> tuple[bytes, dict, bytes]:
    """(head, headers, payload) of a stored response; a block that is none is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", {}, block
    head, blank, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return head + blank, {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}, payload


def page_of(headers: dict) -> int | None:
    value = headers.get(PAGE_HEADER.lower())
    return int(value) if value else None


def _files(spark: SparkSession, folder: str, rows: Callable[[str, bytes], Iterator[tuple]], schema: str, types: list) -> DataFrame:
    """What ``rows`` makes of each file (name, bytes)."""
    names = [column.split()[0] for column in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                found = list(rows(path.as_py().rsplit("/", 1)[-1], unpacked(content.as_py())))
                columns = list(zip(*found, strict=True)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)], names
                )

    return spark.read.format("binaryFile").load(folder).select("path", "content").mapInArrow(read, schema)


# ---- ARC to WARC

def record_id(file: str, offset: int) -> str:
    """The same record always gets the same identifier."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{file}/{offset}')}>"


def warc_date(date: str) -> str:
    """The 14 digits of an ARC date in WARC's form."""
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def warc_record(file, offset, url, address, date, block: bytes, first_file, first_offset) -> bytes:
    """A response, or a revisit of the record given by first_file and first_offset."""
    head, _, payload = http_parts(block)
    first = (first_file, first_offset) == (file, offset) or first_file is None
    body = block if first else head
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first else 'revisit'}",
        f"WARC-Record-ID: {record_id(file, offset)}",
        f"WARC-Date: {warc_date(date)}",
        f"WARC-Target-URI: {url}",
        f"WARC-IP-Address: {address}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(body)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if not first:
        lines += [f"WARC-Refers-To: {record_id(first_file, first_offset)}", f"WARC-Profile: {PROFILE}", "WARC-Truncated: length"]
    return "\r\n".join([*lines, f"Content-Length: {len(body)}", "", ""]).encode() + body


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, min_bytes: int = 0) -> None:
    """Write the records of all ARC files as WARC records.

    Of records whose payloads are equal and have at least ``min_bytes`` bytes the one with the smallest page
    id becomes a response (a missing id counts as the largest; of equal ids the first by file and place), the
    others revisits of it that keep only their HTTP head.  Shorter ones all become responses.

    Only digests are grouped; a payload is read twice and moves once, compressed, to its group's
    totals, which are spread over parts of the group.
    """
    parts = salts(spark)

    def keys(file, content):
        for offset, _, block in arc_records(content):
            _, headers, payload = http_parts(block)
            yield file, offset, page_of(headers), digest(payload), len(payload)

    def blocks(file, content):
        for offset, fields, block in arc_records(content):
            key = digest(http_parts(block)[2])
            yield file, offset, key, fields["URL"], fields["IP-address"], fields["Archive-date"], zlib.compress(block, 1)

    salt = F.pmod(F.xxhash64("file", "offset"), F.lit(parts)).cast("int").alias("salt")
    text, whole, binary = pa.string(), pa.int64(), pa.binary()
    slim = _files(spark, arc_folder, keys, "file string, offset long, page_id long, digest string, bytes long", [text, whole, whole, text, whole])
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "offset").alias("place")
    slim = checkpointed(slim.filter(F.col("bytes") >= min_bytes).select("digest", salt, order))
    firsts = group_totals(slim, "digest", "salt", {"first": ("min", "place")}).select(
        "digest", "salt", F.col("first.file").alias("first_file"), F.col("first.offset").alias("first_offset")
    )
    rows = _files(
        spark, arc_folder, blocks, "file string, offset long, digest string, url string, address string, date string, block binary",
        [text, whole, text, text, text, text, binary],
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [
                warc_record(x["file"], x["offset"], x["url"], x["address"], x["date"], zlib.decompress(x["block"]), x["first_file"], x["first_offset"])
                for x in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([as_text(values)], ["value"])

    joined = rows.select("*", salt).join(firsts, ["digest", "salt"], "left")
    joined.mapInArrow(records, "value string").write.text(warc_folder, compression="gzip", lineSep=WARC_END)


# ---- WARC

def warc_records(content: bytes) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of the records of a file."""
    place = 0
    while place < len(content):
        end = content.index(b"\r\n\r\n", place)
        lines = content[place:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {place}")
        headers = {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}
        length = int(headers["content-length"])
        yield headers, content[end + 4 : end + 4 + length]
        place = end + 4 + length + 4


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, date) of all records.

    Bytes and digest are those of the full payload, also for a revisit; a response whose payload does
    not fit its digest is an error.  ``refers_to`` is the page id of the response that a revisit names.
    """
    parts = salts(spark)

    def rows(_, content):
        for headers, block in warc_records(content):
            _, answer, payload = http_parts(block)
            key, kind = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
            if kind == "response" and digest(payload) != key:
                raise ValueError(f"{headers['warc-record-id']}: the payload does not fit its digest")
            size = int(answer["content-length"]) if kind == "revisit" else len(payload)
            own = headers["warc-record-id"]
            yield page_of(answer), size, key, kind, headers.get("warc-refers-to", own), own, headers["warc-target-uri"], headers["warc-date"]

    text, whole = pa.string(), pa.int64()
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, target string, record_id string, url string, date string"
    found = checkpointed(
        _files(spark, folder, rows, schema, [whole, whole, text, text, text, text, text, text])
        .withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(parts)).cast("int"))
    )
    page = F.when(F.col("record_type") == "response", F.col("page_id"))
    pages = group_totals(found.select("target", "salt", page.alias("page")), "target", "salt", {"page": ("min", "page")})
    return found.join(pages, ["target", "salt"]).select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", F.col("page")).alias("refers_to"), "url", "date",
    )


def archive(pages: DataFrame, folder: str, capture: Capture = Capture(), min_bytes: int = 0) -> DataFrame:
    """Pages (page_id, url, html) by way of ARC and WARC files below ``folder``; rows of ``read_warc``.

    A null html is an empty payload, a null url becomes ``-``, white space in a url is percent-encoded;
    a page without id has a record without one; repeated rows give a record each, of which one is
    the response.  Other columns are not read; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    write_arc(pages, f"{folder}/arc", capture)
    convert(spark, f"{folder}/arc", f"{folder}/warc", min_bytes)
    return read_warc(spark, f"{folder}/warc")
