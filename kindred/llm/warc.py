"""WARC archives of pages: written with segments and chunked framing, read back and reassembled.

Writing. Pages with equal payloads of at least ``revisit_bytes`` are one ``response`` (that of the largest
page id) and ``revisit`` records that refer to it. A response is an HTTP message in chunked transfer coding;
one longer than ``segment_bytes`` is cut into a first record and ``continuation`` records that name it as
their origin, carry their segment number and, in the last one, the total length. Archives are gzipped WARC
files written by Spark's text writer into any folder Spark can write to: each row is a record, and the two
line ends that close a record are the line separator. So a lost task's file is written anew as a whole.

Reading. Files are parsed by content length. Whole records are decoded where they are; segments are
grouped by their origin, put in order of their numbers, checked for gaps and against the total length, and
then decoded. A gap, a wrong length or a broken chunk fails the job.

Which pages share a payload is found from digests alone. Digests are paired with pages by digest and a salt,
so that a payload that a third of all pages have is spread over ``SALTS`` places.

Defined cases: a null payload is empty; a null id is kept as null and is never preferred over another id;
repeated rows each have a record; an empty table gives an empty archive. Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.llm.texts import blocks

END = b"\r\n"
#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

REVISIT_BYTES = 1_000
SEGMENT_BYTES = 65_536
CHUNK_BYTES = 8_192
#: Records of a file at most; with the segment size this bounds a file.
FILE_RECORDS = 250
SALTS = 32
#: Pages have no time of their own.
DATE = "2020-01-01T00:00:00Z"


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer coding: the length of each chunk in hexadecimal, the chunk, and an empty one last."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        parts += [b"%x" % len(part), END, part, END]
    return b"".join([*parts, b"0", END, END])


def dechunked(framed: bytes) -> bytes:
    """The payload of a chunked message body; extensions of a chunk and trailers are skipped."""
    parts, at = [], 0
    while True:
        line_end = framed.index(END, at)
        size = int(framed[at:line_end].split(b";")[0], 16)
        at = line_end + 2
        if size == 0:
            return b"".join(parts)
        part = framed[at : at + size]
        if len(part) != size or framed[at + size : at + size + 2] != END:
            raise ValueError(f"broken chunk at byte {at}")
        parts.append(part)
        at += size + 2


def headers(fields: Iterable[tuple[str, object]]) -> bytes:
    return b"".join(f"{name}: {value}".encode() + END for name, value in fields)


def parse_headers(lines: bytes) -> dict[str, str]:
    """Names in lower case; a line that begins with a blank goes on from the one before."""
    found: dict[str, str] = {}
    last = None
    for line in lines.split(END):
        if line[:1] in (b" ", b"\t") and last:
            found[last] += " " + line.strip().decode()
        elif line:
            name, _, value = line.partition(b":")
            last = name.strip().lower().decode()
            found[last] = value.strip().decode()
    return found


class Record(NamedTuple):
    fields: dict[str, str]
    block: bytes


def records(archive: bytes) -> Iterator[Record]:
    """The records of an archive in order."""
    at = 0
    while at < len(archive):
        if archive[at : at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        head_end = archive.index(END + END, at)
        fields = parse_headers(archive[archive.index(END, at) + 2 : head_end])
        begin = head_end + 4
        stop = begin + int(fields["content-length"])
        if archive[stop : stop + 4] != END + END:
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield Record(fields, archive[begin:stop])
        at = stop + 4


def _digest(sha1: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()


def _record(kind: str, record_id: str, page: tuple, more: list[tuple[str, object]], block: bytes) -> bytes:
    page_id, url, sha1 = page
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE)]
    fields += [("WARC-Target-URI", " ".join(url.split()))] if url else []
    fields += [("WARC-Page-ID", page_id)] if page_id is not None else []
    fields += [("WARC-Payload-Digest", _digest(sha1)), *more, ("Content-Length", len(block))]
    # The writer adds the two line ends that close the record.
    return VERSION + END + headers(fields) + END + block


def page_records(page: tuple, payload: bytes, record_id: str, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """A response, as one record or as a first segment and its continuations."""
    http = b"HTTP/1.1 200 OK" + END + headers([("Content-Type", "text/html; charset=utf-8"), ("Transfer-Encoding", "chunked")])
    message = http + END + chunked(payload, chunk_bytes)
    kind = ("Content-Type", "application/http; msgtype=response")
    if len(message) <= segment_bytes:
        yield _record("response", record_id, page, [kind], message)
        return
    cuts = range(0, len(message), segment_bytes)
    for number, at in enumerate(cuts, 1):
        part = message[at : at + segment_bytes]
        more: list[tuple[str, object]] = [("WARC-Segment-Number", number)]
        if number == 1:
            yield _record("response", record_id, page, [kind, *more], part)
            continue
        more.append(("WARC-Segment-Origin-ID", f"<{record_id}>"))
        if number == len(cuts):
            more.append(("WARC-Segment-Total-Length", len(message)))
        yield _record("continuation", f"{record_id}:{number}", page, more, part)


def revisit_record(page: tuple, size: int, record_id: str, target: tuple) -> bytes:
    target_id, target_url = target
    http = b"HTTP/1.1 200 OK" + END + headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", size)]) + END
    more = [("Content-Type", "application/http; msgtype=response"), ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To-Date", DATE)]
    more += [("WARC-Refers-To-Target-URI", " ".join(target_url.split()))] if target_url else []
    more += [("WARC-Refers-To-Page-ID", target_id)] if target_id is not None else []
    return _record("revisit", record_id, page, more, http)


def with_targets(pages: DataFrame, page_id: str, url: str, payload: str, revisit_bytes: int) -> DataFrame:
    """Pages with ``_size``, ``_sha1`` and, for those that revisit another, the ``_target`` page."""
    body = F.coalesce(pages[payload].cast("binary"), F.lit(b""))
    pages = pages.select(
        pages[page_id].alias("_page"), pages[url].alias("_url"), body.alias("_text"),
        F.sha1(body).alias("_sha1"), F.octet_length(body).cast("bigint").alias("_size"),
    )
    # Only digests of payloads that occur more than once, each with its last page.
    shared = (
        pages.filter(F.col("_size") >= revisit_bytes)
        .groupBy("_sha1")
        .agg(F.max(F.struct("_page", "_url")).alias("_target"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1")
        .select("_sha1", "_target", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    )
    salted = pages.withColumn("_salt", F.pmod(F.xxhash64("_page"), F.lit(SALTS)).cast("int"))
    joined = salted.join(shared, ["_sha1", "_salt"], "left")
    is_target = F.col("_target").isNull() | F.col("_target._page").eqNullSafe(F.col("_page"))
    # A payload that a page revisits is not written, so it is not carried on.
    return joined.select(
        "_page", "_url", "_sha1", "_size", F.when(is_target, F.col("_text")).otherwise(F.lit(b"")).alias("_text"),
        F.when(~is_target, F.col("_target")).alias("_target"),
    )


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
                   revisit_bytes: int = REVISIT_BYTES, segment_bytes: int = SEGMENT_BYTES,
                   chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write pages as a folder of WARC files, replacing what is there."""
    ready = with_targets(pages, page_id, url, payload, revisit_bytes)

    def run(batches):
        part = TaskContext.get().partitionId()
        count = 0
        for block in blocks(batches, "_text"):
            out = []
            for row in block.to_pylist():
                record_id = f"urn:page:{part}:{count}"
                count += 1
                page = (row["_page"], row["_url"], row["_sha1"])
                if row["_target"] is None:
                    out += page_records(page, row["_text"], record_id, segment_bytes, chunk_bytes)
                else:
                    out.append(revisit_record(page, row["_size"], record_id, tuple(row["_target"].values())))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    # The cast only renames the type: the bytes of a record go to the file as they are.
    rows = ready.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    rows.write.mode("overwrite").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", FILE_RECORDS).option(
        "compression", "gzip"
    ).text(path)


_PARSED = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, "
    "payload binary, origin string, segment int, total bigint, block binary"
)


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def _parsed(record: Record) -> tuple:
    """A record as a row of ``_PARSED``; segments keep their block, others are decoded."""
    fields = record.fields
    kind = fields["warc-type"]
    algorithm, _, digest = fields["warc-payload-digest"].partition(":")
    if algorithm != "sha1":
        raise ValueError(f"digest {algorithm}")
    sha1 = base64.b32decode(digest).hex()
    page = (_number(fields.get("warc-page-id")), fields.get("warc-target-uri"))
    number = fields.get("warc-segment-number")
    if number is not None:
        origin = fields.get("warc-segment-origin-id", fields["warc-record-id"])
        total = _number(fields.get("warc-segment-total-length"))
        return (*page, kind, None, sha1, None, None, origin, int(number), total, record.block)
    if kind == "revisit":
        http = parse_headers(record.block.partition(END)[2])
        target = _number(fields.get("warc-refers-to-page-id"))
        return (*page, kind, target, sha1, int(http["content-length"]), None, None, None, None, None)
    payload = message_payload(record.block, sha1)
    return (*page, kind, None, sha1, len(payload), payload, None, None, None, None)


def message_payload(message: bytes, sha1: str) -> bytes:
    """The decoded body of an HTTP message, checked against the digest of its record."""
    head, _, body = message.partition(END + END)
    fields = parse_headers(head.partition(END)[2])
    if fields.get("transfer-encoding", "").lower() == "chunked":
        body = dechunked(body)
    if hashlib.sha1(body).hexdigest() != sha1:
        raise ValueError("a payload does not have the digest of its record")
    return body


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page: ``(page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload)``.

    A revisit has the digest and size of the payload it stands for and no payload of its own.
    """
    schema = StructType.fromDDL(_PARSED)
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    arrow = [kinds[field.dataType.simpleString()] for field in schema.fields]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(arrow)]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def parse(batches):
        for files in batches:
            for content in files.column("content"):
                rows, size = [], 0
                for record in records(gzip.decompress(content.as_py())):
                    if record.fields["warc-type"] in ("response", "revisit", "continuation"):
                        rows.append(_parsed(record))
                        size += len(record.block)
                    if size > 4_000_000:
                        yield batch(rows)
                        rows, size = [], 0
                yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    parsed = files.mapInArrow(parse, schema)
    result = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    whole = parsed.filter("segment IS NULL").select(*result)
    return whole.unionByName(_reassembled(parsed.filter("segment IS NOT NULL"), result))


def _reassembled(segments: DataFrame, columns: list[str]) -> DataFrame:
    """Segments grouped by origin, in order, complete, of the right length, and decoded."""
    origin = F.max_by(F.struct("page_id", "url", "record_type", "payload_digest"), -F.col("segment")).alias("first")
    grouped = segments.groupBy("origin").agg(
        origin, F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts")
    )
    schema = StructType.fromDDL("first struct<page_id: bigint, url: string, record_type: string, payload_digest: string>, payload binary")

    def join(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                numbers = [part["segment"] for part in row["parts"]]
                message = b"".join(part["block"] for part in row["parts"])
                if numbers != list(range(1, len(numbers) + 1)) or row["total"] != len(message):
                    raise ValueError(f"{row['origin']}: segments {numbers} of {len(message)} bytes, not {row['total']}")
                payload = message_payload(message, row["first"]["payload_digest"])
                yield pa.RecordBatch.from_arrays(
                    [batch.slice(i, 1).column("first"), pa.array([payload], pa.binary())], names=schema.names
                )

    joined = grouped.mapInArrow(join, schema).select("first.*", "payload")
    return joined.select(
        "page_id", "url", "record_type", F.lit(None).cast("bigint").alias("refers_to"), "payload_digest",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"), "payload",
    ).select(*columns)
