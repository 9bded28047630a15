"""WARC archives: a writer with revisit records, and a reader that salvages damaged archives.

An archive is a row ``path, content`` as Spark's binary file reader gives it, so that archives can
lie in any store that Spark reads; the writer keeps them in Parquet.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Compressed bytes after which an archive ends.
ARCHIVE_BYTES = 4 << 20
#: Bytes given to the decompressor at a time.
FEED = 1 << 16
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-30T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"
BEGIN = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n")
VERSION_LINE = re.compile(rb"WARC/\d\.\d\r\n")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def record(key, url, payload: bytes, refers_to) -> bytes:
    """One record: HTTP headers and payload of a response, the headers alone of a revisit."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if kind == "response" else b"")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(key)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", re.sub(r"[\r\n]", "", url or "")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, wbits=31)
    return packer.compress(data) + packer.flush()


def with_first(
    pages: DataFrame, key: str, url: str, payload: str, revisit_from: int
) -> DataFrame:
    """``key, url, payload, refers_to``: the smallest key of the same payload, null if it is it."""
    rows = pages.select(
        F.col(key).cast("long").alias("key"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    first = rows.groupBy("sha").agg(F.min("key").alias("first"))
    shared = (F.octet_length("payload") >= revisit_from) & ~F.col("key").eqNullSafe(F.col("first"))
    return rows.join(first, "sha").select(
        "key", "url", "payload", F.when(shared, F.col("first")).alias("refers_to")
    )


def write_warc(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    revisit_from: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write one record a row, each a gzip member, into archives below ``path``.

    Of rows with equal payloads of at least ``revisit_from`` bytes, those with the smallest key are
    responses and the others revisit it; rows of shorter payloads are all responses. A null payload
    is empty, a null address is empty. A row without a key revisits the smallest key of its payload,
    or is a response where there is none. Repeated rows are each written. An empty table writes no
    archive; other columns are not read.
    """

    def archives(batches):
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append(
                    member(record(row["key"], row["url"], row["payload"], row["refers_to"]))
                )
                size += len(held[-1])
                if size >= archive_bytes:
                    yield archive(part, number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield archive(part, number, held)

    def archive(part, number, held):
        name = f"part-{part:05d}-{number:05d}.warc.gz"
        return pa.RecordBatch.from_pydict(
            {"path": [name], "content": pa.array([b"".join(held)], pa.binary())}
        )

    rows = with_first(pages, key, url, payload, revisit_from)
    rows.mapInArrow(archives, "path string, content binary").write.parquet(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("path string, content binary").parquet(path)


class Damaged(Exception):
    pass


def inflate(data: memoryview, at: int) -> tuple[bytes, int, str | None]:
    """The content of the gzip member at ``at``, as far as it inflates, its end, and what broke it."""
    unpacker, out, fed, broken = zlib.decompressobj(wbits=31), [], at, None
    try:
        while not unpacker.eof and fed < len(data):
            out.append(unpacker.decompress(data[fed : fed + FEED]))
            fed = min(fed + FEED, len(data))
    except zlib.error:
        # The piece that failed gave nothing; bytewise it gives what lies before the break.
        broken = "member does not inflate"
        unpacker, out = zlib.decompressobj(wbits=31), []
        for begin in range(at, fed, FEED):
            out.append(unpacker.decompress(data[begin : min(begin + FEED, fed)]))
        try:
            for i in range(fed, min(fed + FEED, len(data))):
                out.append(unpacker.decompress(data[i : i + 1]))
        except zlib.error:
            fed = i
    if broken is None and not unpacker.eof:
        broken = "member is cut off"
    return b"".join(out), fed - len(unpacker.unused_data), broken


def parse(data: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at``, checked by its length, its end mark and its digests, and its end."""
    if not VERSION_LINE.match(data, at):
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damaged("header without an end")
    fields = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, mark, value = line.partition(b":")
        if not mark:
            raise Damaged("header line without a name")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    try:
        size = int(fields["content-length"])
    except (KeyError, ValueError):
        raise Damaged("no content length") from None
    begin = end + 4
    stop = begin + size
    if size < 0 or data[stop : stop + 4] != b"\r\n\r\n":
        raise Damaged("no end mark behind the content")
    block = data[begin:stop]
    said = fields.get("warc-block-digest", "").removeprefix("sha1:")
    if said and said != digest(block):
        raise Damaged("block digest differs")
    http, mark, payload = block.partition(b"\r\n\r\n")
    if not mark or not http.startswith(b"HTTP/"):
        http, payload = b"", block
    kind = fields.get("warc-type")
    said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    length = len(payload)
    if kind == "revisit":
        told = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        length = int(told[1]) if told else None
    elif said and said != digest(payload):
        raise Damaged("payload digest differs")
    return {
        "record_id": fields.get("warc-record-id"),
        "record_type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": said or digest(payload),
        "payload_bytes": length,
        "payload": None if kind == "revisit" else payload,
    }, stop + 4


def records(data: bytes):
    """Records of plain bytes, and the gaps between them: (offset, end, record or None, reason)."""
    at, gap, reason = 0, None, None
    while at < len(data):
        try:
            one, end = parse(data, at)
        except Damaged as error:
            if gap is None:
                gap, reason = at, str(error)
            following = VERSION_LINE.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield gap, at, None, reason
            gap = None
        yield at, end, one, None
        at = end
    if gap is not None:
        yield gap, at, None, reason


def salvage(content: bytes):
    """Records of an archive, and its gaps: (offset, length, record or None, reason).

    Where a check fails, the search goes on at the next gzip member or version line from which a
    whole valid record can be read; the bytes in between are one gap with the first reason. Inside a
    gzip member it goes on at the next version line of the inflated bytes; records and gaps there
    have the offset and length of the member. Of a member that breaks, the records before the break
    are kept, unless it has just one; the search goes on in its bytes, which are a gap as well.
    """
    view, at, gap, reason = memoryview(content), 0, None, None
    while at < len(content):
        packed, broken, why = content.startswith(MAGIC, at), None, None
        if packed:
            data, end, broken = inflate(view, at)
            found = list(records(data))
            if broken is not None:
                # What lies behind the last whole record is part of the break.
                while found and found[-1][2] is None:
                    found.pop()
                # A record that fills its member is quarantined with it, as the member's check fails.
                if len(found) == 1 and found[0][:2] == (0, len(data)):
                    found = []
            elif not any(one for _, _, one, _ in found):
                why = found[0][3] if found else None
                found = []
            why = broken if broken is not None and not found else why
            bad = why is not None
        else:
            try:
                one, end = parse(content, at)
                found, bad = [(0, 0, one, None)], False
            except Damaged as error:
                why, bad = str(error), True
        if bad:
            if gap is None:
                gap, reason = at, why
            following = BEGIN.search(content, at + 1)
            at = following.start() if following else len(content)
            continue
        if gap is not None:
            yield gap, at - gap, None, reason
            gap = None
        if broken is not None:
            # Records kept from a broken member; its other bytes are searched for whole members.
            following = BEGIN.search(content, at + 1)
            while following and following.start() < end and not starts(view, following.start()):
                following = BEGIN.search(content, following.start() + 1)
            end = following.start() if following else len(content)
        for _, _, one, why in found:
            yield at, end - at, one, why
        if broken is not None:
            yield at, end - at, None, broken
        at = end
    if gap is not None:
        yield gap, at - gap, None, reason


def starts(data: memoryview, at: int) -> bool:
    """Whether a valid record, plain or in a member, begins at ``at``."""
    if bytes(data[at : at + len(MAGIC)]) == MAGIC:
        return any(one for _, _, one, _ in records(inflate(data, at)[0]))
    try:
        return bool(parse(bytes(data[at:]), 0))
    except Damaged:
        return False


FOUND = {
    "path": "string",
    "offset": "long",
    "length": "long",
    "gap_reason": "string",
    "record_id": "string",
    "record_type": "string",
    "target_uri": "string",
    "refers_to": "string",
    "payload_digest": "string",
    "payload_bytes": "long",
    "payload": "binary",
}
ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def read_warc(archives: DataFrame) -> DataFrame:
    """Every record of archives ``path, content``, and every quarantined gap of bytes.

    A gap has a ``gap_reason`` and no record columns; ``offset`` and ``length`` are bytes of the
    archive. Null and empty archives give no row, and other columns are not read.
    """

    def run(batches):
        schema = pa.schema([(n, ARROW[k]) for n, k in FOUND.items()])
        for batch in batches:
            for path, content in zip(*(c.to_pylist() for c in batch.columns)):
                rows = [
                    {"path": path, "offset": at, "length": n, "gap_reason": why, **(one or {})}
                    for at, n, one, why in salvage(content or b"")
                ]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = ", ".join(f"{n} {k}" for n, k in FOUND.items())
    return archives.select(F.col("path"), F.col("content").cast("binary")).mapInArrow(run, schema)


def page_records(found: DataFrame) -> DataFrame:
    """One row a page from the records that were read."""
    number = r"<urn:page:(-?[0-9]+)>"
    return found.where(F.col("gap_reason").isNull()).select(
        F.expr(f"try_cast(regexp_extract(record_id, '{number}', 1) AS BIGINT)").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.expr(f"try_cast(regexp_extract(refers_to, '{number}', 1) AS BIGINT)").alias("refers_to"),
    )
