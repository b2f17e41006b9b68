"""WARC archives: pages written as records, and archives read record by record.

Each record is one gzip member. Of equal payloads the page with the smallest id is a `response`
record; the others are `revisit` records that name it and carry no payload. Archives
are written by Spark's text writer, so its commit protocol holds when a task runs again and any
file system that Spark writes to will do: a row is one member without its last byte,
and the row separator is that byte. A member ends with its size, whose last byte is
zero below 16 MiB; a larger member is kept whole, and the separator is then a padding zero,
which gzip readers skip.

Repeats are found from digests and ids alone, and only payloads that repeat are looked up again: the others are written where they are
read. Pages are written by size, so that a file holds a bounded number of bytes and a large page changes no other page's file.

The reader walks through an archive once: it inflates one member at a time in small
steps, takes the record's header lines, exactly as many bytes as its Content-Length
says, and the two empty lines after them, and compares the payload's SHA-1 with the
recorded digest. Anything else raises. A large archive is read in steps from a file system that pyarrow can open.

Cases: a null html is the empty payload, which is equal to other empty payloads. Repeated rows give a
record each; rows with the smallest id of their payload are all responses. A null id counts after all
others and is read back as null; a null url is read back as an empty one. Payloads below
`revisit_from` bytes are always responses. An empty table gives no records.
Other columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm.columns import named
from cadastra.scratch import written

#: Bytes of payloads in one archive file, at most, before compression, and records.
FILE_BYTES, RECORDS_PER_FILE = 256 << 20, 4_096
#: Pages are written by sizes: payloads up to so many bytes together; above the last, each is a file.
SIZES = (64 << 10, 1 << 20, 16 << 20)
#: Bytes of an archive that is read as one value; a larger one is streamed from its file system.
WHOLE_BYTES = 128 << 20
#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN_AT = "2024-01-01T00:00:00Z"
#: An address that would break its header line is written in percent code under a name of its own.
_URL, _ESCAPED, _CONTROL = "WARC-Target-URI", "X-Escaped-Target-URI", re.compile(r"[\x00-\x1f\x7f]|^\s|\s$")
_STEP = 64 * 1024
READ_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)


def digest(payload: bytes) -> str:
    """SHA-1 as bare upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def member(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool) -> bytes:
    """One record as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    address = f"{_ESCAPED}: {quote(url)}" if _CONTROL.search(url or "") else f"{_URL}: {url or ''}"
    head = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_uri(page_id)}",
        f"WARC-Date: {WRITTEN_AT}",
        address,
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += [f"WARC-Refers-To: {_uri(first)}", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", revisit_from: int = 0) -> None:
    """Write all pages as archives below `path`."""
    spark = pages.sparkSession
    payload = F.coalesce(named(html), F.lit("")).cast("binary")
    ident = named(page_id).cast("long").alias("page_id")
    # Stored first, so Catalyst knows its size: only a large table of repeats makes it shuffle payloads.
    repeated = written(
        pages.select(ident, F.sha1(payload).alias("key"), F.octet_length(payload).alias("size"))
        .where(F.col("size") >= revisit_from).groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull()).select("key", "first"), "repeated",
    )
    rows = pages.select(ident, named(url).alias("url"), payload.alias("payload"), F.sha1(payload).alias("key"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = rows.join(repeated, "key", "left").withColumn("revisit", revisit)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                own = None if pd.isna(row.page_id) else int(row.page_id)
                first_id = None if pd.isna(row.first) else int(row.first)
                data = member(own, row.url, bytes(row.payload), first_id, bool(row.revisit))
                out.append(data[:-1] if data[-1] == 0 else data)
            yield pd.DataFrame({"record": out})

    length = F.octet_length("payload")
    limits = (-1, *SIZES, None)
    classes = list(zip(limits, limits[1:], strict=False))
    inside = [(length > low) if high is None else (length > low) & (length <= high) for low, high in classes]
    held = rows.agg(*(F.count_if(condition) for condition in inside)).first()
    for (_, high), condition, count in zip(classes, inside, held, strict=True):
        if count or (high == SIZES[0] and not any(held)):
            packed = joined.where(condition).select("page_id", "url", "payload", "first", "revisit").mapInPandas(pack, "record binary")
            records = 1 if high is None else max(1, min(RECORDS_PER_FILE, FILE_BYTES // high))
            lines = packed.select(F.col("record").cast("string").alias("value"))
            lines.write.mode("append").option("lineSep", "\0").option("maxRecordsPerFile", records).text(path)


def _members(source: io.BufferedIOBase) -> Iterator[bytes]:
    """The inflated content of each gzip member, one at a time."""
    rest = b""
    while True:
        rest = rest.lstrip(b"\0")
        while not rest:
            if not (rest := source.read(_STEP)):
                return
            rest = rest.lstrip(b"\0")
        unpacker, out = zlib.decompressobj(31), []
        while not unpacker.eof:
            rest = rest or source.read(_STEP)
            out.append(unpacker.decompress(rest, _STEP))
            if not rest and not out[-1] and not unpacker.eof:
                raise ValueError("the archive ends inside a record")
            rest = unpacker.unconsumed_tail or unpacker.unused_data
        yield b"".join(out)


def read_records(source: io.BufferedIOBase) -> Iterator[tuple]:
    """The records of an archive, in order; raises where one is not whole."""
    for content in _members(source):
        head, found, body = content.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not found or lines[0] != VERSION:
            raise ValueError("a record does not start with its version")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        length = int(fields["Content-Length"])
        block, end = body[:length], body[length:]
        if len(block) != length or end != b"\r\n\r\n":
            raise ValueError("a record's length differs from its Content-Length")
        if f"sha1:{digest(block)}" != fields["WARC-Block-Digest"]:
            raise ValueError("a record's block does not have its digest")
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
        recorded = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = fields["WARC-Type"] == "revisit"
        if not revisit and (len(payload) != size or digest(payload) != recorded):
            raise ValueError("a payload does not have its recorded length and digest")
        yield (
            _page_id(fields["WARC-Record-ID"]), fields[_URL] if _URL in fields else unquote(fields[_ESCAPED]), fields["WARC-Type"],
            _page_id(fields["WARC-Refers-To"]) if revisit else None, size, recorded, None if revisit else payload,
        )


def _batches(source: io.BufferedIOBase) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in READ_SCHEMA.split(", ")]
    rows, held = [], 0
    for record in read_records(source):
        rows.append(record)
        held += len(record[-1] or b"")
        if held > 8 << 20:
            yield _frame(rows, names)
            rows, held = [], 0
    if rows:
        yield _frame(rows, names)


def read_archives(spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """Every record of the archives below `path`; a revisit has no payload of its own."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                yield from _batches(io.BytesIO(content))

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for name in batch["path"]:
                system, inner = fs.FileSystem.from_uri(name)
                with system.open_input_stream(inner, compression=None) as source:
                    yield from _batches(source)

    files = spark.read.format("binaryFile").load(path)
    found = files.where(F.col("length") <= whole_bytes).select("content").mapInPandas(unpack, READ_SCHEMA)
    large = files.where(F.col("length") > whole_bytes).select("path")
    return found.union(large.mapInPandas(stream, READ_SCHEMA))


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
