"""Web archives (WARC 1.1): index first, then sorted and coalesced byte-range reads.

``write_archives`` turns pages into archive files in a shared folder and returns an index:
one row per record with its archive, offset, length, URL and payload digest.  Each task
writes files of its own name, so a task that runs twice leaves at most an unread file; only
the archives that the index names count.  ``read_records`` takes any selection of index
rows, sorts the ranges of each archive, joins neighbours into one read and parses them.

Records with the same payload of at least ``least_bytes`` bytes are stored once: the one
with the largest page_id is a response, the others are revisits that refer to it.

Defined cases: a null html is an empty payload; rows that share the largest page_id of a
payload are all responses; rows without page_id are responses and nobody refers to them; a
null URL is the empty one; an empty table gives an empty index; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwright.llm.common import new_folder, stage

INDEX = (
    "archive string, offset long, length long, url string, digest string, page_id long, record_type string, "
    "refers_to long"
)
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary"
)
SMALL_ROWS = 200_000  # of 60 bytes: payloads with copies are broadcast up to this many
GAP = 64 << 10
CHUNK = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_folder(folder: str):
    """The file system of a folder and the folder's path there."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(),
        folder,
    )
    return system, path


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id}|{digest}'.encode()).hexdigest())}>"


def _uri(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url or "")


def _format(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page_id, digest),
        "WARC-Date": date,
        "WARC-Target-URI": _uri(url),
        "WARC-Payload-Digest": f"sha1:{digest}",
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _record_id(refers_to, digest)}
        fields |= {"X-Refers-To-Page": str(refers_to)}
    if page_id is not None:
        fields["X-Page"] = str(page_id)
    fields |= {"Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(record: bytes) -> dict:
    """The fields and the payload of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page"),
        "url": fields["WARC-Target-URI"],
        "record_type": kind,
        "refers_to": number("X-Refers-To-Page"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def responses(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Payload digests that occur more than once, each with the page that keeps the payload."""
    html = F.coalesce("html", F.lit(""))
    return (
        pages.filter(F.octet_length(html) >= least_bytes)
        .groupBy(F.sha1(html.cast("binary")).alias("same_digest"))
        .agg(F.max("page_id").alias("kept_page"), F.count("*").alias("copies"))
        .filter("copies > 1 AND kept_page IS NOT NULL")
        .select("same_digest", "kept_page")
    )


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 1000, date: str = "2000-01-01T00:00:00Z"
) -> DataFrame:
    """Write every page as a record below ``folder``; the index, itself written there."""
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    same = stage(responses(pages, least_bytes), "warc-copies")
    if same.count() <= SMALL_ROWS:
        same = F.broadcast(same)
    rows = pages.withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    long_enough = F.octet_length("html") >= least_bytes
    rows = rows.join(same, (F.col("digest") == F.col("same_digest")) & long_enough, "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        F.when(F.col("page_id") < F.col("kept_page"), F.col("kept_page")).alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        archive, out, offset = "", None, 0
        schema = pa.schema(
            [("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string())]
            + [("digest", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        )
        for batch in batches:
            if out is None:
                archive = f"{uuid.uuid4().hex}.warc"
                system.create_dir(path, recursive=True)
                out = system.open_output_stream(f"{path}/{archive}")
            index = []
            columns = [batch.column(n) for n in ("page_id", "url", "html", "digest", "refers_to")]
            for values in zip(*columns):
                page_id, url, html, digest, refers_to = (v.as_py() for v in values)
                record = _format(page_id, url, html.encode(), digest, refers_to, date)
                out.write(record)
                kind = "response" if refers_to is None else "revisit"
                index.append((archive, offset, len(record), url, digest, page_id, kind, refers_to))
                offset += len(record)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*index), schema.types)] if index else [[]] * 8, schema=schema
            )
        if out is not None:
            out.close()

    return stage(rows.mapInArrow(write, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that ``index`` names, parsed and checked against their digests."""
    ordered = (
        index.select("archive", "offset", "length")
        .repartition("archive", F.floor(F.col("offset") / (64 << 20)))
        .sortWithinPartitions("archive", "offset")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        opened, source = None, None
        for batch in batches:
            ranges = list(zip(*(batch.column(n).to_pylist() for n in ("archive", "offset", "length"))))
            i = 0
            while i < len(ranges):
                archive, start, length = ranges[i]
                j, end = i + 1, start + length
                while j < len(ranges) and ranges[j][0] == archive and ranges[j][1] - end <= GAP:
                    if max(end, ranges[j][1] + ranges[j][2]) - start > CHUNK:
                        break
                    end = max(end, ranges[j][1] + ranges[j][2])
                    j += 1
                if opened != archive:
                    source, opened = system.open_input_file(f"{path}/{archive}"), archive
                chunk = source.read_at(end - start, start)
                records = [parse(chunk[o - start : o - start + n]) for _, o, n in ranges[i:j]]
                if not with_payload:
                    for record in records:
                        record["payload"] = None
                yield pa.RecordBatch.from_pylist(records, schema=_RECORD_SCHEMA)
                i = j

    return ordered.mapInArrow(read, RECORD)


_RECORD_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)


def new_archive_folder(pages: DataFrame) -> str:
    return new_folder(pages.sparkSession, "warc")
