"""WARC archives with an index that is written first and read by coalesced byte ranges.

Writing: payload digests are grouped over all pages, so that of equal payloads the smallest id is
the response and the others revisit it.  Each task then streams its pages into gzip archives (one
member per record) in the shared folder and returns an index row per record: archive, offset,
length, URL, digest.  The index is a written table; archives of lost or repeated attempts have
names of their own and are in no index.

Reading: the selected index rows are sorted by archive and offset and coalesced, inside segments of
bounded size, into byte ranges that skip at most ``gap`` unwanted bytes; tasks read a range with one
request and parse its records.

Null payloads are empty.  Payloads shorter than ``min_bytes`` are always responses.  Rows with the
same smallest id and payload are all responses; null ids come last, and if all ids of a payload are null
all are responses.  An empty table writes no archive.  The shared folder must have a scheme that
``pyarrow.fs`` reads (file, hdfs, s3, gs).
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.session import scratch_path

INDEX = (
    "page_id long, url string, archive string, offset long, length long, digest string, "
    "record_type string, refers_to long"
)
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary, intact boolean"
)
_END = b"\r\n"


def _safe(url: str | None) -> str:
    """A URL that fits one header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC/1.1 record; a revisit has the response's header but no payload."""
    http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload)]
    block = _END.join(http) + _END * 2 + (b"" if refers_to is not None else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {_safe(url)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return _END.join(h.encode() for h in head) + _END * 2 + block + _END * 2


def _packed(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse_record(member: bytes) -> dict:
    """Fields of one gzip member; ``intact`` tells whether the payload has its digest."""
    data = zlib.decompress(member, 31)
    head, block = data.split(_END * 2, 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, payload = block.split(_END * 2, 1)
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"

    def page(name: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))
        return int(found[1]) if found else None

    return {
        "page_id": page("WARC-Record-ID"),
        "payload_bytes": len(payload) if response else size,
        "payload_digest": base32_sha1(payload) if response else digest,
        "record_type": fields["WARC-Type"],
        "refers_to": page("WARC-Refers-To"),
        "payload": payload if response else None,
        "intact": not response or (base32_sha1(payload) == digest and size == len(payload)),
    }


def decided(pages: DataFrame, id: str, url: str, payload: str, min_bytes: int) -> DataFrame:
    """(page_id, url, payload, refers_to): what each page's record refers to, null for responses.

    Only ids and digests are grouped and only revisits are joined back; equal payloads are counted
    in partial minima.
    """
    rows = pages.select(
        F.col(f"`{id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    firsts = (
        rows.filter(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1 and first_id is not null")
        .select(F.col("digest").alias("same"), "first_id")
    )
    small = rows.select("page_id", "digest")
    revisits = (
        small.join(firsts, small["digest"] == firsts["same"])
        .filter(~F.col("page_id").eqNullSafe(F.col("first_id")))
        .select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "first_id")
        .distinct()
    )
    return rows.join(
        revisits, rows["page_id"].eqNullSafe(F.col("p")) & (rows["digest"] == F.col("d")), "left"
    ).select("page_id", "url", "payload", F.col("first_id").alias("refers_to"))


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = 0,
    archive_bytes: int = 256 << 20,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write the archives and their index under ``folder``; returns the index as read back."""
    folder = folder or scratch_path(pages.sparkSession, "warc")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(f"{folder}/archives")
        store.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        for b in batches:
            made = []
            for row in b.to_pylist():
                if out is None or at >= archive_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                digest = base32_sha1(row["payload"])
                member = _packed(record(row["page_id"], row["url"], row["payload"], digest, row["refers_to"], date))
                out.write(member)
                kind = "response" if row["refers_to"] is None else "revisit"
                made.append((row["page_id"], row["url"], name, at, len(member), digest, kind, row["refers_to"]))
                at += len(member)
            if made:
                yield _batch(made, INDEX)
        if out is not None:
            out.close()

    decided(pages, id, url, payload, min_bytes).mapInArrow(scan, INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.parquet(f"{folder}/index").withColumn("folder", F.lit(folder))


_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def coalesced(places: list[tuple[int, int]], gap: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """(begin, end, places) of byte ranges over places (offset, length) sorted by offset."""
    ranges: list[tuple[int, int, list]] = []
    for at, size in places:
        if ranges and at - ranges[-1][1] <= gap:
            begin, end, held = ranges[-1]
            held.append((at, size))
            ranges[-1] = (begin, max(end, at + size), held)
        else:
            ranges.append((at, at + size, [(at, size)]))
    return ranges


def read_records(
    selected: DataFrame, gap: int = 64 << 10, segment_bytes: int = 8 << 20, with_payload: bool = True
) -> DataFrame:
    """The records of the selected index rows, parsed from their archives."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORDS.split(", ")]
        for b in batches:
            for segment in b.to_pylist():
                store, path = fs.FileSystem.from_uri(f"{segment['folder']}/archives/{segment['archive']}")
                places = sorted((p["offset"], p["length"], p["url"]) for p in segment["places"])
                urls = {at: url for at, _, url in places}
                made = []
                with store.open_input_file(path) as file:
                    for begin, end, held in coalesced([p[:2] for p in places], gap):
                        file.seek(begin)
                        data = file.read(end - begin)
                        for at, size in held:
                            found = parse_record(data[at - begin : at - begin + size]) | {"url": urls[at]}
                            if not with_payload:
                                found["payload"] = None
                            made.append(tuple(found[n] for n in names))
                yield _batch(made, RECORDS)

    segments = selected.groupBy(
        "folder", "archive", F.floor(F.col("offset") / segment_bytes).alias("segment")
    ).agg(F.collect_list(F.struct("offset", "length", F.coalesce("url", F.lit("")).alias("url"))).alias("places"))
    return segments.mapInArrow(scan, RECORDS)
