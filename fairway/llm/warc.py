"""WARC archives: a writer with payload deduplication and a splittable reader.

*Writer.* One gzip member for each record. Of pages with equal payloads (of at
least ``least_bytes`` bytes) the one with the smallest id is a ``response``, the
others are ``revisit`` records that name it. Tasks write files of their own name
into a shared folder; only the files of successful tasks are in the returned
manifest, so repeated or lost tasks leave at most files that nobody reads.

*Reader.* Files are cut into byte ranges of any size. A task scans its range for
the gzip magic, validates each candidate by decoding the member's first bytes
(they must be a WARC version line) and owns the records that start inside; it
reads on past the end of its range to finish the last one. Bytes of a member
that started in an earlier range are passed over, since no position in them
decodes to a record. Memory is one read buffer and one record.

Defined cases: a null html is an empty payload, a null url gives no target
URI; line breaks in urls are percent-encoded; pages without an id come after all
others (they refer to the smallest id, or are responses when none has an id);
repeated rows of the smallest id are all responses; no rows give no archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairway.llm.staging import parts, shared_folder, ship, stage

MAGIC = b"\x1f\x8b\x08"
ARCHIVE_BYTES = 64 << 20
RANGE_BYTES = 8 << 20
READ_BYTES = 1 << 20
# Reading tasks at most, for each of the session's shuffle partitions.
READ_TASKS = 4
# Repeated payloads sent to all tasks at most (about 100 bytes each).
BROADCAST_GROUPS = 100_000
_URN = "urn:x-page:"
_DATE = "1970-01-01T00:00:00Z"   # pages carry no crawl date
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed WARC record."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
            "\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<{_URN}{'' if page_id is None else page_id}>"), ("WARC-Date", _DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    head.append(("WARC-Payload-Digest", "sha1:" + payload_digest(payload)))
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<{_URN}{refers_to}>"), ("WARC-Profile", _PROFILE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives; returns the manifest
    (path, bytes, records)."""
    spark = pages.sparkSession
    ship(spark)
    folder = folder or shared_folder(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"),
                        F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.encode("html", "UTF-8"))))
    groups = stage(rows.select("page_id", "digest", F.octet_length("html").alias("size")).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
        .where((F.col("n") > 1) & (F.col("size") >= least_bytes) & F.col("first").isNotNull())
        .select("digest", "first"), "payloads")
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    rows = rows.join(groups, "digest", "left").select("page_id", "url", "html", F.when(
        F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]):
        fs, base = _filesystem(folder)
        out, path, size, records = None, "", 0, 0
        done = []
        for batch in batches:
            for page, url, html, first in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    fs.create_dir(base, recursive=True)
                    path, out, size, records = f"{folder.rstrip('/')}/{name}", fs.open_output_stream(
                        f"{base.rstrip('/')}/{name}", compression=None), 0, 0
                member = zlib.compressobj(4, zlib.DEFLATED, 31)
                data = member.compress(record(page, url, html.encode(), first)) + member.flush()
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((path, size, records))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, records))
        if done:
            yield pa.record_batch([pa.array(x) for x in zip(*done)], names=["path", "bytes", "records"])

    return stage(rows.mapInArrow(write, "path string, bytes long, records long"), "manifest")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    fields = {k.lower(): v for k, v in fields.items()}
    return fields, rest[:int(fields["content-length"])]


class _Window:
    """Forward reads of one file from a position, in buffers."""

    def __init__(self, file, at: int):
        self.file, self.at, self.data = file, at, b""

    def more(self) -> bool:
        got = self.file.read_at(READ_BYTES, self.at + len(self.data))
        self.data += got
        return bool(got)

    def drop(self, n: int) -> None:
        self.data, self.at = self.data[n:], self.at + n


def _member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """Decode the member at offset ``at`` of the window: its bytes and its
    compressed length, or None when it isn't a WARC record."""
    decoder, out, used = zlib.decompressobj(31), [], 0
    known = b""
    while True:
        chunk = window.data[at + used:]
        if not chunk:
            if not window.more():
                return None
            continue
        try:
            piece = decoder.decompress(chunk if known[:5] == b"WARC/" else chunk[:4096])
        except zlib.error:
            return None
        taken = len(chunk if known[:5] == b"WARC/" else chunk[:4096]) - len(decoder.unused_data)
        used += taken
        out.append(piece)
        if len(known) < 5:
            known += piece[:5 - len(known)]
            if known != b"WARC/"[:len(known)]:
                return None
        if decoder.eof:
            return (b"".join(out), used) if known == b"WARC/" else None


def records_in(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(position, record bytes) of all records that start in [start, end)."""
    window = _Window(file, start)
    while window.at < end:
        found = window.data.find(MAGIC)
        if found < 0:
            window.drop(max(0, len(window.data) - 2))  # a magic may lie across two reads
            if not window.more():
                return
            continue
        if window.at + found >= end:
            return
        window.drop(found)
        got = _member(window, 0)
        if got is None:
            window.drop(1)
            continue
        yield window.at, got[0]
        window.drop(got[1])


def read_archives(spark: SparkSession, manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the manifest's archives: path, position, fields of the
    header, and payload (null for revisits)."""
    ship(spark)
    ranges = manifest.select("path", F.col("bytes"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
        .alias("start"))
    # a numbered range partitioning: adaptive execution would merge these few small
    # rows into one task, and hashing would leave tasks without a range
    ranges = stage(ranges, "ranges")
    tasks = max(1, min(ranges.count(), READ_TASKS * parts(spark)))
    ranges = ranges.repartitionByRange(tasks, "path", "start")

    def read(batches: Iterator[pa.RecordBatch]):
        names = ["path", "position", "record_id", "type", "uri", "digest", "refers_to", "payload_bytes", "payload"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(),
                 pa.binary()]

        def send(rows):
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for path, size, start in zip(*[batch.column(c).to_pylist() for c in ("path", "bytes", "start")]):
                fs, place = _filesystem(path)
                rows, held = [], 0
                with fs.open_input_file(place) as file:
                    for at, data in records_in(file, start, min(start + range_bytes, size)):
                        fields, block = parse(data)
                        head, _, payload = block.partition(b"\r\n\r\n")
                        size_of = next((int(x.split(b":")[1]) for x in head.split(b"\r\n")
                                        if x.lower().startswith(b"content-length:")), len(payload))
                        revisit = fields["warc-type"] == "revisit"
                        rows.append((path, at, fields["warc-record-id"].strip("<>"), fields["warc-type"],
                                     fields.get("warc-target-uri"), fields.get("warc-payload-digest"),
                                     fields.get("warc-refers-to", "").strip("<>") or None, size_of,
                                     None if revisit else payload))
                        held += len(data)
                        if held >= 8 << 20:
                            yield send(rows)
                            rows, held = [], 0
                if rows:
                    yield send(rows)

    return ranges.mapInArrow(read, "path string, position long, record_id string, type string, uri string, "
                                   "digest string, refers_to string, payload_bytes long, payload binary")


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` and read them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to. A response's digest is computed from
    the payload read; a payload that differs from its header fails the job."""
    records = read_archives(pages.sparkSession, write_archives(pages))

    def check(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            digest = []
            for stated, payload in zip(batch.column("digest").to_pylist(), batch.column("payload").to_pylist()):
                own = stated.removeprefix("sha1:") if payload is None else payload_digest(payload)
                if stated != f"sha1:{own}":
                    raise ValueError(f"payload digest {own} differs from {stated}")
                digest.append(own)
            yield pa.record_batch([batch.column("record_id"), batch.column("payload_bytes"), pa.array(digest, pa.string()),
                                   batch.column("type"), batch.column("refers_to")],
                                  names=["record_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    number = lambda c: F.expr(f"try_cast(substring({c}, {len(_URN) + 1}) AS bigint)")
    return records.mapInArrow(check, "record_id string, payload_bytes long, payload_digest string, record_type string, "
                                     "refers_to string").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"))
