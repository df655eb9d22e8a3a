"""WARC archives: a writer of one gzip member per record, and a splittable reader.

*Reader.*  Every archive is cut into byte ranges.  A task seeks to its range, looks for gzip
magic, and validates a candidate member by decoding its head: a WARC record must begin
there.  It owns the records whose members start inside its range and reads past the end to
finish the last one.  Magic bytes inside compressed data fail the validation and are skipped;
a valid member's end is known from its decoding, so its inside is never searched.  Members are
decoded in steps; a task holds one record at a time.

*Damage.*  A member that begins as a record and cannot be decoded to its end (cut off, or bits
changed) is a row of type ``damaged`` with its path and offset; reading goes on behind it.  One
that does not even begin as a record is not seen by the reader: ``missing`` compares the records
read with the manifest's, and ``round_trip`` fails if any is missing.

*Writer.*  Every task writes one archive under a name of its attempt; the manifest, kept in
shared storage, names the archives of attempts that counted, so a lost executor or a second
attempt leaves nothing that is read.

Equal payloads are stored once: of the records with equal payloads the one with the largest
page_id is the response, the others are revisits that refer to it (``min_bytes``: smaller
payloads are responses all).  Files are reached through ``pyarrow.fs``, which takes local
paths, HDFS and object stores by URI.

Null html is an empty payload.  A null url has no target line.  A null page_id counts as
smaller than all; rows that repeat the largest page_id of a payload are responses each.
Control characters in a url are percent-encoded.  An empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .storage import new_folder, saved

MAGIC = b"\x1f\x8b\x08"
RANGE_BYTES = 16 << 20
MOST_TASKS = 20_000  # a task reads several ranges beyond
READ_BYTES = 1 << 16
HEAD_BYTES = 1 << 12
SEND_BYTES = 1 << 21
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"  # records carry a fixed date, so reruns write equal bytes


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))


def digest_column(payload):
    """Upper-case base32 of the payload's SHA-1 (32 characters; 160 bits need no padding)."""
    hexed = F.sha1(payload)
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    # five hex digits are 20 bits, four base32 characters
    digits = [F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 10).cast("int") for k in range(8)]
    return F.concat(*(F.substring(alphabet, F.shiftright(d, s).bitwiseAND(31) + 1, 1) for d in digits for s in (15, 10, 5, 0)))


def write(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write (page_id, url, html) as archives into ``folder``; the manifest (path, records)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    keys = pages.select("page_id", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("bytes"))
    first = keys.where(F.col("bytes") >= min_bytes).groupBy("sha").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
    again = keys.join(first.where("n > 1"), "sha").where(F.col("bytes") >= min_bytes).where("NOT page_id <=> response").select(
        F.col("page_id").alias("id"), "response", "sha").distinct()
    # one row per revisit without its payload; the page itself is matched by id and payload
    rows = pages.join(again, pages["page_id"].eqNullSafe(again["id"]) & (F.sha1("payload") == again["sha"]), "left")
    rows = rows.select("page_id", "url", "payload", digest_column(F.col("payload")).alias("digest"),
                       F.col("sha").isNotNull().alias("revisit"), F.col("response").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        task = TaskContext.get()
        name, n, sink = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz", 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    fs.create_dir(root, recursive=True)
                    sink = fs.open_output_stream(f"{root}/{name}", compression=None)
                sink.write(_member(_record(*row)))
                n += 1
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["path", "records"])

    return saved(rows.mapInArrow(run, "path string, records long"))


def _record(page_id, url, payload: bytes, digest: str, revisit: bool, refers_to) -> bytes:
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Bytes", str(len(payload)))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    block = http if revisit else http + payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def read(spark: SparkSession, folder: str, manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of the manifest's archives: page_id, url, payload, payload_bytes,
    payload_digest, record_type, refers_to, and the path and offset of each.

    A response's bytes and digest are taken of the payload read; a revisit has those of its head.
    A damaged record has its path and offset only; an archive that is not there has no rows.
    """
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                size = fs.get_file_info(f"{root}/{name}").size or 0
                starts = list(range(0, size, range_bytes))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(starts)), pa.array(starts, pa.int64())], ["path", "start"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        kinds = (pa.int64(), pa.string(), pa.large_binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to", "path", "offset"]
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns)):
                held, weight = [], 0
                with fs.open_input_file(f"{root}/{name}") as f:
                    for at, record in members(f, start, start + range_bytes):
                        held.append((*(DAMAGED if record is None else _parsed(record)), name, at))
                        weight += len(record or b"")
                        if weight > SEND_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
                            held, weight = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    # a partition for each range, in order: by their own few bytes, ranges would be merged into one task
    ranges = saved(manifest.select("path").mapInArrow(sizes, "path string, start long"))
    tasks = max(1, min(ranges.count(), MOST_TASKS))
    return ranges.repartitionByRange(tasks, "path", "start").sortWithinPartitions("path", "start").mapInArrow(
        run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "path string, offset long")


def missing(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """(path, records, found) of the archives that gave fewer sound records than the manifest names."""
    sound = found.groupBy("path").agg(F.count_if(F.col("record_type") != "damaged").alias("found"))
    both = manifest.select("path", "records").join(sound, "path", "left")
    return both.select("path", "records", F.coalesce("found", F.lit(0)).alias("found")).where("found < records")


def records(f: io.IOBase, start: int, end: int) -> Iterator[bytes]:
    """The sound ones of ``members``."""
    return (record for _, record in members(f, start, end) if record is not None)


class _Damaged(Exception):
    pass


def members(f: io.IOBase, start: int, end: int) -> Iterator[tuple[int, bytes | None]]:
    """(offset, decoded record) of the gzip members that start in [start, end) of ``f``; None if damaged."""
    window, at = b"", start  # bytes of f from offset ``at`` on
    while True:
        k = window.find(MAGIC)
        if k < 0:  # keep what may be the beginning of a magic
            keep = window[-(len(MAGIC) - 1):] if window else b""
            at += len(window) - len(keep)
            if at >= end:
                return
            f.seek(at + len(keep))
            more = f.read(READ_BYTES)
            if not more:
                return
            window = keep + more
            continue
        if at + k >= end:
            return
        window, at = window[k:], at + k
        try:
            found = _decoded(f, at, window)
        except _Damaged:
            yield at, None
            found = None
        if found is None:
            window, at = window[1:], at + 1
        else:
            record, after, window = found
            if record:
                yield at, record
            at = after


def _decoded(f: io.IOBase, at: int, window: bytes) -> tuple[bytes, int, bytes] | None:
    """(record, offset after its member, bytes read from there on); None if no record begins at ``at``."""
    z, out, fed, first = zlib.decompressobj(31), [], at, b""
    part = window
    while True:
        if not part:
            f.seek(fed)
            part = f.read(READ_BYTES)
            if not part:
                return _failed(first)
        fed += len(part)
        first += part[:max(0, HEAD_BYTES - len(first))]
        try:
            data = z.decompress(part)
        except zlib.error:
            return _failed(first)
        if not out and data and not b"WARC/".startswith(data[:5]) and not data.startswith(b"WARC/"):
            return None
        if data:
            out.append(data)
        if z.eof:
            return b"".join(out), fed - len(z.unused_data), z.unused_data
        part = b""


def _failed(first: bytes) -> None:
    """None if no record begins with the bytes ``first``; an error if one does."""
    try:
        if zlib.decompressobj(31).decompress(first, 5) == b"WARC/":
            raise _Damaged
    except zlib.error:
        pass


DAMAGED = (None, None, None, None, None, "damaged", None)


def _parsed(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    page = lambda name: int(m[1]) if (m := re.search(r"urn:page:(-?\d+)", fields.get(name, ""))) else None
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        n, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    else:
        payload, n, digest = None, int(fields["X-Payload-Bytes"]), fields["WARC-Payload-Digest"].partition(":")[2]
    return page("WARC-Record-ID"), fields.get("WARC-Target-URI"), payload, n, digest, fields["WARC-Type"], page("WARC-Refers-To")


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages, read the archives back: one row per page, without payloads."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    manifest = write(pages, folder, min_bytes)
    found = saved(read(spark, folder, manifest).drop("url", "payload"))
    lost = missing(manifest, found).limit(20).collect()
    if lost:
        raise ValueError("records are missing in " + ", ".join(f"{r['path']} ({r['found']} of {r['records']})" for r in lost))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
