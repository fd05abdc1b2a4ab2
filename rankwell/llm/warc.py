"""WARC archives: an index written with the records, and range reads that follow it.

Every task writes archives of its own into a shared folder and returns an index row for each
record: file, offset, length, URL, digest. Reading starts from index rows: those of one file are
sorted by offset, near ones are read in one range, and each record is cut out, unpacked and
checked. Records are gzip members of their own, so any range of the index can be read alone.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwell.llm.common import shared_folder, stored, text_batches

# An archive is closed beyond these; both bound what one reading task gets.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 64 << 20, 20_000
# Records nearer than GAP bytes are read together, up to RANGE bytes.
GAP, RANGE = 64 << 10, 4 << 20
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
_RECORD, _PROFILE = "urn:x-page:", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

INDEX = "file string, offset long, length long, page_id long, url string, digest string, record_type string, refers_to long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(text: str | None) -> str:
    """A header value: line breaks and non-ASCII characters percent-encoded."""
    return "".join(c if 32 <= ord(c) < 127 else "".join(f"%{b:02X}" for b in c.encode()) for c in text or "")


def record(page_id, url, payload: bytes, refers_to, first: bool) -> tuple[bytes, str]:
    """(the record as a gzip member, payload digest); ``first`` gives a response, else a revisit."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if first else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if first else 'revisit'}"]
    head += [f"WARC-Record-ID: <{_RECORD}{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if not first:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_RECORD}{'' if refers_to is None else refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0), digest


def _number(value: str) -> int | None:
    digits = value.strip("<>").removeprefix(_RECORD)
    return int(digits) if digits else None


def parse(member: bytes) -> dict:
    """The record of one gzip member, its lengths and digest checked; ValueError if they differ."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    block, end = rest[:size], rest[size:]
    if lines[0] != "WARC/1.1" or len(block) != size or end != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    told = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    first = fields["WARC-Type"] == "response"
    if first and (len(payload) != told or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    return {
        "page_id": _number(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": told,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": None if first else _number(fields["WARC-Refers-To"]),
        "payload": payload if first else None,
    }


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", folder) if "://" in folder or folder.startswith("/") else re.sub(r"^file:/+", "/", folder))


def _writer(folder: str, most_records: int):
    """Writes batches of (page_id, url, payload, refers_to, first) into archives of the task's own."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _file_system(folder)
        out, name, at, n = None, "", 0, 0
        for batch in batches:
            rows = []
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                page_id, url, payload, refers_to, first = (c[i].as_py() for c in columns)
                if out is None:
                    # A name of its own, so that a repeated task never writes into the same file.
                    name, at, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                    info = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: 18\r\n\r\nformat: WARC 1.1\r\n\r\n\r\n"
                    start = gzip.compress(info.encode(), LEVEL, mtime=0)
                    out.write(start)
                    at += len(start)
                member, digest = record(page_id, url, (payload or "").encode(), refers_to, first)
                out.write(member)
                rows.append((name, at, len(member), page_id, url, digest, "response" if first else "revisit", refers_to))
                at, n = at + len(member), n + 1
                if at >= ARCHIVE_BYTES or n >= most_records:
                    out.close()
                    out = None
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
            names = [c.split()[0] for c in INDEX.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows) if rows else [()] * 8, kinds)], names)
        if out is not None:
            out.close()

    return write


def sha1_of(payload: Column) -> Column:
    return F.sha1(F.coalesce(payload, F.lit("")).cast("binary"))


def write(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    id_col: str = "page_id",
    url: str = "url",
    payload: str = "html",
    records: int = ARCHIVE_RECORDS,
) -> DataFrame:
    """Writes a record for each page into archives below ``folder``; the index of them all.

    Of pages with equal payloads of ``min_bytes`` or more the one with the smallest id is a
    response, the others revisit it; smaller ones are all responses. Null payloads are empty, a
    null URL has no target line, a null id comes last; of rows with the same id one is first.
    The index has one row per record: file, offset, length, page_id, url, digest, record_type,
    refers_to. Only files it names belong to the archive: a task that was lost may leave another.
    """
    text_batches(pages.sparkSession, 500)
    held = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{payload}`").alias("payload"))
    # Stored, as row numbers may differ when a plan is run twice.
    held = stored(held.withColumns({"sha1": sha1_of(F.col("payload")), "row": F.monotonically_increasing_id()}))
    order = F.struct(F.col("page_id").isNull(), "page_id", "row")
    small = F.octet_length(F.coalesce("payload", F.lit(""))) < min_bytes
    firsts = stored(held.groupBy("sha1").agg(F.min(order).alias("o")).select("sha1", F.col("o.page_id").alias("at"), F.col("o.row").alias("head")))
    joined = held.join(firsts, "sha1")
    first = small | (F.col("row") == F.col("head"))
    rows = joined.select("page_id", "url", "payload", F.when(~first, F.col("at")).alias("refers_to"), first.alias("first"))
    return stored(rows.mapInArrow(_writer(folder, records), INDEX)).withColumn("file", F.concat(F.lit(folder.rstrip("/") + "/"), "file"))


def ranges(rows: list[tuple[int, int]], gap: int = GAP, most: int = RANGE) -> list[tuple[int, int, list[int]]]:
    """(offset, length, indexes of rows) of the reads that cover sorted (offset, length) rows."""
    out: list[tuple[int, int, list[int]]] = []
    for i, (at, size) in enumerate(rows):
        if out:
            start, length, members = out[-1]
            if at - (start + length) <= gap and at + size - start <= most:
                out[-1] = (start, max(length, at + size - start), [*members, i]) if at + size > start + length else (start, length, [*members, i])
                continue
        out.append((at, size, [i]))
    return out


def read(index: DataFrame, payload: bool = True) -> DataFrame:
    """The records of ``index`` rows: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    One group is one archive, whose size writing bounds; it is read in coalesced ranges by
    offset. Each record is checked against its lengths, its digest and the index; ValueError if
    they differ. ``payload`` adds the bytes of responses (null for revisits).
    """
    names = [c.split()[0] for c in RECORD.split(", ")]
    schema = pa.schema([(n, k) for n, k in zip(names, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()))])

    def records(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("offset").to_pylist()
        folder, name = rows[0]["file"].rsplit("/", 1)
        system, path = _file_system(folder)
        out = []
        with system.open_input_file(f"{path}/{name}") as archive:
            for start, length, members in ranges([(r["offset"], r["length"]) for r in rows]):
                archive.seek(start)
                data = archive.read(length)
                for i in members:
                    at = rows[i]["offset"] - start
                    found = parse(data[at : at + rows[i]["length"]])
                    if found["payload_digest"] != rows[i]["digest"] or found["page_id"] != rows[i]["page_id"]:
                        raise ValueError(f"{rows[i]['file']} at {rows[i]['offset']} differs from its index")
                    if not payload:
                        found["payload"] = None
                    out.append(found)
        return pa.Table.from_pylist(out, schema)

    chosen = index.select("file", "offset", "length", "page_id", "digest")
    found = chosen.groupBy("file").applyInArrow(records, RECORD)
    return found if payload else found.drop("payload")


def archive(pages: DataFrame, **names) -> DataFrame:
    """``write`` to a new shared folder."""
    return write(pages, f"{shared_folder(pages.sparkSession)}", **names)


_NIBBLES = "list_transform(range(1, 41), lambda i: strpos('0123456789abcdef', substr(hex, i, 1)) - 1)"
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, strlen(t)::BIGINT AS payload_bytes, sha1(t) AS hex FROM p),
d AS (
  SELECT page_id, payload_bytes, hex, {_NIBBLES} AS n, min(page_id) OVER (PARTITION BY hex) AS head FROM h)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('{_BASE32}',
         1 + (((n[1 + (5 * i) // 4] * 16 + coalesce(n[2 + (5 * i) // 4], 0)) >> (3 - (5 * i) % 4)) & 31)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN head = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN head <> page_id THEN head END AS refers_to
FROM d
"""
