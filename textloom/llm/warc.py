"""WARC records in ZIP-packaged web archives, written and read back without extraction.

An archive is a ZIP file whose members are stored, not compressed: ``archive/data.warc.gz``, in which
each record is a gzip member of its own, and ``indexes/index.jsonl`` with place, length and type of
each record. The reader parses the end record of the ZIP file, its ZIP64 record and the central
directory, finds where a member's bytes begin, reads the index, and then fetches byte ranges of
records; neighbouring ranges are fetched at once. Records of one archive are read by many tasks.

Pages with equal payloads of at least ``LEAST_REVISIT`` bytes are stored once: the one with the
largest key holds the payload, the others are revisit records that refer to it.

Defined results: null html is an empty payload; a null url becomes ``urn:unknown`` and control
characters in a url are dropped; repeated rows with the largest key all hold the payload; a null key
never holds one for others; an empty table gives no archives and no records; payloads of any length
are kept whole; other columns are neither read nor written.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.plans.session import stage_path, staged

LEAST_REVISIT = 1000
#: Bytes that a reader fetches at once when records are neighbours, and records of a reading task's share.
FETCH, RECORDS_PER_TASK = 1 << 20, 2000
_DATA, _INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
# Fixed values of the formats.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END, _END64, _PLACE64, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


def marked(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key``, ``url``, ``payload``, ``digest`` and ``refers_to``: the key that holds an equal payload, or null."""
    payload = F.coalesce(F.encode(html, "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    held = rows.where(F.length("payload") >= LEAST_REVISIT).groupBy("digest").agg(F.max("key").alias("holder"), F.count("*").alias("n"))
    both = rows.join(held.where("n > 1").drop("n"), "digest", "left")
    refers = F.when(F.col("holder").isNotNull() & ~F.col("key").eqNullSafe(F.col("holder")), F.col("holder"))
    return both.select("key", "url", "payload", "digest", refers.alias("refers_to"))


def record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record."""
    target = "".join(c for c in url or "urn:unknown" if c > " ") or "urn:unknown"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<urn:page:{key}>", "WARC-Date": date,
        "WARC-Target-URI": target, "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write an archive per partition below ``folder``; a table of their paths.

    An attempt writes under a name of its own, and only the archives of attempts that succeeded are
    listed, so lost executors leave at most files that no list names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        count, at, index = 0, 0, []
        with store.open_output_stream(f"{base}/{name}") as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as package:
            with package.open(zipfile.ZipInfo(_DATA), "w", force_zip64=True) as member:
                for batch in _chain(first, batches):
                    for row in batch.to_pylist():
                        data = gzip.compress(record(date=date, **row), 1, mtime=0)
                        member.write(data)
                        kind = "response" if row["refers_to"] is None else "revisit"
                        index.append(json.dumps({"key": row["key"], "at": at, "size": len(data), "type": kind}))
                        at += len(data)
                        count += 1
            package.writestr(zipfile.ZipInfo(_INDEX), "\n".join(index))
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": pa.array([count], pa.int64())})

    return staged(marked(pages, key, url, html).mapInArrow(run, "path string, records long"), "archives")


def _chain(first, rest):
    yield first
    yield from rest


def members(file, size: int) -> dict[str, tuple[int, int]]:
    """Where the bytes of each stored member begin and how many they are, from the central directory."""
    tail = file.read_at(min(size, 65_557 + 20), max(0, size - 65_577))
    at = tail.rfind(_END)
    if at < 0:
        raise ValueError("no end record: not a ZIP file")
    entries, length, start = struct.unpack_from("<HII", tail, at + 10)
    if 0xFFFF == entries or 0xFFFFFFFF in (length, start):
        if tail[at - 20 : at - 16] != _PLACE64:
            raise ValueError("no ZIP64 locator")
        end64 = file.read_at(56, struct.unpack_from("<Q", tail, at - 20 + 8)[0])
        if end64[:4] != _END64:
            raise ValueError("no ZIP64 end record")
        entries, length, start = struct.unpack_from("<QQQ", end64, 32)
    directory, at, found = file.read_at(length, start), 0, {}
    for _ in range(entries):
        if directory[at : at + 4] != _ENTRY:
            raise ValueError("broken central directory")
        method, packed, whole, name_size, extra_size, note_size, offset = (
            *struct.unpack_from("<H", directory, at + 10), *struct.unpack_from("<II", directory, at + 20),
            *struct.unpack_from("<HHH", directory, at + 28), *struct.unpack_from("<I", directory, at + 42),
        )
        name = directory[at + 46 : at + 46 + name_size].decode()
        extra = directory[at + 46 + name_size : at + 46 + name_size + extra_size]
        while len(extra) >= 4:
            tag, size64 = struct.unpack_from("<HH", extra)
            if tag == 1:
                wide = iter(struct.unpack_from(f"<{size64 // 8}Q", extra, 4))
                whole = next(wide) if whole == 0xFFFFFFFF else whole
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                offset = next(wide) if offset == 0xFFFFFFFF else offset
            extra = extra[4 + size64 :]
        if method:
            raise ValueError(f"member {name} is compressed, not stored")
        local = file.read_at(30, offset)
        if local[:4] != _LOCAL:
            raise ValueError(f"no local header for {name}")
        found[name] = (offset + 30 + sum(struct.unpack_from("<HH", local, 26)), packed)
        at += 46 + name_size + extra_size + note_size
    return found


def index(archives: DataFrame) -> DataFrame:
    """``path``, ``at`` and ``size`` of every record of the archives, from their directories and indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, base = fs.FileSystem.from_uri(path)
                with store.open_input_file(base) as file:
                    parts = members(file, file.size())
                    start, size = parts[_INDEX]
                    lines = [json.loads(line) for line in file.read_at(size, start).decode().split("\n") if line]
                first = parts[_DATA][0]
                for k in range(0, len(lines), 10_000):
                    some = lines[k : k + 10_000]
                    yield pa.RecordBatch.from_pydict({
                        "path": [path] * len(some), "at": pa.array([first + x["at"] for x in some], pa.int64()),
                        "size": pa.array([x["size"] for x in some], pa.int64()), "share": pa.array([(k + i) // RECORDS_PER_TASK for i in range(len(some))], pa.int64()),
                    })

    return archives.select("path").mapInArrow(run, "path string, at long, size long, share long")


def parse(data: bytes) -> dict:
    """A record's fields; what a revisit leaves out is told by its HTTP header and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    number = lambda name: None if fields[name] == "<urn:page:None>" else int(fields[name][10:-1])
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and len(body) != length:
        raise ValueError("a payload is not whole")
    return {
        "key": number("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"], "payload_bytes": length,
        "payload_digest": fields["WARC-Payload-Digest"][5:] if revisit else hashlib.sha1(body).hexdigest(),
        "refers_to": number("WARC-Refers-To") if revisit else None, "payload": None if revisit else body,
    }


def read(archives: DataFrame) -> DataFrame:
    """All records: ``key``, ``url``, ``record_type``, ``payload_bytes``, ``payload_digest``, ``refers_to`` and
    ``payload`` (null for revisits)."""
    schema = pa.schema([
        ("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, pa.NativeFile] = {}
        for batch in batches:
            rows = batch.to_pylist()
            k = 0
            while k < len(rows):
                first, last = rows[k], k + 1
                while last < len(rows) and rows[last]["path"] == first["path"] and rows[last]["at"] == rows[last - 1]["at"] + rows[last - 1]["size"]:
                    if rows[last]["at"] + rows[last]["size"] - first["at"] > FETCH:
                        break
                    last += 1
                if first["path"] not in opened:
                    for file in opened.values():
                        file.close()
                    store, base = fs.FileSystem.from_uri(first["path"])
                    opened = {first["path"]: store.open_input_file(base)}
                end = rows[last - 1]["at"] + rows[last - 1]["size"]
                data = opened[first["path"]].read_at(end - first["at"], first["at"])
                found = [parse(gzip.decompress(data[r["at"] - first["at"] : r["at"] - first["at"] + r["size"]])) for r in rows[k:last]]
                yield pa.RecordBatch.from_pylist(found, schema=schema)
                k = last
        for file in opened.values():
            file.close()

    # The rows of an index stand for whole payloads, so their bytes say nothing about the tasks they are worth.
    shares = archives.agg(F.sum(F.ceil(F.col("records") / RECORDS_PER_TASK))).first()[0] or 1
    spread = index(archives).repartition(int(shares), "path", "share").sortWithinPartitions("path", "at")
    kinds = "key long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    return spread.mapInArrow(run, kinds)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write archives of the pages to the shared folder and read them back."""
    return read(write(pages, stage_path(spark, "warc")))
