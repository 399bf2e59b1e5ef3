"""WARC records in ZIP-packaged archives, written by tasks and read back by byte ranges.

An archive is a ZIP file with two stored members: ``archive/data.warc.gz``, one gzip member per record, and
``indexes/index.cdxj``, one JSON line per record with its place. The reader parses the central directory (with its
ZIP64 forms), finds the stored members, reads the index member by range and then each record by range; nothing is
extracted. Files are opened through ``pyarrow.fs`` by URI, in tasks only.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
#: A new archive begins after so many bytes of records; it bounds the index a task holds.
ARCHIVE_BYTES = 256 << 20
#: Records are dealt to reading tasks by spans of an archive, and neighbours are read at once up to this size.
SPAN_BYTES, READ_BYTES = 32 << 20, 4 << 20
#: Bytes of archives for each reading task.
TASK_BYTES = 64 << 20

RECORD = "record_id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary"
LOCATION = "path string, record_id string, offset long, length long"


class Member(NamedTuple):
    name: str
    method: int
    size: int
    stored_size: int
    header_offset: int


def plan_records(pages: DataFrame, key: str, url: str, payload: Column, least: int = 1000) -> DataFrame:
    """Decide response or revisit for each row: ``key, record_id, url, record_type, refers_to, payload_digest,
    payload_bytes, payload`` (payload null for revisits).

    Of rows with equal payloads of ``least`` bytes or more, the one with the largest key is the response and
    those with a smaller or null key are revisits of it; rows repeated with that largest key are all responses,
    and so are rows whose group has no key at all. A null payload counts as empty. Groups are counted per digest
    with map-side sums; only digests seen twice join back, and a hot one is split by adaptive skew joins.
    """
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"),
                        F.coalesce(payload, F.lit(b"")).alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"),
                       F.sha1("payload").alias("payload_digest"))
    groups = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes").agg(
        F.max("key").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    revisit = F.col("last").isNotNull() & (F.col("key").isNull() | (F.col("key") < F.col("last")))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("null")))
    return rows.join(groups, ["payload_digest", "payload_bytes"], "left").select(
        name(F.col("key")).alias("record_id"), "url",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, name(F.col("last"))).alias("refers_to"), "payload_digest", "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"))


def file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def warc_record(row: dict, date: str) -> bytes:
    """The bytes of one record; a revisit has HTTP headers but no payload."""
    clean = lambda s: re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", s)
    body = row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{row['record_id']}>", f"WARC-Date: {date}"]
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {clean(row['url'])}")
    if row["refers_to"] is not None:
        head += [f"WARC-Refers-To: <{row['refers_to']}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{row['payload_digest']}", f"X-Payload-Length: {row['payload_bytes']}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers and payload of one uncompressed record."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    payload = block[: int(fields["content-length"])].partition(b"\r\n\r\n")[2]
    bare = lambda k: fields[k].strip("<>") if k in fields else None
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    return {"record_id": bare("warc-record-id"), "url": fields.get("warc-target-uri"), "record_type": fields.get("warc-type"),
            "refers_to": bare("warc-refers-to"), "payload_digest": digest or None,
            "payload_bytes": int(fields["x-payload-length"]) if "x-payload-length" in fields else None,
            "payload": payload if fields.get("warc-type") != "revisit" else None}


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the records of ``plan_records`` as archives below ``folder``; returns ``path, bytes, records``.

    Each task writes its own archives, a new one after ``archive_bytes``. A file gets its final name by a move
    when complete, so a task that runs twice leaves one copy. The frame returned is lazy: running it writes.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        part, number, rows = TaskContext.get().partitionId(), 0, (r for b in batches for r in b.to_pylist())
        row = next(rows, None)
        while row is not None:
            name, temporary = f"{folder}/part-{part:06d}-{number:04d}.wacz", f"{root}/_{uuid.uuid4().hex}"
            index, count, at = [], 0, 0
            with fs.open_output_stream(temporary) as stream, zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED) as z:
                with z.open(zipfile.ZipInfo(WARC_MEMBER), "w", force_zip64=True) as member:
                    while row is not None and at < archive_bytes:
                        data = zlib.compress(warc_record(row, date), 6, 31)
                        member.write(data)
                        index.append(json.dumps({"id": row["record_id"], "offset": at, "length": len(data)}))
                        at, count, row = at + len(data), count + 1, next(rows, None)
                with z.open(zipfile.ZipInfo(INDEX_MEMBER), "w", force_zip64=True) as member:
                    member.write("".join(line + "\n" for line in index).encode())
            final = file_system(name)[1]
            fs.move(temporary, final)
            yield pa.RecordBatch.from_pydict({"path": [name], "bytes": [fs.get_file_info(final).size], "records": [count]})
            number += 1

    return records.select("record_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes",
                          "payload").mapInArrow(write, "path string, bytes long, records long")


def list_archives(spark: SparkSession, folder: str, pattern: str = "*.wacz") -> DataFrame:
    """``path, bytes`` of the archives below an existing folder; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(
        folder).select("path", F.col("length").alias("bytes"))


def read_at(file: BinaryIO, start: int, size: int) -> bytes:
    file.seek(start)
    data = file.read(size)
    if len(data) != size:
        raise ValueError(f"the archive ends within the {size} bytes from {start}")
    return data


def central_directory(file: BinaryIO, size: int) -> list[Member]:
    """Members by the central directory. Only the file's end and the directory are read.

    The end record may be followed by a comment. Where it holds 0xFFFF or 0xFFFFFFFF, the ZIP64 end record has
    the value; where an entry does, its ZIP64 extra field. Anything else raises ValueError.
    """
    tail_at = max(0, size - 22 - 65535)
    tail = read_at(file, tail_at, size - tail_at)
    end = len(tail) - 22
    while end >= 0 and not (tail[end:end + 4] == b"PK\5\6" and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail)):
        end = tail.rfind(b"PK\5\6", 0, end + 3)
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP archive")
    _, _, _, count, length, start = struct.unpack_from("<HHHHII", tail, end + 4)
    if 0xFFFF == count or 0xFFFFFFFF in (length, start):
        at = tail_at + end - 20
        mark, _, end64, _ = struct.unpack("<4sIQI", read_at(file, at, 20)) if at >= 0 else (b"", 0, 0, 0)
        if mark == b"PK\6\7":
            record = read_at(file, end64, 56)
            if record[:4] != b"PK\6\6":
                raise ValueError("the ZIP64 locator points to no end record")
            count, length, start = struct.unpack_from("<QQQ", record, 32)
    found, data, at = [], read_at(file, start, length), 0
    for _ in range(count):
        if data[at:at + 4] != b"PK\1\2":
            raise ValueError("the central directory is cut short")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        stored, plain, name_n, extra_n, comment_n = struct.unpack_from("<IIHHH", data, at + 20)
        offset, = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46:at + 46 + name_n].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[at + 46 + name_n:at + 46 + name_n + extra_n]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:  # 8 bytes for each value that did not fit, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                offset = next(wide) if offset == 0xFFFFFFFF else offset
            extra = extra[4 + n:]
        found.append(Member(name, method, plain, stored, offset))
        at += 46 + name_n + extra_n + comment_n
    return found


def data_offset(file: BinaryIO, member: Member) -> int:
    """Where a stored member's bytes begin: after its local header, whose fields may be longer than the directory's."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed in the archive; only stored members are read by range")
    head = read_at(file, member.header_offset, 30)
    if head[:4] != b"PK\3\4":
        raise ValueError(f"{member.name} has no local header")
    return member.header_offset + 30 + sum(struct.unpack_from("<HH", head, 26))


def lines_at(file: BinaryIO, start: int, size: int, step: int = 1 << 20) -> Iterator[bytes]:
    """The lines of a byte range, a block at a time."""
    rest = b""
    for at in range(start, start + size, step):
        *lines, rest = (rest + read_at(file, at, min(step, start + size - at))).split(b"\n")
        yield from lines
    if rest:
        yield rest


def scan_records(file: BinaryIO, start: int, size: int, step: int = 1 << 20) -> Iterator[tuple[str, int, int]]:
    """``(record id, offset, length)`` of each gzip member of a range, for an archive without index."""
    at, head, begun, inflate = start, b"", start, zlib.decompressobj(31)
    while at < start + size:
        block = read_at(file, at, min(step, start + size - at))
        at += len(block)
        while block:
            head = (head + inflate.decompress(block))[:1 << 16]
            block = inflate.unused_data
            if inflate.eof:
                record = re.search(rb"(?i)\r\nwarc-record-id:\s*<([^>]*)>", head)
                yield record[1].decode() if record else "", begun, at - len(block) - begun
                begun, head, inflate = at - len(block), b"", zlib.decompressobj(31)
    if begun != start + size:
        raise ValueError("the last record is cut short")


def locate_records(archives: DataFrame) -> DataFrame:
    """Places of all records of ``archives(path, bytes)``: ``path, record_id, offset, length`` in the file.

    Taken from the members ``indexes/*.cdxj``; an archive without such a member has its ``archive/*.warc.gz``
    members scanned instead. Compressed members of these names and damaged directories raise ValueError. An
    archive without records gives no rows.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, size in ((r["path"], r["bytes"]) for b in batches for r in b.to_pylist()):
            fs, name = file_system(path)
            with fs.open_input_file(name) as file:
                members = central_directory(file, size)
                data = [m for m in members if re.fullmatch(r"archive/.*\.warc\.gz", m.name)]
                indexes = [m for m in members if re.fullmatch(r"indexes/.*\.cdxj", m.name)]

                def places():
                    if indexes and len(data) == 1:
                        base = data_offset(file, data[0])
                        for m in indexes:
                            for line in lines_at(file, data_offset(file, m), m.size):
                                x = json.loads(line)
                                yield x["id"], base + x["offset"], x["length"]
                    else:
                        for m in data:
                            yield from scan_records(file, data_offset(file, m), m.size)

                block = []
                for place in places():
                    block.append((path, *place))
                    if len(block) == 10_000:
                        yield pa.RecordBatch.from_pylist([dict(zip(("path", "record_id", "offset", "length"), x)) for x in block])
                        block = []
                if block:
                    yield pa.RecordBatch.from_pylist([dict(zip(("path", "record_id", "offset", "length"), x)) for x in block])

    return archives.select("path", "bytes").repartition(read_tasks(archives), "path").mapInArrow(locate, LOCATION)


def read_tasks(archives: DataFrame) -> int:
    """Tasks to read the archives with: one for ``TASK_BYTES``, and no fewer than a shuffle of the session has."""
    size = archives.agg(F.sum("bytes")).first()[0] or 0
    return max(int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))


def read_records(places: DataFrame, tasks: int) -> DataFrame:
    """Range-read and parse the records of ``locate_records`` (or any part of them) in so many tasks.

    Places are dealt out by spans of an archive, so a large archive is read by many tasks, and neighbouring
    records are fetched together. Only the places are shuffled; as they are small beside what they point at, the
    number of tasks is given (``read_tasks``) and not left to adaptive execution, which would join them all.
    A record, however long, is one value in one task; places of no records, or of none left, give no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        for batch in batches:
            rows = batch.to_pylist()
            i = 0
            while i < len(rows):
                first = rows[i]
                if first["path"] != path:
                    if file:
                        file.close()
                    path = first["path"]
                    fs, name = file_system(path)
                    file = fs.open_input_file(name)
                j, end = i + 1, first["offset"] + first["length"]
                while (j < len(rows) and rows[j]["path"] == path and rows[j]["offset"] == end
                       and end + rows[j]["length"] - first["offset"] <= READ_BYTES):
                    end, j = end + rows[j]["length"], j + 1
                data, parsed = read_at(file, first["offset"], end - first["offset"]), []
                for r in rows[i:j]:
                    at = r["offset"] - first["offset"]
                    parsed.append(parse_record(zlib.decompress(data[at:at + r["length"]], 31)))
                yield pa.RecordBatch.from_pylist(parsed, schema)
                i = j
        if file:
            file.close()

    schema = pa.schema([("record_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
    span = F.floor(F.col("offset") / SPAN_BYTES)
    return places.repartition(tasks, "path", span).sortWithinPartitions("path", "offset").mapInArrow(read, RECORD)
