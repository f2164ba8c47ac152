"""WARC archives: a writer with one gzip member per record, and a reader that splits files at any byte.

A reading task gets a byte range. It looks for the gzip magic, decodes what follows as far as a record's header to tell a
member from a chance match, and owns the records that start inside its range, also where they end behind it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfields.llm.files import attempt_name, create, new_folder, opened
from docfields.llm.tree_merge import PLACE, placed
from docfields.session import materialise

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a reading task's range, and after how many bytes a writing task begins another file.
SPLIT_BYTES, FILE_BYTES = 32 << 20, 256 << 20
READ = 1 << 18
#: Bytes that a decoder is fed at once.
CHUNK = 1 << 14
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key: int | None, file: int, at: int) -> str:
    return f"<urn:x-row:{'' if key is None else key}:{file}:{at}>"


def record(kind: str, rid: str, uri: str | None, digest: str, payload: bytes, refers_to: str = "", date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One gzip member. A revisit keeps the HTTP header, with the payload's length, and leaves out the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if uri is not None:
        fields.append(("WARC-Target-URI", quote(uri, safe=":/?#[]@!$&'()*+,;=%~-._")))
    if kind == "revisit":
        fields += [("WARC-Refers-To", refers_to), ("WARC-Profile", REVISIT)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def write(pages: DataFrame, key: str = "page_id", uri: str = "url", payload: str = "html", least: int = 0, folder: str | None = None) -> DataFrame:
    """Archives of all ``pages``: ``file, bytes, records`` of each.

    Of payloads (text in UTF-8; null: empty) that are equal and have ``least`` bytes or more, the one with the smallest
    key (null keys last; then by place) is a response and the others are revisits of it. A null address has no target
    field. Repeated rows have a record each. Other columns are not read. An empty table gives no files.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    rows = placed(pages, {"_key": F.col(key).cast("long"), "_uri": F.col(uri), "_payload": F.coalesce(F.col(payload), F.lit(""))})
    here = F.struct(F.col("_key").isNull().alias("no_key"), F.col("_key").alias("key"), F.col(PLACE[0]).alias("file"), F.col(PLACE[1]).alias("at"))
    data = F.col("_payload").cast("binary")
    marks = materialise(rows.select(F.sha1(data).alias("sha1"), F.length(data).alias("size"), "_key", *PLACE), "payloads").where(F.col("size") >= least)
    first = marks.groupBy("sha1", "size").agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = marks.join(first, ["sha1", "size"]).where(here != F.col("first")).select(*PLACE, "first")

    def run(batches):
        out, name, held, n = None, "", 0, 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pylist([{"file": name, "bytes": held, "records": n}], schema=pa.schema(
                [("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

        for batch in batches:
            for r in _rows(batch):
                if out is None:
                    name, held, n = f"{folder}/{attempt_name('part', '.warc.gz')}", 0, 0
                    out = create(name)
                body = r["_payload"].encode("utf-8")
                of = r["first"]
                member = record("revisit" if of else "response", record_id(r["_key"], r[PLACE[0]], r[PLACE[1]]), r["_uri"], sha1_base32(body),
                                body, record_id(of["key"], of["file"], of["at"]) if of else "")
                out.write(member)
                held, n = held + len(member), n + 1
                if held >= FILE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return materialise(rows.join(again, list(PLACE), "left").mapInArrow(run, "file string, bytes long, records long"), "warc-files")


def _rows(batch: pa.RecordBatch, some: int = 256) -> Iterator[dict]:
    for at in range(0, batch.num_rows, some):
        yield from batch.slice(at, some).to_pylist()


class Range:
    """Records that start in bytes ``start`` to ``end`` of a file, read through a buffer that moves on: each byte once, but
    for those behind a chance match."""

    def __init__(self, file, size: int, start: int, end: int):
        self.file, self.size, self.start, self.end = file, size, start, min(end, size)
        self.held, self.low = b"", start

    def _at(self, place: int, n: int) -> bytes:
        """``n`` bytes from ``place`` on, fewer at the end of the file."""
        end = self.low + len(self.held)
        if not self.low <= place <= end:
            self.held, self.low, end = b"", place, place
        if place + n > end:
            self.file.seek(end)
            self.held, self.low = self.held[place - self.low :] + self.file.read(max(READ, place + n - end)), place
        return self.held[place - self.low : place - self.low + n]

    def records(self) -> Iterator[tuple[int, bytes]]:
        """Place and content of each record."""
        at = self.start
        while at < self.end:
            at = self._magic(at)
            if at < 0:
                return
            found = self._member(at)
            if found is None:
                at += 1  # a chance match
                continue
            content, size = found
            yield at, content
            at += size

    def _magic(self, at: int) -> int:
        """The next place of the magic that lies before ``end``, or -1."""
        while at < self.end:
            data = self._at(at, READ)
            found = data.find(MAGIC)
            if found >= 0:
                return at + found if at + found < self.end else -1
            if len(data) < READ:
                return -1  # the end of the file, wherever it was said to be
            at += READ - len(MAGIC) + 1
        return -1

    def _member(self, at: int) -> tuple[bytes, int] | None:
        """A record's content and the member's size; None if no record starts here."""
        decoder, parts, place, checked = zlib.decompressobj(31), [], at, False
        while not decoder.eof:
            data = self._at(place, CHUNK)
            if not data:
                if checked:
                    raise ValueError(f"the record at {at} is cut off")
                return None
            try:
                parts.append(decoder.decompress(data))
            except zlib.error as e:
                if checked:
                    raise ValueError(f"the record at {at} is damaged") from e
                return None
            place += len(data)
            if not checked:
                head = b"".join(parts)
                if not b"WARC/1.".startswith(head[:7]) or decoder.eof and not head:
                    return None
                if b"\r\n\r\n" in head:
                    if parse_head(head) is None:
                        return None
                    checked = True
        return (b"".join(parts), place - len(decoder.unused_data) - at) if checked else None


def parse_head(content: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields by lower-case name and the place of the block; None if it is no record."""
    end = content.find(b"\r\n\r\n")
    lines = content[:end].decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        return None
    fields = {k.strip().lower(): v.strip() for k, colon, v in (x.partition(":") for x in lines[1:]) if colon}
    return (fields, end + 4) if "warc-type" in fields and fields.get("content-length", "").isdigit() else None


def _key_of(rid: str | None) -> int | None:
    m = re.fullmatch(r"<urn:x-row:(-?\d+):-?\d+:\d+>", rid or "")
    return int(m[1]) if m else None


FIELDS = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
                    ("key", pa.int64()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("refers_to", pa.string()), ("refers_to_key", pa.int64()), ("payload", pa.binary())])


def read(spark: SparkSession, files: DataFrame, payload: bool = True, split: int = SPLIT_BYTES) -> DataFrame:
    """The records of ``files`` (``file``, ``bytes``): place, type, ids, address, size and digest of the payload, and the payload.

    A response's payload is checked against its digest and length; damage raises an error. ``key`` is the row's key where
    this module wrote the file. A revisit's size is that of the payload it leaves out. With ``payload=False`` that column
    is left out. Members with other content than records are skipped.
    """
    parts_ = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("bytes") / split) - 1, F.lit(0)).cast("int"))
    ranges = files.select("file", "bytes", F.explode(parts_).alias("part"))
    schema = FIELDS if payload else FIELDS.remove(len(FIELDS) - 1)

    def row(name: str, at: int, content: bytes) -> dict:
        fields, start = parse_head(content)
        block = content[start : start + int(fields["content-length"])]
        head, _, body = block.partition(b"\r\n\r\n")
        length = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        size, digest = int(length[1]) if length else len(body), fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        if fields["warc-type"] == "response" and (len(body) != size or digest and sha1_base32(body) != digest):
            raise ValueError(f"the payload at {at} of {name} does not match its header")
        return {"file": name, "offset": at, "record_type": fields["warc-type"], "record_id": fields.get("warc-record-id"),
                "key": _key_of(fields.get("warc-record-id")), "target_uri": fields.get("warc-target-uri"), "payload_bytes": size,
                "payload_digest": digest, "refers_to": fields.get("warc-refers-to"), "refers_to_key": _key_of(fields.get("warc-refers-to")),
                "payload": body}

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                with opened(r["file"]) as f:
                    held, size = [], 0
                    for at, content in Range(f, r["bytes"], r["part"] * split, (r["part"] + 1) * split).records():
                        held.append(row(r["file"], at, content))
                        size += len(content)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)

    sql = "file string, offset long, record_type string, record_id string, key long, target_uri string, payload_bytes long, payload_digest string, refers_to string, refers_to_key long"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(n, "file", "part").mapInArrow(run, sql + (", payload binary" if payload else ""))
