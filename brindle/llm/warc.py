"""WARC archives of pages: one gzip member per record, written and read by tasks.

A page becomes a `response` record, its payload the html in UTF-8. Of records with equal payloads of a given size or
more, that with the largest page_id is the response; the others become `revisit` records that refer to it and carry
only the http header. A page_id is kept in the record id.

Each task writes files of its own and reports them when they are complete; a reader only opens files that were
reported, so what a lost task left behind is never read. The reader goes through a file once, from front to back:
it decompresses piece by piece, cuts records by their content length and checks both digests.

NULL html is an empty payload, a NULL url gives no target. Rows that repeat the page_id and the payload of a response
are responses too. A NULL page_id is the smallest. Pages in any number of partitions, none at all included, will do.

The folder is a path or address that pyarrow can write to from every executor, such as a shared file system.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.joining import with_findings_or_none
from brindle.llm.words import slices
from brindle.session import fresh_path, materialize

LEAST = 1000  # bytes of a payload from which on copies become revisits
FILE_BYTES = 1 << 30  # compressed size after which a task begins another file
LEVEL = 6  # of compression
PIECE = 1 << 16  # compressed bytes read at a time
DATE = "2025-01-01T00:00:00Z"  # the pages have no date of their own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _sha1(data: bytes) -> bytes:
    return hashlib.sha1(data).digest()


def _shown(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", record_id or "")
    return int(found[1]) if found else None


def record(kind: str, page_id, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """A record as it stands in an archive before compression."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if kind == "response" else b"")
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", DATE),
        ("WARC-Target-URI", url and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Payload-Digest", _shown(_sha1(payload))), ("WARC-Block-Digest", _shown(_sha1(block))),
        ("WARC-Profile", PROFILE if kind == "revisit" else None),
        ("WARC-Refers-To", _record_id(refers_to) if kind == "revisit" else None),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    """`data` as a gzip member of its own."""
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _write(batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    store, root = _open(folder)
    out, name, done, size, records = None, "", [], 0, 0
    for rows, payloads in slices(batches, "html"):
        ids, urls = rows.column("page_id").to_pylist(), rows.column("url").to_pylist()
        again, first = rows.column("is_copy").to_pylist(), rows.column("refers_to").to_pylist()
        for page_id, url, payload, copy, target in zip(ids, urls, payloads, again, first, strict=True):
            if out is None:
                name, size, records = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                out = store.open_output_stream(name, compression=None)
            size += out.write(member(record("revisit" if copy else "response", page_id, url, payload or b"", target)))
            records += 1
            if size >= file_bytes:
                out.close()
                out = None
                done.append((name, records))
    if out is not None:
        out.close()
        done.append((name, records))
    yield pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "records"]
    )


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, payloads in slices(batches, "html"):
        payloads = [p or b"" for p in payloads]
        digests = pa.array([hashlib.sha256(p).digest() for p in payloads], pa.binary())
        sizes = pa.array([len(p) for p in payloads], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [rows.column("page_id"), rows.column("html_key"), sizes, digests], names=["page_id", "html_key", "size", "digest"]
        )


def revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """The pages that become revisits: page_id, html_key, refers_to."""
    id_type = pages.schema["page_id"].dataType.simpleString()
    keyed = pages.select("page_id", "html", F.xxhash64("html").alias("html_key"))
    digests = keyed.mapInArrow(_sizes, f"page_id {id_type}, html_key bigint, size bigint, digest binary")
    large = materialize(digests.where(F.col("size") >= least).drop("size"), "digests")
    best = large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    copies = large.join(materialize(best.drop("n"), "best"), "digest")
    return materialize(
        copies.where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "html_key", "refers_to").distinct(),
        "revisits",
    )


def write(pages: DataFrame, folder: str | None = None, least: int = LEAST, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write archives of `pages` (page_id, url, html) and return their paths and numbers of records.

    Without a folder they go to a fresh one in the shared work folder.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    store, root = _open(folder)
    store.create_dir(root, recursive=True)
    copies = revisits(pages, least).withColumn("is_copy", F.lit(True))
    keyed = pages.select("page_id", "url", "html", F.xxhash64("html").alias("html_key"))
    rows = with_findings_or_none(keyed, copies, "page_id", "html_key").select(
        "page_id", "url", "html", "refers_to", F.coalesce("is_copy", F.lit(False)).alias("is_copy")
    )
    made = rows.mapInArrow(lambda batches: _write(batches, folder, file_bytes), "path string, records bigint")
    return materialize(made.withColumn("folder", F.lit(folder)), "archives")


@dataclass
class Record:
    fields: dict[str, str]
    kind: str
    payload: bytes
    payload_bytes: int
    payload_digest: bytes

    @property
    def page_id(self) -> int | None:
        return _page_id(self.fields.get("warc-record-id"))

    @property
    def refers_to(self) -> int | None:
        return _page_id(self.fields.get("warc-refers-to"))


class _Member:
    """The decompressed bytes of one gzip member, as far as they are asked for."""

    def __init__(self, stream, rest: bytes):
        self.stream, self.pack, self.held, self.rest = stream, zlib.decompressobj(31), bytearray(), rest

    def _more(self) -> bool:
        if self.pack.eof:
            return False
        piece = self.rest or self.stream.read(PIECE)
        if not piece:
            raise ValueError("archive ends within a record")
        self.held += self.pack.decompress(piece)
        self.rest = self.pack.unused_data if self.pack.eof else b""
        return True

    def until(self, mark: bytes) -> bytes:
        at = 0
        while (found := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark))
            if not self._more():
                raise ValueError("record without an end of its header")
        out = bytes(self.held[:found])
        del self.held[: found + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("record shorter than its content length")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def close(self) -> bytes:
        """The compressed bytes after this member; the member must hold nothing more."""
        while self._more():
            pass
        if self.held:
            raise ValueError("record longer than its content length")
        return self.rest


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _checked(fields: dict[str, str], name: str, data: bytes) -> None:
    shown = fields.get(name)
    if shown is not None and shown != _shown(_sha1(data)):
        raise ValueError(f"{name} does not fit in {fields.get('warc-record-id')}")


def records(stream) -> Iterator[Record]:
    """The records of an archive, read from front to back. Damage raises ValueError."""
    rest = stream.read(PIECE)
    while rest:
        part = _Member(stream, rest)
        head = part.until(b"\r\n\r\n")
        if not head.startswith(b"WARC/1."):
            raise ValueError("not a record")
        fields = _fields(head)
        block = part.take(int(fields["content-length"]))
        if part.take(4) != b"\r\n\r\n":
            raise ValueError("record without its end")
        rest = part.close() or stream.read(PIECE)
        _checked(fields, "warc-block-digest", block)
        http, _, payload = block.partition(b"\r\n\r\n")
        kind = fields["warc-type"]
        if kind == "response":
            _checked(fields, "warc-payload-digest", payload)
        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
        yield Record(fields, kind, payload, int(_fields(http).get("content-length", len(payload))), digest)


def _read(batches: Iterator[pa.RecordBatch], id_type: pa.DataType, with_payload: bool) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload

    def table(held: list[Record]) -> pa.RecordBatch:
        columns = [
            pa.array([r.page_id for r in held], id_type), pa.array([r.fields.get("warc-target-uri") for r in held], pa.string()),
            pa.array([r.payload_bytes for r in held], pa.int64()), pa.array([r.payload_digest.hex() for r in held], pa.string()),
            pa.array([r.kind for r in held], pa.string()), pa.array([r.refers_to for r in held], id_type),
        ]
        if with_payload:
            columns.append(pa.array([r.payload if r.kind == "response" else None for r in held], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        for folder, path in zip(batch.column("folder").to_pylist(), batch.column("path").to_pylist(), strict=True):
            store, _ = _open(folder)
            with store.open_input_stream(path, compression=None) as stream:
                held, size = [], 0
                for r in records(stream):
                    held.append(r)
                    size += len(r.payload) if with_payload else 300
                    if not with_payload:
                        r.payload = b""
                    if size > 4 << 20:
                        yield table(held)
                        held, size = [], 0
                if held:
                    yield table(held)


def read(archives: DataFrame, id_type: str = "bigint", with_payload: bool = True) -> DataFrame:
    """The records of archives (folder, path), one file after the other in each task.

    page_id, url, payload_bytes, payload_digest (hexadecimal, of the full payload), record_type, refers_to, and, if
    asked for, payload (NULL for revisits).
    """
    kind = {"bigint": pa.int64(), "int": pa.int32()}[id_type]
    files = archives.repartitionByRange(max(1, archives.count()), "folder", "path")  # one file a task
    schema = f"page_id {id_type}, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to {id_type}"
    return files.select("folder", "path").mapInArrow(
        lambda batches: _read(batches, kind, with_payload), schema + ", payload binary" * with_payload
    )
