"""WARC archives: one gzip member per record, and a sequential reader that verifies them.

Writing: every task appends its records to archives of its own in a shared folder and
returns a manifest row per archive, named by partition and attempt. Only archives of the
manifest are read, so what a failed or repeated attempt left behind is never seen. The
largest key of several records with one payload is the response; the others are revisit
records, which keep the protocol head and name the response they refer to.

Reading: each archive is one stream, inflated piece by piece; a member ends where the
decompressor says so, a record by its content length, and the digests of block and
payload are verified. Memory is bounded by one record and one piece. Archives are closed
at a size limit, so one source never makes one task read everything.

Archives are reached through `pyarrow.fs`, which takes the folder as the session names it
(local path, or a URI of a store that it supports).

Defined cases: a null payload is empty; a null address is written as the record's own
name; a null key is empty in the record and null again when read; rows that repeat the
largest key of a payload are all responses; control characters in addresses are escaped.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import workspace
from .common import stored

ARCHIVE_BYTES = 64 << 20  # an archive is closed once it is so long
PIECE = 1 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_name(key, digest: str) -> str:
    return f"<urn:page:{'' if key is None else key}:{digest}>"


def record(key, url: str | None, payload: bytes, response_key, repeat: bool) -> bytes:
    """One record as a gzip member of its own."""
    digest = digest32(payload)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if repeat else head + payload
    name = record_name(key, digest)
    fields = [
        ("WARC-Type", "revisit" if repeat else "response"), ("WARC-Record-ID", name), ("WARC-Date", DATE),
        ("WARC-Target-URI", name[1:-1] if url is None else _CONTROL.sub(lambda c: f"%{ord(c[0]):02X}", url)),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{digest32(block)}"), ("Content-Length", str(len(block))),
    ]
    if repeat:
        fields += [("WARC-Refers-To", record_name(response_key, digest)), ("WARC-Profile", PROFILE)]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress(text.encode() + block + b"\r\n\r\n") + member.flush()


def _file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def _write(folder: str, archive_bytes: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        task, out, path, size, n = TaskContext.get().partitionId(), None, "", 0, 0

        def manifest():
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n])], names=["archive", "records"])

        try:
            for batch in batches:
                keys, urls, bodies, best = (batch.column(i) for i in range(4))
                for key, url, body, response in zip(
                    keys.to_pylist(), urls.to_pylist(), bodies.cast(pa.binary()).to_pylist(), best.to_pylist()
                ):
                    if out is None:
                        path, size, n = f"part-{task:06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = fs.open_output_stream(f"{base}/{path}", compression=None)
                    repeat = response is not None and key != response
                    size += out.write(record(key, url, body or b"", response, repeat))
                    n += 1
                    if size >= archive_bytes:
                        out.close()
                        out = None
                        yield manifest()
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield manifest()

    return of


def write_archives(
    df: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", least: int = 0,
    folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES,
) -> tuple[str, DataFrame]:
    """Write a record per row; (folder, manifest of archive and records).

    Payloads of at least `least` bytes that several rows share become revisits.
    """
    folder = folder or workspace(df.sparkSession, "warc")
    fs, base = _file_system(folder)
    fs.create_dir(base, recursive=True)
    payload = F.coalesce(F.col("body"), F.lit("")).cast("binary")
    rows = df.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{body}`").alias("body")
    ).select("*", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("bytes"))
    shared = stored(
        rows.where(F.col("bytes") >= least).groupBy("digest", "bytes")
        .agg(F.count(F.lit(1)).alias("n"), F.max("key").alias("response")).where("n > 1").drop("n"),
        "shared-payloads",
    )
    records = rows.join(shared, ["digest", "bytes"], "left").select("key", "url", "body", "response")
    manifest = stored(records.mapInArrow(_write(folder, archive_bytes), "archive string, records long"), "manifest")
    return folder, manifest


class _Members:
    """Inflated bytes of a stream of gzip members, on demand."""

    def __init__(self, stream) -> None:
        self.stream, self.raw, self.data, self.inflate = stream, b"", bytearray(), None

    def _more(self) -> bool:
        """Inflate a piece of the present member; false where it ends."""
        if self.inflate.eof:
            self.raw = self.inflate.unused_data
            return False
        self.raw = self.raw or self.stream.read(PIECE)
        if not self.raw:
            raise ValueError("the archive ends inside a member")
        self.data += self.inflate.decompress(self.raw, PIECE)
        self.raw = self.inflate.unconsumed_tail
        if self.inflate.eof:
            self.raw = b""
        return True

    def begin(self) -> bool:
        self.raw = self.raw or self.stream.read(PIECE)
        self.inflate = zlib.decompressobj(31)
        return bool(self.raw)

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (at := self.data.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.data)
            if not self._more():
                raise ValueError("a record has no end of its head")
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.data) < n:
            if not self._more():
                raise ValueError("a record is shorter than its content length")
        out = bytes(self.data[:n])
        del self.data[:n]
        return out

    def end(self) -> None:
        while self._more():
            pass
        if self.data:
            raise ValueError("a member holds more than its record")


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record, verified; fields are in lower case."""
    members = _Members(stream)
    while members.begin():
        version, *lines = members.until(b"\r\n\r\n").decode().split("\r\n")
        if not version.startswith("WARC/1."):
            raise ValueError(f"not a record: {version[:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}
        block = members.take(int(fields["content-length"]))
        if members.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end after its content length")
        members.end()
        if fields.get("warc-block-digest", "sha1:" + digest32(block)) != "sha1:" + digest32(block):
            raise ValueError(f"block digest of {fields.get('warc-record-id')} does not match")
        yield fields, block


def _page(fields: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", b"\r\n" + head)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    name, refers = fields["warc-record-id"], fields.get("warc-refers-to")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or digest32(payload) != digest):
        raise ValueError(f"payload digest of {name} does not match")
    url = fields["warc-target-uri"]

    def key(text):
        found = text.split(":")[2]
        return int(found) if found else None

    return (
        key(name), None if url == name[1:-1] else url, kind, payload if kind == "response" else None, size, digest,
        key(refers) if refers else None,
    )


PAGES = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
])


def _read(folder: str, rows: int):
    def batch(pages: Iterable[tuple]) -> pa.RecordBatch:
        columns = zip(*pages)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PAGES)], schema=PAGES)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        held, size = [], 0
        for archives in batches:
            for name in archives.column(0).to_pylist():
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for fields, block in read_records(stream):
                        held.append(_page(fields, block))
                        size += len(block)
                        if len(held) >= rows or size >= 8 * PIECE:
                            yield batch(held)
                            held, size = [], 0
        if held:
            yield batch(held)

    return of


def read_archives(folder: str, manifest: DataFrame, rows: int = 1000) -> DataFrame:
    """(page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to) of all records."""
    archives = max(1, manifest.count())
    return manifest.select("archive").repartition(archives, "archive").mapInArrow(
        _read(folder, rows),
        "page_id long, url string, record_type string, payload binary, payload_bytes long, "
        "payload_digest string, refers_to long",
    )
