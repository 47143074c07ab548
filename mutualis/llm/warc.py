"""WARC archives: a writer of record-at-a-time gzip files and a sequential reader.

Each record is one gzip member. The reader takes a file in blocks, inflates member after member
with an incremental zlib object, frames a record by its Content-Length, and checks the block and
payload digests as the bytes go by; nothing but the record in hand is held.

Writing: each task writes its rows to one file in the shared folder under a name of its own attempt
and lists it in a manifest table; only listed files are read, so a retried or duplicate task leaves
at most an unread file behind. Equal payloads of at least ``min_revisit`` bytes are stored once, as
the response of the smallest page id; the others are revisit records that refer to it.

Null html is an empty payload; a null url leaves out the target, line ends in a url are
percent-encoded. Rows with a null id are responses (an unnamed record), unless an equal payload has
an id to refer to. Rows that repeat the smallest id of their payload are all responses.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import current_scope, materialize, scratch_path, scratch_scope

MIN_REVISIT = 100       # smallest payload (bytes) that may be replaced by a revisit
READ_BLOCK = 1 << 16    # bytes read from a file at a time
LEVEL = 6               # gzip
_ID = "urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"  # pages have no fetch time


class WarcError(ValueError):
    """The archive is not a sequence of whole, well-formed records with right digests."""


def _digest(data: bytes) -> str:
    return "sha256:" + base64.b32encode(hashlib.sha256(data).digest()).decode()


def _uri(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 0x20 or ord(c) == 0x7F else c for c in url)


def record(page_id, url, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One record as a gzip member."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>", f"WARC-Date: {_DATE}",
            "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: {_digest(payload)}", f"WARC-Block-Digest: {_digest(block)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


@dataclass
class Record:
    headers: dict[str, str] = field(default_factory=dict)  # lower-case names
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""
    payload_sha256: str | None = None  # of the stored payload; None for a revisit
    verified: bool = True


def _fields(lines: list[bytes]) -> dict[str, str]:
    out, last = {}, None
    for line in lines:
        if line[:1] in b" \t" and last:
            out[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError(f"not a header line: {line[:60]!r}")
        last = name.strip().decode("utf-8", "replace").lower()
        out[last] = value.strip().decode("utf-8", "replace")
    return out


def _same_digest(stated: str, digest: bytes) -> bool:
    kind, _, value = stated.partition(":")
    if kind.lower() != "sha256":
        raise WarcError(f"digest not supported: {stated[:40]}")
    return value.lower() in (digest.hex(), base64.b32encode(digest).decode().lower())


class _Member:
    """The inflated bytes of one gzip member, on demand."""

    def __init__(self, source, rest: bytes):
        self.source, self.packed, self.out = source, rest, bytearray()
        self.z, self.over = zlib.decompressobj(31), False

    def more(self) -> bool:
        while not self.over:
            if not self.packed:
                self.packed = self.source.read(READ_BLOCK)
                if not self.packed:
                    raise WarcError("the file ends inside a gzip member")
            try:
                got = self.z.decompress(self.packed, READ_BLOCK)
            except zlib.error as e:
                raise WarcError(f"gzip: {e}") from e
            self.packed = self.z.unconsumed_tail
            if self.z.eof:
                self.over, self.packed = True, self.z.unused_data
            if got:
                self.out += got
                return True
        return False

    def line(self) -> bytes:
        seen = 0
        while (at := self.out.find(b"\n", seen)) < 0:
            seen = len(self.out)
            if not self.more():
                raise WarcError("the record ends inside its header")
        got = bytes(self.out[:at])
        del self.out[:at + 1]
        return got.removesuffix(b"\r")

    def header(self) -> list[bytes]:
        lines = []
        while line := self.line():
            lines.append(line)
        return lines

    def take(self, n: int) -> bytes:
        """Up to n bytes, at least one unless the member is over."""
        if not self.out:
            self.more()
        got = bytes(self.out[:n])
        del self.out[:n]
        return got


def read_records(source, strict: bool = True, keep_payload: bool = True) -> Iterator[Record]:
    """The records of a binary stream (``read(n)``) of gzip members, one record each.

    strict: a wrong digest raises; otherwise the record has ``verified`` false. Broken framing
    always raises. Trailing zero bytes of padding are not members and are skipped.
    """
    rest = b""
    while True:
        while not rest.lstrip(b"\0"):
            rest = source.read(READ_BLOCK)
            if not rest:
                return
        member = _Member(source, rest.lstrip(b"\0"))
        if not member.line().startswith(b"WARC/"):
            raise WarcError("the member does not start with a WARC version")
        rec = Record(_fields(member.header()))
        try:
            left = int(rec.headers["content-length"])
        except (KeyError, ValueError) as e:
            raise WarcError("no usable Content-Length") from e
        whole, own, parts = hashlib.sha256(), hashlib.sha256(), []
        is_http = rec.headers.get("content-type", "").startswith("application/http")
        head = bytearray() if is_http else None
        while left:
            got = member.take(left)
            if not got:
                raise WarcError("the record is shorter than its Content-Length")
            left -= len(got)
            whole.update(got)
            if head is not None:
                head += got
                if (at := head.find(b"\r\n\r\n")) < 0:
                    continue
                rec.http = _fields(bytes(head[:at]).split(b"\r\n")[1:])
                got, head = bytes(head[at + 4:]), None
            own.update(got)
            if keep_payload:
                parts.append(got)
        while tail := member.take(READ_BLOCK):
            if tail.strip(b"\r\n"):
                raise WarcError("the record is longer than its Content-Length")
        rest = member.packed
        rec.payload = b"".join(parts)
        if rec.headers.get("warc-type") != "revisit":
            rec.payload_sha256 = own.hexdigest()
        for name, digest in (("warc-block-digest", whole), ("warc-payload-digest", own)):
            stated = rec.headers.get(name)
            if stated and not (name == "warc-payload-digest" and rec.payload_sha256 is None):
                rec.verified &= _same_digest(stated, digest.digest())
        if strict and not rec.verified:
            raise WarcError(f"wrong digest in {rec.headers.get('warc-record-id')}")
        yield rec


def _open(path: str, mode: str):
    """A stream on a shared file, by its URI (file, hdfs, s3, gs)."""
    from pyarrow import fs
    store, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    if mode == "r":
        return store.open_input_stream(inner, compression=None)
    store.create_dir(inner.rpartition("/")[0], recursive=True)
    return store.open_output_stream(inner, compression=None)


def _folder(path: str) -> str:
    """``file:/x`` (as Hadoop writes it) with the two slashes that URIs have."""
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path


def revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html",
             min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``(page_id, digest, refers_to)`` of the pages whose payload an earlier page has."""
    raw = F.coalesce(F.col(html), F.lit(""))
    seen = pages.where(F.octet_length(raw) >= min_revisit).select(
        F.col(page_id).alias("page_id"), F.sha2(raw, 256).alias("digest"))
    seen = materialize(seen, "payload_digests")
    first = seen.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    first = materialize(first.where("n > 1 and refers_to is not null").drop("n"), "first_payloads")
    return seen.join(first, "digest").where("not (page_id <=> refers_to)").select(
        "page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url",
                   html: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write one .warc.gz per task into ``folder`` (a URI that all executors share); returns the
    manifest ``(path, records)``, already written, so it can be read any number of times."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    held = current_scope()
    rows = rows.withColumn("digest", F.sha2(F.coalesce("html", F.lit("")), 256))
    folder = _folder(folder)

    def write(batches):
        out, n, task = None, 0, TaskContext.get()
        path = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        for batch in batches:
            for i in range(batch.num_rows):
                pid, address, body, first = (batch.column(c)[i].as_py() for c in range(4))
                out = out or _open(path, "w")
                out.write(record(pid, address, (body or "").encode(), first, first is not None))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], names=["path", "records"])

    with scratch_scope(pages.sparkSession):
        again = materialize(revisits(rows, "page_id", "html", min_revisit), "revisits").withColumnsRenamed(
            {"page_id": "_page", "digest": "_digest"})
        same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
        rows = rows.join(again, same, "left").select("page_id", "url", "html", "refers_to")
        manifest, stats = materialize(rows.mapInArrow(write, "path string, records long"), "manifest",
                                      {"files": F.count(F.lit(1))}, held)
    # A number that is stated is kept: each task reads one file, however small the manifest is.
    return manifest.repartition(max(1, stats["files"]))


def read_archives(manifest: DataFrame, strict: bool = True) -> DataFrame:
    """One row per record of the listed files: ``(page_id, url, record_type, refers_to,
    payload_bytes, payload_digest, verified, payload)``; length and digest are those of the full
    payload, for a revisit as its headers state them, and its payload is null."""
    schema = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
              "payload_digest string, verified boolean, payload binary")

    def bare(stated: str) -> str:
        value = stated.partition(":")[2]
        return value.lower() if len(value) == 64 else base64.b32decode(value).hex()

    def named(uri: str | None):
        value = (uri or "").strip("<>").removeprefix(_ID)
        return int(value) if value else None

    names = [c.split()[0] for c in schema.split(", ")]

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with _open(path, "r") as source:
                    rows, size = [], 0
                    for rec in read_records(source, strict):
                        h, revisit = rec.headers, rec.payload_sha256 is None
                        rows.append((
                            named(h.get("warc-record-id")), h.get("warc-target-uri"), h.get("warc-type"),
                            named(h.get("warc-refers-to")),
                            int(rec.http.get("content-length", 0)) if revisit else len(rec.payload),
                            bare(h["warc-payload-digest"]) if revisit else rec.payload_sha256,
                            rec.verified, None if revisit else rec.payload))
                        size += len(rec.payload)
                        if size > 1 << 22 or len(rows) >= 4096:
                            yield _batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows)

    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return manifest.select("path").mapInArrow(read, schema)


def archive_round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                       min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write the pages to archives in the shared folder and read the archives back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, page_id, url, html, min_revisit))
