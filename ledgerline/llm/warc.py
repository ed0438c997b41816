"""WARC archives: writing, normalising monolithic gzip, reading by offset.

Crawlers may hand over archives compressed as one gzip stream, which can only
be read from the start.  ``normalise`` inflates such a stream once, front to
back, rewrites every record as a gzip member of its own and writes a sidecar
index (offset, length, record id, type) beside the archive, so that any record
can be read alone.

Archives are real files below a shared folder.  A task writes files under names
of its own and reports them as rows; the reported table is written by Spark, so
a lost or repeated task leaves at most an unlisted file and never a record
twice.  Archives are closed at about ``ARCHIVE_BYTES`` of payload; records are
streamed through in ``BLOCK`` bytes, so memory does not grow with either.

``write`` marks records with equal payloads: the one with the smallest page id
is a response, the others are revisits that refer to it (no payload stored).

Defined results: null html is an empty payload; a null page id is never the
smallest and is referred to only if its group has no other (as null); rows that
repeat the smallest page id of their group are all responses; an empty table
writes no archive.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.workers import ship
from ledgerline.operators.staging import stage
from ledgerline.session import scratch_path

ARCHIVE_BYTES = 64 << 20
BLOCK = 1 << 20
LEVEL = 3
MANIFEST = "path string, records bigint, bytes bigint"


def _open(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root)


def _header(row: dict) -> bytes:
    """WARC/1.1 header of a record (without its payload)."""

    def urn(page_id: int | None) -> str:
        return f"<urn:page:{'' if page_id is None else page_id}>"

    revisit = row["record_type"] == "revisit"
    url = "".join(c if c > " " else "%20" for c in row["url"] or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {urn(row['page_id'])}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(row['digest'])).decode()}",
        f"X-Payload-Length: {row['payload_bytes']}",
        f"Content-Length: {0 if revisit else row['payload_bytes']}",
    ]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {urn(row['refers_to'])}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return dict(line.split(": ", 1) for line in lines[1:] if line)


def _page(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def with_roles(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest (hex), payload_bytes, record_type, refers_to."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn(
        "payload_bytes", F.octet_length("payload").cast("long")
    )
    groups = rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # only groups of several; a hot digest is one row here, and AQE splits its other side
    shared = groups.where("n > 1").select("digest", "first")
    met = rows.join(shared, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return met.select(
        "page_id",
        "url",
        "payload",
        "digest",
        "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


class _Archive:
    """A growing archive file; ``members``: every record a gzip member of its own."""

    def __init__(self, fs: pafs.FileSystem, folder: str, members: bool):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        self.fs, self.members = fs, members
        self.out = fs.open_output_stream(self.path, compression=None)
        self.zip = None if members else zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        self.records = self.payload = self.at = 0
        self.index: list[str] = []

    def add(self, header: bytes, body: Iterator[bytes]) -> None:
        begin = self.at
        squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31) if self.members else self.zip
        self._put(squeeze.compress(header))
        for block in body:
            self.payload += len(block)
            self._put(squeeze.compress(block))
        self._put(squeeze.compress(b"\r\n\r\n"))
        if self.members:
            self._put(squeeze.flush())
            f = _fields(header.removesuffix(b"\r\n\r\n"))
            entry = {"offset": begin, "length": self.at - begin}
            entry |= {"id": f["WARC-Record-ID"], "type": f["WARC-Type"]}
            self.index.append(json.dumps(entry))
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def close(self) -> tuple[str, int, int]:
        if self.zip is not None:
            self._put(self.zip.flush())
        self.out.close()
        if self.members:
            with self.fs.open_output_stream(f"{self.path}.idx", compression=None) as side:
                side.write("\n".join(self.index).encode())
        return self.path, self.records, self.at


def _manifest(rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
    kinds = (pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "records", "bytes"]
    )


def write(pages: DataFrame, root: str) -> DataFrame:
    """Write ``pages`` as monolithic .warc.gz archives below ``root``; one row per archive."""
    ship(pages.sparkSession)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _open(root)
        fs.create_dir(folder, recursive=True)
        archive, done = None, []
        for batch in batches:
            payloads = batch.column(batch.schema.names.index("payload"))
            for i, row in enumerate(batch.drop_columns(["payload"]).to_pylist()):
                archive = archive or _Archive(fs, folder, members=False)
                body = [] if row["record_type"] == "revisit" else [payloads[i].as_py()]
                archive.add(_header(row), iter(body))
                if archive.payload >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        yield _manifest(done)

    return stage(with_roles(pages).mapInArrow(put, MANIFEST), "warc-written")


class _Stream:
    """A gzip stream inflated once, front to back, in bounded blocks."""

    def __init__(self, source) -> None:
        self.source, self.buffer = source, b""
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        raw = self.inflate.unconsumed_tail or self.source.read(BLOCK)
        while raw or self.inflate.unused_data:
            if self.inflate.eof:  # a further member of the same file
                raw = self.inflate.unused_data + raw
                self.inflate = zlib.decompressobj(31)
            data = self.inflate.decompress(raw, BLOCK)
            if data:
                self.buffer += data
                return True
            raw = self.inflate.unconsumed_tail or self.source.read(BLOCK)
        return False

    def header(self) -> bytes | None:
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.buffer.strip():
                    raise ValueError("archive ends inside a record header")
                return None
        header, self.buffer = self.buffer[:end], self.buffer[end + 4 :]
        return header

    def body(self, length: int) -> Iterator[bytes]:
        while length > 0:
            if not self.buffer and not self._more():
                raise ValueError("archive ends inside a payload")
            block, self.buffer = self.buffer[:length], self.buffer[length:]
            length -= len(block)
            yield block

    def skip(self, expected: bytes) -> None:
        while len(self.buffer) < len(expected) and self._more():
            pass
        if not self.buffer.startswith(expected):
            raise ValueError("record does not end where its length says")
        self.buffer = self.buffer[len(expected) :]


def _spread(manifest: DataFrame) -> DataFrame:
    """One archive a partition (archives are of like size)."""
    n = manifest.count()
    return manifest.repartition(max(1, n))


def normalise(manifest: DataFrame, root: str) -> DataFrame:
    """Rewrite listed archives below ``root`` with a member for each record and a sidecar index."""
    ship(manifest.sparkSession)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _open(root)
        fs.create_dir(folder, recursive=True)
        for batch in batches:
            done = []
            for path in batch.column(0).to_pylist():
                out = _Archive(fs, folder, members=True)
                with fs.open_input_stream(path, compression=None) as source:
                    stream = _Stream(source)
                    while (header := stream.header()) is not None:
                        out.add(header + b"\r\n\r\n", stream.body(int(_fields(header)["Content-Length"])))
                        stream.skip(b"\r\n\r\n")
                done.append(out.close())
            yield _manifest(done)

    listed = _spread(manifest.select("path", "records", "bytes"))
    return stage(listed.mapInArrow(rewrite, MANIFEST), "warc-normal")


RECORDS = (
    "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint"
)


def read(manifest: DataFrame, root: str) -> DataFrame:
    """Records of normalised archives, each read alone through the sidecar index.

    A response's payload is checked against its digest; a revisit has no payload
    (null) but carries the full payload's length and digest.
    """
    ship(manifest.sparkSession)

    def member(file, entry: dict) -> tuple:
        raw = zlib.decompress(file.read_at(entry["length"], entry["offset"]), 31)
        header, _, rest = raw.partition(b"\r\n\r\n")
        f = _fields(header)
        digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
        page_id, size = _page(f["WARC-Record-ID"]), int(f["X-Payload-Length"])
        if f["WARC-Type"] == "revisit":
            to = _page(f["WARC-Refers-To"])
            return page_id, f["WARC-Target-URI"], None, size, digest, "revisit", to
        payload = rest[: int(f["Content-Length"])]
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {entry['id']} does not match its digest")
        return page_id, f["WARC-Target-URI"], payload, size, digest, f["WARC-Type"], None

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(root)
        names = [part.split()[0] for part in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                with fs.open_input_stream(f"{path}.idx", compression=None) as side:
                    entries = [json.loads(x) for x in side.read().decode().split("\n") if x]
                with fs.open_input_file(path) as file:
                    rows, held = [], 0
                    for entry in entries:
                        rows.append(member(file, entry))
                        held += len(rows[-1][2] or b"")
                        if held >= 4 * BLOCK or len(rows) >= 4096:
                            yield batch_of(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(rows)

    return _spread(manifest.select("path", "records", "bytes")).mapInArrow(get, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages``, normalise the archives and read every record back."""
    root = scratch_path(pages.sparkSession, "warc")
    if root.startswith(("/", "file:/")):
        root = "file:///" + root.removeprefix("file:").lstrip("/")
    return read(normalise(write(pages, f"{root}/raw"), f"{root}/normal"), f"{root}/normal")
