"""WARC archives written and read as a chunked record table.

Payloads never exist as whole records beyond the input row itself: a record goes into its archive chunk by chunk, and
an archive comes back as rows of (record_id, chunk_no, data), each carrying the digest of the payload so far. The
archives are gzip members, one a record, in files of bounded size that the tasks write to a folder all executors
share, through Arrow's file systems. The manifest names the files of finished task attempts only, so files left by a
lost executor are never read.

Of the pages with equal payloads of at least `least` bytes, the one with the largest page_id becomes a response and the
others revisit it. Equality is SHA-1 and length; it is found by a pre-aggregated count per digest, and only digests
that occur twice or more are joined back, so a payload shared by a third of all pages is one row of the small side,
and adaptive execution splits the large side.

Defined cases: null html is an empty payload; empty payloads are equal to each other; of repeated rows with the same
largest page_id each is a response; rows with a null page_id are never referred to unless all copies have none, and
then all are responses; urls are percent-encoded where they would break a header; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from mailloom.llm.common import run_folder, stored
from mailloom.session import arrow_store

#: Bytes of payload in a row of the record table.
CHUNK = 64 * 1024
#: A task starts a new archive after so many bytes.
ARCHIVE_BYTES = 16 << 20
#: Tasks that read archives, if there are so many.
READERS = 20_000

MANIFEST = "path string, records long"
CHUNKS = (
    "record_id long, record_type string, refers_to long, target_uri string, chunk_no long, data binary, "
    "bytes_so_far long, digest_so_far string, is_last boolean, payload_bytes long, payload_digest string"
)

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def planned(pages: DataFrame, least: int = 0, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """record_id, target_uri, payload, record_type and refers_to of every page."""
    rows = pages.select(
        F.col(page).cast("long").alias("record_id"), F.col(url).alias("target_uri"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload")
    ).withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    repeated = rows.where(F.col("size") >= least).groupBy("digest", "size").agg(F.max("record_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    revisits = F.col("first_id").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("first_id"))
    return rows.join(repeated, ["digest", "size"], "left").select(
        "record_id", "target_uri", "payload", F.when(revisits, "revisit").otherwise("response").alias("record_type"), F.when(revisits, F.col("first_id")).alias("refers_to")
    )


def _header(kind: str, record_id, uri: str | None, refers_to, date: str, digest: str, size: int, content: int) -> bytes:
    uri = "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in uri) if uri is not None else None
    # Page numbers may repeat or lack, record ids must not.
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {date}"]
    if record_id is not None:
        lines.append(f"X-Page: {record_id}")
    if uri is not None:
        lines.append(f"WARC-Target-URI: {uri}")
    if refers_to is not None:
        lines += [f"X-Refers-To-Page: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}", "Content-Type: application/http; msgtype=response", f"Content-Length: {content}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def write_archives(planned_rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, chunk: int = CHUNK) -> DataFrame:
    """Write the records below a shared folder; the manifest of finished archives, itself stored."""
    date = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = arrow_store(folder)
        number = TaskContext.get().partitionId()
        out, path, n = None, "", 0

        def close() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": pa.array([path]), "records": pa.array([n], pa.int64())})

        for batch in batches:
            columns = [batch.column(c) for c in ("record_id", "target_uri", "payload", "record_type", "refers_to")]
            for i in range(batch.num_rows):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    name = f"{number:06d}-{uuid.uuid4().hex}.warc.gz"
                    out, path, n = fs.open_output_stream(f"{base}/{name}", compression=None), f"{folder}/{name}", 0
                record_id, uri, _, kind, refers = (c[i].as_py() if k != 2 else None for k, c in enumerate(columns))
                payload = memoryview(columns[2][i].as_buffer())
                size, sha = len(payload), hashlib.sha1()
                for at in range(0, size, chunk):
                    sha.update(payload[at : at + chunk])
                http = _HTTP % size
                body = size if kind == "response" else 0
                z = zlib.compressobj(1, zlib.DEFLATED, 31)
                out.write(z.compress(_header(kind, record_id, uri, refers, date, _base32(sha.digest()), size, len(http) + body) + http))
                for at in range(0, body, chunk):
                    out.write(z.compress(payload[at : at + chunk]))
                out.write(z.compress(b"\r\n\r\n") + z.flush())
                n += 1
                if out.tell() >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return stored(planned_rows.mapInArrow(task, MANIFEST), "warc-manifest")


def _bytes(source, size: int = 1 << 18) -> Iterator[bytes]:
    """The unpacked bytes of an archive, in pieces of bounded size."""
    z = zlib.decompressobj(31)
    while packed := source.read(size):
        while packed:
            yield z.decompress(packed, size)
            packed = z.unconsumed_tail
            if z.eof:  # then the tail, if any, is unused data too, and of the next member
                packed = z.unused_data
                z = zlib.decompressobj(31)
    yield z.flush()  # a few bytes may wait when a piece was just full


class _Reader:
    """Lines and bounded pieces of a stream."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.held, self.at = pieces, b"", 0

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.held, self.at = self.held[self.at :] + piece, 0
        return True

    def until(self, mark: bytes) -> bytes | None:
        while (end := self.held.find(mark, self.at)) < 0:
            if not self.more():
                return None
        got, self.at = self.held[self.at : end], end + len(mark)
        return got

    def up_to(self, n: int) -> bytes:
        while self.at >= len(self.held):
            if not self.more():
                raise EOFError("an archive ends within a record")
        got = self.held[self.at : self.at + n]
        self.at += len(got)
        return got


def read_archives(manifest: DataFrame, chunk: int = CHUNK, data: bool = True) -> DataFrame:
    """The record table of the archives a manifest names: one row per chunk, at least one per record.

    Every chunk carries the number of payload bytes and the digest (base32 SHA-1) up to its end. payload_bytes and
    payload_digest are set in the last chunk: for a response what was read, for a revisit what its header states of
    the payload it stands for. A response that differs from its header raises.
    """
    names = [part.split()[0] for part in CHUNKS.split(", ")]
    types = pa.schema(
        [("record_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string()), ("chunk_no", pa.int64()), ("data", pa.binary())]
        + [("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("is_last", pa.bool_()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    )

    def records(path: str) -> Iterator[tuple]:
        fs, name = arrow_store(path)
        with fs.open_input_stream(name, compression=None) as source:
            r = _Reader(_bytes(source))
            while (head := r.until(b"\r\n\r\n")) is not None:
                field = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
                number = lambda k: int(v) if (v := field.get(k)) else None
                http = r.until(b"\r\n\r\n")
                left = int(field["Content-Length"]) - len(http) - 4
                head_of = (number("X-Page"), field["WARC-Type"], number("X-Refers-To-Page"), field.get("WARC-Target-URI"))
                size, stated = int(field["X-Payload-Length"]), field["WARC-Payload-Digest"].removeprefix("sha1:")
                sha, done, k = hashlib.sha1(), 0, 0
                while True:
                    parts, have = [], 0
                    while have < chunk and left:
                        parts.append(r.up_to(min(left, chunk - have)))
                        have += len(parts[-1])
                        left -= len(parts[-1])
                        sha.update(parts[-1])
                    done += have
                    digest = _base32(sha.digest())
                    last = not left
                    if last and head_of[1] == "response" and (digest, done) != (stated, size):
                        raise ValueError(f"record {head_of[0]}: payload differs from its header")
                    yield (*head_of, k, b"".join(parts) if data else None, done, digest, last, size if last else None, stated if last else None)
                    k += 1
                    if last:
                        break
                if r.until(b"\r\n\r\n") is None:
                    raise EOFError("an archive ends within a record")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for row in records(path):
                    rows.append(row)
                    held += 200 + len(row[5] or b"")
                    if held >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], names=names)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], names=names)

    return manifest.select("path").mapInArrow(task, CHUNKS)


def archive(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write pages into archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    manifest = write_archives(planned(pages, least), run_folder(pages.sparkSession, "warc"))
    # The names are few bytes, the archives are not: one task an archive, up to a bound.
    files = manifest.repartition(max(1, min(manifest.count(), READERS)))
    return read_archives(files, data=False).where("is_last").select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
