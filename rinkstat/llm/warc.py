"""WARC archives written and read as a chunked record table.

Writing: each task streams its records into gzip members of ``.warc.gz`` files
in a shared folder and returns where each block of records lies.  Only files
that the stored manifest names belong to the archive; a lost attempt leaves
files that nothing refers to.

Reading: a block of records is streamed, and every record becomes rows
``(record, chunk_no, ...)`` of at most ``chunk_bytes`` of payload.  A row carries
the digest and size of the payload so far, so the last chunk's row tells those
of the whole, and no payload is ever held as one value.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shielded, stored

CHUNK_BYTES = 1 << 20
BLOCK_BYTES = 1 << 24
FILE_BYTES = 1 << 28
#: Blocks that one task reads, on average, where there are more than cores.
BLOCKS_PER_TASK = 8
MANIFEST = "path string, begin long, end long, n_records long"
CHUNKS = (
    "record string, record_id string, target_uri string, record_type string, refers_to string, declared_digest string,"
    " declared_bytes long, chunk_no long, is_last boolean, data binary, bytes_so_far long, digest_so_far string"
)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_revisits(pages: DataFrame, key: str = "page_id", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """``pages`` with ``payload_sha1``, ``payload_bytes``, ``refers_to``, ``record_type``.

    Of records with equal payloads of at least ``least_bytes`` bytes, those with
    the largest key are responses and the others revisit it (repeated rows of
    that key are all responses; a NULL key is below all others).  Only groups of
    two or more are joined back; a common payload is summed up per task first.
    An empty table stays empty; columns of these four names are replaced, any
    others kept.  ``key`` and ``payload`` don't begin with ``_``.
    """
    pages, back = shielded(pages)
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    known = pages.drop("payload_sha1", "payload_bytes", "refers_to", "record_type").withColumns(
        {"payload_sha1": F.sha1(body), "payload_bytes": F.octet_length(body).cast("long")}
    )
    groups = stored(
        known.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_sha1")
        .agg(F.max(key).alias("_last"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        .select(F.col("payload_sha1").alias("_sha1"), "_last"),
        "equal-payloads",
    )
    refers = F.when(~F.col(key).eqNullSafe(F.col("_last")), F.col("_last"))
    return back(
        known.join(groups, F.col("payload_sha1") == F.col("_sha1"), "left").select(
            *known.columns, refers.alias("refers_to"),
            F.when(refers.isNull(), "response").otherwise("revisit").alias("record_type"),
        )
    )


def _urn(key: object) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def _key(urn: str | None) -> str | None:
    return urn.removeprefix("<urn:page:").removesuffix(">") or None if urn else None


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI and the path in it; Hadoop's names of S3 are Arrow's ``s3``."""
    scheme, rest = folder.split("://", 1) if "://" in folder else ("", folder)
    try:
        return pafs.FileSystem.from_uri(f"s3://{rest}" if scheme in ("s3a", "s3n") else folder)
    except pa.ArrowInvalid as e:
        raise ValueError(f"archives can't be written to {folder}: pyarrow knows no file system for {scheme or 'it'}") from e


class _Writer:
    """Streams records into rolled files; ``blocks`` are the manifest rows."""

    def __init__(self, folder: str, level: int):
        self.store, self.folder = opened(folder)
        self.level, self.out, self.blocks = level, None, []

    def _open(self) -> None:
        self.path = f"{self.folder}/{uuid.uuid4().hex}.warc.gz"
        self.out, self.at, self.begin, self.n = self.store.open_output_stream(self.path, compression=None), 0, 0, 0

    def _end_block(self) -> None:
        if self.n:
            self.blocks.append((self.path, self.begin, self.at, self.n))
        self.begin, self.n = self.at, 0

    def close(self) -> None:
        if self.out is not None:
            self._end_block()
            self.out.close()
            self.out = None

    def write(self, head: bytes, payload: memoryview) -> None:
        if self.out is None:
            self._open()
        squeeze = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        parts = (head, *(payload[i : i + CHUNK_BYTES] for i in range(0, len(payload), CHUNK_BYTES)), b"\r\n\r\n")
        for part in parts:
            self._put(squeeze.compress(part))
        self._put(squeeze.flush())
        self.n += 1
        if self.at - self.begin >= BLOCK_BYTES:
            self._end_block()
        if self.at >= FILE_BYTES:
            self.close()

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.at += len(data)


def _head(key: object, uri: str | None, digest: str, size: int, refers_to: object, is_revisit: bool, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {_urn(key)}", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + (0 if is_revisit else size)}",
    ]
    if uri is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    if is_revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


def write_archives(
    records: DataFrame, folder: str, key: str = "page_id", uri: str = "url", payload: str = "html",
    date: str = "1970-01-01T00:00:00Z", level: int = 1,
) -> DataFrame:
    """Writes the rows of ``with_revisits`` as WARC records; returns the stored manifest.

    NULL payloads are empty, a NULL key has an empty id, a NULL uri no header.
    ``folder`` is any URI that pyarrow's file systems know, shared by all machines.
    """
    store, path = opened(folder)
    store.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Writer(folder, level)
        for batch in batches:
            rows = {c: batch.column(c).to_pylist() for c in ("_key", "_uri", "payload_sha1", "payload_bytes", "refers_to", "record_type")}
            bodies = batch.column("_payload")
            for i, kind in enumerate(rows["record_type"]):
                head = _head(
                    rows["_key"][i], rows["_uri"][i], rows["payload_sha1"][i], rows["payload_bytes"][i],
                    rows["refers_to"][i], kind == "revisit", date,
                )
                body = bodies[i].as_buffer() if kind != "revisit" and rows["payload_bytes"][i] else b""
                out.write(head, memoryview(body))
        out.close()
        columns = list(zip(*out.blocks, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
            names=["path", "begin", "end", "n_records"],
        )

    rows = records.select(
        F.col(key).alias("_key"), F.col(uri).cast("string").alias("_uri"), F.col(payload).cast("string").alias("_payload"),
        "payload_sha1", "payload_bytes", "refers_to", "record_type",
    )
    return stored(rows.mapInArrow(write, MANIFEST), "warc-manifest")


class _Reader:
    """Streams the records of one block of a file."""

    def __init__(self, store, path: str, begin: int, end: int):
        self.file, self.path, self.end = store.open_input_file(path), path, end
        self.file.seek(begin)
        self.raw, self.place = b"", begin  # place: of the first byte of raw

    def _member(self) -> Iterator[bytes]:
        """The plain bytes of the next gzip member, a piece at a time."""
        plain = zlib.decompressobj(31)
        while not plain.eof:
            raw = plain.unconsumed_tail or self.raw or self.file.read(1 << 16)
            if not raw:
                raise EOFError(f"{self.path} ends within a record")
            self.raw = b""
            piece = plain.decompress(raw, CHUNK_BYTES)
            if piece:
                yield piece
        self.raw = plain.unused_data
        self.place = self.file.tell() - len(self.raw)

    def records(self) -> Iterator[tuple[int, Iterator[bytes]]]:
        while self.place < self.end:
            member = self._member()
            yield self.place, member
            for _ in member:  # what the caller has left
                pass


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}


def _split_head(have: bytes, pieces: Iterator[bytes]) -> tuple[bytes, bytes]:
    while (at := have.find(b"\r\n\r\n")) < 0:
        have += next(pieces)
    return have[:at], have[at + 4 :]


def record_chunks(pieces: Iterator[bytes], chunk_bytes: int) -> Iterator[tuple[dict, dict, int, bool, bytes, int, str]]:
    """``(warc fields, http fields, chunk_no, is_last, data, bytes so far, digest so far)`` of one record."""
    head, rest = _split_head(b"", pieces)
    warc = _fields(head)
    left = int(warc["content-length"])
    http_head, rest = _split_head(rest, pieces)
    http, left = _fields(http_head), left - len(http_head) - 4
    sha1, number, so_far = hashlib.sha1(), 0, 0
    while True:
        while len(rest) < min(chunk_bytes, left):
            rest += next(pieces)
        data, rest = rest[: min(chunk_bytes, left)], rest[min(chunk_bytes, left) :]
        sha1.update(data)
        so_far, left = so_far + len(data), left - len(data)
        yield warc, http, number, left == 0, data, so_far, base64.b32encode(sha1.copy().digest()).decode()
        if not left:
            return
        number += 1


def read_chunks(manifest: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives in ``manifest``.

    ``record`` tells records apart even if ids repeat.  An empty payload has one
    empty chunk; without ``with_data`` the data column stays NULL.
    """
    names = [c.split()[0] for c in CHUNKS.split(",")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = opened(folder)
        schema = pa.schema(list(zip(names, [
            *[pa.string()] * 6, pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.string()], strict=True)))
        for batch in batches:
            for block in batch.to_pylist():
                rows, held = [], 0
                for place, member in _Reader(store, block["path"], block["begin"], block["end"]).records():
                    for warc, http, number, last, data, so_far, digest in record_chunks(member, chunk_bytes):
                        rows.append((
                            f"{block['path']}#{place}", _key(warc["warc-record-id"]), warc.get("warc-target-uri"), warc["warc-type"],
                            _key(warc.get("warc-refers-to")), warc["warc-payload-digest"].removeprefix("sha1:"),
                            int(http["content-length"]), number, last, data if with_data else None, so_far, digest,
                        ))
                        held += 500 + len(data) * with_data
                        if held > 4 * CHUNK_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    # The manifest is small, so the number of tasks has to be named: AQE would merge them into one.
    parallel = manifest.sparkSession.sparkContext.defaultParallelism
    tasks = max(parallel, -(-manifest.count() // BLOCKS_PER_TASK))
    return manifest.repartition(tasks, "path", "begin").mapInArrow(read, CHUNKS)


def verified(chunks: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``chunks`` read with data; a row whose data isn't as long as its place in the payload says fails the query."""
    size = F.octet_length("data")
    whole = F.col("is_last") | (size == chunk_bytes)
    right = (F.col("bytes_so_far") == F.col("chunk_no") * chunk_bytes + size) & whole
    said = F.concat(F.lit("payload bytes missing in "), F.col("record"), F.lit(" chunk "), F.col("chunk_no").cast("string"))
    return chunks.filter(F.when(F.coalesce(right, F.lit(False)), F.lit(True)).otherwise(F.raise_error(said).cast("boolean")))


def records_of(chunks: DataFrame) -> DataFrame:
    """One row per record: its headers, and size and digest of the payload it holds, from its last chunk."""
    return chunks.filter("is_last").select(
        "record", "record_id", "target_uri", "record_type", "refers_to", "declared_digest", "declared_bytes",
        F.col("bytes_so_far").alias("stored_bytes"), F.col("digest_so_far").alias("stored_digest"),
    )
