"""WARC archives: writing, normalising whole-file gzip streams, reading by an index.

``write`` makes archives that are one gzip stream from start to end, as some
crawlers leave them. ``normalise`` inflates such a stream once, writes every
record as a gzip member of its own, and a sidecar index of their offsets.
``read`` opens single members through the index.

Files are written by the tasks, through ``pyarrow.fs``, into a folder that all
executors share. A task writes under a name of its own and moves the file to its
final name when it is complete, so a repeated task leaves whole files, and only
files that a finished task reports are read.

A null or empty payload is an empty one. Rows with the same page id and payload
are all written; of equal payloads, all rows with the largest id are responses.
Empty tables make no file. Other columns than those named are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.operators.spread import spread_join
from pagequarry.session import Workspace

MIN_REVISIT = 1000
FILE_BYTES = 64 << 20  # of records in one archive
READ_BYTES = 1 << 20
DATE = "2024-01-01T00:00:00Z"
FILES = "path string, index string, records long"


def with_types(pages: DataFrame, ws: Workspace, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """pages(page_id, url, payload binary) with digest, record_type and refers_to.

    Payloads stay in their rows. Only digests are grouped, and the table of those
    that repeat, a row for each, is broadcast if its measured size allows.
    """
    pages = pages.withColumn("payload", F.coalesce("payload", F.lit(b""))).withColumn(
        "digest", F.sha1("payload")
    )
    length = F.octet_length("payload")
    repeats = ws.save(
        pages.where(length >= min_revisit)
        .groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n"),
        "repeats",
    )
    joined = spread_join(pages, repeats, ["digest"], "left", spread_on=["page_id"])
    revisit = F.coalesce(F.col("refers_to") != F.col("page_id"), F.lit(False))
    return joined.withColumn(
        "record_type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    ).withColumn("refers_to", F.when(revisit, F.col("refers_to")))


def _id(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>"


def record(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC record: an HTTP response, or its head alone for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if kind == "response" else b"")
    named = "".join(c for c in (url or "") if c not in "\r\n")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_id(page_id)}",
        f"WARC-Target-URI: {named}",
        f"WARC-Date: {DATE}",
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_id(refers_to)}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


class Archive:
    """A file under a temporary name that gets its own when it is complete."""

    def __init__(self, folder: str, name: str):
        self.fs, root = fs.FileSystem.from_uri(folder)
        self.fs.create_dir(root, recursive=True)
        self.target, self.made = f"{root}/{name}", f"{root}/_{uuid.uuid4().hex}"
        self.out: BinaryIO = self.fs.open_output_stream(self.made, compression=None)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.made, self.target)


def write(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES, level: int = 1) -> DataFrame:
    """Archives of single gzip streams below ``folder``: files(path, index null, records).

    Takes rows of ``with_types``. Each task fills files of about ``file_bytes``.
    """

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[str, int]] = []
        file, size, n = None, 0, 0

        def finish() -> None:
            file.out.write(gz.flush())
            file.close()
            done.append((name, n))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if file is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    file, size, n = Archive(folder, name), 0, 0
                    gz = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = record(*row)
                file.out.write(gz.compress(data))
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    finish()
                    file = None
        if file is not None:
            finish()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f"{folder}/{name}" for name, _ in done], pa.string()),
                pa.array([None] * len(done), pa.string()),
                pa.array([n for _, n in done], pa.int64()),
            ],
            names=["path", "index", "records"],
        )

    columns = ["page_id", "url", "payload", "digest", "record_type", "refers_to"]
    return records.select(*columns).mapInArrow(archive, FILES)


def records_of(source: BinaryIO) -> Iterator[bytes]:
    """Records of a gzip file of one or many members, inflated as a stream, each once."""
    gz, pending, ahead = zlib.decompressobj(31), bytearray(), None
    while chunk := source.read(READ_BYTES):
        while chunk:
            pending += gz.decompress(chunk)
            chunk = gz.unused_data
            if gz.eof:
                gz = zlib.decompressobj(31)
        at = 0
        while True:
            if ahead is None:  # length of the record that begins at ``at``
                end = pending.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                head = bytes(pending[at:end]).lower()
                length = int(head.rpartition(b"\r\ncontent-length:")[2].split(b"\r\n")[0])
                ahead = end + 4 + length + 4 - at
            if len(pending) - at < ahead:
                break
            yield bytes(pending[at : at + ahead])
            at, ahead = at + ahead, None
        del pending[:at]
    if pending:
        raise ValueError("the last record is not complete")


def normalise(files: DataFrame, folder: str, level: int = 4) -> DataFrame:
    """Rewrite archives with a gzip member for each record, and index their offsets.

    The index has a line of JSON for each record: offset and length of its member,
    record id, type, and target.
    """

    def rewrite(path: str) -> tuple[str, str, int]:
        system, at = fs.FileSystem.from_uri(path)
        name = path.rpartition("/")[2].removesuffix(".warc.gz")
        archive, index = Archive(folder, f"{name}.warc.gz"), Archive(folder, f"{name}.idx")
        offset = n = 0
        with system.open_input_stream(at, compression=None) as source:
            for data in records_of(source):
                headers, _ = parse(data)
                gz = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = gz.compress(data) + gz.flush()
                archive.out.write(member)
                entry = {
                    "offset": offset,
                    "length": len(member),
                    "id": headers["warc-record-id"],
                    "type": headers["warc-type"],
                    "uri": headers["warc-target-uri"],
                }
                index.out.write(json.dumps(entry).encode() + b"\n")
                offset, n = offset + len(member), n + 1
        archive.close()
        index.close()
        return f"{folder}/{name}.warc.gz", f"{folder}/{name}.idx", n

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [rewrite(p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*made) if made else ([], [], []), (pa.string(), pa.string(), pa.int64()))],
                names=["path", "index", "records"],
            )

    return _dealt(files).select("path").mapInArrow(each, FILES)


def _dealt(files: DataFrame) -> DataFrame:
    """Files dealt out over the tasks, about one to each."""
    n = max(1, files.count())
    return files.repartition(n)


READ = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


def read(files: DataFrame) -> DataFrame:
    """Records of normalised archives, each opened by its place in the index.

    A response's digest comes from its payload and must be the one in its header.
    A revisit has no payload; length and digest come from its headers.
    """

    def page(name: str | None) -> int | None:
        number = name.removeprefix("<urn:page:").removesuffix(">") if name else "None"
        return None if number == "None" else int(number)

    def row(data: bytes) -> tuple:
        headers, block = parse(data)
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(http.lower().rpartition(b"content-length:")[2])
        digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
        kind = headers["warc-type"]
        if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"{headers['warc-record-id']}: the payload is not the one that was written")
        refers = page(headers.get("warc-refers-to"))
        body = payload if kind == "response" else None
        return page(headers["warc-record-id"]), headers["warc-target-uri"], body, length, digest, kind, refers

    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in READ.split(", ")]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[tuple] = []
                size = 0
                system, at = fs.FileSystem.from_uri(path)
                with system.open_input_file(at) as archive, system.open_input_stream(
                    fs.FileSystem.from_uri(index)[1], compression=None
                ) as lines:
                    for line in lines.read().splitlines():
                        entry = json.loads(line)
                        archive.seek(entry["offset"])
                        data = zlib.decompress(archive.read(entry["length"]), 31)
                        rows.append(row(data))
                        size += len(data)
                        if size >= READ_BYTES * 4:
                            yield packed(rows)
                            rows, size = [], 0
                if rows:
                    yield packed(rows)

    return _dealt(files).select("path", "index").mapInArrow(each, READ)
