"""Zstandard web archives: writer, and a reader that checks what it reads.

An archive begins with a skippable frame that holds the dictionary; then each record is a frame of its own, so a
record can be read alone and a damaged one does not hide the next. A record is a response with its payload, or a revisit
that refers to the response with the same payload.

The writer makes one archive per partition of its input, named by the partition, and renames it when it is
complete: a lost task writes the same name again, and a half-written archive never has the final name. The folder
must be one that all executors share; ``pyarrow.fs`` opens it by its address.

The reader takes the archives from Spark's ``binaryFile`` source and decodes frame by frame. It checks the dictionary
frame, the version line, the named headers, the declared length against the block, the end mark, the digest of
payloads, and that a frame holds exactly one record; a failure is an error with the archive, the offset and the cause.

Edge cases: a null payload is empty; a null id is written as "null" and read back as null; rows with equal ids are
records of their own; an empty table writes archives without records, which read back as no rows. Too few or too
short records for a dictionary give an archive without one, which begins with the first record.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import struct
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmill.session import cut_lineage, new_path

# Fixed values of the formats: frame numbers, version line, end of a record, named headers.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
EMPTY_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "2024-01-01T00:00:00Z"
#: Bytes of dictionary, and of payload heads it is trained on (the first rows of a partition).
DICTIONARY, SAMPLE, HEAD = 32_768, 4 << 20, 16_384
#: Bytes of payloads that a task holds for the dictionary, and of an archive.
HELD, ROLL = 32 << 20, 128 << 20
RECORD = "path string, offset long, page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, page: str, url: str, refers_to: str | None, sha1: str, size: int, payload: bytes) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{page}>"),
        ("WARC-Target-URI", re.sub(r"[\r\n]", "", url)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{sha1}"),
        *([("WARC-Profile", EMPTY_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")] if kind == "revisit" else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = b"\r\n".join([VERSION, *(f"{k}: {v}".encode() for k, v in headers)])
    return head + b"\r\n\r\n" + block + END


def train(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary, or nothing where the samples do not carry one."""
    if len(samples) < 8 or sum(map(len, samples)) < 16 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def open_folder(address: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of an address; a bare path is local."""
    if not urlsplit(address).scheme:
        return fs.LocalFileSystem(), address
    return fs.FileSystem.from_uri(address)


def write(records: DataFrame, folder: str) -> None:
    """Writes rows (page_id, url, payload, payload_digest, refers_to) as archives: at least one per partition, a new one
    once ``ROLL`` bytes are written, so that a reader never holds much more. A task holds the first payloads, up to ``HELD``
    bytes, to make the dictionary; all others pass one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, path = open_folder(folder)
        name = f"part-{context.partitionId():05d}"
        store.create_dir(path, recursive=True)

        def rows() -> Iterator[dict]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}

        stream, held, size, whole = rows(), [], 0, 0
        for row in stream:
            held.append(row)
            size += min(HEAD, len(row["payload"] or b""))
            whole += len(row["payload"] or b"")
            if size >= SAMPLE or whole >= HELD:
                break
        # Short texts repeat across pages, so the heads of the first pages make the dictionary.
        words = train([r["payload"][:HEAD] for r in held if r["payload"]])
        packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(words)) if words else zstandard.ZstdCompressor(level=3)
        every, made, left = itertools.chain(held, stream), [], True
        while left:
            n, left = 0, False
            final, unfinished = f"{path}/{name}-{len(made):04d}.warc.zst", f"{path}/.{name}-{len(made):04d}-{context.taskAttemptId()}"
            with store.open_output_stream(unfinished) as out:
                if words:
                    out.write(struct.pack("<II", DICTIONARY_FRAME, len(words)) + words)
                for row in every:
                    payload = row["payload"] or b""
                    page = "null" if row["page_id"] is None else str(row["page_id"])
                    revisit = row["refers_to"] is not None
                    record = _record("revisit" if revisit else "response", page, row["url"] or "", str(row["refers_to"]), row["payload_digest"], len(payload), b"" if revisit else payload)
                    out.write(packer.compress(record))
                    n += 1
                    if out.tell() >= ROLL:
                        left = True
                        break
            made.append((unfinished, final, n))
        # All or none: a task that fails before leaves no archive behind.
        for unfinished, final, _ in made:
            store.move(unfinished, final)
        yield pa.RecordBatch.from_arrays([pa.array([f for _, f, _ in made]), pa.array([n for *_, n in made], pa.int64())], names=["path", "n"])

    records.select("page_id", "url", "payload", "payload_digest", "refers_to").mapInArrow(run, "path string, n long").agg(F.sum("n")).collect()


class Archive:
    """The frames of an archive held in memory; ``records`` yields (offset, record)."""

    PIECE = 1 << 16

    def __init__(self, path: str, data: bytes):
        self.path, self.data, self.at = path, memoryview(data), 0
        words = None
        if len(data) >= 8:
            magic, size = struct.unpack_from("<II", data)
            if magic == DICTIONARY_FRAME:
                if 8 + size > len(data):
                    raise self.fault("the dictionary frame is cut off")
                content = bytes(self.data[8 : 8 + size])
                # A dictionary may itself be compressed.
                if content[:4] == struct.pack("<I", ZSTD_FRAME):
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                words, self.at = zstandard.ZstdCompressionDict(content), 8 + size
        self.unpacker = zstandard.ZstdDecompressor(dict_data=words) if words else zstandard.ZstdDecompressor()

    def fault(self, cause: str) -> ValueError:
        return ValueError(f"{self.path} at {self.at}: {cause}")

    def records(self) -> Iterator[tuple[int, bytes]]:
        while self.at < len(self.data):
            begin, frame, out = self.at, self.unpacker.decompressobj(), []
            while not frame.eof:
                piece = self.data[self.at : self.at + self.PIECE]
                if not piece:
                    raise self.fault("the last frame is cut off")
                try:
                    out.append(frame.decompress(piece))
                except zstandard.ZstdError as error:
                    raise self.fault(f"not a frame: {error}") from None
                self.at += len(piece) - len(frame.unused_data)
            yield begin, b"".join(out)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record; raises ValueError with the cause."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] != VERSION:
        raise ValueError("not a record of a known version")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or not name.strip():
            raise ValueError(f"header without a name: {line!r}")
        headers[name.strip().lower()] = value.strip()
    if missing := [n for n in REQUIRED if n not in headers]:
        raise ValueError(f"missing headers {missing}")
    if not headers["content-length"].isdecimal():
        raise ValueError("length is no number")
    size = int(headers["content-length"])
    if len(rest) != size + len(END):
        raise ValueError(f"length is {headers['content-length']}, the block has {len(rest) - len(END)}")
    if rest[size:] != END:
        raise ValueError("end mark is missing")
    return headers, rest[:size]


def _page(identifier: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+|null)>", identifier or "")
    return int(found[1]) if found and found[1] != "null" else None


def unfold(record: bytes) -> dict:
    """The fields of a page record; raises ValueError with the cause."""
    headers, block = parse(record)
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        raise ValueError(f"type {kind!r}")
    http, mark, payload = block.partition(b"\r\n\r\n")
    declared = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    if not mark or not declared:
        raise ValueError("no HTTP header with a length")
    size, sha1 = int(declared[1]), headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or digest(payload) != sha1):
        raise ValueError("payload differs from its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in headers):
        raise ValueError("revisit with a payload or without a reference")
    return {
        "page_id": _page(headers["warc-record-id"]), "url": headers.get("warc-target-uri"), "record_type": kind,
        "refers_to": _page(headers.get("warc-refers-to")), "payload_digest": sha1, "payload_bytes": size,
        "payload": payload if kind == "response" else None,
    }


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives ``*.warc.zst`` of a folder (``RECORD``); every record is checked."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [("path", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())]
        schema = pa.schema(types)
        for batch in batches:
            for i in range(batch.num_rows):
                archive = Archive(batch.column("path")[i].as_py(), batch.column("content")[i].as_buffer())
                rows, size = [], 0
                for offset, record in archive.records():
                    try:
                        row = unfold(record)
                    except ValueError as error:
                        raise archive.fault(f"record at {offset}: {error}") from None
                    if not payloads:
                        row["payload"] = None
                    rows.append({"path": archive.path, "offset": offset, **row})
                    size += len(row["payload"] or b"") + 200
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return files.mapInArrow(run, RECORD)


def with_references(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """Rows for ``write``: of equal payloads of at least ``least`` bytes, the largest id is the response.

    Only digests that occur twice or more are joined back, so a table without copies moves no payload.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [digest(v.as_buffer()) if v.is_valid else digest(b"") for v in batch.column("payload")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.string())], names=[*batch.schema.names, "payload_digest"])

    plain = pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.encode(F.col(f"`{payload}`").cast("string"), "UTF-8"), F.lit(b"")).alias("payload"))
    summed = plain.mapInArrow(run, "page_id long, url string, payload binary, payload_digest string")
    narrow = cut_lineage(summed.select("page_id", "payload_digest", F.octet_length("payload").alias("size")), "digests")
    shared = cut_lineage(
        narrow.where(F.col("size") >= least).groupBy("payload_digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1 and last is not null").select(F.col("payload_digest").alias("_digest"), "last"),
        "shared",
    )
    joined = summed.join(shared, F.col("payload_digest") == F.col("_digest"), "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("last")), F.col("last"))
    return joined.select("page_id", "url", "payload", "payload_digest", refers.alias("refers_to"))


def round_trip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Writes the pages as archives and reads them back without payloads."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "archives")
    write(with_references(pages, **options), folder)
    return read(spark, folder, payloads=False)


def oracle(least: int = 0) -> str:
    """The records of ``pages`` in DuckDB SQL."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    # Five hex digits are 20 bits, which are four letters of five bits.
    text = " || ".join(
        f"substr('{letters}', 1 + CAST((CAST('0x' || substr(h, {1 + 5 * g}, 5) AS INTEGER) >> {shift}) & 31 AS INTEGER), 1)" for g in range(8) for shift in (15, 10, 5, 0)
    )
    return f"""
WITH sums AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
named AS (SELECT page_id, payload_bytes, {text} AS payload_digest FROM sums),
lasts AS (SELECT *, CASE WHEN payload_bytes >= {least} THEN max(page_id) OVER (PARTITION BY payload_digest) END AS last FROM named)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM lasts"""
