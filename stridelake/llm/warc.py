"""WARC archives: written by tasks as one gzip member per record, and read back in sequence.

Of pages with equal payloads of at least `least` bytes, the one with the smallest id is stored as a response and
the others as revisits that refer to it; smaller payloads are always stored. Tasks write their files to the shared
folder under names of their own and return a manifest row per file. Only rows of finished tasks reach the written
manifest, so files of lost or repeated tasks are never read. The reader takes a file in blocks, inflates one member
after the other, frames a record by its content length, and checks the digests of its block and payload.

Null payloads are empty. Equal payloads with equal ids (repeated rows) are all responses, a null id is larger
than all others, and null URLs are stored as empty.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from stridelake.llm.names import free_name
from stridelake.llm.packed import qualified, raw_texts, store
from stridelake.session import new_folder

# Marks of the format.
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_HEAD = "urn:page:"

REVISIT_BYTES = 100
FILE_BYTES = 64 << 20
BLOCK_BYTES = 1 << 18
HEAD_BYTES = 1 << 20
ARCHIVE_DATE = "2024-01-01T00:00:00Z"
MANIFEST = "file string, records long, bytes long"
RECORDS = "record_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to string"


class DamagedArchive(ValueError):
    pass


def head(fields: list[tuple[str, object]], first: bytes) -> bytes:
    return b"\r\n".join([first, *(f"{k}: {v}".encode() for k, v in fields if v is not None)]) + END


def one_line(text: str) -> str:
    """A header value cannot hold line ends."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(page: str, url: str, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """A response, or a revisit of `refers_to` with the HTTP head alone."""
    http = head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))], b"HTTP/1.1 200 OK")
    block = http if refers_to is not None else http + payload
    return head([
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{ID_HEAD}{page}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", one_line(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Refers-To", None if refers_to is None else f"<{ID_HEAD}{refers_to}>"),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block))], VERSION) + block + END


def gzip_member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@dataclass
class Record:
    fields: dict[str, str]
    http: dict[str, str]
    block_bytes: int
    payload: bytes | None
    payload_sha: str
    payload_read: int


@dataclass
class _Frame:
    """The record in work: its head, then its block in pieces."""
    waiting: bytearray = field(default_factory=bytearray)
    fields: dict[str, str] | None = None
    left: int = 0
    http: dict[str, str] | None = None
    block_sha: object = field(default_factory=hashlib.sha256)
    payload_sha: object = field(default_factory=hashlib.sha256)
    payload_read: int = 0
    pieces: list[bytes] = field(default_factory=list)


def _fields(head_bytes: bytes) -> dict[str, str]:
    lines = head_bytes.decode("utf-8", "replace").split("\r\n")
    return {"": lines[0]} | {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def read_records(chunks: Iterator[bytes], name: str = "archive", with_payload: bool = True) -> Iterator[Record]:
    """Records of an archive that comes in pieces of any size. Memory holds a piece and, if wanted, one payload."""
    unzip, frame, begun = zlib.decompressobj(31), _Frame(), False

    def feed(data: bytes) -> None:
        """Take inflated bytes of one member."""
        f = frame
        if f.fields is None:
            f.waiting += data
            at = f.waiting.find(END)
            if at < 0:
                if len(f.waiting) > HEAD_BYTES:
                    raise DamagedArchive(f"{name}: a head without end")
                return
            f.fields = _fields(bytes(f.waiting[:at]))
            if not f.fields[""].startswith("WARC/") or not f.fields.get("content-length", "").isdigit():
                raise DamagedArchive(f"{name}: no WARC head")
            f.left = int(f.fields["content-length"])
            data, f.waiting = bytes(f.waiting[at + 4:]), bytearray()
        block, rest = data[:f.left], data[f.left:]
        f.left -= len(block)
        f.block_sha.update(block)
        if f.http is None and block:
            f.waiting += block
            at = f.waiting.find(END)
            if at < 0 and len(f.waiting) > HEAD_BYTES:
                raise DamagedArchive(f"{name}: an HTTP head without end")
            if at >= 0:
                f.http = _fields(bytes(f.waiting[:at]))
                block, f.waiting = bytes(f.waiting[at + 4:]), bytearray()
        if f.http is not None and block:
            f.payload_sha.update(block)
            f.payload_read += len(block)
            if with_payload:
                f.pieces.append(block)
        if not f.left:
            f.waiting += rest

    def finished() -> Record:
        f = frame
        if f.fields is None or f.left or f.http is None or bytes(f.waiting) != END:
            raise DamagedArchive(f"{name}: a record of the wrong length")
        if f.fields.get("warc-block-digest") != f"sha256:{f.block_sha.hexdigest()}":
            raise DamagedArchive(f"{name}: the digest of a block differs")
        digest = f.payload_sha.hexdigest()
        if f.fields.get("warc-type") == "response" and f.fields.get("warc-payload-digest") != f"sha256:{digest}":
            raise DamagedArchive(f"{name}: the digest of a payload differs")
        return Record(f.fields, f.http, int(f.fields["content-length"]), b"".join(f.pieces) if with_payload else None,
                      digest, f.payload_read)

    for chunk in chunks:
        while chunk:
            try:
                data = unzip.decompress(chunk, BLOCK_BYTES)
            except zlib.error as error:
                raise DamagedArchive(f"{name}: {error}") from error
            begun = True
            feed(data)
            chunk = unzip.unconsumed_tail
            if unzip.eof:
                yield finished()
                chunk, unzip, frame, begun = unzip.unused_data, zlib.decompressobj(31), _Frame(), False
    if begun:
        raise DamagedArchive(f"{name}: the last member is cut off")


def with_records(pages: DataFrame, key: str, payload: str, least: int) -> DataFrame:
    """Add digest and the id of the response that a page revisits, if it is no response itself."""
    digest, first = free_name(pages, "digest"), free_name(pages, "first_id")
    body = F.coalesce(F.col(payload), F.lit(""))
    large = F.octet_length(body) >= least
    hashed = pages.withColumn(digest, F.sha2(body.cast("binary"), 256))
    shared = pages.select(F.sha2(body.cast("binary"), 256).alias("_digest"), F.col(key).alias("_id"), large.alias("_large")) \
        .filter("_large").groupBy("_digest").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    # Small payloads have no partner; without a key of their own they would meet in one task.
    joined = hashed.join(shared, (hashed[digest] == shared["_digest"]) & large, "left")
    revisits = F.when(~pages[key].eqNullSafe(F.col("_first")), F.col("_first"))
    return joined.select(*[hashed[c] for c in pages.columns], hashed[digest], revisits.alias(first))


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
                   least: int = REVISIT_BYTES, file_bytes: int = FILE_BYTES, level: int = 6,
                   date: str = ARCHIVE_DATE) -> DataFrame:
    """Write every page as a record and return the manifest, which is stored beside the archives."""
    spark = pages.sparkSession
    target = qualified(spark, folder)
    rows = pages.select(
        F.col(key).cast("string").alias("page"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"), F.col(key).alias("id"))
    rows = with_records(rows, "id", "payload", least).select(
        F.coalesce("page", F.lit("")).alias("page"), "url", "payload", "digest", F.col("first_id").cast("string").alias("first_id"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store(target)
        out, done, name, records, size = None, [], "", 0, 0

        def closed() -> None:
            out.close()
            done.append((name, records, size))

        for batch in batches:
            texts = zip(*(batch.column(c).to_pylist() for c in ("page", "url", "digest", "first_id")), raw_texts(batch.column("payload")))
            for page, address, digest, first, body in texts:
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(f"{root}/{name}")
                member = gzip_member(record_bytes(page, address, body, digest, first, date), level)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= file_bytes:
                    closed()
                    out = None
        if out is not None:
            closed()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            ["file", "records", "bytes"])

    rows.mapInArrow(written, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives that the folder's manifest names, a task per file."""
    source = qualified(spark, folder)
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    count = max(1, files.count())

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store(source)
        for batch in batches:
            for name, expected in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist()):
                found, held, seen = [], 0, 0
                with system.open_input_stream(f"{root}/{name}") as stream:
                    chunks = iter(lambda: stream.read(BLOCK_BYTES), b"")
                    for r in read_records(chunks, name, with_payload):
                        found.append(r)
                        seen += 1
                        held += 500 + len(r.payload or b"")
                        if held >= 16 << 20:
                            yield packed(found, with_payload)
                            found, held = [], 0
                if seen != expected:
                    raise DamagedArchive(f"{name}: {seen} records, {expected} were written")
                yield packed(found, with_payload)

    schema = RECORDS + (", payload binary" if with_payload else "")
    return files.repartition(count, "file").mapInArrow(records, schema)


def packed(found: list[Record], with_payload: bool) -> pa.RecordBatch:
    def name(value: str | None) -> str | None:
        return None if value is None else value.strip("<>").removeprefix(ID_HEAD)

    columns = {
        "record_id": pa.array([name(r.fields["warc-record-id"]) for r in found], pa.string()),
        "record_type": pa.array([r.fields["warc-type"] for r in found], pa.string()),
        "url": pa.array([r.fields.get("warc-target-uri", "") for r in found], pa.string()),
        "payload_bytes": pa.array([int(r.http["content-length"]) for r in found], pa.int64()),
        "payload_digest": pa.array([r.fields["warc-payload-digest"].removeprefix("sha256:") for r in found], pa.string()),
        "refers_to": pa.array([name(r.fields.get("warc-refers-to")) for r in found], pa.string())}
    if with_payload:
        columns["payload"] = pa.array([r.payload for r in found], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def page_records(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back, and return the records by page id."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archives(pages, folder)
    id_type = pages.schema["page_id"].dataType
    back = read_archives(spark, folder, with_payload=False)
    return back.select(
        F.when(F.col("record_id") != "", F.col("record_id")).cast(id_type).alias("page_id"),
        "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(id_type).alias("refers_to"))
