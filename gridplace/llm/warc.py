"""WARC archives: writing records as gzip members, and a sequential reader.

Writing: each payload is digested; of equal payloads of at least
``min_revisit_bytes`` the one with the largest id becomes the response and
the others are revisit records that name it.  Digests are grouped with a
map-side combine and only ids and digests are shuffled for that; the rows
with a payload are then dealt by id, and each task streams its records into
archives of bounded size under a shared folder.  A file name is unique per
task attempt, and the list of finished archives is itself a Spark table, so a
retried or speculative task leaves at most an unlisted file.

Reading: one row per archive is dealt out; a task reads its archive forward
in blocks, inflates one gzip member at a time with an incremental
decompressor, frames the record by its content length, and checks the block
and payload digests while the bytes go by.  Nothing but the current record's
header and one block is held unless the payload itself is asked for.

Defined cases: NULL content is an empty payload; a NULL id is written as an
empty key and its record is a response; repeated ids each get a record, and
rows that repeat the largest id of equal payloads are all responses; an empty
table gives no archive and an empty result; a damaged member, a wrong length
or a wrong digest raises; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplace.llm.common import map_arrow, materialize
from gridplace.session import tables_folder

BLOCK = 1 << 16
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    pass


def open_store(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path or URI, for use inside tasks."""
    return pa.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def label(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def bare_hex(value: str) -> str:
    return base64.b32decode(value.removeprefix("sha1:")).hex()


def record_id(key: str) -> str:
    return f"<urn:x-record:{key}>"


def record_key(value: str) -> str:
    return value.removeprefix("<urn:x-record:").removesuffix(">")


def one_line(value: str) -> str:
    """Header values cannot hold line ends."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(key: str, url: str, payload: bytes, refers_to: str | None, date: str, level: int) -> bytes:
    """One record as a gzip member of its own."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(key)),
        ("WARC-Date", date),
        ("WARC-Target-URI", one_line(url)),
        ("WARC-Payload-Digest", label(hashlib.sha1(payload).digest())),
        ("WARC-Block-Digest", label(hashlib.sha1(block).digest())),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        head[3:3] = [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    text = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n"
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(text + block + b"\r\n\r\n") + pack.flush()


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str] = field(default_factory=dict)
    payload_sha1: str = ""
    payload_bytes: int = 0
    payload: bytes | None = None


def fields(lines: list[bytes]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines)}


class Member:
    """Forward bytes of one gzip member: inflated block by block."""

    def __init__(self, source, rest: bytes) -> None:
        self.source, self.rest = source, rest
        self.inflate = zlib.decompressobj(31)
        self.ready = bytearray()

    def more(self) -> bool:
        """Inflate some more; False at the end of the member."""
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.rest or self.source.read(BLOCK)
            if not data:
                raise WarcError("the archive ends inside a record")
            if data is self.rest:
                self.rest = b""
            out = self.inflate.decompress(data, BLOCK)
            if self.inflate.eof:
                self.rest = self.inflate.unused_data + self.rest
            if out:
                self.ready += out
                return True
        return False

    def until(self, mark: bytes, limit: int = 1 << 20) -> bytes:
        seen = 0
        while (at := self.ready.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.ready)
            if seen > limit or not self.more():
                raise WarcError("a header does not end")
        out = bytes(self.ready[:at])
        del self.ready[: at + len(mark)]
        return out

    def take(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.ready and not self.more():
                raise WarcError("a record is shorter than its content length")
            part = bytes(self.ready[:size])
            del self.ready[: len(part)]
            size -= len(part)
            yield part


def read_records(source, with_payload: bool = False) -> Iterator[Record]:
    """Records of an open archive in order, digests verified."""
    rest = b""
    while rest or (rest := source.read(BLOCK)):
        member = Member(source, rest)
        lines = member.until(b"\r\n\r\n").split(b"\r\n")
        if lines[0] != VERSION:
            raise WarcError(f"not a record: {lines[0][:40]!r}")
        record = Record(fields(lines[1:]))
        size = int(record.headers["content-length"])
        block, whole = hashlib.sha1(), hashlib.sha1()
        kept: list[bytes] = []
        head = bytearray()
        in_head = True
        for part in member.take(size):
            block.update(part)
            if in_head:
                head += part
                if (at := head.find(b"\r\n\r\n")) < 0:
                    continue
                record.http = fields(bytes(head[:at]).split(b"\r\n")[1:])
                in_head, part = False, bytes(head[at + 4 :])
            whole.update(part)
            record.payload_bytes += len(part)
            if with_payload:
                kept.append(part)
        if in_head:
            raise WarcError("no HTTP header in the block")
        tail = b"".join(member.take(4))
        if tail != b"\r\n\r\n" or member.ready or member.more():
            raise WarcError("a record is longer than its content length")
        if label(block.digest()) != record.headers["warc-block-digest"]:
            raise WarcError(f"block digest of {record.headers['warc-record-id']}")
        if record.headers["warc-type"] == "response":
            if label(whole.digest()) != record.headers["warc-payload-digest"]:
                raise WarcError(f"payload digest of {record.headers['warc-record-id']}")
            if record.payload_bytes != int(record.http["content-length"]):
                raise WarcError(f"payload length of {record.headers['warc-record-id']}")
            record.payload = b"".join(kept) if with_payload else None
        record.payload_sha1 = bare_hex(record.headers["warc-payload-digest"])
        rest = member.rest
        yield record


def first_copies(pages: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """(id, key, refers_to) of the pages that revisit another one.  A revisit
    drops its payload, so payloads are equal when their SHA-256 is; the SHA-1
    of the records is no reason to drop one."""
    digests = materialize(
        pages.filter(F.octet_length("payload") >= min_revisit_bytes).select(
            "id", "key", F.unhex(F.sha2(F.col("payload").cast("binary"), 256)).alias("digest")
        ),
        "payload_digests",
    )
    shared = materialize(
        digests.groupBy("digest").agg(F.max("id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"),
        "shared_payloads",
    )
    # both sides are plain tables, so a payload that a third of all pages share is split by AQE
    return digests.join(shared, "digest").filter(F.col("id") < F.col("refers_to")).select("id", "key", "refers_to").distinct()


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 1000,
    date: str = "2024-01-01T00:00:00Z",
    archive_bytes: int = 64 << 20,
    level: int = 4,
) -> DataFrame:
    """Write all pages to archives under ``folder`` (shared by all executors);
    returns the table of archives: path, records, bytes."""
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
    ).withColumn("key", F.xxhash64("payload"))
    known = first_copies(rows, min_revisit_bytes)
    dealt = rows.join(known.hint("shuffle_hash"), ["id", "key"], "left").select("id", "url", "payload", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        done: list[tuple[str, int, int]] = []
        out, name, records, size = None, "", 0, 0
        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out, records, size = store.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                key, refers = batch.column(0)[i].as_py(), batch.column(3)[i].as_py()
                data = record_bytes(
                    "" if key is None else str(key), batch.column(1)[i].as_py(), batch.column(2)[i].as_py().encode("utf-8", "surrogatepass"),
                    None if refers is None else str(refers), date, level,
                )
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((name, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, records, size))
        if done:
            names, counts, sizes = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["path", "records", "bytes"])

    listed = map_arrow(dealt, run, "path string, records long, bytes long")
    return materialize(listed.withColumn("path", F.concat(F.lit(folder.rstrip("/") + "/"), "path")), "archives")


def read_warc(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of the archives named in ``path``: record_key, record_type,
    refers_to, url, payload_bytes, payload_digest (bare hex SHA-1 of the full
    payload), and payload (responses) if asked for."""
    schema = "record_key string, record_type string, refers_to string, url string, payload_bytes long, payload_digest string" + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()] + ([pa.binary()] if with_payload else [])

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = open_store(path)
                rows: list[tuple] = []
                held = 0
                with store.open_input_stream(name, compression=None, buffer_size=BLOCK) as source:
                    for r in read_records(source, with_payload):
                        refers = r.headers.get("warc-refers-to")
                        row = (
                            record_key(r.headers["warc-record-id"]), r.headers["warc-type"], None if refers is None else record_key(refers),
                            r.headers.get("warc-target-uri"), int(r.http["content-length"]), r.payload_sha1,
                        )
                        rows.append(row + ((r.payload,) if with_payload else ()))
                        held += len(r.payload or b"")
                        if len(rows) >= 4096 or held > 16 << 20:
                            yield emit(rows)
                            rows, held = [], 0
                if rows:
                    yield emit(rows)

    n = max(1, archives.count())
    return map_arrow(archives.select("path").repartition(n), run, schema)


def archive_folder(spark: SparkSession) -> str:
    return f"{tables_folder(spark)}/warc-{uuid.uuid4().hex}"


def through_warc(pages: DataFrame) -> DataFrame:
    """Write the pages, read the archives back: one row per record."""
    archives = write_warc(pages, archive_folder(pages.sparkSession))
    id_type = pages.schema["page_id"].dataType
    return read_warc(archives).select(
        F.when(F.col("record_key") != "", F.col("record_key")).cast(id_type).alias("page_id"),
        "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )
