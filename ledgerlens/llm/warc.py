"""Deterministic sharded WARC writer and its reader (operator 6).

Rows are range-sorted by page_id; each range is written by one task into files
that roll over once their compressed size passes ``ROLL_BYTES``. Headers and
SHA-1 digests are made anew from the payload. A file is written under a
temporary name and renamed when complete; names depend on range and sequence
only, so a repeated task writes the same bytes under the same names. A manifest
(one row per file with records, bytes and digest) is stored last, and readers
take only files that it lists.

* Payload: the html in UTF-8; null is empty. Of equal payloads of at least
  ``SMALLEST`` bytes the record with the largest page_id is the response and the
  others are revisits; smaller payloads are always responses.
* Null page_id sorts first and never wins over a number. Rows that repeat both
  page_id and payload lie next to each other in one range: the first is the
  response (if their page_id wins), the others revisit it.
* Null url becomes ``urn:page:<page_id>``; control bytes and spaces in a url are
  percent-encoded. Other columns are not read.
* An empty table gives an empty manifest and no record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import cut_lineage, scratch_path

SMALLEST = 1000
ROLL_BYTES = 64 << 20
#: One date for all records: the same input must give the same bytes.
DATE = "1970-01-01T00:00:00Z"
LEVEL = 6
READ_BYTES = 1 << 20

MANIFEST = "file string, records long, bytes long, sha256 string"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary"
)


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` with the scheme that Spark reads it by, so that archives and manifest share a file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a qualified folder."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), uri.removeprefix("file:").removeprefix("//")
    return fs.FileSystem.from_uri(uri)


def record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{copy}')}>"


def clean_url(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def digest_label(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def record_bytes(page_id, url, payload: bytes, digest: str, copy: int, original) -> bytes:
    """One record; ``original`` is None for a response, else (page_id,) of the record it revisits."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if original is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest, copy)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {clean_url(url, page_id)}",
        f"WARC-Payload-Digest: {digest_label(digest)}",
        f"WARC-Block-Digest: {digest_label(hashlib.sha1(block).hexdigest())}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if original is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(original[0], digest, 0)}")
        if original[0] is not None:
            head.append(f"X-Refers-To-Page-Id: {original[0]}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class RollingFiles:
    """Compressed files of one task, each complete before it gets its name."""

    def __init__(self, root: str, part: int, attempt: int, roll: int):
        self.files, self.path = file_system(root)
        self.part, self.attempt, self.roll = part, attempt, roll
        self.done: list[tuple[str, int, int, str]] = []
        self.sink = None

    def name(self) -> str:
        return f"part-{self.part:06d}-{len(self.done):04d}.warc.gz"

    def open(self) -> None:
        self.temporary = f"{self.path}/_temporary-{self.name()}-{self.attempt}"
        self.sink = self.files.open_output_stream(self.temporary, compression=None)
        self.records, self.bytes, self.digest = 0, 0, hashlib.sha256()

    def add(self, record: bytes) -> None:
        if self.sink is None:
            self.open()
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        packed = packer.compress(record) + packer.flush()
        self.sink.write(packed)
        self.digest.update(packed)
        self.records += 1
        self.bytes += len(packed)
        if self.bytes >= self.roll:
            self.close()

    def close(self) -> None:
        if self.sink is not None:
            self.sink.close()
            self.files.move(self.temporary, f"{self.path}/{self.name()}")
            self.done.append((self.name(), self.records, self.bytes, self.digest.hexdigest()))
            self.sink = None


def decided(pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """Pages with digest, and the winning page_id where the payload can be revisited."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", html.alias("payload"), F.sha1(html).alias("digest"))
    large = rows.where(F.length("payload") >= smallest).groupBy("digest")
    groups = large.agg(F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("copies"))
    shared = cut_lineage(groups.where(F.col("copies") > 1).select("digest", "winner", F.lit(True).alias("shared")))
    return rows.join(shared, "digest", "left")


def write_warc(pages: DataFrame, root: str, smallest: int = SMALLEST, roll: int = ROLL_BYTES) -> DataFrame:
    """Write the archives below ``root``; returns the stored manifest."""
    spark = pages.sparkSession
    root = qualified(spark, root)
    files, path = file_system(root)
    files.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        out = RollingFiles(root, task.partitionId(), task.taskAttemptId(), roll)
        last, copy = None, 0
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["page_id"], row["digest"])
                copy = copy + 1 if key == last else 0
                last = key
                first = row["page_id"] == row["winner"] and copy == 0
                original = (row["winner"],) if row["shared"] and not first else None
                out.add(record_bytes(row["page_id"], row["url"], row["payload"], row["digest"], copy, original))
        out.close()
        columns = list(zip(*out.done, strict=True)) or [[], [], [], []]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "records", "bytes", "sha256"]
        )

    ordered = (
        decided(pages, smallest)
        .select("page_id", "url", "payload", "digest", "winner", "shared")
        .repartitionByRange("page_id", "digest")
        .sortWithinPartitions("page_id", "digest")
    )
    manifest = f"{root}/manifest"
    ordered.mapInArrow(run, MANIFEST).write.parquet(manifest)
    return spark.read.parquet(manifest)


def unpacked(stream) -> Iterator[bytes]:
    """The members of a compressed archive, one after the other."""
    packed, opener, parts = b"", zlib.decompressobj(31), []
    while True:
        if not packed:
            packed = stream.read(READ_BYTES)
            if not packed:
                break
        parts.append(opener.decompress(packed))
        packed = b""
        if opener.eof:
            packed = opener.unused_data
            yield b"".join(parts)
            opener, parts = zlib.decompressobj(31), []
    if parts and any(parts):
        raise ValueError("the archive ends inside a record")


def parsed(record: bytes) -> dict:
    """One record as a row; digests that do not fit the content raise ValueError."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if digest_label(hashlib.sha1(block).hexdigest()) != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} does not fit")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != size or digest_label(hashlib.sha1(payload).hexdigest()) != fields["WARC-Payload-Digest"]):
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']} does not fit")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-Id"),
        "url": fields["WARC-Target-URI"],
        "payload_bytes": size,
        "payload_digest": base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex(),
        "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-Id"),
        "payload": payload if response else None,
    }


def read_warc(spark: SparkSession, root: str, payload: bool = True) -> DataFrame:
    """Records of the files that the manifest below ``root`` lists, a file per task step."""
    root = qualified(spark, root)
    names = [part.split()[0] for part in RECORDS.split(", ") if payload or "binary" not in part]
    schema = ", ".join(part for part in RECORDS.split(", ") if part.split()[0] in names)
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(p.split()[0], kinds[p.split()[1]]) for p in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = file_system(root)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for record in unpacked(stream):
                        rows.append({k: v for k, v in parsed(record).items() if k in names})
                        held += len(record) if payload else 100
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, arrow)

    manifest = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    tasks = max(1, manifest.count())  # a file each: Spark would merge such small rows into one task
    return manifest.select("file").repartition(tasks, "file").mapInArrow(run, schema)


def op6_warc(spark, sf_dir) -> DataFrame:
    root = scratch_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), root)
    return read_warc(spark, root, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP6_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
w AS (SELECT payload_digest, max(page_id) AS winner FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN winner IS NULL OR winner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN winner <> page_id THEN winner END AS refers_to
FROM p LEFT JOIN w USING (payload_digest)
"""
