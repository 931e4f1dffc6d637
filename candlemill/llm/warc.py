"""A deterministic sharded WARC writer, and a reader of its archives.

Records are range-sorted by id, one shard per partition; a shard's file is closed once its
compressed size reaches ``roll_bytes``. Every record is a gzip member of its own with newly
made headers and digests. A task writes each file under a temporary name and renames it when
it is complete; the names and contents follow from the rows alone, so a task that runs again
writes the same files over. The manifest of all files is written last and names what counts:
readers open nothing else.

The rows that say which page a copy refers to are sorted in between the pages themselves, so
the payloads are shuffled once.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.common import settled, table
from candlemill.sources.scratch import scratch_dir

ROLL_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"  # of all records: archives of equal rows are equal
_MANIFEST = "file string, shard int, part int, records long, bytes long, sha256 string"
_RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _b32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(text: str) -> str:
    return "".join(c for c in text if c not in "\r\n\0")


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = [*headers, ("WARC-Date", DATE), ("WARC-Block-Digest", f"sha1:{_b32(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id, url, payload: bytes, refers_to, revisit: bool, place: str) -> bytes:
    digest = _b32(payload)
    name = f"urn:x-page:{'' if page_id is None else page_id}:{digest}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{name}:{place}>" if revisit else f"<{name}>"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _clean(url)))
    if revisit:
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.append(("WARC-Refers-To", f"<urn:x-page:{refers_to}:{digest}>"))
    return record_bytes(headers, http if revisit else http + payload)


class _File:
    """One archive under a temporary name until it is closed."""

    def __init__(self, folder: str, shard: int, part: int):
        self.system, base = _system(folder)
        self.name, self.shard, self.part = f"shard-{shard:06d}-{part:05d}.warc.gz", shard, part
        self.temporary, self.final = f"{base}/_temporary-{uuid.uuid4().hex}", f"{base}/{self.name}"
        self.system.create_dir(base, recursive=True)
        self.out = self.system.open_output_stream(self.temporary, compression=None)
        self.sha, self.bytes, self.records = hashlib.sha256(), 0, 0
        info = f"software: candlemill\r\nformat: WARC File Format 1.1\r\nisPartOf: shard {shard}\r\n".encode()
        self.add(record_bytes([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-shard:{shard}:{part}>"),
                               ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info))
        self.records = 0

    def add(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)
        self.records += 1

    def close(self) -> tuple:
        self.out.close()
        self.system.move(self.temporary, self.final)
        return self.name, self.shard, self.part, self.records, self.bytes, self.sha.hexdigest()

    def abandon(self) -> None:
        self.out.close()
        self.system.delete_file(self.temporary)


def _writer(folder: str, roll_bytes: int):
    names = ["file", "shard", "part", "records", "bytes", "sha256"]
    schema = pa.schema(list(zip(names, [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part, n, file, done = TaskContext.get().partitionId(), 0, 0, None, []
        before, refers = None, None  # the page before; the copy announced by the last row
        try:
            for batch in batches:
                for page_id, key, kind, refers_to, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                    if kind == 0:
                        refers = (page_id, key, refers_to)
                        continue
                    to = refers[2] if refers and refers[:2] == (page_id, key) else None
                    if to is None and before == (page_id, key) and page_id is not None:
                        to = page_id  # the same row once more
                    if file is None:
                        file = _File(folder, shard, part)
                    file.add(page_record(page_id, url, html.encode(), to, to is not None, f"{shard}.{n}"))
                    before, n = (page_id, key), n + 1
                    if file.bytes >= roll_bytes:
                        done.append(file.close())
                        file, part = None, part + 1
            if file is not None:
                done.append(file.close())
                file = None
        finally:
            if file is not None:
                file.abandon()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    return run


def write_warc(
    pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, id_col: str = "page_id",
    url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """Write one record per row under ``folder`` (a path of a file system all tasks share).

    Gives the manifest (file, shard, part, records, bytes, sha256), which also lies in
    ``folder/manifest``, written when all files are complete. Of equal payloads the page with
    the smallest id is the response, the others revisit it; null ids count as larger than
    all, and where all ids of a payload are null each row is a response. A row that repeats
    a page with its payload revisits that page. A null html is an empty payload, a null url
    leaves its header out. An empty table gives an empty manifest.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.sha2(html, 256).alias("key"), F.lit(1).alias("kind"),
        F.lit(None).cast("bigint").alias("refers_to"), F.col(url_col).cast("string").alias("url"), html.alias("html"),
    )
    keys = settled(rows.select("page_id", "key"), "warc-keys")
    first = settled(
        keys.groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1"), "warc-first"
    )
    copies = (
        keys.join(first, "key").filter("first IS NOT NULL AND (page_id IS NULL OR page_id <> first)")
        .select("page_id", "key", F.lit(0).alias("kind"), F.col("first").alias("refers_to"),
                F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"))
        .distinct()
    )
    order = ["page_id", "key", "kind", "url"]
    ordered = rows.unionByName(copies).repartitionByRange("page_id", "key").sortWithinPartitions(*order)
    ordered.mapInArrow(_writer(folder, roll_bytes), _MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(pages.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def parse(stream, chunk: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """The (headers, block) of every record of a compressed archive, one at a time."""
    raw, member, data = b"", zlib.decompressobj(31), bytearray()
    while True:
        if not raw:
            raw = stream.read(chunk)
        if not raw:
            if data or not member.eof and member.unconsumed_tail:
                raise ValueError("the archive ends within a record")
            return
        data += member.decompress(raw)
        raw = member.unused_data
        if not member.eof:
            raw = b""
            continue
        member = zlib.decompressobj(31)
        head, _, block = bytes(data).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        if not lines[0].startswith("WARC/") or len(block) != size + 4:
            raise ValueError("not a whole WARC record")
        block = block[:size]
        if headers["WARC-Block-Digest"] != f"sha1:{_b32(block)}":
            raise ValueError(f"wrong digest in {headers['WARC-Record-ID']}")
        yield headers, block
        data = bytearray()


def _page(headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    page = headers["WARC-Record-ID"].split(":")[2]
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = headers["WARC-Type"] == "revisit"
    if not revisit and (_b32(payload) != digest or len(payload) != int(fields["Content-Length"])):
        raise ValueError(f"wrong payload in {headers['WARC-Record-ID']}")
    to = int(headers["WARC-Refers-To"].split(":")[2]) if revisit else None
    return (int(page) if page else None, headers.get("WARC-Target-URI"), int(fields["Content-Length"]), digest,
            headers["WARC-Type"], to, None if revisit else payload)


def _reader(folder: str):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds)))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _system(folder)
        for files in batches:
            for name in files.column("file").to_pylist():
                rows, size = [], 0
                with system.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for headers, block in parse(stream):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(_page(headers, block))
                        size += len(block)
                        if size > 8 << 20 or len(rows) >= 5000:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    return run


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page record of the archives in the manifest, with its digests checked.

    The payload of a revisit is null; its size and digest are those of the full payload.
    """
    files = manifest(spark, folder).select("file", "bytes")
    parts = max(1, min(files.count(), 100_000))
    return files.repartition(parts, "file").mapInArrow(_reader(folder), _RECORDS)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder).drop("payload", "url")
