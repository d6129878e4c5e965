"""WARC archives: write, normalise a monolithic gzip file into members with an index, read back.

``write_archives`` puts pages into files that are one gzip stream each, as many crawlers do; such a
file can only be read from its start. ``normalise`` inflates each whole-file stream once, rewrites every
record as a gzip member of its own and writes a sidecar index (a JSON line per record: record
id, offset, length), after which any record is one seek away. Payloads of at least ``MIN_REVISIT``
bytes that several records share are stored once: the record with the largest page_id stays a
response, the others become revisit records that refer to it.

Files go through ``pyarrow.fs``, so the shared folder may be anything it opens (a shared mount, hdfs,
s3, ...). Every attempt writes files of its own name and only those a finished task reports are used.
A file is closed at ``ROLL_BYTES`` of raw records; tasks stream and hold one record at a time.

Defined results: null html is an empty payload; a null url is left out; a null page_id counts as the
smallest; repeated rows are records of their own, of which one is the response; an empty table gives no files and no rows.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.stage import shared_folder, written

MIN_REVISIT = 1000
ROLL_BYTES = 16 << 20
LEVEL = 4
CHUNK = 1 << 20

RECORDS = "archive string, ordinal long, page_id long, record_id string, payload_digest string, payload_bytes long"
ARCHIVES = "archive string, sidecar string, records long"
PAGES = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "url string, payload binary"
)


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    uri = re.sub(r"^file:/+", "file:///", uri)
    return pafs.FileSystem.from_uri(uri)


def _header(name: str, value) -> str:
    safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", str(value))
    return f"{name}: {safe}\r\n"


def record_bytes(record_id: str, url: str | None, digest: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """A response record, or without its payload the revisit record that refers to ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    block = http + payload if refers_to is None else http
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\n" + _header("WARC-Record-ID", f"<{record_id}>")
    head += "WARC-Date: 1970-01-01T00:00:00Z\r\n"
    if url is not None:
        head += _header("WARC-Target-URI", url)
    head += _header("WARC-Payload-Digest", f"sha1:{digest}")
    if refers_to is not None:
        head += _header("WARC-Refers-To", f"<{refers_to}>")
        head += _header("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head += f"Content-Type: application/http;msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def inflate(source) -> Iterator[bytes]:
    """The contents of a gzip file of one or many members, in chunks."""
    engine = zlib.decompressobj(31)
    while data := source.read(CHUNK):
        while data:
            yield engine.decompress(data)
            data = engine.unused_data
            if data:
                engine = zlib.decompressobj(31)


def parse(chunks: Iterator[bytes]) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of each record of a stream of WARC bytes."""
    buffer = bytearray()

    def fill(size: int) -> bool:
        while len(buffer) < size:
            more = next(chunks, None)
            if more is None:
                return False
            buffer.extend(more)
        return True

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not fill(len(buffer) + 1):
                if buffer.strip():
                    raise ValueError("a WARC record is cut off")
                return
        lines = buffer[:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        if not fill(end + 8 + size):
            raise ValueError("a WARC record is cut off")
        block = bytes(buffer[end + 4 : end + 4 + size])
        del buffer[: end + 8 + size]
        yield headers, block


def write_archives(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes the pages as monolithic gzip files; a row per record (``RECORDS``)."""
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")

    def write(batches):
        files, path = open_folder(folder)
        files.create_dir(path, recursive=True)
        name, out, engine, size, ordinal = None, None, None, 0, 0
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    name, size, ordinal = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, engine = files.open_output_stream(f"{path}/{name}", compression=None), zlib.compressobj(1, wbits=31)
                payload = (html or "").encode()
                digest = hashlib.sha1(payload).hexdigest()
                record_id = f"urn:x-page:{'' if page_id is None else page_id}:{name[:32]}:{ordinal}"
                data = record_bytes(record_id, url, digest, payload)
                out.write(engine.compress(data))
                rows.append((name, ordinal, page_id, record_id, digest, len(payload)))
                size, ordinal = size + len(data), ordinal + 1
                if size >= roll_bytes:
                    out.write(engine.flush())
                    out.close()
                    out = None
            yield _rows(rows, RECORD_TYPES)
        if out is not None:
            out.write(engine.flush())
            out.close()

    return given.mapInArrow(write, RECORDS)


def revisits(records: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``records`` plus ``target``: the record_id that a revisit record refers to, else null."""
    shared = (
        records.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max(F.struct("page_id", "archive", "ordinal", "record_id")).alias("h"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("payload_digest", "payload_bytes", F.col("h.record_id").alias("head"))
    )
    joined = records.join(shared, ["payload_digest", "payload_bytes"], "left")
    return joined.withColumn("target", F.when(F.col("head") != F.col("record_id"), F.col("head"))).drop("head")


def normalise(records: DataFrame, source: str, folder: str, archives: int) -> DataFrame:
    """Rewrites each archive of ``source`` with a member per record and its index; ``ARCHIVES`` rows."""

    def rewrite(table: pa.Table) -> pa.Table:
        files, path = open_folder(folder)
        origin, at = open_folder(source)
        files.create_dir(path, recursive=True)
        name = table["archive"][0].as_py()
        targets = dict(zip(table["ordinal"].to_pylist(), table["target"].to_pylist()))
        out_name = f"{uuid.uuid4().hex}.warc.gz"
        offset, index = 0, io.StringIO()
        with (
            origin.open_input_stream(f"{at}/{name}", compression=None) as given,
            files.open_output_stream(f"{path}/{out_name}", compression=None) as out,
        ):
            for ordinal, (headers, block) in enumerate(parse(inflate(given))):
                record_id = headers["WARC-Record-ID"][1:-1]
                data = record_bytes(
                    record_id,
                    headers.get("WARC-Target-URI"),
                    headers["WARC-Payload-Digest"][5:],
                    block[block.index(b"\r\n\r\n") + 4 :],
                    targets[ordinal],
                )
                engine = zlib.compressobj(LEVEL, wbits=31)
                member = engine.compress(data) + engine.flush()
                out.write(member)
                entry = {"record_id": record_id, "offset": offset, "length": len(member)}
                index.write(json.dumps(entry) + "\n")
                offset += len(member)
        sidecar = f"{out_name}.idx"
        with files.open_output_stream(f"{path}/{sidecar}", compression=None) as out:
            out.write(index.getvalue().encode())
        return pa.table({"archive": [out_name], "sidecar": [sidecar], "records": pa.array([len(targets)], pa.int64())})

    dealt = records.repartitionByRange(max(1, archives), "archive")
    return dealt.groupBy("archive").applyInArrow(rewrite, ARCHIVES)


def read_archives(manifest: DataFrame, folder: str, archives: int, with_payload: bool = True) -> DataFrame:
    """A row per record (``PAGES``) of normalised archives, each found by its index entry."""

    def read(batches):
        files, path = open_folder(folder)
        for batch in batches:
            for archive, sidecar in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.open_input_stream(f"{path}/{sidecar}", compression=None) as f:
                    entries = [json.loads(line) for line in f.read().decode().splitlines()]
                rows, held = [], 0
                with files.open_input_file(f"{path}/{archive}") as f:
                    for entry in entries:
                        f.seek(entry["offset"])
                        member = zlib.decompress(f.read(entry["length"]), 31)
                        rows.append(_page(member, with_payload))
                        held += len(member)
                        if held >= ROLL_BYTES:
                            yield _rows(rows, PAGE_TYPES)
                            rows, held = [], 0
                yield _rows(rows, PAGE_TYPES)

    return manifest.select("archive", "sidecar").repartitionByRange(max(1, archives), "archive").mapInArrow(read, PAGES)


def _page(member: bytes, with_payload: bool) -> tuple:
    ((headers, block),) = parse(iter([member]))
    cut = block.index(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in block[:cut].decode().split("\r\n")[1:])
    page_of = lambda x: int(x) if (x := x.strip("<>").split(":")[2]) else None
    refers = headers.get("WARC-Refers-To")
    return (
        page_of(headers["WARC-Record-ID"]),
        int(http["Content-Length"]),
        headers["WARC-Payload-Digest"][5:],
        headers["WARC-Type"],
        page_of(refers) if refers else None,
        headers.get("WARC-Target-URI"),
        block[cut + 4 :] if with_payload and headers["WARC-Type"] == "response" else None,
    )


RECORD_TYPES = {
    "archive": pa.string(), "ordinal": pa.int64(), "page_id": pa.int64(),
    "record_id": pa.string(), "payload_digest": pa.string(), "payload_bytes": pa.int64(),
}
PAGE_TYPES = {
    "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(),
    "refers_to": pa.int64(), "url": pa.string(), "payload": pa.binary(),
}


def _rows(rows: list[tuple], types: dict) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], list(types))


def archive_pages(pages: DataFrame, folder: str | None = None, with_payload: bool = True) -> DataFrame:
    """Writes ``pages`` as normalised archives below ``folder`` and returns what reading them gives."""
    spark: SparkSession = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    crawl, final = f"{folder}/crawl", f"{folder}/members"
    records = written(write_archives(pages, crawl))
    count = records.select("archive").distinct().count()
    manifest = written(normalise(revisits(records), crawl, final, count))
    if count:
        # Every archive is rewritten and listed: the streams that can only be read whole go.
        files, path = open_folder(crawl)
        files.delete_dir(path)
    return read_archives(manifest, final, count, with_payload)
