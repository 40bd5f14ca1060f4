"""WARC archives: writing, an index of offsets, and coalesced byte-range reads.

Each writing task makes archives of its own, one gzip member per record, under fresh names, and
returns a row per finished file; files of attempts that failed are in no such row, so lost executors
leave nothing that is read. The index is a table with a row per record: file, offset, length, URL,
digest and the header fields. Selected index rows are sorted by file and offset and cut into tasks
by bytes; a task joins neighbouring ranges into one read and unpacks a record at a time.

Archives go below a folder that all executors reach, by any scheme Arrow's file systems know.

Defined results: a null or empty payload is an empty payload. A null URL leaves the header field
out; control characters in a URL are percent-encoded. A null page id makes a record without page
number. Rows that repeat page id and payload are one page: all are response if the first is.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hybridflow.llm.common import Cuts, ready, record_batches

DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 256 << 20
READ_BYTES = 4 << 20
GAP_BYTES = 64 << 10
TASK_BYTES = 32 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record(page_id, url, payload: bytes, digest: str, refers_to, n_bytes: int) -> bytes:
    """One record; with ``refers_to`` a revisit without payload."""
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n_bytes
    if not revisit:
        block += payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>" if page_id is None else f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {DATE}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Header fields (lower-case names), payload, and the payload length that HTTP gives."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(fields.get("content-length", 0))]
    if not fields.get("content-type", "").startswith("application/http"):
        return fields, block, len(block)
    http, _, payload = block.partition(b"\r\n\r\n")
    said = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    return fields, payload, int(said.group(1)) if said else len(payload)


FILES = pa.schema([("file", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])


def _writer(folder: str, file_bytes: int):
    """(page_id, url, payload, sha1 hex, refers_to) to a row per archive written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        out, path, size, n, rows = None, "", 0, 0, []
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                page_id, url, payload, sha1, refers_to = (c[i].as_py() for c in columns)
                payload = (payload or "").encode("utf-8", "surrogatepass") if not isinstance(payload, bytes) else payload
                digest = base64.b32encode(bytes.fromhex(sha1)).decode("ascii")
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = pack.compress(record(page_id, url, payload, digest, refers_to, len(payload))) + pack.flush()
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, path, size, n = store.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}", 0, 0
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    out.close()
                    rows.append({"file": path, "n_records": n, "n_bytes": size})
                    out = None
        if out is not None:
            out.close()
            rows.append({"file": path, "n_records": n, "n_bytes": size})
        yield from record_batches(iter(rows), FILES)

    return run


def plan_records(pages: DataFrame, cuts: Cuts, min_revisit_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, sha1, refers_to``: of equal payloads all but the first page refer to it."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    )
    rows = rows.withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    large = F.octet_length("payload") >= min_revisit_bytes
    # Written first: Spark then knows its size, and moves no payload where it is small.
    firsts = cuts.cut(
        rows.where(large)
        .groupBy(F.col("sha1").alias("s"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("s", "first")
    )
    joined = rows.join(firsts, rows["sha1"] == firsts["s"], "left")
    refers = F.when(large & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", "sha1", refers.alias("refers_to"))


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archives of ``records`` (as :func:`plan_records` gives them) below ``folder``: a row per file."""
    store, root = open_folder(folder)
    store.create_dir(root, recursive=True)
    return records.mapInArrow(_writer(folder, file_bytes), "file string, n_records long, n_bytes long")


INDEX = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()),
     ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())]
)
INDEX_DDL = "file string, offset long, length long, url string, digest string, record_id string, record_type string, refers_to string"


def members(stream, chunk: int = 1 << 20) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of every gzip member of a stream, one in memory at a time."""
    offset, data, at = 0, b"", 0
    while True:
        unpack, parts, start = zlib.decompressobj(31), [], offset
        while not unpack.eof:
            if not data:
                data = stream.read(chunk)
                if not data:
                    if parts:
                        raise EOFError(f"the archive ends within the record at {start}")
                    return
            parts.append(unpack.decompress(data))
            used = len(data) - len(unpack.unused_data)
            offset, data = offset + used, unpack.unused_data
        yield start, offset - start, b"".join(parts)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for file in batch.column(0).to_pylist():
                store, path = open_folder(file)
                with store.open_input_file(path) as stream:
                    for offset, length, data in members(stream):
                        head, _, _ = parse(data)
                        yield {
                            "file": file, "offset": offset, "length": length, "url": head.get("warc-target-uri"),
                            "digest": head.get("warc-payload-digest"), "record_id": head.get("warc-record-id"),
                            "record_type": head.get("warc-type"), "refers_to": head.get("warc-refers-to"),
                        }

    yield from record_batches(rows(), INDEX)


def build_index(files: DataFrame, n_files: int) -> DataFrame:
    """A row per record of the archives in ``files.file``; a task per file."""
    return files.select("file").repartition(max(n_files, 1), "file").mapInArrow(_index, INDEX_DDL)


RECORDS = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.string()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)
RECORDS_DDL = "record_id string, record_type string, url string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def ranges(rows: Iterator[tuple[str, int, int]], gap: int, most: int) -> Iterator[tuple[str, int, int, list]]:
    """Sorted (file, offset, length) joined to reads (file, start, size, records)."""
    file, start, end, held = None, 0, 0, []
    for f, offset, length in rows:
        if held and (f != file or offset - end > gap or offset + length - start > most):
            yield file, start, end - start, held
            held = []
        if not held:
            file, start, end = f, offset, offset
        held.append((offset, length))
        end = max(end, offset + length)
    if held:
        yield file, start, end - start, held


def _read(gap: int, most: int, payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def wanted():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)

        def rows():
            opened, stream = None, None
            for file, start, size, held in ranges(wanted(), gap, most):
                if file != opened:
                    store, path = open_folder(file)
                    opened, stream = file, store.open_input_file(path)
                data = stream.read_at(size, start)
                for offset, length in held:
                    head, body, said = parse(zlib.decompress(data[offset - start : offset - start + length], 31))
                    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
                    if head.get("warc-type") != "revisit":
                        if base32_sha1(body) != digest or len(body) != said:
                            raise ValueError(f"payload of {head.get('warc-record-id')} in {file} at {offset} is damaged")
                    yield {
                        "record_id": head.get("warc-record-id"), "record_type": head.get("warc-type"),
                        "url": head.get("warc-target-uri"), "refers_to": head.get("warc-refers-to"),
                        "payload_bytes": said, "payload_digest": digest, "payload": body if payload else None,
                    }

        yield from record_batches(rows(), RECORDS, 200 if payload else 5000)

    return run


def read_records(
    selected: DataFrame,
    n_bytes: int,
    payload: bool = True,
    gap: int = GAP_BYTES,
    most: int = READ_BYTES,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """The records that ``selected`` rows of an index name. ``n_bytes``: about their length in all.

    Payloads are checked against their digests.
    """
    n = 1 + n_bytes // task_bytes
    rows = selected.select("file", "offset", "length").repartitionByRange(n, "file", "offset")
    return rows.sortWithinPartitions("file", "offset").mapInArrow(_read(gap, most, payload), RECORDS_DDL)


def round_trip(spark: SparkSession, pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Pages as archives, indexed and read back: a row per page from its record."""
    cuts = Cuts(ready(spark), "warc")
    records = plan_records(pages, cuts, min_revisit_bytes)
    files = cuts.cut(write_archives(records, f"{cuts.root}/archives"))
    n, total = files.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    index = cuts.cut(build_index(files, n))
    found = read_records(index, total, payload=False)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return found.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )
