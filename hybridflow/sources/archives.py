"""Zip archives read by byte ranges: a listing, a table of members, and members as lines.

An archive is never read whole. Its central directory, at its end, names the members and where they
start; each member is then a piece of work of its own, so one large archive is read by many tasks.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

READ_BYTES = 1 << 20
LINES_PER_CHUNK = 20_000
#: Packed bytes that one task reads.
TASK_BYTES = 64 << 20

MEMBERS = "path STRING, member STRING, header_offset BIGINT, packed_size BIGINT, size BIGINT, method INT, crc BIGINT"
LINES = "path STRING, member STRING, line_no BIGINT, value STRING"

# Fixed values of the zip format: a local header is 30 bytes, then the name and extra fields.
LOCAL_HEADER, LOCAL_SIGNATURE = "<4s5H3L2H", b"PK\3\4"
STORED, DEFLATED = zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED


def opened(path: str) -> pyarrow.NativeFile:
    """A file of any store Arrow knows, open for reading at any place."""
    store, inside = pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return store.open_input_file(inside)


def list_archives(spark: SparkSession, folder: str, pattern: str = "*.zip") -> DataFrame:
    """``path``, ``file_name`` and ``length`` of the archives below a folder; none is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return files.load(folder).select("path", F.col("_metadata.file_name").alias("file_name"), "length")


def list_members(archives: DataFrame) -> DataFrame:
    """A row per member of the archives, from their central directories alone; folders are left out."""

    def directory(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                with opened(path) as file, zipfile.ZipFile(file) as archive:
                    held = [
                        (path, m.filename, m.header_offset, m.compress_size, m.file_size, m.compress_type, m.CRC)
                        for m in archive.infolist()
                        if not m.is_dir()
                    ]
                for start in range(0, len(held), LINES_PER_CHUNK):
                    yield pd.DataFrame(held[start : start + LINES_PER_CHUNK], columns=[c.split()[0] for c in MEMBERS.split(", ")])

    return archives.select("path").mapInPandas(directory, MEMBERS)


class _Member(io.RawIOBase):
    """A member's bytes, unpacked as they are read; damage is an error."""

    def __init__(self, file, header_offset: int, packed_size: int, method: int, crc: int):
        head = struct.unpack(LOCAL_HEADER, file.read_at(struct.calcsize(LOCAL_HEADER), header_offset))
        if head[0] != LOCAL_SIGNATURE or method not in (STORED, DEFLATED):
            raise ValueError(f"no readable member at {header_offset}")
        self.file, self.crc, self.seen = file, crc, 0
        self.at = header_offset + struct.calcsize(LOCAL_HEADER) + head[-2] + head[-1]
        self.end = self.at + packed_size
        self.unpack = zlib.decompressobj(-15) if method == DEFLATED else None
        self.held = b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.held and self.at < self.end:
            packed = self.file.read_at(min(READ_BYTES, self.end - self.at), self.at)
            self.at += len(packed)
            self.held = self.unpack.decompress(packed) if self.unpack else packed
            if self.unpack and self.at >= self.end:
                self.held += self.unpack.flush()
        n = min(len(buffer), len(self.held))
        buffer[:n], self.held = self.held[:n], self.held[n:]
        self.seen = zlib.crc32(buffer[:n], self.seen)
        if n == 0 and self.seen != self.crc:
            raise ValueError(f"a member of {self.file} is damaged")
        return n


def read_members(members: DataFrame, n_bytes: int, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Lines of the members, each read from its own byte range in bounded chunks.

    ``n_bytes`` is about their packed size in all; members are dealt to the tasks one by one, in
    any order. ``line_no`` counts from 0 in each member.
    """

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                with opened(row.path) as file:
                    raw = _Member(file, int(row.header_offset), int(row.packed_size), int(row.method), int(row.crc))
                    text = io.TextIOWrapper(io.BufferedReader(raw, READ_BYTES), encoding="utf-8", newline="\n")
                    yield from chunks(row.path, row.member, text)

    def chunks(path: str, member: str, text) -> Iterator[pd.DataFrame]:
        start, held = 0, []
        for line in text:
            held.append(line.removesuffix("\n"))
            if len(held) == LINES_PER_CHUNK:
                yield frame(path, member, start, held)
                start, held = start + len(held), []
        if held:
            yield frame(path, member, start, held)

    def frame(path: str, member: str, start: int, held: list[str]) -> pd.DataFrame:
        return pd.DataFrame({"path": path, "member": member, "line_no": range(start, start + len(held)), "value": held})

    tasks = 1 + n_bytes // task_bytes
    return members.repartition(int(tasks)).mapInPandas(lines, LINES)


def write_zip(path: str, members: Iterator[tuple[str, Iterator[str]]]) -> int:
    """Members of lines as one archive, written as a stream; gives its length. Run again it is replaced."""
    store, inside = pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    store.create_dir(inside.rpartition("/")[0], recursive=True)
    with store.open_output_stream(inside, compression=None) as raw:
        with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as archive:
            for name, lines in members:
                with archive.open(zipfile.ZipInfo(name), "w", force_zip64=True) as member:
                    for line in lines:
                        member.write(line.encode() + b"\n")
        return raw.tell()
