"""A directory of log files as a stream with a ceiling in bytes per batch; large files are split over batches.

Offsets are places in the files' order: the time and path of a file and a byte in it. A restart goes on at the byte. Tasks read ranges of files
and yield the lines that begin in them. Compressed files cannot be split: they count with their size on disk and one that
is larger than the ceiling is a batch of its own.

Files are taken by time of change, then path, once they are ``settle_seconds`` old; they must be complete when they appear, and appear within that
time. Names that begin with ``_`` or ``.`` are left out. Lines end with a line feed; a carriage return before it is cut off, bytes that are no UTF-8
are replaced.

Options: ``path``, ``max_bytes`` (64 MB), ``split_bytes`` (16 MB, the most that a task reads), ``settle_seconds`` (5).
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from threatsieve.sources.lines import LINE_SCHEMA

BLOCK = 1 << 20
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4")
START = {"time": -1, "path": "", "byte": 0}


@dataclass
class FileRange(InputPartition):
    """The lines that begin in ``begin <= byte < end`` of a file; all of a compressed one."""

    path: str
    begin: int
    end: int


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def lines_from(source, at: int, end: int | None) -> Iterator[list[bytes]]:
    """Lists of lines from an open file that stands at the line that begins at ``at``, as long as they begin before ``end``."""
    held: list[bytes] = []  # of a line that is not whole yet
    while end is None or at < end:
        block = source.read(BLOCK)
        cut = block.rfind(b"\n") + 1
        if block and not cut:
            held.append(block)
            continue
        data = b"".join([*held, block[:cut]])
        if not block:
            if data:
                yield [data]
            return
        found = data.split(b"\n")[:-1]
        if end is not None and at + len(data) > end:
            begin, kept = at, 0
            for line in found:
                if begin >= end:
                    break
                begin += len(line) + 1
                kept += 1
            found = found[:kept]
        yield found
        held, at = [block[cut:]], at + len(data)


class PacedReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.max_bytes = int(options.get("max_bytes", 64 << 20))
        self.split_bytes = int(options.get("split_bytes", 16 << 20))
        self.settle = float(options.get("settle_seconds", 5))
        self.current: dict | None = None
        if min(self.max_bytes, self.split_bytes) < 1:
            raise ValueError("max_bytes and split_bytes must be positive")

    def files(self) -> list[tuple[int, str, int]]:
        """Time, path and size of the files, in order: as long as the directory's listing."""
        system, root = file_system(self.path)
        newest = time.time() - self.settle
        found = []
        for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            inside = info.path[len(root) :].strip("/").split("/")
            if info.is_file and info.mtime.timestamp() <= newest and not any(p.startswith(("_", ".")) for p in inside):
                found.append((info.mtime_ns, info.path, info.size))
        return sorted(found)

    def initialOffset(self) -> dict:
        return dict(START)

    def latestOffset(self) -> dict:
        """The place that is at most ``max_bytes`` further on."""
        if self.current is None:
            self.current = self.initialOffset()
        left, place = self.max_bytes, self.current
        for changed, path, size in self.files():
            if (changed, path) < (place["time"], place["path"]):
                continue
            begin = place["byte"] if (changed, path) == (place["time"], place["path"]) else 0
            if begin >= size:
                continue
            if path.endswith(COMPRESSED) and size > left and left < self.max_bytes or left <= 0:
                break
            end = size if path.endswith(COMPRESSED) else min(size, begin + left)
            place = {"time": changed, "path": path, "byte": end}
            left -= end - begin
        self.current = place
        return place

    def partitions(self, start: dict, end: dict) -> list[FileRange]:
        # A restart asks for the last batch of the checkpoint first.
        if self.current is None:
            self.current = end
        out = []
        first, last = (start["time"], start["path"]), (end["time"], end["path"])
        for changed, path, size in self.files():
            if not first <= (changed, path) <= last:
                continue
            begin = start["byte"] if (changed, path) == first else 0
            stop = end["byte"] if (changed, path) == last else size
            step = max(1, stop - begin) if path.endswith(COMPRESSED) else self.split_bytes
            out += [FileRange(path, at, min(at + step, stop)) for at in range(begin, stop, step)]
        return out

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        if partition.path.endswith(COMPRESSED):
            source, at, end = system.open_input_stream(partition.path, compression="detect"), 0, None
        else:
            source, at, end = system.open_input_file(partition.path), partition.begin, partition.end
        with source:
            if at:
                # The line at hand began before, unless a line ends just here.
                source.seek(at - 1)
                at -= 1
                while at < end:
                    block = source.read(BLOCK)
                    found = block.find(b"\n") + 1
                    at += found or len(block)
                    if found or not block:
                        break
                else:
                    return
                if not found:
                    return
                source.seek(at)
            for lines in lines_from(source, at, end):
                values = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
                yield pa.record_batch([pa.array(values, pa.string())], ["value"])

    def commit(self, end: dict) -> None:
        if self.current is None:
            self.current = end


class PacedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paced_lines"

    def schema(self) -> str:
        return LINE_SCHEMA

    def streamReader(self, schema: StructType) -> PacedReader:
        return PacedReader(dict(self.options))


def paced_lines(
    spark: SparkSession, path: str, max_bytes: int, split_bytes: int = 16 << 20, settle_seconds: float = 5
) -> DataFrame:
    """A directory of log files as a stream of lines, at most ``max_bytes`` per batch."""
    spark.dataSource.register(PacedLines)
    options = {"path": path, "max_bytes": max_bytes, "split_bytes": split_bytes, "settle_seconds": settle_seconds}
    return spark.readStream.format("paced_lines").options(**options).load()
