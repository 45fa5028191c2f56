"""Folders of text lines as a log: a data source whose offsets are byte positions.

The files of a folder, in the natural order of their paths, are the segments of one log.  A line's
offset is the number of bytes before it in the log, so offsets are unique, keep the order of files
and lines, and are the same however the files are cut into tasks.  A task reads a range of bytes; a line
belongs to the range in which it begins.

A stream reads the files that have come since its last batch.  Files must appear whole, with paths
that sort behind the ones before, and must stay: a batch that finds the files before its start changed
fails, as its offsets would no longer be true.  There is no limit on a batch; ``availableNow`` takes what
is there in one.

Storage is reached through pyarrow's file systems, by the scheme of the path.
"""

from __future__ import annotations

import fnmatch
import io
import posixpath
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "wardflow_lines"
SCHEMA = "value string, offset bigint, timestamp timestamp"

# Bytes of a task, and of a batch of lines handed to the JVM.
SPLIT_BYTES = 64 << 20
BATCH_BYTES = 4 << 20

ARROW = pa.schema(
    [("value", pa.string()), ("offset", pa.int64()), ("timestamp", pa.timestamp("us", tz="UTC"))]
)


@dataclass(frozen=True)
class Segment:
    """A file and the bytes of the log before it."""

    path: str
    size: int
    base: int
    micros: int


@dataclass
class LineRange(InputPartition):
    segment: Segment
    start: int
    end: int


def natural(path: str) -> list[tuple[int, str]]:
    """Sort key in which part-100000 comes after part-99999."""
    return [(int(t), "") if t.isdigit() else (-1, t) for t in re.split(r"([0-9]+)", path) if t]


def open_storage(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def segments(path: str) -> list[Segment]:
    """The files of a folder and those below it, of a glob on file names, or the one file."""
    storage, root = open_storage(path)
    pattern = "*"
    if any(c in posixpath.basename(root) for c in "*?["):
        root, pattern = posixpath.split(root)
    info = storage.get_file_info(root)
    found = [info]
    if info.type == fs.FileType.Directory:
        found = storage.get_file_info(fs.FileSelector(root, recursive=True))
    elif info.type == fs.FileType.NotFound:
        found = []
    files = [f for f in found if f.type == fs.FileType.File and _visible(f.path, root, pattern)]
    out, base = [], 0
    for f in sorted(files, key=lambda f: natural(f.path)):
        out.append(Segment(f.path, f.size, base, (f.mtime_ns or 0) // 1000))
        base += f.size
    return out


def _visible(path: str, root: str, pattern: str) -> bool:
    """Not Spark's markers or unfinished writes."""
    below = posixpath.relpath(path, root).split("/") if path != root else [posixpath.basename(path)]
    return not any(n.startswith(("_", ".")) for n in below) and fnmatch.fnmatch(below[-1], pattern)


def ranges(found: list[Segment], split_bytes: int) -> list[LineRange]:
    return [
        LineRange(s, at, min(at + split_bytes, s.size))
        for s in found
        for at in range(0, s.size, split_bytes)
    ]


def lines_of(source, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Lines that begin in ``[start, end)``, with the position of each; a lone return ends one too."""
    at = start
    if start:
        source.seek(start - 1)
        at = start - 1 + len(source.readline())
    while at < end:
        line = source.readline()
        if not line:
            return
        begin = at
        for piece in line.rstrip(b"\n").split(b"\r"):
            yield begin, piece
            begin += len(piece) + 1
        at += len(line)


def read_range(path: str, part: LineRange) -> Iterator[pa.RecordBatch]:
    storage, _ = open_storage(path)
    segment = part.segment
    values, offsets, held = [], [], 0

    def batch():
        stamps = [segment.micros] * len(values)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(values, pa.string()),
                pa.array(offsets, pa.int64()),
                pa.array(stamps, pa.int64()).cast(ARROW.field("timestamp").type),
            ],
            schema=ARROW,
        )

    with io.BufferedReader(storage.open_input_file(segment.path), 1 << 20) as source:
        for at, line in lines_of(source, part.start, part.end):
            values.append(line.decode("utf-8", "replace"))
            offsets.append(segment.base + at)
            held += len(line)
            if held >= BATCH_BYTES:
                yield batch()
                values, offsets, held = [], [], 0
    if values:
        yield batch()


class _Options:
    def __init__(self, options):
        self.path = options["path"]
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))

    def read(self, partition: LineRange) -> Iterator[pa.RecordBatch]:
        return read_range(self.path, partition)


class LineReader(_Options, DataSourceReader):
    def partitions(self) -> list[LineRange]:
        return ranges(segments(self.path), self.split_bytes) or [_nothing()]

    def read(self, partition):
        return read_range(self.path, partition) if partition.end else iter(())


class LineStreamReader(_Options, DataSourceStreamReader):
    """An offset is the number of files and of bytes read so far: the state is two numbers."""

    def initialOffset(self) -> dict:
        return {"files": 0, "bytes": 0}

    def latestOffset(self) -> dict:
        found = segments(self.path)
        return {"files": len(found), "bytes": sum(s.size for s in found)}

    def partitions(self, start: dict, end: dict) -> list[LineRange]:
        found = segments(self.path)
        for mark in (start, end):
            if sum(s.size for s in found[: mark["files"]]) != mark["bytes"]:
                raise ValueError(
                    f"{self.path}: the first {mark['files']} files no longer hold {mark['bytes']} "
                    "bytes; files of a log must stay, and new ones must sort behind them"
                )
        return ranges(found[start["files"] : end["files"]], self.split_bytes)

    def commit(self, end: dict) -> None:
        """Nothing to release: files stay."""


def _nothing() -> LineRange:
    return LineRange(Segment("", 0, 0, 0), 0, 0)


class LineLog(DataSource):
    """``spark.read`` or ``readStream`` with ``path`` and, if wanted, ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LineReader:
        return LineReader(self.options)

    def streamReader(self, schema) -> LineStreamReader:
        return LineStreamReader(self.options)
