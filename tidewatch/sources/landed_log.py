"""A2/A4: landed topic logs with offsets, as a Python data source.

A landed log is a folder of ``partition=<p>/<base offset>.jsonl`` files: each
line is a message, the file's name the offset of its first one. So a file's
offsets are known from its successor's name, and only a partition's last file
has to be counted. Batch reads take ranges of offsets, a stream goes on from
the offsets in its checkpoint; both give (partition, offset, value) and read
the files in parallel, none of them whole into memory.

``first_offsets`` gives the end offsets of the first n messages in (partition,
offset) order from these names, so that a bounded read neither sorts nor scans
the topic. Options of the format ``landed_log``: ``path``, ``starting`` and
``ending`` (JSON objects from partition to offset; the end is exclusive).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "landed_log"
SCHEMA = "partition int, offset long, value string"
_FILE = re.compile(r"partition=(\d+)/(\d+)\.jsonl$")
_ROWS = 4096
_BYTES = 1 << 20


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if re.match(r"[a-z0-9]+:", folder) else (fs.LocalFileSystem(), folder)


@dataclass
class Segment(InputPartition):
    """Messages ``first`` to ``last`` (exclusive, None: to the file's end) of
    the file at ``path`` whose first offset is ``base``."""

    path: str
    partition: int
    base: int
    first: int
    last: int | None


def segments(folder: str) -> dict[int, list[tuple[int, str]]]:
    """Per partition its files as (base offset, path), in order."""
    from pyarrow import fs

    store, path = _store(folder)
    out: dict[int, list[tuple[int, str]]] = {}
    for info in store.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True)):
        if found := _FILE.search(info.path):
            out.setdefault(int(found[1]), []).append((int(found[2]), info.path))
    return {p: sorted(files) for p, files in sorted(out.items())}


def _count(folder: str, path: str) -> int:
    """Whole lines of a file; a line without its end is still being written."""
    store, _ = _store(folder)
    n = 0
    with store.open_input_stream(path) as src:
        while block := src.read(_BYTES):
            n += block.count(b"\n")
    return n


def ends(folder: str) -> dict[int, int]:
    """The offset behind each partition's last message."""
    return {p: files[-1][0] + _count(folder, files[-1][1]) for p, files in segments(folder).items()}


def first_offsets(folder: str, n: int) -> dict[int, int]:
    """The end offsets of the first ``n`` messages by (partition, offset):
    whole partitions, then a part of one, nothing of the rest."""
    out = {}
    for p, files in segments(folder).items():
        first = files[0][0]
        closed = files[-1][0] - first
        have = closed if closed >= n else closed + _count(folder, files[-1][1])
        out[p] = first + min(n, have)
        n -= min(n, have)
    return out


def _ranges(folder: str, starting: dict[int, int], ending: dict[int, int] | None) -> list[Segment]:
    out = []
    for p, files in segments(folder).items():
        if ending is not None and p not in ending:
            continue
        for k, (base, path) in enumerate(files):
            after = files[k + 1][0] if k + 1 < len(files) else None
            first = max(base, starting.get(p, base))
            last = after if ending is None else ending[p] if after is None else min(after, ending[p])
            if last is None or first < last:
                out.append(Segment(path, p, base, first, last))
    return out


def _lines(folder: str, part: Segment) -> Iterator[pa.RecordBatch]:
    """The messages of a range; lines of any length, in Arrow batches."""
    store, _ = _store(folder)
    offset, rest, values, first = part.base, b"", [], part.first

    def batch():
        return pa.RecordBatch.from_arrays([pa.array([part.partition] * len(values), pa.int32()), pa.array(range(first, first + len(values)), pa.int64()),
                                           pa.array(values, pa.string())], names=["partition", "offset", "value"])
    with store.open_input_stream(part.path) as src:
        pieces: list[bytes] = []
        while part.last is None or offset < part.last:
            block = src.read(_BYTES)
            if not block:
                break
            *whole, rest = block.split(b"\n")
            if whole:
                whole[0] = b"".join(pieces) + whole[0]
                pieces = []
            pieces.append(rest)
            for line in whole:
                if offset >= part.first and (part.last is None or offset < part.last):
                    values.append(line.decode("utf-8", "replace"))
                    if len(values) >= _ROWS:
                        yield batch()
                        first, values = first + len(values), []
                offset += 1
    if values:
        yield batch()


def _offsets(text: str | None) -> dict[int, int] | None:
    return None if text is None else {int(p): int(o) for p, o in json.loads(text).items()}


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.starting, self.ending = _offsets(options.get("starting")) or {}, _offsets(options.get("ending"))

    def partitions(self) -> list[Segment]:
        ending = ends(self.folder) if self.ending is None else self.ending
        return _ranges(self.folder, self.starting, ending) or [Segment("", 0, 0, 0, 0)]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return _lines(self.folder, partition) if partition.path else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.starting = _offsets(options.get("starting")) or {}

    def initialOffset(self) -> dict:
        return {str(p): self.starting.get(p, files[0][0]) for p, files in segments(self.folder).items()}

    def latestOffset(self) -> dict:
        return {str(p): o for p, o in ends(self.folder).items()}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        return _ranges(self.folder, {int(p): o for p, o in start.items()}, {int(p): o for p, o in end.items()}) or [Segment("", 0, 0, 0, 0)]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return _lines(self.folder, partition) if partition.path else iter(())


class LandedLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))

    def streamReader(self, schema) -> _StreamReader:
        return _StreamReader(dict(self.options))


def read_log(spark: SparkSession, folder: str, starting: dict[int, int] | None = None, ending: dict[int, int] | None = None):
    """The messages of a landed log between two sets of offsets."""
    spark.dataSource.register(LandedLog)
    r = spark.read.format(FORMAT).option("path", folder)
    for name, offsets in (("starting", starting), ("ending", ending)):
        if offsets is not None:
            r = r.option(name, json.dumps(offsets))
    return r.load()


def stream_log(spark: SparkSession, folder: str, starting: dict[int, int] | None = None):
    spark.dataSource.register(LandedLog)
    r = spark.readStream.format(FORMAT).option("path", folder)
    return (r.option("starting", json.dumps(starting)) if starting else r).load()
