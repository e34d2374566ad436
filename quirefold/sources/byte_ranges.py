"""Byte ranges of files as rows, read where they are needed: no worker and no driver loads a whole file.

A Python data source plans one partition a range from the files' sizes; workers open the file on the
shared file system its URI names (file, hdfs, s3, gs, ...), and read their range and a halo behind it. Empty files
give no rows; a path that is a folder stands for all files below it; a path that isn't there is an error."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file string, range_no long, start long, stop long, size long, data binary"
_ARROW = pa.schema([("file", pa.string()), ("range_no", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("size", pa.int64()), ("data", pa.binary())])
RANGE_BYTES, HALO_BYTES = 1 << 20, 1 << 16
#: Ranges one task reads; they follow one another in a file.
RANGES_A_TASK = 64


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def sizes_of(paths: list[str]) -> list[tuple[str, int]]:
    """(file, bytes) of the files named and of those below the folders named."""
    from pyarrow import fs

    out = []
    for p in paths:
        system, at = _open(p)
        info = system.get_file_info(at)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(p)
        if info.type == fs.FileType.Directory:
            below = system.get_file_info(fs.FileSelector(at, recursive=True))
            root = p.rstrip("/")
            out += sorted((root + x.path.removeprefix(at.rstrip("/")), x.size) for x in below if x.type == fs.FileType.File)
        else:
            out.append((p, info.size))
    return out


class _Part(InputPartition):
    def __init__(self, file: str, size: int, first: int, last: int) -> None:
        self.file, self.size, self.first, self.last = file, size, first, last


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths = json.loads(options["paths"])
        self.span, self.halo = int(options.get("range_bytes", RANGE_BYTES)), int(options.get("halo_bytes", HALO_BYTES))

    def partitions(self) -> list[InputPartition]:
        out = []
        for f, n in sizes_of(self.paths):
            k = -(-n // self.span)
            out += [_Part(f, n, i, min(i + RANGES_A_TASK, k)) for i in range(0, k, RANGES_A_TASK)]
        return out

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        system, at = _open(partition.file)
        with system.open_input_file(at) as h:
            for i in range(partition.first, partition.last):
                a = i * self.span
                b = min(a + self.span, partition.size)
                data = h.read_at(min(b + self.halo, partition.size) - a, a)
                yield pa.RecordBatch.from_pylist([{"file": partition.file, "range_no": i, "start": a, "stop": b, "size": partition.size, "data": data}], schema=_ARROW)


class ByteRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "byte_ranges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def byte_ranges(spark: SparkSession, paths: list[str], range_bytes: int = RANGE_BYTES, halo_bytes: int = HALO_BYTES) -> DataFrame:
    """The ranges [start, stop) of each file, in `data` with up to halo_bytes of what follows."""
    spark.dataSource.register(ByteRanges)
    return spark.read.format("byte_ranges").options(paths=json.dumps(paths), range_bytes=range_bytes, halo_bytes=halo_bytes).load()
