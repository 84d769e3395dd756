"""Zipped CSV as a Spark data source: archives dealt to tasks by size, read where they lie.

Deflate cannot be split, so an archive is one task's work from its first byte to its last.
The reader lists the archives with their sizes before any task starts, packs them into
tasks of about equal bytes (the largest first, each to the task with the least), and a task
opens its archives one after the other through pyarrow's file systems, a block at a time.
Neither an archive nor its content is ever held whole.

Which stores there are is settled when the table is planned: a path on a store that pyarrow
does not open is an error then, unless an ``opener`` for it is given.
"""

from __future__ import annotations

import base64
import heapq
import io
import json
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.csv as pacsv
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schema import TRIP_COLUMNS, TRIPS_TEXT

#: From a path to pyarrow's file system for it and the path inside.
Opener = Callable[[str], tuple[pafs.FileSystem, str]]

#: Stores that pyarrow opens by itself, under its names for them.
ARROW_STORES = {
    "": "file", "file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss",
}

LAYOUT = T.StructType([T.StructField("source", T.StringType()), *TRIPS_TEXT.fields])
_BLOCK_BYTES = 8 << 20
_LARGEST_BLOCK = 1 << 30


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    scheme = urlsplit(path).scheme
    if not scheme:
        path = f"file://{path}"
    elif scheme == "file":
        path = "file:///" + path.removeprefix("file:").lstrip("/")
    else:
        path = ARROW_STORES[scheme] + path[len(scheme) :]
    return pafs.FileSystem.from_uri(path)


class _Raw(io.RawIOBase):
    """A pyarrow file with the errors that ``zipfile`` expects when it looks before the start."""

    def __init__(self, file: pa.NativeFile):
        self._file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._file.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        start = (0, self._file.tell(), self._file.size())[whence]
        if start + offset < 0:
            raise OSError("before the start of the file")
        return self._file.seek(start + offset)

    def readinto(self, into) -> int:
        return self._file.readinto(into)


@contextmanager
def opened(path: str, opener: Opener = open_store):
    files, inside = opener(path)
    with files.open_input_file(inside) as archive:
        yield io.BufferedReader(_Raw(archive), 1 << 20)


def _batches(member, skip: int, block: int) -> Iterator[pa.RecordBatch]:
    reader = pacsv.open_csv(
        member,
        read_options=pacsv.ReadOptions(block_size=block, use_threads=False, skip_rows_after_names=skip),
        parse_options=pacsv.ParseOptions(newlines_in_values=True),
        convert_options=pacsv.ConvertOptions(
            column_types=dict.fromkeys(TRIP_COLUMNS, pa.string()),
            null_values=[""],
            strings_can_be_null=True,
        ),
    )
    header = reader.schema.names
    if [c.lower() for c in header] != list(TRIP_COLUMNS):
        raise ValueError(f"the header is not that of trips: {header}")
    yield from reader


def first_member_rows(archive, path: str) -> Iterator[pa.RecordBatch]:
    """Rows of an archive's first member with their ``source``; later members are ignored.

    Quoted line breaks are read at any size.  As with CSV, the header must be the
    layout's.  A row longer than a block is read again with larger blocks.
    """
    with zipfile.ZipFile(archive) as box:
        members = box.infolist()
        if not members:
            return
        done, block = 0, _BLOCK_BYTES
        while True:
            try:
                with box.open(members[0]) as member:
                    for rows in _batches(member, done, block):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path] * rows.num_rows, pa.string()), *rows.columns], LAYOUT.names
                        )
                        done += rows.num_rows
                return
            except pa.ArrowInvalid as failure:
                if "straddling" not in str(failure) or block >= _LARGEST_BLOCK:
                    raise ValueError(f"{path}: {failure}") from failure
                block *= 8
            except ValueError as failure:
                raise ValueError(f"{path}: {failure}") from failure


def packed(sizes: list[int], tasks: int) -> list[list[int]]:
    """Numbers of the items of each task, largest first, each to the task with the least so far."""
    load = [(0, k) for k in range(min(tasks, len(sizes)))]
    out: list[list[int]] = [[] for _ in load]
    for item in sorted(range(len(sizes)), key=lambda n: (-sizes[n], n)):
        total, k = heapq.heappop(load)
        out[k].append(item)
        heapq.heappush(load, (total + sizes[item], k))
    return out


class _Archives(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


class TripArchives(DataSource):
    """``spark.read.format("trip_archives")``; options are ``tasks`` (JSON) and ``opener`` (pickled)."""

    @classmethod
    def name(cls) -> str:
        return "trip_archives"

    def schema(self) -> T.StructType:
        return LAYOUT

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ArchiveReader(self.options)


class _ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.tasks = json.loads(options["tasks"])
        self.opener = cloudpickle.loads(base64.b64decode(options["opener"])) if "opener" in options else open_store

    def partitions(self) -> list[InputPartition]:
        return [_Archives(paths) for paths in self.tasks]

    def read(self, partition: _Archives) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            with opened(path, self.opener) as archive:
                yield from first_member_rows(archive, path)


def listed(spark: SparkSession, patterns: list[str]) -> list[tuple[str, int]]:
    """(path, bytes) of the files that match, each once; a pattern without any is an error."""
    found: dict[str, int] = {}
    conf = spark._jsc.hadoopConfiguration()
    for pattern in patterns:
        at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        files = at.getFileSystem(conf)
        hits = list(files.globStatus(at) or [])
        if len(hits) == 1 and hits[0].isDirectory():
            hits = list(files.listStatus(hits[0].getPath()))
        hits = [s for s in hits if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
        if not hits:
            raise FileNotFoundError(f"no archive matches {pattern}")
        found.update((s.getPath().toString(), s.getLen()) for s in hits)
    return sorted(found.items())


def read_archives(
    spark: SparkSession, patterns: list[str], opener: Opener | None = None, tasks: int | None = None
) -> DataFrame:
    """Text trips and ``source`` from all archives that match, packed into ``tasks`` tasks.

    Unless told otherwise there are as many tasks as cores, or as
    ``spark.sql.files.maxPartitionBytes`` asks for if that is more, and never more than archives.
    """
    archives = listed(spark, patterns)
    if opener is None:
        closed = sorted({urlsplit(path).scheme for path, _ in archives} - set(ARROW_STORES))
        if closed:
            raise ValueError(f"pyarrow opens no store of the kind {closed[0]}://; give an opener for it")
    if tasks is None:
        each = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
        tasks = max(spark.sparkContext.defaultParallelism, -(-sum(n for _, n in archives) // each))
    dealt = [[archives[k][0] for k in own] for own in packed([n for _, n in archives], tasks)]
    spark.dataSource.register(TripArchives)
    reader = spark.read.format(TripArchives.name()).option("tasks", json.dumps(dealt))
    if opener is not None:
        reader = reader.option("opener", base64.b64encode(cloudpickle.dumps(opener)).decode())
    return reader.load()
