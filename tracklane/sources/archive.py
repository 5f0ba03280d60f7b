"""``archive_lines`` and ``archive_members``: the CSV members of ZIP archives.

    spark.read.format("archive_lines").load("s3://bucket/recordings.zip")
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

from tracklane.sources.records import OPEN_BYTES, RANGE_BYTES, SMALLEST_RANGE, ByteRange, Pack, RecordReader, bytes_read, packed, whole_batches
from tracklane.sources.storage import is_csv_member, list_files, open_archive

# Lines per part: at 32 KB a line, a part stays below 128 MB.
PART_LINES = 4096
_BATCH_BYTES = 4 * 1024 * 1024
_LINES = pa.schema(
    [
        ("source_file", pa.string()),
        ("member", pa.string()),
        ("block", pa.int64()),
        ("pos", pa.int64()),
        ("line", pa.string()),
    ]
)


class ArchiveLines(DataSource):
    """Members are streamed whole, small ones share a partition. Options ``members`` all|first, ``label`` name|path of sources,
    the ``parallelism`` to aim at."""

    @classmethod
    def name(cls) -> str:
        return "archive_lines"

    def schema(self) -> str:
        return "source_file string, member string, block bigint, pos bigint, line string"

    def reader(self, schema) -> DataSourceReader:
        return LineReader(dict(self.options))


class LineReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.members = options.get("members", "all")
        self.label = options.get("label", "name")
        self.parallelism = int(options.get("parallelism", 1))

    def partitions(self) -> list[ByteRange | Pack]:
        reader = RecordReader({"path": self.path, "members": self.members, "label": self.label, "suffix": ".zip"})
        files = reader.files()
        share = sum(part.end for part in files) // self.parallelism
        return packed(files, min(RANGE_BYTES, max(SMALLEST_RANGE, share)), bytes_read) or [ByteRange("", None, 0, 0)]

    def read(self, part: ByteRange | Pack) -> Iterator[pa.RecordBatch]:
        parts = part.parts if isinstance(part, Pack) else [part] if part.path else []
        # Members of one archive follow one another, and its directory is read once for them.
        for path, members in groupby(parts, lambda one: one.path):
            with open_archive(path) as archive:
                yield from whole_batches(found for one in members for found in self._lines(archive, one))

    def _lines(self, archive: zipfile.ZipFile, part: ByteRange) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        with archive.open(part.member) as stream:
            # Any of the three line endings, and no byte-order mark.
            text = io.TextIOWrapper(stream, encoding="utf-8-sig", errors="replace", newline=None)
            for number, line in enumerate(text):
                rows.append((part.source_file, part.member, number // PART_LINES, number, line.rstrip("\n")))
                held += len(line)
                if held >= _BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)


class ArchiveMembers(DataSource):
    """Every member of every archive, from the central directories only."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return "archive string, member string, size bigint, compressed_size bigint, crc bigint, eligible boolean"

    def reader(self, schema) -> DataSourceReader:
        return MemberReader(dict(self.options))


class MemberReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.parallelism = int(options.get("parallelism", 1))

    def partitions(self) -> list[ByteRange | Pack]:
        archives = [ByteRange(path, None, 0, size) for path, size in list_files(self.path, ".zip")]
        # Directories only are read, so what counts is the number of archives; a large one may have many members.
        cost = lambda part: OPEN_BYTES + part.end // 64
        return packed(archives, max(SMALLEST_RANGE, min(RANGE_BYTES, sum(map(cost, archives)) // self.parallelism)), cost)

    def read(self, part: ByteRange | Pack) -> Iterator[tuple]:
        for one in part.parts if isinstance(part, Pack) else [part]:
            with open_archive(one.path) as archive:
                for m in archive.infolist():
                    if not m.is_dir():
                        yield one.path, m.filename, m.file_size, m.compress_size, m.CRC, is_csv_member(m.filename)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _LINES)], schema=_LINES)


def read_archive_lines(spark: SparkSession, path: str, members: str = "all", label: str = "name") -> DataFrame:
    """``lines(source_file, member, block, pos, line)`` of the CSV members of a ZIP or a folder of ZIPs."""
    spark.dataSource.register(ArchiveLines)
    return spark.read.format("archive_lines").options(members=members, label=label, parallelism=spark.sparkContext.defaultParallelism).load(path)


def list_archive_members(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(ArchiveMembers)
    return spark.read.format("archive_members").option("parallelism", spark.sparkContext.defaultParallelism).load(path)
