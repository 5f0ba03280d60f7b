"""``trajectory_records``: recordings read as whole logical records, with no shuffle.

A plain file, or an archive member stored as it is, is cut into byte ranges. A range owns the records whose first line
begins in it and reads on past its end to finish the last one, so every record comes out whole and once. Small files and
members share a task, up to a range's bytes. A compressed member cannot be cut; one task streams it and hands its records
on in batches of few bytes, which ``read_records`` spreads over all tasks before they are parsed.

    spark.read.format("trajectory_records").load("s3://bucket/recordings/")
"""

from __future__ import annotations

import io
import json
import re
import struct
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tracklane import schemas as S
from tracklane.sources.storage import is_csv_member, label_files, list_files, open_archive, open_bytes, relative_name

RANGE_BYTES = 128 * 1024 * 1024
SMALLEST_RANGE = 1024 * 1024
BATCH_BYTES = 4 * 1024 * 1024
# What opening a file counts for beside its bytes, when small files are put together for one task.
OPEN_BYTES = 64 * 1024
# Neither an Arrow string column nor a JVM string holds more; a record beyond it stops the read with an error.
LARGEST_TEXT = 2**31 - 1
_CHUNK = 1024 * 1024
_START = re.compile(rb"\s*\d+\s*;\s*[A-Za-z]")
_ARROW = pa.schema(
    [("source_file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("text", pa.string())]
)


@dataclass
class ByteRange(InputPartition):
    path: str
    member: str | None
    start: int
    end: int
    source_file: str = ""
    #: Where a stored member's bytes begin in its archive; none for a compressed one.
    offset: int | None = None
    size: int = 0
    #: Bytes of text that go on as one batch, in a range that cannot be cut.
    batch: int | None = None


@dataclass
class Pack(InputPartition):
    """Small parts that one task reads one after the other."""

    parts: list[ByteRange]


def packed(parts: list[ByteRange], size: int, cost: Callable[[ByteRange], int]) -> list[ByteRange | Pack]:
    """The parts in their order, neighbours put together as long as they cost no more than ``size``."""
    packs, held = [], 0
    for part in parts:
        if not packs or held + cost(part) > size:
            packs.append([])
            held = 0
        packs[-1].append(part)
        held += cost(part)
    return [pack[0] if len(pack) == 1 else Pack(pack) for pack in packs]


def bytes_read(part: ByteRange) -> int:
    return part.end - part.start + OPEN_BYTES


class TrajectoryRecords(DataSource):
    """Options: ``members`` all|first, ``rowLimit`` records per file (0 = all), ``skipHeader``, ``label`` name|path of
    sources, ``suffix`` of the plain files in a folder, ``rangeBytes`` or the ``parallelism`` to aim at."""

    @classmethod
    def name(cls) -> str:
        return "trajectory_records"

    def schema(self):
        return S.RECORD

    def reader(self, schema) -> DataSourceReader:
        return RecordReader(dict(self.options))


class RecordReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        options = {name.lower(): value for name, value in options.items()}
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.members = options.get("members", "all")
        if self.members not in ("all", "first"):
            raise ValueError(f"members must be 'all' or 'first', got {self.members!r}")
        self.label = options.get("label", "name")
        self.suffixes = (options.get("suffix", ".csv").lower(), ".zip")
        self.row_limit = int(options.get("rowlimit", 0))
        self.skip_header = str(options.get("skipheader", "true")).lower() == "true"
        self.range_bytes = int(options["rangebytes"]) if "rangebytes" in options else None
        self.parallelism = int(options.get("parallelism", 1))
        self.archive: tuple[str, zipfile.ZipFile] | None = None

    def files(self) -> list[ByteRange]:
        """A range for every file or member as a whole."""
        found = [(relative_name(path, given), path, size) for given in self.paths for path, size in list_files(given, self.suffixes)]
        whole, names = [], []
        for name, path, size in found:
            if path.lower().endswith(".zip"):
                parts = member_ranges(path, self.members)
                whole += parts
                names += [part.member if path in self.paths else f"{name}/{part.member}" for part in parts]
            else:
                whole.append(ByteRange(path, None, 0, size, size=size))
                names.append(name)
        for part, label in zip(whole, label_files(names, self.label), strict=True):
            part.source_file = label
        return whole

    def partitions(self) -> list[ByteRange | Pack]:
        files = self.files()
        # Small inputs are cut finer, so that every core gets a part.
        share = sum(part.end for part in files) // self.parallelism
        cut = self.range_bytes or min(RANGE_BYTES, max(SMALLEST_RANGE, share))
        return packed([part for file in files for part in self.cut(file, cut)], cut, bytes_read) or [ByteRange("", None, 0, 0)]

    def cut(self, file: ByteRange, size: int) -> list[ByteRange]:
        if file.member is not None and file.offset is None:
            return [replace(file, batch=min(size, BATCH_BYTES))]
        # A row limit counts records from the top of the file, so the file is read as one range that stops early.
        step = max(file.end, 1) if self.row_limit else size
        return [replace(file, start=at, end=min(at + step, file.end)) for at in range(0, file.end, step)]

    def read(self, part: ByteRange | Pack) -> Iterator[pa.RecordBatch]:
        if isinstance(part, Pack):
            yield from whole_batches(found for one in part.parts for found in self.read(one))
            return
        if not part.path:
            return
        rows: list[tuple[str, int, int, str | None]] = []
        held, block, sent = 0, part.start, 0
        for seq, text in self._records(part):
            length = len(text or "")
            # A batch holds few bytes or one long record.
            if rows and held + length > (part.batch or BATCH_BYTES):
                yield _batch(rows)
                if part.batch:
                    block = part.start + sent
                rows, held = [], 0
            rows.append((part.source_file, block, seq, text))
            held += length
            sent += length + 1
        if rows:
            yield _batch(rows)

    def _records(self, part: ByteRange) -> Iterator[tuple[int, str | None]]:
        """(seq, text) of the records the range owns; seq 0 is what comes before a file's first start."""
        seq, size, seen, first, pieces = 0, 0, 0, 0, []
        # Lines before the first start of a later range belong to the range before it.
        opened = part.start == 0
        for begin, line in self._lines(part):
            starts = _START.match(line) is not None
            # Past its range, only an open record keeps a reader going.
            if begin >= part.end and (starts or not opened or seq == 0):
                break
            if starts:
                if opened and (seq or pieces):
                    yield seq, self._text(seq, pieces)
                    seen += 1
                    if self.row_limit and seen >= self.row_limit:
                        return
                seq, size, first, pieces, opened = seq + 1, 0, begin, [], True
            if opened and (seq or not pieces):
                pieces.append(line)
                size += len(line) + 1
                if size > LARGEST_TEXT:
                    raise _too_long("record", part, first)
        if opened and (seq or pieces):
            yield seq, self._text(seq, pieces)

    def _text(self, seq: int, pieces: list[bytes]) -> str | None:
        return b"\n".join(pieces).decode("utf-8", errors="replace") if seq else None

    def _lines(self, part: ByteRange) -> Iterator[tuple[int, bytes]]:
        """(byte offset, line) of the non-blank lines from the first one that begins in the range on."""
        with self._opened(part) as stream:
            at = part.start
            if at:
                # Step back one byte: a line that begins exactly here is ours.
                stream.seek(at - 1)
                at -= 1
                while True:
                    skipped = stream.readline(_CHUNK)
                    at += len(skipped)
                    if not skipped or skipped.endswith(b"\n"):
                        break
            first = part.start == 0
            header = first and self.skip_header
            while raw := stream.readline(LARGEST_TEXT + 1):
                begin, at = at, at + len(raw)
                if len(raw) > LARGEST_TEXT:
                    raise _too_long("line", part, begin)
                for line in raw.rstrip(b"\r\n").split(b"\r"):
                    if header:
                        header = False
                        continue
                    if first:
                        line, first = line.removeprefix(b"\xef\xbb\xbf"), False
                    if line:
                        yield begin, line

    def _opened(self, part: ByteRange):
        if part.member is None:
            return open_bytes(part.path)
        if part.offset is not None:
            return io.BufferedReader(_Stretch(open_bytes(part.path), part.offset, part.size), _CHUNK)
        # Members of one archive follow one another, and its directory is read once for them.
        if self.archive is None or self.archive[0] != part.path:
            self.archive = part.path, open_archive(part.path)
        return self.archive[1].open(part.member)


def member_ranges(path: str, members: str) -> list[ByteRange]:
    """A range for each chosen member as a whole."""
    with open_archive(path) as archive:
        chosen = [m for m in archive.infolist() if is_csv_member(m.filename)]
        if not chosen:
            raise ValueError(f"no CSV member in archive {path}")
        chosen = chosen[:1] if members == "first" else chosen
        return [ByteRange(path, m.filename, 0, m.file_size, m.filename, _bytes_from(archive, m), m.file_size) for m in chosen]


def _bytes_from(archive: zipfile.ZipFile, member: zipfile.ZipInfo) -> int | None:
    """Where the bytes of a member begin that is neither compressed nor encrypted."""
    if member.compress_type != zipfile.ZIP_STORED or member.flag_bits & 1:
        return None
    archive.fp.seek(member.header_offset + 26)
    # The two lengths that end a local header: of the name and of the extra field behind it.
    name, extra = struct.unpack("<HH", archive.fp.read(4))
    return member.header_offset + 30 + name + extra


class _Stretch(io.RawIOBase):
    """Part of a file as a file of its own."""

    def __init__(self, stream, offset: int, size: int):
        self.stream, self.offset, self.size, self.at = stream, offset, size, 0
        stream.seek(offset)

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, to: int, whence: int = io.SEEK_SET) -> int:
        self.at = to + (0, self.at, self.size)[whence]
        self.stream.seek(self.offset + self.at)
        return self.at

    def tell(self) -> int:
        return self.at

    def readinto(self, into) -> int:
        data = self.stream.read(max(0, min(len(into), self.size - self.at)))
        into[: len(data)] = data
        self.at += len(data)
        return len(data)


def _too_long(what: str, part: ByteRange, offset: int) -> ValueError:
    file = f"{part.path}!{part.member}" if part.member else part.path
    return ValueError(f"{file}: the {what} that begins at byte {offset} is longer than {LARGEST_TEXT} bytes")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def whole_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of small files put together, up to ``BATCH_BYTES``."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > BATCH_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def read_records(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Logical records of CSV files, ZIP archives or folders of them.

    Only records of compressed members move between tasks.
    """
    spark.dataSource.register(TrajectoryRecords)
    options["paths"] = json.dumps([path] if isinstance(path, str) else path)
    options.setdefault("parallelism", spark.sparkContext.defaultParallelism)
    records = spark.read.format("trajectory_records").options(**options).load()
    reader = RecordReader({k: str(v) for k, v in options.items()})
    if any(file.member is not None and file.offset is None for file in reader.files()):
        parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        return records.repartition(parts, "source_file", "block")
    return records


def list_recordings(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """``(path, member, source_file, size, start)`` of every file and member that ``read_records`` reads; ``start`` is where a
    stored member's bytes begin."""
    options["paths"] = json.dumps([path] if isinstance(path, str) else path)
    files = RecordReader({k: str(v) for k, v in options.items()}).files()
    rows = [(f.path, f.member, f.source_file, f.end, f.offset) for f in files]
    return spark.createDataFrame(rows, FILES)


#: Files to read, as ``list_recordings`` and the ledger of a stream have them.
FILES = "path string, member string, source_file string, size bigint, start bigint"


def records_of(files: DataFrame, skip_header: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Logical records, with ``path``, of the files in a DataFrame (``FILES``).

    Ranges are planned from the rows, so no list of paths passes the driver. Files of one source keep their own
    records; ``path`` tells them apart.
    """
    reader = RecordReader({"paths": "[]", "skipheader": str(skip_header)})
    whole = F.col("member").isNotNull() & F.col("start").isNull()
    step = F.lit(int(range_bytes))
    starts = F.when(whole, F.array(F.lit(0).cast("long"))).when(F.col("size") > 0, F.sequence(F.lit(0).cast("long"), F.col("size") - 1, step)).otherwise(F.array().cast("array<bigint>"))
    ranges = files.select("path", "member", "source_file", "size", "start", F.explode(starts).alias("at"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                uncut = row["member"] is not None and row["start"] is None
                end = row["size"] if uncut else min(row["at"] + range_bytes, row["size"])
                part = ByteRange(row["path"], row["member"], row["at"], end, row["source_file"], row["start"], row["size"], min(range_bytes, BATCH_BYTES) if uncut else None)
                for found in reader.read(part):
                    yield found.append_column("path", pa.array([row["path"] if row["member"] is None else f"{row['path']}!{row['member']}"] * len(found), pa.string()))

    spark = files.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Few bytes a row here; the texts are read behind the exchange.
    return ranges.repartition(parts, "path", "member", "at").mapInArrow(read, "source_file string, block bigint, seq bigint, text string, path string")
