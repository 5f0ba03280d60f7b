from __future__ import annotations

import hashlib
import zipfile

import pytest
from pyspark.sql import functions as F
from samples import HEADER, two_frames

from tracklane import schemas as S
from tracklane.operators.frames import frames_of, parse_records
from tracklane.operators.records import assemble_records, number_records
from tracklane.sources.archive import list_archive_members, read_archive_lines
from tracklane.sources.files import dataset_metrics, discover_files, hash_files, read_lines, read_source, register_sources
from tracklane.sources.records import RecordReader, list_recordings, read_records, records_of


@pytest.fixture
def archive(tmp_path):
    path = tmp_path / "recordings.zip"
    body = "\r\n".join([HEADER, two_frames(1), two_frames(2)])
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("deep/a.CSV", "﻿" + body)
        z.writestr("b.csv", body)
        z.writestr("__MACOSX/b.csv", "junk")
        z.writestr("deep/.hidden.csv", "junk")
        z.writestr("readme.txt", "junk")
    return str(path)


def test_archive_members(spark, archive):
    rows = list_archive_members(spark, archive).collect()
    assert {r.member for r in rows if r.eligible} == {"deep/a.CSV", "b.csv"} and len(rows) == 5
    assert all(r.size > 0 and r.compressed_size > 0 for r in rows)


def test_archive_lines(spark, archive):
    lines = read_archive_lines(spark, archive)
    assert lines.groupBy("source_file").count().collect().__len__() == 2
    assert lines.filter("pos = 0").select("line").distinct().collect() == [(HEADER,)]
    assert read_archive_lines(spark, archive, members="first").count() == 3


def test_archive_records(spark, archive):
    assert read_records(spark, archive).groupBy("source_file").count().collect().__len__() == 2
    assert read_records(spark, archive, members="first").count() == 2
    assert read_records(spark, archive, rowLimit=1).count() == 2


def test_bad_archives(spark, tmp_path):
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    with pytest.raises(Exception, match="not a readable ZIP"):
        read_records(spark, str(tmp_path / "bad.zip")).count()
    with zipfile.ZipFile(tmp_path / "empty.zip", "w") as z:
        z.writestr("x.txt", "x")
    with pytest.raises(Exception, match="no CSV member"):
        read_records(spark, str(tmp_path / "empty.zip")).count()


def test_discovery_and_hashes(spark, tmp_path):
    for name in ("b.csv", "a.csv", "c.txt"):
        (tmp_path / name).write_text(name)
    files = discover_files(spark, str(tmp_path))
    assert [r.source_file for r in files.collect()] == ["a.csv", "b.csv"]
    hashes = {r.source_file: r.file_hash for r in hash_files(files).collect()}
    assert hashes["a.csv"] == hashlib.sha256(b"a.csv").hexdigest()
    assert discover_files(spark, str(tmp_path / "missing")).count() == 0


def test_named_sources_and_metrics(spark):
    rows = [("a", 1, 5), ("a", 2, 7), ("b", 1, 1)]
    df = spark.createDataFrame(rows, "source_file string, track_id int, frame_count bigint")
    register_sources(spark, {"raw.things": df})
    got = dataset_metrics(read_source(spark, "raw.things"), S.TRACK_KEY, "frame_count").first()
    assert tuple(got) == (3, 2, 3, 13)
    assert tuple(dataset_metrics(df.limit(0), S.TRACK_KEY, "frame_count").first()) == (0, 0, 0, 0)


def test_urls(spark):
    from tracklane.functions.urls import object_name, safe_url

    urls = {
        "https://x.com/records/1/file/dataset.zip?download=1": ("dataset.zip", "https://x.com/records/1/file/dataset.zip"),
        "HTTPS://User:pw@X.com:8443/a/b/?q=/z#f": ("b", "https://x.com/a/b/"),
        "https://x.com": (None, "https://x.com"),
        "https://x.com/": (None, "https://x.com/"),
        "s3://bucket/key.zip": ("key.zip", "s3://bucket/key.zip"),
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = {r.u: (r.n, r.s) for r in df.select("u", object_name(F.col("u")).alias("n"), safe_url(F.col("u")).alias("s")).collect()}
    assert got == urls


def test_files_of_one_name(spark, tmp_path):
    for folder, tracks in (("a", (1, 2)), ("b/deep", (3,)), ("_old", (9,))):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "rec 1+.csv").write_text("\r\n".join([HEADER, *map(two_frames, tracks)]) + "\r\n")
    with zipfile.ZipFile(tmp_path / "in" / "z.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for folder, track in (("x", 5), ("y", 6)):
            z.writestr(f"{folder}/rec.csv", f"{HEADER}\n{two_frames(track)}\n")
    source, archive = str(tmp_path / "in"), str(tmp_path / "in" / "z.zip")

    def found(records):
        return sorted((r.source_file, r.track_id) for r in frames_of(parse_records(records)).select("source_file", "track_id").distinct().collect())

    plain = [("a/rec 1+.csv", 1), ("a/rec 1+.csv", 2), ("b/deep/rec 1+.csv", 3)]
    members = [("x/rec.csv", 5), ("y/rec.csv", 6)]
    assert found(read_records(spark, source, label="path")) == plain + [(f"z.zip/{m}", t) for m, t in members]
    assert found(read_records(spark, archive, label="path")) == members
    assert found(assemble_records(read_archive_lines(spark, archive, label="path"))) == members
    assert found(assemble_records(read_lines(spark, str(tmp_path / "in" / "b"), "path"))) == [("deep/rec 1+.csv", 3)]
    lines = read_lines(spark, source, "path").where("source_file LIKE '%.csv'")
    assert found(assemble_records(lines)) == plain
    for read in (lambda: read_records(spark, source).count(), lambda: read_archive_lines(spark, archive).count(), lambda: read_lines(spark, source)):
        with pytest.raises(Exception, match="two files are called"):
            read()
    for read in (lambda: read_records(spark, source + "/none").count(), lambda: read_lines(spark, source + "/none").count()):
        with pytest.raises(Exception, match="no such file or folder|PATH_NOT_FOUND"):
            read()


@pytest.mark.parametrize("packing", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_one_member_is_parsed_by_many_tasks(spark, tmp_path, packing):
    with zipfile.ZipFile(tmp_path / "one.zip", "w", packing) as z:
        z.writestr("first.txt", "x" * 1000)
        z.writestr("rec.csv", "\n".join([HEADER, "lost line", *map(two_frames, range(1, 301))]))
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "rec.csv").write_text("\n".join([HEADER, "lost line", *map(two_frames, range(1, 301))]))
    records = read_records(spark, str(tmp_path / "one.zip"), rangeBytes=2000)
    assert records.select(F.spark_partition_id()).distinct().count() > 1
    want = sorted(map(tuple, read_records(spark, str(tmp_path / "plain")).select("source_file", "text").collect()), key=str)
    assert sorted(map(tuple, records.select("source_file", "text").collect()), key=str) == want and len(want) == 301
    numbers = number_records(records).select("record_no").collect()
    assert sorted(r.record_no for r in numbers) == list(range(1, 302))


def test_records_of_listed_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([HEADER, *map(two_frames, range(1, 101))]))
    (folder / "empty.csv").write_text("")
    with zipfile.ZipFile(folder / "z.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("b.csv", "\n".join([HEADER, *map(two_frames, range(1, 101))]))
    files = list_recordings(spark, str(folder))
    assert sorted(r.source_file for r in files.collect()) == ["a.csv", "b.csv", "empty.csv"]
    want = sorted(map(tuple, read_records(spark, str(folder)).select("source_file", "text").collect()))
    got = records_of(files, range_bytes=700)
    assert sorted(map(tuple, got.select("source_file", "text").collect())) == want and len(want) == 200
    assert {r.path.rsplit("/", 1)[-1] for r in got.select("path").distinct().collect()} == {"a.csv", "z.zip!b.csv"}


def test_small_files_share_tasks(spark, tmp_path):
    """Many small files and members: few partitions, and every record once."""
    folder = tmp_path / "many"
    for k in range(120):
        (folder / f"d{k}").mkdir(parents=True)
        (folder / f"d{k}" / "a.csv").write_text("\n".join([HEADER, two_frames(k), two_frames(1000 + k)]))
    reader = RecordReader({"path": str(folder), "label": "path", "parallelism": "4"})
    assert len(reader.partitions()) < 12
    found = read_records(spark, str(folder), label="path").select("source_file", "block", "seq", "text").collect()
    assert sorted((r.source_file, r.block, r.seq, r.text) for r in found) == sorted(
        (f"d{k}/a.csv", 0, n + 1, two_frames(1000 * n + k)) for k in range(120) for n in (0, 1)
    )


@pytest.mark.parametrize("packing", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_small_archives_share_tasks(spark, tmp_path, packing):
    folder = tmp_path / "archives"
    folder.mkdir()
    for k in range(60):
        with zipfile.ZipFile(folder / f"{k}.zip", "w", packing) as made:
            for m in range(2):
                made.writestr(f"m{m}/a.csv", "\n".join([HEADER, two_frames(2 * k + m)]))
    want = sorted((f"{k}.zip/m{m}/a.csv", two_frames(2 * k + m)) for k in range(60) for m in range(2))
    records = read_records(spark, str(folder), label="path")
    assert sorted((r.source_file, r.text) for r in records.collect()) == want
    lines = read_archive_lines(spark, str(folder), label="path")
    assert sorted((r.source_file, r.line) for r in lines.where("pos = 1").collect()) == want
    assert lines.count() == 240
    members = list_archive_members(spark, str(folder))
    assert members.count() == 120 and members.where("eligible").select("archive").distinct().count() == 60
    assert max(lines.rdd.getNumPartitions(), members.rdd.getNumPartitions()) < 20
