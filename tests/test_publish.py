from __future__ import annotations

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F
from samples import HEADER, two_frames
from test_parity import rows

from tracklane import schemas as S
from tracklane.operators import publish, runs, versions
from tracklane.operators.frames import frames_of, parse_records
from tracklane.plans.loads import load_new_files, load_recordings
from tracklane.sources.files import read_layer
from tracklane.sources.records import read_records
from tracklane.streaming.ingest import stream_recordings


def tracks(spark, path):
    return sorted((r.source_file, r.track_id) for r in read_layer(spark, path, S.SUMMARY).collect())


def batch(spark, **sources):
    return rows(spark, *[{"source_file": f"{name}.csv", "track_id": t} for name, ids in sources.items() for t in ids])


def test_sources_are_replaced_one_by_one(spark, tmp_path):
    target = str(tmp_path / "serving")
    first = publish.publish(spark, batch(spark, A=[1, 2], B=[1, 2, 3]), target, "r1")
    assert (first.status, first.staged, first.rows, first.frames, first.kept) == ("success", (5, 500), 5, 500, None)
    publish.publish(spark, batch(spark, A=[1, 2], B=[1, 2, 3]), target, "r2")
    assert len(tracks(spark, target)) == 5
    publish.publish(spark, batch(spark, A=[10, 11, 12]), target, "r3")
    assert tracks(spark, target) == [("A.csv", 10), ("A.csv", 11), ("A.csv", 12), ("B.csv", 1), ("B.csv", 2), ("B.csv", 3)]
    publish.publish(spark, batch(spark, C=[1]), target, "r4", publish.REPLACE_SNAPSHOT)
    assert tracks(spark, target) == [("C.csv", 1)]


def test_failed_checks_leave_the_target_alone(spark, tmp_path):
    target = str(tmp_path / "serving")
    publish.publish(spark, batch(spark, A=[1]), target, "good")
    bad = publish.publish(spark, batch(spark, A=[1, 1]), target, "bad")
    assert bad.status == "failed" and bad.checks.named("failed") == ["grain_unique"]
    assert bad.kept.endswith("_bad") and os.path.exists(bad.kept) and tracks(spark, target) == [("A.csv", 1)]
    short = publish.publish(spark, batch(spark, A=[1]), target, "short", expected_row_count=2, expected_frame_sum=100)
    assert short.checks.named("failed") == ["expected_row_count"]
    empty = publish.publish(spark, batch(spark, A=[1]).limit(0), target, "empty")
    assert empty.status == "failed" and tracks(spark, target) == [("A.csv", 1)]


def test_bad_arguments(spark, tmp_path):
    for options in ({"mode": "append"}, {"rows_per_file": 0}, {"run_id": "a-b; drop"}):
        with pytest.raises(ValueError):
            publish.publish(spark, batch(spark, A=[1]), str(tmp_path / "t"), **({"run_id": "r"} | options))
    with pytest.raises(ValueError):
        publish.create_table_ddl("bad name; --")
    with pytest.raises(ValueError):
        publish.materialise(batch(spark, A=[1]), "x", "index")


def test_replacement_without_storage(spark):
    got = publish.replace_sources(batch(spark, A=[1], B=[1]), batch(spark, A=[5])).collect()
    assert sorted((r.source_file, r.track_id) for r in got) == [("A.csv", 5), ("B.csv", 1)]


def test_json_footprint_and_ddl(spark, tmp_path):
    summary = batch(spark, A=[1, 2])
    publish.export_json(summary, str(tmp_path / "json"))
    lines = [line for f in (tmp_path / "json").glob("*.json") for line in f.read_text().splitlines()]
    assert sorted(json.loads(line)["track_id"] for line in lines) == [1, 2]
    result = publish.write_summary(spark, summary, str(tmp_path / "gold"))
    assert (result.status, result.trajectories, result.frames) == ("success", 2, 200)
    got = publish.storage_footprint(spark, str(tmp_path / "gold"), 1000).first()
    assert got.row_count == 2 and got.bytes_per_row == got.total_bytes / 2 and got.projected_bytes == got.total_bytes * 500
    ddl = publish.create_table_ddl("serving_summary", path=str(tmp_path / "gold"))
    assert ddl.index("source_file") < ddl.index("end_lon") and "PARTITIONED BY (source_file)" in ddl
    assert publish.published_sources(summary).collect() == [("A.csv",)]
    merged = str(tmp_path / "merged")
    publish.write_by_source(summary.repartition(4), merged, partitions=1)
    assert len(list((tmp_path / "merged").rglob("*.parquet"))) == 1
    assert publish.write_summary(spark, summary.limit(0), str(tmp_path / "none")).status == "failed"


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert runs.read_runs(spark, path).count() == 0
    start = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    shape = "source_file string, file_hash string, rows_loaded bigint, rows_rejected bigint"
    for hours, name, status in [(0, "a", "failed"), (1, "a", "success"), (30, "b", "failed"), (31, "c", "failed")]:
        at = start + datetime.timedelta(hours=hours)
        one = spark.createDataFrame([(name, "h", 1, 0)], shape)
        runs.append_runs(runs.run_rows(one, status, at, at + datetime.timedelta(seconds=1.23456), "d", "t"), path)
    log = runs.read_runs(spark, path)
    assert log.count() == 4 and {r.duration_s for r in log.collect()} == {1.235}
    as_of = F.lit(start + datetime.timedelta(hours=54, minutes=30))
    assert sorted(r.source_file for r in runs.failed_without_rerun(log, as_of).collect()) == ["c"]
    assert runs.failed_without_rerun(log).count() == 0
    with pytest.raises(ValueError):
        runs.run_rows(one, "odd", start, start, "d", "t")


def write_recording(path, *numbers):
    path.write_bytes(("﻿" + "\r\n".join([HEADER, *[two_frames(n) for n in numbers]]) + "\r\n").encode())


def test_new_and_changed_files_are_loaded_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    raw, log = str(tmp_path / "raw"), str(tmp_path / "runs")
    write_recording(folder / "a.csv", 1, 2)
    write_recording(folder / "b.csv", 1)

    def load():
        got = load_new_files(spark, str(folder), raw, log)
        return sorted((r.source_file, r.status, r.rows_loaded, r.rows_rejected) for r in got.collect())

    def frames():
        return {r.source_file: r["count"] for r in read_layer(spark, raw, S.RAW).groupBy("source_file").count().collect()}

    assert load() == [("a.csv", "success", 4, 0), ("b.csv", "success", 2, 0)]
    assert load() == [("a.csv", "skipped", 0, 0), ("b.csv", "skipped", 0, 0)]
    write_recording(folder / "b.csv", 5, 6, 7)
    assert load() == [("a.csv", "skipped", 0, 0), ("b.csv", "success", 6, 0)]
    assert frames() == {"a.csv": 4, "b.csv": 6}
    (folder / "b.csv").write_text(f"{HEADER}\n1; Car; 1\n")
    assert load() == [("a.csv", "skipped", 0, 0), ("b.csv", "success", 0, 1)]
    assert frames() == {"a.csv": 4} and runs.read_runs(spark, log).count() == 8


def test_failed_load_is_logged(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    write_recording(folder / "a.csv", 1)
    log = str(tmp_path / "runs")
    monkeypatch.setattr(publish, "write_by_source", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("disk full")))
    with pytest.raises(RuntimeError):
        load_new_files(spark, str(folder), str(tmp_path / "raw"), log)
    got = runs.read_runs(spark, log).collect()
    assert [(r.status, r.error_message) for r in got] == [("failed", "disk full")]


def test_recordings_end_to_end(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write_recording(folder / "a.csv", *range(1, 121))
    with (folder / "a.csv").open("a") as f:
        f.write("500; Car; 1; 2; 3;\n")
    result = load_recordings(spark, str(folder), str(tmp_path / "layers"), str(tmp_path / "serving"), "run1")
    assert result.status == "success" and (result.silver.frames, result.silver.records, result.silver.rejected) == (240, 120, 1)
    assert (result.published.rows, result.published.frames) == (120, 240)
    rejects = read_layer(spark, result.silver.rejects_path, S.REJECT).collect()
    assert [(r.track_id, r.reason_code, r.record_no) for r in rejects] == [("500", "too_few_fields", 121)]
    again = load_recordings(spark, str(folder), str(tmp_path / "layers"), str(tmp_path / "serving"), "run2")
    assert again.published.rows == 120
    (folder / "b.csv").write_text(f"{HEADER}\n{two_frames(1)}\n2; Car; 1\n")
    gated = load_recordings(spark, str(folder / "b.csv"), str(tmp_path / "layers2"), str(tmp_path / "serving"), "run3")
    assert gated.status == "failed" and gated.published is None
    (folder / "c.csv").write_text(f"{HEADER}\n")
    plan = frames_of(parse_records(read_records(spark, str(folder))))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    empty = load_recordings(spark, str(folder / "c.csv"), str(tmp_path / "layers3"), str(tmp_path / "serving"), "run4")
    assert empty.status == "failed" and empty.silver.frames == 0


def test_a_batch_that_fails_its_gate_never_reaches_serving(spark, tmp_path):
    layers, serving = str(tmp_path / "layers"), str(tmp_path / "serving")
    bad, good = tmp_path / "bad", tmp_path / "good"
    bad.mkdir()
    good.mkdir()
    (bad / "x.csv").write_text(f"{HEADER}\n{two_frames(1)}\n" + "2; Car; 1\n" * 50)
    write_recording(good / "y.csv", 3, 4)
    assert load_recordings(spark, str(bad), layers, serving, "r1").status == "failed"
    assert load_recordings(spark, str(good), layers, serving, "r2").status == "success"
    assert tracks(spark, serving) == [("y.csv", 3), ("y.csv", 4)]
    assert {r.source_file for r in read_layer(spark, f"{layers}/silver", S.SILVER).select("source_file").collect()} == {"y.csv"}


def test_a_source_without_valid_records_loses_its_old_rows(spark, tmp_path):
    layers, serving, folder = str(tmp_path / "layers"), str(tmp_path / "serving"), tmp_path / "in"
    folder.mkdir()
    write_recording(folder / "a.csv", 1, 2)
    write_recording(folder / "b.csv", *range(1, 301))
    assert load_recordings(spark, str(folder), layers, serving, "r1").published.rows == 302
    (folder / "a.csv").write_text(f"{HEADER}\n2; Car; 1\n")
    assert load_recordings(spark, str(folder), layers, serving, "r2").status == "success"
    for layer in (f"{layers}/summary", serving):
        assert {name for name, _ in tracks(spark, layer)} == {"b.csv"}


def test_a_source_that_now_has_a_header_only_loses_its_old_rows(spark, tmp_path):
    layers, serving, folder = str(tmp_path / "layers"), str(tmp_path / "serving"), tmp_path / "in"
    folder.mkdir()
    write_recording(folder / "a.csv", 1, 2)
    write_recording(folder / "b.csv", 1)
    assert load_recordings(spark, str(folder), layers, serving, "r1").status == "success"
    (folder / "a.csv").write_text(f"{HEADER}\n")
    assert load_recordings(spark, str(folder), layers, serving, "r2").status == "success"
    for layer in (f"{layers}/summary", serving):
        assert tracks(spark, layer) == [("b.csv", 1)]
    assert {r.source_file for r in read_layer(spark, f"{layers}/silver", S.SILVER).collect()} == {"b.csv"}


def test_readers_see_a_publish_whole(spark, tmp_path):
    target = str(tmp_path / "serving")
    publish.publish(spark, batch(spark, A=[1], B=[1]), target, "r1")
    before = read_layer(spark, target, S.SUMMARY)
    store, dataset = versions.store_of(spark, target)
    staged = publish.stage_batch(spark, batch(spark, A=[5], C=[1]), target, "r2")
    assert tracks(spark, target) == [("A.csv", 1), ("B.csv", 1)]
    gone = spark.createDataFrame([("B.csv",)], "source_file string")
    assert versions.commit(spark, store, 1, {dataset: (staged.version, staged.folder)}, gone) == 2
    assert tracks(spark, target) == [("A.csv", 5), ("C.csv", 1)]
    assert before.count() == 2  # a reader that had begun goes on with its state
    assert [r.track_id for r in versions.read(spark, target, S.SUMMARY, 1).orderBy("source_file").collect()] == [1, 1]
    with pytest.raises(versions.StaleState):
        versions.commit(spark, store, 1, {dataset: (staged.version, staged.folder)})


def test_old_versions_go(spark, tmp_path):
    target = str(tmp_path / "serving")
    for n in range(6):
        publish.publish(spark, batch(spark, A=[n], **({"B": [7]} if n == 0 else {})), target, f"r{n}")
    assert tracks(spark, target) == [("A.csv", 5), ("B.csv", 7)]
    left = sorted(name.split("_")[-1] for name in os.listdir(target) if name.startswith("version="))
    assert left == ["r0", "r3", "r4", "r5"]  # the first one still holds B


def streamed(spark, tmp_path, **options):
    layers, serving = str(tmp_path / "layers"), str(tmp_path / "serving")
    stream_recordings(spark, str(tmp_path / "in"), layers, serving, str(tmp_path / "checkpoint"), **options).awaitTermination()
    return tracks(spark, serving)


def test_stream_rebuilds_sources_from_all_their_files(spark, tmp_path):
    (tmp_path / "in" / "day1").mkdir(parents=True)
    (tmp_path / "in" / "day2").mkdir()
    write_recording(tmp_path / "in" / "day1" / "a.csv", 1, 2)
    assert streamed(spark, tmp_path) == [("a.csv", 1), ("a.csv", 2)]
    write_recording(tmp_path / "in" / "day2" / "b.csv", 9)
    write_recording(tmp_path / "in" / "day2" / "a.csv", 3)
    write_recording(tmp_path / "in" / "day2" / "c.csv")
    want = [("a.csv", 1), ("a.csv", 2), ("a.csv", 3), ("b.csv", 9)]
    assert streamed(spark, tmp_path) == want
    (tmp_path / "in" / "day3").mkdir()
    write_recording(tmp_path / "in" / "day3" / "a.csv", 3)  # what the source already has
    assert streamed(spark, tmp_path) == want
    ledger = read_layer(spark, str(tmp_path / "layers" / "ledger"), S.LEDGER).collect()
    assert sorted((r.source_file, r.path.split("/")[-2]) for r in ledger) == [("a.csv", "day1"), ("a.csv", "day2"), ("b.csv", "day2"), ("c.csv", "day2")]


def test_stream_keeps_rejects_and_its_gate(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([HEADER, two_frames(1), "2; Car; 1", two_frames(3)]))
    assert streamed(spark, tmp_path, max_reject_fraction=0.5) == [("a.csv", 1), ("a.csv", 3)]
    (rejected,) = read_layer(spark, str(tmp_path / "layers" / "rejects"), S.REJECT).collect()
    assert (rejected.source_file, rejected.record_no, rejected.track_id, rejected.reason_code) == ("a.csv", 2, "2", "too_few_fields")
    assert rejected.path.endswith("/in/a.csv")
    write_recording(folder / "good.csv", *range(1, 50))
    (folder / "bad.csv").write_text(f"{HEADER}\n2; Car; 1\n")
    with pytest.raises(Exception, match="100% of one file"):
        streamed(spark, tmp_path, max_reject_fraction=0.5)
    assert tracks(spark, str(tmp_path / "serving")) == [("a.csv", 1), ("a.csv", 3)]
    assert read_layer(spark, str(tmp_path / "layers" / "rejects"), S.REJECT).count() == 1


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write_recording(folder / "a.csv", 1, 2)
    assert streamed(spark, tmp_path) == [("a.csv", 1), ("a.csv", 2)]
    store = str(tmp_path / "layers")
    stream_recordings(spark, str(folder), store, str(tmp_path / "serving"), str(tmp_path / "lost_checkpoint")).awaitTermination()
    assert versions.state(spark, store) == 1 and len(tracks(spark, str(tmp_path / "serving"))) == 2


def test_many_small_sources_share_files(spark, tmp_path):
    """A version has files by size, not a folder for every source; versions that have folders are read beside it."""
    target = str(tmp_path / "serving")
    store, dataset = versions.register(spark, target, target, "rows")
    version, folder = versions.version_folder(spark, target, "old")
    publish.write_by_source(batch(spark, A=[1], old=[1]), folder, publish.REPLACE_SNAPSHOT)
    versions.commit(spark, store, 0, {dataset: (version, folder)})
    names = [f"s{k}" for k in range(40)]
    done = publish.publish(spark, batch(spark, A=[2], **{name: [1, 2] for name in names}), target, "new")
    assert (done.status, done.rows) == ("success", 81)
    assert tracks(spark, target) == sorted([("A.csv", 2), ("old.csv", 1), *[(f"{name}.csv", t) for name in names for t in (1, 2)]])
    made = [f for path, _, files in os.walk(target) if "_new" in path for f in files if f.endswith(".parquet")]
    assert len(made) < 10


def test_files_of_a_run_are_one_batch(spark, tmp_path):
    """More files than a batch held before: sources are rebuilt once for all of them."""
    folder = tmp_path / "in"
    for k in range(1002):
        (folder / str(k)).mkdir(parents=True)
        write_recording(folder / str(k) / "a.csv", k)
    assert streamed(spark, tmp_path) == [("a.csv", k) for k in range(1002)]
    assert versions.state(spark, str(tmp_path / "layers")) == 1
