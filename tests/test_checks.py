from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F
from samples import SUMMARY_ROW

from tracklane import schemas as S
from tracklane.operators import checks
from tracklane.operators.publish import write_by_source

STAMP = datetime.datetime(2024, 1, 1)
SILVER_ROW = ("sample.csv", 1, "Car", 61.25, 7.35, 37.951204, 23.702816, 6.2051, 0.0734, -0.0412, 0.0, "bronze/x.zip", STAMP)


def ddl(schema):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def silver(spark, **changes):
    row = dict(zip(S.names(S.SILVER), SILVER_ROW)) | changes
    return spark.createDataFrame([tuple(row.values())], ddl(S.SILVER))


def summary(spark, **changes):
    row = dict(zip(S.names(S.SUMMARY), SUMMARY_ROW)) | changes
    return spark.createDataFrame([tuple(row.values())], ddl(S.SUMMARY))


def failed(df, specs):
    return checks.report("x", checks.run_checks(df, specs)).named("failed")


def test_good_data_passes(spark):
    assert failed(silver(spark), checks.frame_checks(1)) == []
    assert failed(summary(spark), checks.summary_checks(1, 100)) == []
    assert failed(summary(spark), checks.serving_checks(1, 100)) == []


@pytest.mark.parametrize(
    ("change", "check"),
    [
        ({"lat": 38.2}, "latitude_in_bounds"),
        ({"lat": float("nan")}, "latitude_in_bounds"),
        ({"lon": 23.5}, "longitude_in_bounds"),
        ({"speed_ms": -0.1}, "speed_non_negative"),
        ({"source_file": ""}, "source_file_populated"),
        ({"bronze_key": ""}, "bronze_key_populated"),
        ({"timestamp_s": None}, "not_null_timestamp_s"),
    ],
)
def test_frame_checks_fail_one_by_one(spark, change, check):
    assert failed(silver(spark, **change), checks.frame_checks()) == [check]


@pytest.mark.parametrize(
    ("change", "check"),
    [
        ({"frame_count": 0}, "frame_count_positive"),
        ({"duration_s": -1.0}, "duration_non_negative"),
        ({"traveled_d_m": -1.0}, "distance_non_negative"),
        ({"min_speed_ms": -1.0}, "speed_non_negative"),
        ({"start_time_s": 9.0}, "time_order"),
    ],
)
def test_summary_and_serving_checks_fail_one_by_one(spark, change, check):
    assert failed(summary(spark, **change), checks.summary_checks()) == [check]
    assert failed(summary(spark, **change), checks.serving_checks()) == [check]


def test_expectations_and_grain(spark):
    twice = summary(spark).unionByName(summary(spark))
    assert failed(twice, checks.summary_checks(1, 100)) == ["expected_row_count", "frames_conserved", "grain_unique"]
    assert failed(twice, checks.serving_checks(1, 100)) == ["grain_unique", "expected_row_count", "expected_frame_sum"]
    assert failed(summary(spark, track_id=None), checks.serving_checks()) == ["grain_not_null"]
    assert checks.duplicate_keys(twice, S.TRACK_KEY).collect() == [("sample.csv", 1, 2)]


def test_empty_data_fails_once_and_skips_the_rest(spark):
    report = checks.report("x", checks.run_checks(silver(spark).limit(0), checks.frame_checks()))
    assert report.named("failed") == ["row_count_positive", "source_files_present"]
    assert "latitude_in_bounds" in report.named("skipped") and not report.passed


def test_nan_measures_only_warn(spark):
    report = checks.report("x", checks.run_checks(silver(spark, lon_acc_ms2=float("nan")), checks.frame_checks()))
    assert report.passed and report.named("warning") == ["nan_lon_acc_ms2"] and "PASSED" in report.summary()


def test_all_row_checks_share_one_scan(spark, tmp_path):
    silver(spark).write.parquet(str(tmp_path / "s"))
    specs = [c for c in checks.frame_checks() if c.name != "source_files_present"]
    plan = checks.run_checks(spark.read.parquet(str(tmp_path / "s")), specs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_stored_layers(spark, tmp_path):
    path = str(tmp_path / "gold")
    write_by_source(summary(spark), path)
    assert checks.validate_dataset(spark, path, S.SUMMARY, checks.summary_checks()).passed
    numeric = str(tmp_path / "numeric")
    write_by_source(summary(spark, source_file="0012"), numeric)
    assert checks.validate_dataset(spark, numeric, S.SUMMARY, checks.summary_checks()).passed
    wrong = str(tmp_path / "wrong")
    summary(spark).drop("end_lon").withColumn("track_id", F.col("track_id").cast("long")).write.parquet(wrong)
    report = checks.validate_dataset(spark, wrong, S.SUMMARY, checks.summary_checks())
    assert report.named("failed") == ["schema_names", "schema_types"] and report.named("skipped") == ["not_null_end_lon"]
    missing = checks.validate_dataset(spark, str(tmp_path / "none"), S.SUMMARY, checks.summary_checks())
    assert missing.named("failed") == ["readable"] and len(missing.named("skipped")) == len(checks.summary_checks())


def test_frames_conserved(spark):
    frames = silver(spark).unionByName(silver(spark, lat=None))
    ok = checks.check_frames_conserved(frames, summary(spark, frame_count=1)).first()
    assert (ok.status, ok.detail) == ("passed", "1 frames without a required value")
    assert checks.check_frames_conserved(frames, summary(spark, frame_count=2)).first().status == "failed"


def test_reject_gate(spark):
    counts = spark.createDataFrame([(99, 1), (98, 2)], "record_count bigint, rejected_count bigint")
    assert [r.status for r in checks.check_rejects(counts).collect()] == ["passed", "failed"]


def test_published_scope(spark):
    other = summary(spark, source_file="other.csv")
    serving = summary(spark).unionByName(other)
    assert {r.status for r in checks.check_published(serving, summary(spark)).collect()} == {"passed"}
    changed = checks.check_published(serving, summary(spark, frame_count=7)).collect()
    assert [r.check for r in changed if r.status == "failed"] == ["serving_frames_eq_summary"]
    none = checks.check_published(other, summary(spark)).collect()
    assert none[0].status == "failed"
    assert checks.check_same_row_count("n", serving, serving).first().status == "passed"


def test_layers_have_column_checks(spark):
    assert len([c for c in checks.column_checks("staging") if c.name.startswith("not_null")]) == 12
    assert failed(summary(spark, vehicle_type="tram"), checks.column_checks("fact")) == ["accepted_vehicle_type"]
    with pytest.raises(ValueError):
        checks.column_checks("other")


def test_keys_are_compared_by_narrow_rows(spark):
    rows = [("a", 1, 1.0), ("a", 1, 2.0), ("a", 1, 3.0), ("b", 1, 1.0), (None, 1, 1.0), (None, 1, 1.0), ("c", None, 1.0)]
    df = spark.createDataFrame(rows, "source_file string, track_id int, lat double")
    found = {r["check"]: (r["status"], r["observed"]) for r in checks.run_checks(df, [checks.unique("pair", "source_file", "track_id"), checks.unique("one", "track_id"), *checks.not_null("lat")]).collect()}
    assert found == {"pair": ("failed", 2.0), "one": ("failed", 5.0), "not_null_lat": ("passed", 0.0)}
    plan = checks.run_checks(df, [checks.unique("pair", "source_file", "track_id")])._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Aggregate [h" in plan
    assert {r["status"] for r in checks.run_checks(df.limit(0), [checks.unique("pair", "track_id")]).collect()} == {"skipped"}
