from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from samples import SUMMARY_ROW
from test_checks import ddl

from tracklane import schemas as S
from tracklane.operators.parity import compare, missing_keys, parity_report, parity_totals, repeated_keys, shared_keys


def rows(spark, *changes):
    base = dict(zip(S.names(S.SUMMARY), SUMMARY_ROW))
    return spark.createDataFrame([tuple((base | c).values()) for c in changes], ddl(S.SUMMARY))


def kinds(left, right, **options):
    return sorted((r.kind, r.field) for r in compare(left, right, **options).collect())


def test_equal_sides_pass(spark):
    assert parity_report(rows(spark, {}), rows(spark, {})).passed


@pytest.mark.parametrize(
    ("change", "expected"),
    [
        ({"duration_s": 4.0 + 5e-7}, []),
        ({"duration_s": 4.01}, [("mismatch", "duration_s")]),
        ({"vehicle_type": "bus"}, [("mismatch", "vehicle_type")]),
        ({"frame_count": 101}, [("mismatch", "frame_count")]),
        ({"max_speed_ms": None}, [("mismatch", "max_speed_ms")]),
    ],
)
def test_single_changes(spark, change, expected):
    assert kinds(rows(spark, {}), rows(spark, change)) == expected
    assert kinds(rows(spark, change), rows(spark, {})) == expected


def test_nulls_nans_and_types(spark):
    assert kinds(rows(spark, {"end_lat": None}), rows(spark, {"end_lat": None})) == []
    nan = {"end_lat": float("nan")}
    assert kinds(rows(spark, nan), rows(spark, nan)) == [("mismatch", "end_lat")]
    as_double = rows(spark, {}).withColumn("frame_count", F.col("frame_count").cast("double"))
    assert kinds(rows(spark, {}), as_double) == []
    text = rows(spark, {}).selectExpr("* except (end_lat)", "'north' as end_lat")
    assert kinds(rows(spark, {}), text) == [("mismatch", "end_lat")]
    assert kinds(rows(spark, {}), rows(spark, {}).drop("end_lat")) == [("mismatch", "end_lat")]


def test_keys(spark):
    left, right = rows(spark, {}, {"track_id": 2}), rows(spark, {}, {"source_file": "z.csv"})
    assert kinds(left, right) == [("missing_in_left", None), ("missing_in_right", None)]
    report = parity_report(left, right)
    assert not report.passed and report.totals["compared_keys"] == 1
    assert (report.missing_in_right, report.missing_in_left) == ([("sample.csv", 2)], [("z.csv", 1)])
    assert "FAILED" in report.summary()
    assert missing_keys(left, right).collect() == [("sample.csv", 2)]
    assert shared_keys(left, right).collect() == [("sample.csv", 1)]
    with pytest.raises(ValueError, match="duplicate key on the right"):
        parity_report(left, right.unionByName(right))
    for compared in (compare(right, left.unionByName(left)), parity_totals(left.unionByName(left), right), compare(right, left.unionByName(left).filter("track_id = 2"))):
        with pytest.raises(Exception, match="duplicate key on the (left|right) side: sample.csv, "):
            compared.collect()
    assert [tuple(r) for r in repeated_keys(left.unionByName(left).unionByName(left), right).orderBy("track_id").collect()] == [("sample.csv", 1, "left", 3), ("sample.csv", 2, "left", 3)]
    plan = parity_totals(left, right)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") <= 2 * 2  # once in the initial, once in the final plan


def test_options(spark):
    assert kinds(rows(spark, {}), rows(spark, {"duration_s": 4.001}), tolerance=1e-2) == []
    assert kinds(rows(spark, {}), rows(spark, {"duration_s": 9.0, "end_lat": 1.0}), fields=["end_lat"]) == [("mismatch", "end_lat")]
    assert kinds(rows(spark, {}), rows(spark, {"end_lat": 1.0}), exact=[], floats=[], fields=["end_lat"]) == [("unclassified", "end_lat")]


def test_report_is_capped_and_ordered(spark):
    many = [{"track_id": i} for i in range(30)]
    report = parity_report(rows(spark, *many), rows(spark, *[c | {"frame_count": 1} for c in many]))
    assert report.totals["field_mismatches"] == 30 and len(report.mismatches) == 20
    assert [r.track_id for r in report.mismatches] == list(range(20))
