from __future__ import annotations

import datetime
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tracklane import schemas as S
from tracklane.functions.numbers import round_half_up, to_number
from tracklane.operators.staging import frame_steps, stage_frames, stage_runs
from tracklane.operators.summary import summarise_trajectories, summary_source
from tracklane.plans import marts

FRAMES = [
    ("a.csv", 1, " Car ", 10.0, 3.0, 37.9000004, 23.6, 1.00005, -2.0, 0.5, 0.0),
    ("a.csv", 1, " Car ", 10.0, 3.0, 37.95, 23.7, 5.0, 1.0, -0.75, 0.04),
    ("a.csv", 1, " Car ", 10.0, 3.0, 37.96, 23.8, 3.0, 1.0, 0.25, 0.08),
    ("b.csv", 1, "BUS", 20.0, 4.0, 38.0, 23.6, 2.0, 0.0, 0.0, 5.0),
    ("b.csv", 1, None, 20.0, 4.0, 38.0, 23.6, 2.0, 0.0, 0.0, 1.0),
]
DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.FRAME.fields)


def test_summary_row(spark):
    got = {r.source_file: r for r in summarise_trajectories(spark.createDataFrame(FRAMES, DDL)).collect()}
    assert tuple(got["a.csv"]) == (
        "a.csv", 1, "car", 3, 0.0, 0.08, 0.08, 10.0, 3.0, 5.0, 1.0001, 0.0, 0.0, 2.0, 0.75, 37.9, 23.6, 37.96, 23.8,
    )
    assert (got["b.csv"].frame_count, got["b.csv"].duration_s, got["b.csv"].vehicle_type) == (1, 0.0, "bus")


def test_ties_on_time_use_position(spark):
    rows = [("a", 1, "car", 1.0, 1.0, lat, lon, 1.0, 0.0, 0.0, 7.0) for lat, lon in [(38.0, 23.7), (37.9, 23.9), (37.9, 23.8), (38.0, 23.6)]]
    got = summarise_trajectories(spark.createDataFrame(rows, DDL)).first()
    assert (got.start_lat, got.start_lon, got.end_lat, got.end_lon) == (37.9, 23.8, 38.0, 23.7)


def test_summary_has_one_exchange_and_reads_only_its_columns(spark, tmp_path):
    spark.createDataFrame(FRAMES, DDL).withColumn("unused", F.lit("x")).write.parquet(str(tmp_path / "f"))
    plan = summarise_trajectories(spark.read.parquet(str(tmp_path / "f")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "unused" not in plan and "Window" not in plan


def test_rounding_equals_the_decimal_rule(spark):
    rng = random.Random(3)
    values = [rng.uniform(-60, 60) for _ in range(3000)] + [round(rng.uniform(-60, 60), 5) for _ in range(3000)]
    values += [11.22135, -11.22135, 0.00005, -0.00005, 3.6186499999999997, 1e15, 0.0, 37.9000005, 1e-12]
    df = spark.createDataFrame([(v,) for v in values], "v double")

    def expected(v: float, places: int) -> float:
        cut = Decimal(repr(v)).quantize(Decimal("1e-8"), ROUND_HALF_UP)
        return float(cut.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))

    for places in (4, 6):
        got = df.select("v", round_half_up(F.col("v"), places).alias("r")).collect()
        assert [(r.v, r.r) for r in got if r.r != expected(r.v, places)] == []
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (1e300,)], "v double")
    nan, inf, none, huge = [r.r for r in odd.select(round_half_up(F.col("v"), 4).alias("r")).collect()]
    assert nan != nan and inf == float("inf") and none is None and huge == 1e300


def test_to_number_reads_what_python_reads(spark):
    texts = {"1.5": 1.5, " 2 ": 2.0, "+.5": 0.5, "5.": 5.0, "1e3": 1000.0, "-inf": float("-inf"), "Infinity": float("inf"),
             "1.0d": None, "0x1p3": None, "1_0": None, "": None, ".": None, "abc": None, "1 2": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.v for r in df.select("t", to_number(F.col("t")).alias("v")).collect()} == texts


def test_staging_drops_incomplete_frames(spark):
    stamp = datetime.datetime(2024, 1, 1)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.RAW.fields)
    raw = spark.createDataFrame([(i, f[0], "h", *f[1:], stamp) for i, f in enumerate(FRAMES)], ddl)
    staged = stage_frames(raw)
    assert staged.columns == S.names(S.STAGING) and staged.count() == 4
    assert {r.vehicle_type for r in staged.collect()} == {"car", "bus"}


def test_frame_steps_look_across_spans(spark):
    times = [0.0, 0.04, 59.98, 60.0, 200.0, 200.0]
    rows = [("a", t, "car", 1.0, 1.0, 37.9, 23.6, 1.0, 0.0, 0.0, at) for t in (1, 2) for at in times]
    got = frame_steps(spark.createDataFrame(rows, DDL)).filter("track_id = 2").orderBy("timestamp_s", "step_s").collect()
    assert [None if r.step_s is None else round(r.step_s, 6) for r in got] == [None, 0.04, 59.94, 0.02, 0.0, 140.0]


def test_run_flags(spark):
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.RUN.fields)
    t = datetime.datetime(2024, 1, 1)
    rows = [(str(i), "d", "t", "a", "h", s, None, None, None, t, t, 0.1) for i, s in enumerate(S.RUN_STATUSES)]
    got = stage_runs(spark.createDataFrame(rows, ddl)).orderBy("run_id").collect()
    assert [(r.is_success, r.is_failed, r.is_skipped) for r in got] == [(True, False, False), (False, True, False), (False, False, True)]
    assert {r.rows_loaded for r in got} == {0} and "file_hash" not in got[0]


def test_marts(spark):
    fact = marts.trajectory_fact(summarise_trajectories(spark.createDataFrame(FRAMES, DDL)))
    dim = {r.vehicle_type: tuple(r)[1:] for r in marts.vehicle_type_dim(fact).collect()}
    assert dim == {"car": (1, 10.0, 3.0, 0.08), "bus": (1, 20.0, 4.0, 0.0)}
    assert tuple(map(float, marts.traffic_kpis(fact).first())) == (2, 3.5, 15.0, 0.04)
    assert [r.vehicle_type for r in marts.avg_speed_by_vehicle_type(fact).collect()] == ["bus", "car"]
    assert [tuple(r) for r in marts.trajectories_by_vehicle_type(fact).collect()] == [("bus", 1), ("car", 1)]


def test_unknown_summary_source(spark):
    with pytest.raises(ValueError):
        summary_source(spark, "other")


def test_steps_of_a_track_that_fills_many_ranges(spark):
    times = [t * 0.5 for t in range(4000) for _ in range(1 + (t % 100 == 0))]
    rows = [("a.csv", 7, t) for t in times] + [("a.csv", 8, 1.0), ("b.csv", 7, 0.0), ("b.csv", 7, 900.0)]
    frames = spark.createDataFrame(rows, "source_file string, track_id int, timestamp_s double").repartition(5)
    got = frame_steps(frames, ranges=8)
    found = sorted((r.source_file, r.track_id, r.timestamp_s, r.step_s if r.step_s is not None else -1.0) for r in got.collect())
    want = []
    for key in (("a.csv", 7), ("a.csv", 8), ("b.csv", 7)):
        own = sorted(t for f, k, t in rows if (f, k) == key)
        want += [(*key, t, t - own[i - 1] if i else -1.0) for i, t in enumerate(own)]
    assert found == sorted(want)
    held = got.select("track_id", F.spark_partition_id().alias("p")).where("track_id = 7").distinct().count()
    assert held > 2
