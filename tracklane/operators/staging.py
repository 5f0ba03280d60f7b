"""Row-level projections from raw frames and run logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklane import schemas as S
from tracklane.functions.numbers import normalise_speed, round_half_up
from tracklane.session import scratch_path

_ROUNDED = {
    "lat": S.COORDINATE_PLACES,
    "lon": S.COORDINATE_PLACES,
    "speed_ms": S.KINEMATIC_PLACES,
    "lon_acc_ms2": S.KINEMATIC_PLACES,
    "lat_acc_ms2": S.KINEMATIC_PLACES,
}


def has_required() -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in S.FRAME_REQUIRED])


def normalise_vehicle_type(value: Column) -> Column:
    return F.trim(F.lower(value))


def clean_frames(frames: DataFrame) -> DataFrame:
    """Drop frames missing a required value, normalise the vehicle type, round the measurements.

    Other columns and the column order stay as they are.
    """
    cleaned = {
        "vehicle_type": normalise_vehicle_type(F.col("vehicle_type")),
        **{c: round_half_up(F.col(c), places) for c, places in _ROUNDED.items()},
    }
    return frames.filter(has_required()).select(
        *[cleaned[c].alias(c) if c in cleaned else F.col(c) for c in frames.columns]
    )


def stage_frames(raw: DataFrame) -> DataFrame:
    """Raw frames to the 14 staging columns."""
    return clean_frames(raw).withColumnRenamed("id", "raw_id").select(*S.names(S.STAGING))


def convert_speeds(frames: DataFrame, unit: str) -> DataFrame:
    """Frames with both speeds in m/s."""
    return frames.withColumns(
        {c: normalise_speed(F.col(c), unit) for c in ("avg_speed_ms", "speed_ms")}
    )


def stage_runs(runs: DataFrame) -> DataFrame:
    """Run log for observability: counts without nulls, one flag per outcome, no file hash."""
    flags = {"is_success": "success", "is_failed": "failed", "is_skipped": "skipped"}
    return runs.select(
        "run_id",
        "dag_id",
        "task_id",
        "source_file",
        "status",
        F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"),
        F.coalesce("rows_rejected", F.lit(0)).alias("rows_rejected"),
        "error_message",
        "started_at",
        "finished_at",
        "duration_s",
        *[(F.col("status") == status).alias(name) for name, status in flags.items()],
    )


def frame_steps(frames: DataFrame, ranges: int | None = None) -> DataFrame:
    """Time since the previous frame of the same track, in time order.

    Frames are laid out in ranges of (track, time), as many as shuffle partitions unless ``ranges`` says otherwise, so a track
    with most of the rows is as many tasks' work as it fills ranges. The first frame of a range whose track began
    earlier looks back to the last time before the range: at most one row a range, which every task may hold.
    """
    spark = frames.sparkSession
    parts = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*S.TRACK_KEY, "timestamp_s"]
    laid = frames.select(*order).repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    # Stored, as a second evaluation could cut the ranges elsewhere.
    path = scratch_path(spark, "ranges")
    laid.write.parquet(path)
    stored = spark.read.schema(laid.schema).parquet(path)
    ends = stored.groupBy("part", *S.TRACK_KEY).agg(F.max("timestamp_s").alias("last_s"))
    before = ends.withColumn("before_s", F.lag("last_s").over(Window.partitionBy(*S.TRACK_KEY).orderBy("part")))
    carried = before.where("before_s IS NOT NULL").select("part", *S.TRACK_KEY, "before_s")
    in_range = Window.partitionBy("part", *S.TRACK_KEY).orderBy("timestamp_s")
    previous = F.coalesce(F.lag("timestamp_s").over(in_range), F.col("before_s"))
    return stored.join(F.broadcast(carried), ["part", *S.TRACK_KEY], "left").select(
        *S.TRACK_KEY, "timestamp_s", (F.col("timestamp_s") - previous).alias("step_s")
    )
