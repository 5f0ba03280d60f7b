"""Marts and dashboard queries over the trajectory summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane import schemas as S
from tracklane.operators.summary import in_contract_order


def trajectory_fact(summary: DataFrame) -> DataFrame:
    return in_contract_order(summary)


def vehicle_type_dim(summary: DataFrame) -> DataFrame:
    """One row per vehicle type; means count every trajectory once, whatever its length."""
    return (
        summary.groupBy("vehicle_type")
        .agg(
            F.count(F.lit(1)).alias("trajectory_count"),
            F.avg("traveled_d_m").alias("average_traveled_distance_m"),
            F.avg("avg_speed_ms").alias("average_speed_ms"),
            F.avg("duration_s").alias("average_duration_s"),
        )
        .select(*S.names(S.VEHICLE_TYPE_DIM))
    )


def traffic_kpis(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("total_trajectories"),
        _to_cents(F.avg("avg_speed_ms")).alias("avg_speed_ms"),
        _to_cents(F.avg("traveled_d_m")).alias("avg_distance_m"),
        _to_cents(F.avg("duration_s")).alias("avg_duration_s"),
    )


def trajectories_by_vehicle_type(fact: DataFrame) -> DataFrame:
    counted = fact.groupBy("vehicle_type").agg(F.count(F.lit(1)).alias("trajectory_count"))
    return counted.orderBy(F.desc("trajectory_count"), "vehicle_type")


def avg_speed_by_vehicle_type(fact: DataFrame) -> DataFrame:
    mean = fact.groupBy("vehicle_type").agg(_to_cents(F.avg("avg_speed_ms")).alias("avg_speed_ms"))
    return mean.orderBy(F.desc("avg_speed_ms"), "vehicle_type")


def _to_cents(value: Column) -> Column:
    """Two decimals, rounded on the decimal value."""
    return F.round(value.cast("decimal(20,8)"), 2)
