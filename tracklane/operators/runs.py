"""Run log: which files were loaded, and which still need to be."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane import schemas as S


def pending_files(files: DataFrame, runs: DataFrame) -> DataFrame:
    """Files with no successful run for the same name and content."""
    return files.join(_loaded(runs), ["source_file", "file_hash"], "left_anti").select(*files.columns)


def loaded_files(files: DataFrame, runs: DataFrame) -> DataFrame:
    """Files that a successful run already loaded, to be logged as skipped."""
    return files.join(_loaded(runs), ["source_file", "file_hash"], "left_semi").select(*files.columns)


def _loaded(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status") == "success").select("source_file", "file_hash")


def failed_without_rerun(runs: DataFrame, as_of: Column | None = None, hours: int = 24) -> DataFrame:
    """Sources with a recent failure and no success at any time."""
    now = F.current_timestamp() if as_of is None else as_of
    recent = (F.col("status") == "failed") & (F.col("started_at") >= now - F.expr(f"INTERVAL {int(hours)} HOURS"))
    succeeded = runs.filter(F.col("status") == "success").select("source_file")
    return runs.filter(recent).select("source_file").distinct().join(succeeded, "source_file", "left_anti")


def run_rows(
    per_file: DataFrame,
    status: str,
    started_at: datetime.datetime,
    finished_at: datetime.datetime,
    dag_id: str,
    task_id: str,
    error_message: str | None = None,
) -> DataFrame:
    """Log rows from ``(source_file, file_hash, rows_loaded, rows_rejected)``, one per attempt."""
    if status not in S.RUN_STATUSES:
        raise ValueError(f"status must be one of {S.RUN_STATUSES}, got {status!r}")
    made = {
        "run_id": F.uuid(),
        "dag_id": F.lit(dag_id),
        "task_id": F.lit(task_id),
        "status": F.lit(status),
        "error_message": F.lit(error_message).cast("string"),
        "started_at": F.lit(started_at).cast("timestamp"),
        "finished_at": F.lit(finished_at).cast("timestamp"),
        "duration_s": F.lit(round((finished_at - started_at).total_seconds(), 3)),
    }
    return per_file.select(*[made[c].alias(c) if c in made else F.col(c) for c in S.names(S.RUN)])


def append_runs(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run log; empty before the first run."""
    try:
        return spark.read.schema(S.RUN).parquet(path)
    except Exception as error:  # noqa: BLE001 - only a missing log means "no runs yet"
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], S.RUN)


def new_run_id() -> str:
    return uuid.uuid4().hex
