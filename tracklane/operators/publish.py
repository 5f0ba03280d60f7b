"""Write layers, and replace data per source file so that reruns change nothing."""

from __future__ import annotations

import re
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklane import schemas as S
from tracklane.operators import checks, versions
from tracklane.sources.files import read_layer

REPLACE_SOURCES, REPLACE_SNAPSHOT = "replace_sources", "replace_snapshot"
ROWS_PER_FILE = 5_000_000
PROJECTED_ROWS = 500_000
_IDENTIFIER = re.compile(r"^[A-Za-z0-9_]+$")


def write_by_source(
    df: DataFrame,
    path: str,
    mode: str = REPLACE_SOURCES,
    rows_per_file: int = ROWS_PER_FILE,
    gather: bool = True,
    partitions: int | None = None,
    seen: Observation | None = None,
    metrics: tuple[Column, ...] = (),
    folders: bool = True,
) -> None:
    """Snappy Parquet, one folder per source file, or with ``folders=False`` all sources in common files.

    ``replace_sources`` replaces the folders of the sources in ``df`` and leaves the others alone;
    ``replace_snapshot`` replaces everything. With ``gather``, rows are first brought together by source
    in evenly sized parts: a source with a third of all rows is spread over many tasks, small ones share
    a task. Rows that already lie by source, as parsed byte ranges do, need no such shuffle.
    ``partitions`` merges them into that many tasks instead.

    Folders serve readers that list them, and replacing single sources in place. A version of a dataset needs neither: with a
    folder for each of many small sources, listing, opening and renaming their files costs more than the rows.

    ``metrics`` are observed in the task that writes, behind any shuffle, so a stage that runs again
    after a lost executor is not counted twice.
    """
    if mode not in (REPLACE_SOURCES, REPLACE_SNAPSHOT):
        raise ValueError(f"invalid load mode {mode!r}; expected {REPLACE_SOURCES} or {REPLACE_SNAPSHOT}")
    if rows_per_file <= 0:
        raise ValueError(f"rows per file must be positive, got {rows_per_file}")
    if not folders and mode != REPLACE_SNAPSHOT:
        raise ValueError(f"sources without folders of their own need {REPLACE_SNAPSHOT}")
    overwrite = "dynamic" if mode == REPLACE_SOURCES else "static"
    if partitions:
        df = df.coalesce(partitions)
    elif gather:
        df = df.hint("rebalance", "source_file")
    if seen is not None:
        df = df.observe(seen, *metrics)
    writer = (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
    )
    (writer.partitionBy("source_file") if folders else writer).parquet(path)


@dataclass
class WriteResult:
    path: str
    rows: int
    trajectories: int
    frames: int
    status: str


def observed(seen: Observation, *names: str) -> dict[str, int]:
    """Metrics of a finished write; zeros if the plan turned out empty and dropped its counter."""
    try:
        found = seen.get
    except Py4JJavaError:
        found = {}
    return {name: found.get(name) or 0 for name in names}


def write_frames(
    frames: DataFrame, path: str, mode: str = REPLACE_SOURCES, gather: bool = True, partitions: int | None = None, folders: bool = True
) -> WriteResult:
    """Write Silver frames and count them while they are written; no rows is a failure."""
    seen = Observation()
    write_by_source(
        frames.select(*S.names(S.SILVER)),
        path,
        mode,
        gather=gather,
        partitions=partitions,
        seen=seen,
        metrics=(F.count(F.lit(1)).alias("rows"),),
        folders=folders,
    )
    rows = observed(seen, "rows")["rows"]
    return WriteResult(path, rows, 0, rows, "success" if rows else "failed")


def write_summary(spark: SparkSession, summary: DataFrame, path: str, mode: str = REPLACE_SOURCES, folders: bool = True) -> WriteResult:
    """Write summaries, then count what a reader of this batch finds in storage."""
    seen = Observation()
    metrics = (F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("frame_count"), F.lit(0)).alias("frames"))
    write_by_source(summary, path, mode, seen=seen, metrics=metrics, folders=folders)
    written = observed(seen, "rows", "frames")
    if not written["rows"]:
        return WriteResult(path, 0, 0, 0, "failed")
    stored = _read_back(spark, path, summary)
    complete = (stored["rows"], stored["frames"]) == (written["rows"], written["frames"])
    return WriteResult(path, stored["rows"], written["rows"], written["frames"], "success" if complete else "failed")


def _read_back(spark: SparkSession, path: str, batch: DataFrame):
    """Rows and frames a reader finds for the sources of a batch; other sources do not count."""
    sources = batch.select("source_file").distinct()
    found = read_layer(spark, path, S.SUMMARY).join(sources, "source_file", "left_semi")
    return found.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("frame_count"), F.lit(0)).alias("frames")).first()


def replace_sources(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The target after a batch: rows of the batch's sources come from the batch, the rest stay."""
    sources = batch.select("source_file").distinct()
    return target.join(sources, "source_file", "left_anti").select(*target.columns).unionByName(batch)


@dataclass
class PublishResult:
    """What the gate found in a staged batch, and what the target holds of the batch's sources afterwards."""

    checks: checks.CheckReport
    rows: int = 0
    frames: int = 0
    #: Staged data that was kept for inspection; none once the batch is published whole.
    kept: str | None = None

    @property
    def complete(self) -> bool:
        """The batch passed its gate, and the target holds exactly its rows and frames."""
        return self.checks.passed and (self.rows, self.frames) == self.staged

    @property
    def staged(self) -> tuple[int, int]:
        return int(self.checks.observed("staged_rows")), int(self.checks.observed("frame_sum"))

    @property
    def status(self) -> str:
        return "success" if self.complete else "failed"


@dataclass
class StagedBatch:
    """A batch in a version folder of its target, which no reader sees yet."""

    target: str
    version: str
    folder: str
    result: PublishResult


def stage_batch(
    spark: SparkSession,
    summary: DataFrame,
    target: str,
    run_id: str,
    rows_per_file: int = ROWS_PER_FILE,
    expected_row_count: int | None = None,
    expected_frame_sum: int | None = None,
) -> StagedBatch:
    """Write the batch where it is to stay, and check what was written."""
    version, folder = versions.version_folder(spark, target, run_id)
    write_by_source(summary.select(*S.names(S.SUMMARY)), folder, REPLACE_SNAPSHOT, rows_per_file, folders=False)
    staged = read_layer(spark, folder, S.SUMMARY)
    rows = F.count(F.lit(1))
    totals = [
        checks.Check("staged_rows", rows, lambda n: n >= 0, "rows", on_empty=True),
        checks.Check("frame_sum", F.coalesce(F.sum("frame_count"), F.lit(0)), lambda n: n >= 0, "frames", on_empty=True),
    ]
    found = checks.report(
        folder, checks.run_checks(staged, checks.serving_checks(expected_row_count, expected_frame_sum) + totals)
    )
    return StagedBatch(target, version, folder, PublishResult(found, kept=folder))


def confirm(spark: SparkSession, batch: StagedBatch) -> PublishResult:
    """Count what a reader finds of a committed batch."""
    stored = _read_back(spark, batch.target, read_layer(spark, batch.folder, S.SUMMARY))
    batch.result.rows, batch.result.frames = stored["rows"], stored["frames"]
    if batch.result.complete:
        batch.result.kept = None
    return batch.result


def publish(
    spark: SparkSession,
    summary: DataFrame,
    target: str,
    run_id: str,
    mode: str = REPLACE_SOURCES,
    rows_per_file: int = ROWS_PER_FILE,
    expected_row_count: int | None = None,
    expected_frame_sum: int | None = None,
    read: DataFrame | None = None,
) -> PublishResult:
    """Stage the batch, check what was staged, publish it with one rename.

    A batch holds the complete set of every source in it; sources in ``read`` that the batch has no rows of lose their old
    ones. If a check fails, the staged data stays for inspection and the target is not touched. A reader of the target
    (``read_layer``) sees the old rows until the rename and the new ones from then on.
    """
    if mode not in (REPLACE_SOURCES, REPLACE_SNAPSHOT):
        raise ValueError(f"invalid load mode {mode!r}; expected {REPLACE_SOURCES} or {REPLACE_SNAPSHOT}")
    store, dataset = versions.register(spark, target, target, "rows")
    base = versions.state(spark, store)
    batch = stage_batch(spark, summary, target, run_id, rows_per_file, expected_row_count, expected_frame_sum)
    if batch.result.checks.passed:
        versions.commit(spark, store, base, {dataset: (batch.version, batch.folder)}, read, mode == REPLACE_SNAPSHOT)
        confirm(spark, batch)
    return batch.result


def published_sources(summary: DataFrame) -> DataFrame:
    return summary.select("source_file").distinct().orderBy("source_file")


def export_json(summary: DataFrame, path: str) -> None:
    """One JSON object per line, written by the executors."""
    summary.write.mode("overwrite").json(path)


def storage_footprint(spark: SparkSession, path: str, target_rows: int = PROJECTED_ROWS) -> DataFrame:
    """Bytes on storage, bytes per row and a linear projection to ``target_rows``."""
    files = (
        spark.read.parquet(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .groupBy("file")
        .agg(F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    )
    totals = files.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
    )
    per_row = F.when(F.col("row_count") > 0, F.col("total_bytes") / F.col("row_count")).otherwise(F.lit(0.0))
    return totals.select(
        "*",
        per_row.alias("bytes_per_row"),
        F.bround(per_row * target_rows).cast("bigint").alias("projected_bytes"),
    )


def create_table_ddl(table: str, schema: T.StructType = S.SUMMARY, path: str | None = None) -> str:
    """CREATE TABLE for a layer, columns in contract order, partitioned by source."""
    if not all(_IDENTIFIER.match(part) for part in table.split(".")):
        raise ValueError(f"table name may hold only letters, digits, _ and dots: {table!r}")
    location = f" LOCATION '{path}'" if path else ""
    return f"CREATE TABLE IF NOT EXISTS {table} ({schema.toDDL()}) USING parquet PARTITIONED BY (source_file){location}"


def materialise(df: DataFrame, name: str, kind: str) -> None:
    """``view`` keeps the definition only, ``table`` stores the rows."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        df.write.mode("overwrite").saveAsTable(name)
    else:
        raise ValueError(f"kind must be 'view' or 'table', got {kind!r}")
