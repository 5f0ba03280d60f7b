"""Incremental loads: new recording files are read as they arrive, and their sources are rebuilt from all their files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracklane import schemas as S
from tracklane.operators import versions
from tracklane.operators.publish import publish
from tracklane.operators.summary import summarise_trajectories
from tracklane.plans.loads import load_records
from tracklane.session import scratch_path
from tracklane.sources.files import hash_files, read_layer
from tracklane.sources.records import records_of

_LISTED = "path string, modificationTime timestamp, length bigint, content binary"


def stream_recordings(
    spark: SparkSession,
    folder: str,
    layers: str,
    serving: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    max_reject_fraction: float = S.MAX_REJECT_FRACTION,
    pattern: str = "*.csv",
    skip_header: bool = True,
) -> StreamingQuery:
    """Load the recording files that arrived in a folder or its subfolders since the last run, then stop.

    Files of one name are one source, whatever folder they came in and whenever. A ledger, a dataset of the store at
    ``layers``, lists the files every source is made of, by content: a file whose content its source already has is left
    out. A batch joins its new files with the ledger and rebuilds the sources they belong to from all their files. Silver,
    rejects, summary, serving data and ledger change with one rename, so a batch that is repeated after a failure
    finds its files in the ledger and does nothing. Without ``files_per_batch``, all files of a run are one batch: a rebuild costs
    all files of its sources, so batches of a fixed number would cost the square of the files that arrive. The gate holds for the batch and for every file in it: one
    bad file fails its batch, and nothing of it is seen. The stream tracks paths: for a file whose content changed under its
    old path use ``load_new_files``.
    """
    listed = spark.readStream.format("binaryFile").schema(_LISTED).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if files_per_batch:
        listed = listed.option("maxFilesPerTrigger", files_per_batch)
    files = (
        listed.load(folder)
        .select("path", F.substring_index("path", "/", -1).alias("source_file"), F.col("length").alias("size"))
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        ledger_path = f"{layers.rstrip('/')}/ledger"
        found = _stored(spark, hash_files(batch), "files")
        ledger = _ledger(spark, ledger_path)
        fresh = found.join(ledger, ["source_file", "file_hash"], "left_anti").dropDuplicates(["source_file", "file_hash"])
        fresh = _stored(spark, fresh.select("path", "source_file", "size", "file_hash").withColumn("batch", F.lit(batch_id).cast("bigint")), "fresh")
        if fresh.isEmpty():
            return
        touched = fresh.select("source_file").distinct()
        entries = _stored(spark, ledger.join(touched, "source_file", "left_semi").unionByName(fresh), "entries")
        nothing = F.lit(None)
        listed = entries.select("path", nothing.cast("string").alias("member"), "source_file", "size", nothing.cast("bigint").alias("start"))
        result = load_records(
            spark, records_of(listed, skip_header), touched, layers, serving, f"batch_{batch_id}", folder,
            max_reject_fraction=max_reject_fraction, max_file_reject_fraction=max_reject_fraction, extra={"ledger": entries}, may_be_empty=True,
        )
        if result.status != "success":
            raise RuntimeError(f"batch {batch_id} failed: {_why(result)}")

    return _run_available(files, load, checkpoint)


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    if versions.store_of(spark, path) is None:
        return spark.createDataFrame([], S.LEDGER)
    return read_layer(spark, path, S.LEDGER)


def _stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _why(result) -> str:
    silver = result.silver
    if silver.status != "success":
        return f"{silver.rejected} of {silver.records + silver.rejected} records rejected, {silver.worst_file:.0%} of one file"
    reports = [result.silver_checks, result.summary_checks, result.conserved, result.published and result.published.checks]
    return ", ".join(name for found in reports if found for name in found.named("failed"))


def stream_frames(spark: SparkSession, folder: str, serving: str, checkpoint: str) -> StreamingQuery:
    """The same from Parquet frames, as ``write_by_source`` leaves them.

    All files that arrived since the last run form one batch, so a source may span many files as long
    as they arrive together.
    """
    frames = spark.readStream.schema(S.FRAME).parquet(folder)

    def replace(batch: DataFrame, batch_id: int) -> None:
        _publish_batch(spark, summarise_trajectories(batch), serving, batch_id)

    return _run_available(frames, replace, checkpoint)


def _publish_batch(spark: SparkSession, summary: DataFrame, serving: str, batch_id: int) -> None:
    result = publish(spark, summary, serving, f"batch_{batch_id}")
    if not result.complete and result.staged != (0, 0):
        raise RuntimeError(f"batch {batch_id} failed its checks: {result.checks.named('failed')}")


def _run_available(stream: DataFrame, replace, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(replace)
        .start()
    )
