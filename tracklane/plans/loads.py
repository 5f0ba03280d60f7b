"""End-to-end loads: recordings to Silver frames, to the published trajectory summary."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tracklane import schemas as S
from tracklane.operators import checks, publish, runs, versions
from tracklane.operators.frames import frames_of, judged_parts, parse_records, rejects_in, with_provenance, worst_reject_fraction
from tracklane.operators.summary import summarise_trajectories
from tracklane.session import scratch_path
from tracklane.sources.files import discover_files, hash_files, read_layer
from tracklane.sources.records import list_recordings, read_records, records_of


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


@dataclass
class SilverResult:
    path: str
    frames: int
    records: int
    rejected: int
    rejects_path: str | None
    status: str
    #: The largest share of rejects in one file; 0 where the rejects were not written.
    worst_file: float = 0.0

    @property
    def reject_fraction(self) -> float:
        total = self.records + self.rejected
        return self.rejected / total if total else 0.0


def load_silver(
    spark: SparkSession,
    records: DataFrame,
    path: str,
    bronze_key: str,
    rejects_path: str | None = None,
    speed_unit: str = "ms",
    max_reject_fraction: float = S.MAX_REJECT_FRACTION,
    mode: str = publish.REPLACE_SOURCES,
    folders: bool = True,
) -> SilverResult:
    """Parse records and write their frames; accepted and rejected records are counted on the way.

    Parse and write are one stage, so each record is counted once even if tasks run again. The rejects
    are written by a second pass that runs only if there are any.
    """
    seen = Observation()
    parsed = parse_records(records, speed_unit)
    counts = [
        F.count_if(F.col("reason_code").isNull()).alias("records"),
        F.count_if(F.col("reason_code").isNotNull()).alias("rejected"),
    ]
    counted = parsed.observe(seen, *counts)
    written = publish.write_frames(
        with_provenance(frames_of(counted), bronze_key, _now()), path, mode, gather=False, folders=folders
    )
    totals = publish.observed(seen, "records", "rejected") if written.rows else parsed.agg(*counts).first()
    kept, worst = None, 0.0
    if totals["rejected"] and rejects_path:
        parts = judged_parts(parsed)
        publish.write_by_source(rejects_in(parts), rejects_path, publish.REPLACE_SNAPSHOT, folders=folders)
        kept, worst = rejects_path, worst_reject_fraction(parts)
    result = SilverResult(path, written.rows, totals["records"], totals["rejected"], kept, written.status, worst)
    if result.reject_fraction > max_reject_fraction:
        result.status = "failed"
    return result


@dataclass
class LoadResult:
    status: str
    silver: SilverResult | None = None
    silver_checks: checks.CheckReport | None = None
    summary: publish.WriteResult | None = None
    summary_checks: checks.CheckReport | None = None
    conserved: checks.CheckReport | None = None
    published: publish.PublishResult | None = None


def load_recordings(
    spark: SparkSession,
    source: str,
    layers: str,
    serving: str,
    run_id: str,
    speed_unit: str = "ms",
    max_reject_fraction: float = S.MAX_REJECT_FRACTION,
    **read_options,
) -> LoadResult:
    """Load the recordings of a file, an archive or a folder: ``load_records`` over all that it holds."""
    read = list_recordings(spark, source, **read_options).select("source_file").distinct()
    records = read_records(spark, source, **read_options)
    return load_records(spark, records, read, layers, serving, run_id, source, speed_unit, max_reject_fraction)


def load_records(
    spark: SparkSession,
    records: DataFrame,
    read: DataFrame,
    layers: str,
    serving: str,
    run_id: str,
    origin: str,
    speed_unit: str = "ms",
    max_reject_fraction: float = S.MAX_REJECT_FRACTION,
    max_file_reject_fraction: float | None = None,
    extra: dict[str, DataFrame] | None = None,
    may_be_empty: bool = False,
) -> LoadResult:
    """Records → staged Silver → checks → staged summary → checks and frame conservation → serving data and layers.

    ``read`` lists the sources the records come from, also those without any. Silver, summary, rejects, serving data and
    the ``extra`` tables (by source) are versioned datasets of the store at ``layers``. A run's rows lie beside the ones in
    use and cover this run's sources only. The first gate that fails stops the run; then no reader sees any of them, and
    they stay for inspection. Once all gates hold, one rename puts all in place: every source that was read has its
    new rows, or none if it has no valid record any more. ``may_be_empty`` lets a run pass whose sources hold no record at
    all.
    """
    layers = layers.rstrip("/")
    silver_path, summary_path, rejects_path = f"{layers}/silver", f"{layers}/summary", f"{layers}/rejects"
    extra = {f"{layers}/{name}": table for name, table in (extra or {}).items()}
    names = {"silver": silver_path, "summary": summary_path, "rejects": rejects_path, "serving": serving}
    names |= {path.rsplit("/", 1)[-1]: path for path in extra}
    stores = {path: versions.register(spark, path, layers, name) for name, path in names.items()}
    bases = {store: versions.state(spark, store) for store, _ in stores.values()}
    staged = {path: versions.version_folder(spark, path, run_id) for path in names.values()}
    result = LoadResult("failed")

    def put_in_place() -> None:
        # One store, unless serving data was first published into another one.
        for store in dict.fromkeys(store for store, _ in stores.values()):
            own = {stores[path][1]: staged[path] for path in staged if stores[path][0] == store}
            versions.commit(spark, store, bases[store], own, read)
        result.status = "success"

    for path, table in extra.items():
        publish.write_by_source(table, staged[path][1], publish.REPLACE_SNAPSHOT, folders=False)
    result.silver = load_silver(
        spark, records, staged[silver_path][1], origin, staged[rejects_path][1], speed_unit, max_reject_fraction, publish.REPLACE_SNAPSHOT, folders=False
    )
    if may_be_empty and not result.silver.records + result.silver.rejected:
        put_in_place()
        return result
    if max_file_reject_fraction is not None and result.silver.worst_file > max_file_reject_fraction:
        result.silver.status = "failed"
    if result.silver.status != "success":
        return result
    result.silver_checks = checks.validate_dataset(spark, staged[silver_path][1], S.SILVER, checks.frame_checks())
    if not result.silver_checks.passed:
        return result
    frames = read_layer(spark, staged[silver_path][1], S.SILVER)
    result.summary = publish.write_summary(spark, summarise_trajectories(frames), staged[summary_path][1], publish.REPLACE_SNAPSHOT, folders=False)
    if result.summary.status != "success":
        return result
    result.summary_checks = checks.validate_dataset(spark, staged[summary_path][1], S.SUMMARY, checks.summary_checks())
    summary = read_layer(spark, staged[summary_path][1], S.SUMMARY)
    result.conserved = checks.report("frames", checks.check_frames_conserved(frames, summary))
    if not (result.summary_checks.passed and result.conserved.passed):
        return result
    batch = publish.stage_batch(spark, summary, serving, run_id)
    result.published = batch.result
    if not batch.result.checks.passed:
        return result
    put_in_place()
    result.status = publish.confirm(spark, batch).status
    result.silver.path, result.summary.path = silver_path, summary_path
    if result.silver.rejects_path:
        result.silver.rejects_path = rejects_path
    return result


def load_new_files(
    spark: SparkSession, folder: str, raw_path: str, runs_path: str, dag_id: str = "load_recordings", task_id: str = "load_files"
) -> DataFrame:
    """Load the files of a folder that are new or changed, replacing their earlier rows.

    All pending files are parsed in one job, planned from a table of files. Each gets a row in the run log, also when the job
    fails; files that are already loaded are logged as skipped. The raw layer is versioned: its readers see the rows of all
    files of a run at once, and a file that now gives no frame loses its old ones. Returns this run's log rows.
    """
    started = _now()
    # The file list is read four times below; storing it hashes every file once.
    listing = scratch_path(spark, "files")
    hash_files(discover_files(spark, folder)).write.parquet(listing)
    files = spark.read.parquet(listing)
    log = runs.read_runs(spark, runs_path)
    pending = runs.pending_files(files, log)
    nothing = F.lit(0).cast("bigint")

    def entries(per_file: DataFrame, status: str, error: str | None = None) -> DataFrame:
        return runs.run_rows(per_file, status, started, _now(), dag_id, task_id, error)

    unread = lambda df: df.select(
        "source_file", "file_hash", nothing.alias("rows_loaded"), nothing.alias("rows_rejected")
    )
    made = [entries(unread(runs.loaded_files(files, log)), "skipped")]
    if not pending.isEmpty():
        try:
            store, dataset = versions.register(spark, raw_path, raw_path, "rows")
            base = versions.state(spark, store)
            version, folder = versions.version_folder(spark, raw_path, "files")
            nowhere = F.lit(None)
            listed = pending.select("path", nowhere.cast("string").alias("member"), "source_file", "size", nowhere.cast("bigint").alias("start"))
            parsed = parse_records(records_of(listed))
            frames = frames_of(parsed).join(pending.select("source_file", "file_hash"), "source_file")
            # The surrogate id is unique within one load.
            raw = frames.withColumn("id", F.monotonically_increasing_id()).withColumn(
                "ingested_at", F.lit(started).cast("timestamp")
            )
            publish.write_by_source(raw.select(*S.names(S.RAW)), folder, publish.REPLACE_SNAPSHOT, gather=False, folders=False)
            accepted = F.col("reason_code").isNull()
            counts = parsed.groupBy("source_file").agg(
                F.sum(F.when(accepted, F.size("frames").cast("bigint")).otherwise(0)).alias("rows_loaded"),
                F.count_if(~accepted).alias("rows_rejected"),
            )
            done = pending.join(counts, "source_file", "left").select(
                "source_file",
                "file_hash",
                F.coalesce("rows_loaded", nothing).alias("rows_loaded"),
                F.coalesce("rows_rejected", nothing).alias("rows_rejected"),
            )
            made.append(entries(done, "success"))
            versions.commit(spark, store, base, {dataset: (version, folder)}, pending)
        except Exception as error:
            runs.append_runs(entries(unread(pending), "failed", str(error)), runs_path)
            raise
    stored = scratch_path(spark, "runs")
    this_run = made[0] if len(made) == 1 else made[0].unionByName(made[1])
    this_run.write.parquet(stored)
    this_run = spark.read.schema(S.RUN).parquet(stored)
    runs.append_runs(this_run, runs_path)
    return this_run
