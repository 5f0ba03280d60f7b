"""The registered queries, each over whole given tables."""

from __future__ import annotations

import datetime
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs as I
from tracklane import schemas as S
from tracklane.functions import repair
from tracklane.functions.lines import CUT, join_physical_lines
from tracklane.functions.urls import object_name, safe_url
from tracklane.operators import checks, parity, publish, runs, staging, summary, versions
from tracklane.operators.frames import frames_of, parse_counts, parse_records, rejects_of, with_provenance
from tracklane.operators.records import assemble_records, number_records
from tracklane.plans import marts
from tracklane.plans.loads import load_new_files, load_recordings
from tracklane.session import scratch_path
from tracklane.sources.archive import list_archive_members, read_archive_lines
from tracklane.sources.files import dataset_metrics, discover_files, hash_files, read_layer, read_lines, read_source, register_sources
from tracklane.sources.records import read_records
from tracklane.sources.storage import filesystem_of
from tracklane.streaming.ingest import stream_frames, stream_recordings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _mean(name: str, places: int = 6):
    return F.round(F.col(name).cast("decimal(20,8)"), places).cast("double").alias(name)


def _steady(df: DataFrame, *means: str) -> DataFrame:
    """Cut averages to digits that do not depend on the order of addition."""
    means = means or ("avg_lon_acc_ms2", "avg_lat_acc_ms2")
    return df.select(*[_mean(c) if c in means else F.col(c) for c in df.columns])


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.summarise_trajectories(I.raw_frames(spark, sf_dir))


# --- staging and summary ---------------------------------------------------------------------------


@query
def stage_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_frames(I.dirty_frames(spark, sf_dir))


@query
def trajectory_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steady(_fact(spark, sf_dir))


@query
def trajectory_summary_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steady(summary.summarise_trajectories(I.dirty_frames(spark, sf_dir)))


@query
def trajectory_summary_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steady(summary.summarise_trajectories(I.tied_frames(spark, sf_dir)))


@query
def trajectory_summary_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steady(summary.summarise_trajectories(I.lineitem_frames(spark, sf_dir)))


@query
def trajectory_summary_kmh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _steady(summary.summarise_trajectories(staging.convert_speeds(I.raw_frames(spark, sf_dir), "kmh")))


@query
def summary_from_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_sources(spark, {"serving.gold_trajectory_summary": _fact(spark, sf_dir)})
    return _steady(summary.summary_source(spark, "serving"))


# --- marts -----------------------------------------------------------------------------------------


@query
def trajectory_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = summary.summary_source(spark, "computed", staging.stage_frames(I.raw_frames(spark, sf_dir)))
    publish.materialise(marts.trajectory_fact(source), "fct_vehicle_trajectories", "view")
    return _steady(read_source(spark, "fct_vehicle_trajectories"))


@query
def vehicle_type_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = _steady(
        marts.vehicle_type_dim(_fact(spark, sf_dir)), "average_traveled_distance_m", "average_speed_ms"
    )
    return dim.withColumn("average_duration_s", _mean("average_duration_s", 3))


@query
def traffic_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpis = marts.traffic_kpis(_fact(spark, sf_dir))
    return kpis.select(
        "total_trajectories", *[F.col(c).cast("double").alias(c) for c in kpis.columns if c != "total_trajectories"]
    )


@query
def trajectories_by_vehicle_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.trajectories_by_vehicle_type(_fact(spark, sf_dir))


@query
def avg_speed_by_vehicle_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = marts.avg_speed_by_vehicle_type(_fact(spark, sf_dir))
    return mean.withColumn("avg_speed_ms", F.col("avg_speed_ms").cast("double"))


# --- single operators over frames ------------------------------------------------------------------


@query
def frame_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.frame_steps(staging.stage_frames(I.raw_frames(spark, sf_dir)))


@query
def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_metrics(_fact(spark, sf_dir), S.TRACK_KEY, "frame_count")


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(I.raw_frames(spark, sf_dir), S.TRACK_KEY)


# --- checks ----------------------------------------------------------------------------------------


@query
def frame_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("id") % 307 == 0, "").otherwise("bronze/recordings.zip")
    silver = I.dirty_frames(spark, sf_dir).withColumn("bronze_key", key).select(*S.names(S.SILVER))
    return checks.run_checks(silver, checks.frame_checks(expected_row_count=I.table(spark, sf_dir, "events").count()))


@query
def summary_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    duration = F.when(F.col("track_id") % 9 == 0, -F.col("duration_s")).otherwise(F.col("duration_s"))
    return checks.run_checks(_fact(spark, sf_dir).withColumn("duration_s", duration), checks.summary_checks())


@query
def serving_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _fact(spark, sf_dir)
    late = fact.filter(F.col("track_id") % 31 == 0).withColumn("start_time_s", F.col("start_time_s") + 1e9)
    return checks.run_checks(fact.unionByName(late), checks.serving_checks(1, 1))


@query
def raw_column_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = I.dirty_frames(spark, sf_dir).withColumn("vehicle_type", F.trim("vehicle_type"))
    return checks.run_checks(raw, checks.column_checks("raw"))


@query
def staging_column_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.run_checks(stage_frames(spark, sf_dir), checks.column_checks("staging"))


@query
def summary_column_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.run_checks(_fact(spark, sf_dir), checks.column_checks("summary"))


@query
def fact_column_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = marts.trajectory_fact(summary.summarise_trajectories(I.dirty_frames(spark, sf_dir)))
    return checks.run_checks(fact, checks.column_checks("fact"))


@query
def vehicle_type_dim_column_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.run_checks(marts.vehicle_type_dim(_fact(spark, sf_dir)), checks.column_checks("vehicle_type_dim"))


@query
def serving_column_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.run_checks(_fact(spark, sf_dir), checks.column_checks("serving"))


@query
def run_column_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.run_checks(I.run_log(spark, sf_dir), checks.column_checks("runs"))


@query
def frames_conserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = I.dirty_frames(spark, sf_dir)
    return checks.check_frames_conserved(frames, summary.summarise_trajectories(frames))


@query
def reject_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_rejects(parse_counts(_parsed_faulty(spark, sf_dir)))


@query
def check_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    serving = _fact(spark, sf_dir)
    batch = serving.filter(F.col("source_file") == "view.csv").withColumn("frame_count", F.col("frame_count") + 1)
    return checks.check_published(serving, batch)


@query
def fact_rows_eq_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact against serving data that was published whole, and against some that lacks a source."""
    fact = _fact(spark, sf_dir)
    found = []
    for name, served in (("whole", fact), ("short", fact.filter(F.col("source_file") != "view.csv"))):
        target = scratch_path(spark, "serving")
        publish.publish(spark, served, target, name)
        serving = read_layer(spark, target, S.SUMMARY)
        found.append(checks.check_same_row_count(f"fact_rows_eq_serving_{name}", marts.trajectory_fact(fact), serving))
    return found[0].unionByName(found[1])


@query
def damaged_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of a summary layer that is whole, lacks a column, holds one of another type, or cannot be read."""
    fact = _fact(spark, sf_dir)
    cases = {
        "whole": fact,
        "column_missing": fact.drop("end_lat"),
        "column_too_many": fact.withColumn("extra", F.lit(1)),
        "other_type": fact.withColumn("frame_count", F.col("frame_count").cast("double")),
    }
    rows = []
    for case, layer in cases.items():
        path = scratch_path(spark, "layer")
        publish.write_by_source(layer, path)
        rows += [(case, *r) for r in checks.validate_dataset(spark, path, S.SUMMARY, checks.summary_checks()).rows]
    unreadable = scratch_path(spark, "layer")
    fact.select(F.concat_ws(",", *S.TRACK_KEY)).write.text(unreadable)
    rows += [("unreadable", *r) for r in checks.validate_dataset(spark, unreadable, S.SUMMARY, checks.summary_checks()).rows]
    found = spark.createDataFrame(rows, "case string, check string, status string, observed double, expected string, detail string")
    named = F.col("check").isin("readable", "schema_names", "schema_types", "not_null_end_lat", "row_count_positive")
    # The text of a read error is the reader's own.
    return found.filter(named).select("case", "check", "status", F.when(F.col("check") != "readable", F.col("observed")).alias("observed"), F.when(F.col("check") != "readable", F.col("detail")).alias("detail"))


# --- recordings: lines, records, frames, rejects -----------------------------------------------------


def _broken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = I.physical_lines(I.broken_text(I.recording_frames(spark, sf_dir)))
    return assemble_records(lines, skip_header=False)


def _parsed_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = I.physical_lines(I.plain_text(I.faulty_frames(I.recording_frames(spark, sf_dir))))
    return parse_records(assemble_records(lines, skip_header=False))


def _recording_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record of at most ``FRAMES`` frames, its physical lines separated by line feeds."""
    texts = I.broken_text(I.recording_frames(spark, sf_dir))
    rows = texts.groupBy("track").agg(F.sort_array(F.collect_list(F.struct("idx", "text"))).alias("rows"))
    return rows.select("track", F.array_join("rows.text", "\n").alias("value"))


@query
def assembled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _broken_records(spark, sf_dir)
    text = F.col("text")
    track = F.split(F.ltrim(text), ";")[0].cast("bigint")
    fields = F.size(F.split(join_physical_lines(text), ";")) - 1
    return records.select(
        "source_file",
        track.alias("track"),
        F.size(F.split(text, "\n")).cast("bigint").alias("line_count"),
        ((fields - S.HEADER_FIELDS) / S.FRAME_FIELDS).cast("bigint").alias("frame_count"),
    )


@query
def parse_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = I.physical_lines(I.plain_text(I.recording_frames(spark, sf_dir)))
    return frames_of(parse_records(assemble_records(lines, skip_header=False)))


@query
def repair_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames_of(parse_records(_broken_records(spark, sf_dir)))


@query
def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects_of(_parsed_faulty(spark, sf_dir)).select("source_file", "record_no", "track_id", "reason_code")


@query
def parse_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_counts(_parsed_faulty(spark, sf_dir))


@query
def limited_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = number_records(_broken_records(spark, sf_dir)).filter(F.col("record_no") <= 10)
    track = F.split(F.ltrim("text"), ";")[0].cast("bigint")
    return numbered.select("source_file", track.alias("track"), "record_no")


@query
def read_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files written from the events, read back as whole records by byte range."""
    folder = scratch_path(spark, "recordings")
    _recording_texts(spark, sf_dir).select("value").write.text(folder)
    records = read_records(spark, folder, skipHeader="false", suffix=".txt")
    return frames_of(parse_records(records)).drop("source_file")


@query
def read_recording_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files read by the text scan and assembled from lines."""
    folder = scratch_path(spark, "recordings")
    _recording_texts(spark, sf_dir).select("value").write.text(folder)
    records = assemble_records(read_lines(spark, folder), skip_header=False)
    return frames_of(parse_records(records)).drop("source_file")


@query
def read_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives written by the executors from the events, their members read as records."""
    parsed = frames_of(parse_records(read_records(spark, _archives(spark, sf_dir))))
    return parsed.groupBy("track_id").agg(
        F.count(F.lit(1)).alias("frame_count"), F.max("timestamp_s").alias("end_time_s")
    )


@query
def archive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_archive_lines(spark, _archives(spark, sf_dir))
    return lines.filter(F.col("pos") > 0).agg(F.count(F.lit(1)).alias("line_count"))


#: Documents whose texts go into one file.
BUNDLE = 64


@query
def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Central directories of archives that hold the documents' texts as members, some of them hidden or no recordings."""
    folder = scratch_path(spark, "archives")
    kind = F.col("doc_id") % 9
    member = F.when(kind == 1, "__MACOSX/").when(kind == 2, "deep/.").when(kind == 3, "deep/").otherwise("")
    suffix = F.when(kind == 4, ".txt").when(kind == 5, ".CSV").otherwise(".csv")
    docs = I.table(spark, sf_dir, "documents").select(
        F.floor(F.col("doc_id") / BUNDLE).alias("bundle"), F.concat(member, F.col("doc_id").cast("string"), suffix).alias("member"), F.coalesce("text", F.lit("")).alias("text")
    )

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        storage, inner = filesystem_of(folder)
        storage.create_dir(inner)
        target = f"{inner}/{rows['bundle'].iloc[0]}.zip"
        attempt = f"{target}.{TaskContext.get().taskAttemptId()}.tmp"
        with storage.open_output_stream(attempt) as stream, zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED) as archive:
            archive.writestr("deep/", "")
            for name, text in zip(rows["member"], rows["text"], strict=True):
                archive.writestr(name, text)
        storage.move(attempt, target)
        return pd.DataFrame({"archive": [target]})

    docs.groupBy("bundle").applyInPandas(pack, "archive string").write.parquet(scratch_path(spark, "written"))
    return list_archive_members(spark, folder).select(F.substring_index("archive", "/", -1).alias("archive"), "member", "size", "compressed_size", "eligible")


@query
def hashed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written from the documents' texts, found again in their folder, with the hash of their content."""
    folder = scratch_path(spark, "files")
    docs = I.table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / BUNDLE).alias("bundle"), F.col("doc_id").alias("track"), F.coalesce("text", F.lit("")).alias("value"))
    _write_files(docs.withColumn("file", F.concat(F.lit("bundle"), F.col("bundle").cast("string"), F.when(F.col("bundle") % 5 == 4, ".txt").otherwise(".csv"))), folder, header=False)
    return hash_files(discover_files(spark, folder)).select("source_file", "size", "file_hash")


def _archives(spark: SparkSession, sf_dir: str) -> str:
    """One archive per write task, with one CSV member each and an artefact that readers must skip."""
    folder = scratch_path(spark, "archives")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId()
        storage, inner = filesystem_of(folder)
        storage.create_dir(inner)
        target = f"{inner}/part{number:05d}.zip"
        # A name per attempt: a repeated task replaces the whole file, never a part of it.
        attempt = f"{target}.{TaskContext.get().taskAttemptId()}.tmp"
        with storage.open_output_stream(attempt) as stream, zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("__MACOSX/part.csv", "x")
            with archive.open(f"data/part{number:05d}.csv", "w") as member:
                member.write(b"track_id; type; traveled_d; avg_speed\r\n")
                for batch in batches:
                    for value in batch["value"]:
                        member.write((value + "\n").encode())
        storage.move(attempt, target)
        yield pd.DataFrame({"archive": [target]})

    texts = _recording_texts(spark, sf_dir).select("value")
    texts.mapInPandas(write, "archive string").write.mode("overwrite").parquet(scratch_path(spark, "written"))
    return folder


# --- repair of single tokens -------------------------------------------------------------------------


@query
def boundary_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candidates, in order, for latitudes that lost their point and for accelerations cut behind their second character."""
    frames = I.recording_frames(spark, sf_dir)
    turned = F.format_string("%.2f", F.col("lon_acc").cast("double"))
    cut = F.concat(F.substring(turned, 1, 2), F.lit(CUT), F.substring(turned, 3, 100))
    listed = lambda token: F.array_join(repair.boundary_candidates(token), " ")
    return frames.select("event_id", listed(F.replace("lat", F.lit("."), F.lit(CUT))).alias("latitudes"), listed(cut).alias("accelerations"))


@query
def repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values rebuilt from tokens that lost a point or a digit, next to a neighbouring value."""
    frames = I.recording_frames(spark, sf_dir)
    lat, lon = F.col("lat"), F.col("lon")
    time = F.col("time").cast("double")
    return frames.select(
        "event_id",
        repair.repair_latitude(
            F.concat(F.substring(lat, 1, 1), F.lit(CUT), F.substring(lat, 3, 100)), lat.cast("double") + 0.000001
        ).alias("lat"),
        repair.repair_longitude(F.regexp_replace(lon, r"\.", CUT), lon.cast("double") - 0.000002).alias("lon"),
        repair.repair_speed(F.concat(F.format_string("%.2f", F.col("speed").cast("double")), F.lit(CUT))).alias("speed_ms"),
        repair.repair_time(F.regexp_replace("time", r"\.", CUT), time + 0.004).alias("timestamp_s"),
    )


# --- parity ------------------------------------------------------------------------------------------


def _both_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    left = _fact(spark, sf_dir)
    track = F.col("track_id")
    changed = left.filter(track % 23 != 0).withColumns(
        {
            "frame_count": F.when(track % 11 == 0, F.col("frame_count") + 1).otherwise(F.col("frame_count")),
            "duration_s": F.when(track % 7 == 0, F.col("duration_s") + 0.01).otherwise(F.col("duration_s") + 0.0000005),
            "vehicle_type": F.when(track % 17 == 0, "tram").otherwise(F.col("vehicle_type")),
            "max_speed_ms": F.when(track % 19 != 0, F.col("max_speed_ms")),
        }
    )
    extra = left.filter(track % 29 == 0).withColumn("source_file", F.concat(F.lit("extra_"), "source_file"))
    return left, changed.unionByName(extra)


@query
def parity_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.compare(*_both_sides(spark, sf_dir)).select(*S.TRACK_KEY, "kind", "field")


@query
def parity_first_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = parity_differences(spark, sf_dir).filter(F.col("kind") == "mismatch")
    return found.orderBy(*S.TRACK_KEY, "field").limit(parity.MISMATCHES_SHOWN)


@query
def parity_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.parity_totals(*_both_sides(spark, sf_dir))


@query
def parity_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and verdict of three comparisons: within the tolerance, beyond it, and with rows that one side lacks."""
    left = _fact(spark, sf_dir)
    cases = {
        "same": left.withColumn("duration_s", F.col("duration_s") + 0.0000005),
        "shifted": left.withColumn("duration_s", F.col("duration_s") + F.when(F.col("track_id") % 7 == 0, 0.01).otherwise(0.0)),
        "short": left.filter(F.col("track_id") % 23 != 0),
    }
    found = [parity.parity_totals(left, right).withColumn("case", F.lit(case)) for case, right in cases.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def parity_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen fields with a wide tolerance; a field that is listed neither as exact nor as float is unclassified."""
    left, right = _both_sides(spark, sf_dir)
    options = {"exact": ["frame_count"], "floats": ["duration_s", "max_speed_ms"], "tolerance": 0.02, "fields": ["frame_count", "duration_s", "max_speed_ms", "vehicle_type"]}
    return parity.compare(left, right, **options).select(*S.TRACK_KEY, "kind", "field")


@query
def parity_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that a side repeats, and how many of the three entry points refuse such sides."""
    fact = _fact(spark, sf_dir)
    twice = fact.unionByName(fact.filter(F.col("track_id") % 3 == 0)).unionByName(fact.filter(F.col("track_id") % 6 == 0))
    refused = 0
    for attempt in (lambda: parity.compare(twice, fact).count(), lambda: parity.parity_totals(fact, twice).collect(), lambda: parity.parity_report(fact, twice)):
        try:
            attempt()
        except Exception as error:  # noqa: BLE001 - what is refused is what this query shows
            refused += "duplicate key on the" in str(error)
    return parity.repeated_keys(fact, twice).withColumn("refused", F.lit(refused))


@query
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.missing_keys(*_both_sides(spark, sf_dir))


@query
def shared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.shared_keys(*_both_sides(spark, sf_dir))


# --- publishing --------------------------------------------------------------------------------------


def _next_batch(fact: DataFrame) -> DataFrame:
    """A later batch: two sources, all their tracks under new numbers."""
    changed = fact.filter(F.col("source_file").isin("click.csv", "view.csv"))
    return changed.withColumn("track_id", F.col("track_id") + 1_000_000)


def _publish_twice(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    target = scratch_path(spark, "serving")
    fact = _fact(spark, sf_dir)
    publish.publish(spark, fact, target, "first")
    for run_id in ("second", "second_again"):
        publish.publish(spark, _next_batch(fact), target, run_id, mode)
    return _steady(read_layer(spark, target, S.SUMMARY))


@query
def publish_replace_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _publish_twice(spark, sf_dir, publish.REPLACE_SOURCES)


@query
def publish_replace_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _publish_twice(spark, sf_dir, publish.REPLACE_SNAPSHOT)


@query
def publish_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that fails its checks leaves the target as it was."""
    target = scratch_path(spark, "serving")
    fact = _fact(spark, sf_dir)
    publish.publish(spark, fact, target, "good")
    publish.publish(spark, fact.withColumn("traveled_d_m", F.lit(-1.0)), target, "bad")
    return _steady(read_layer(spark, target, S.SUMMARY))


@query
def replace_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _fact(spark, sf_dir)
    return _steady(publish.replace_sources(fact, _next_batch(fact)))


@query
def published_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.published_sources(_fact(spark, sf_dir))


@query
def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames that arrived as files, published by the stream."""
    incoming, target = scratch_path(spark, "incoming"), scratch_path(spark, "serving")
    publish.write_by_source(I.raw_frames(spark, sf_dir).select(*S.names(S.FRAME)), incoming)
    stream_frames(spark, incoming, target, scratch_path(spark, "checkpoint")).awaitTermination()
    return _steady(read_layer(spark, target, S.SUMMARY))


@query
def publish_seen_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader of the target finds before a publish, when its rows are written, and after the switch. The batch replaces
    two sources and read a third one, which has no rows any more."""
    target, fact = scratch_path(spark, "serving"), _fact(spark, sf_dir)
    publish.publish(spark, fact, target, "first")

    def seen(phase: str) -> DataFrame:
        found = read_layer(spark, target, S.SUMMARY).groupBy("source_file")
        counted = found.agg(F.count(F.lit(1)).alias("tracks"), F.sum("frame_count").alias("frames"), F.min("track_id").alias("first_track"))
        path = scratch_path(spark, "seen")
        counted.withColumn("phase", F.lit(phase)).write.parquet(path)
        return spark.read.parquet(path)

    phases = [seen("before")]
    store, dataset = versions.store_of(spark, target)
    base = versions.state(spark, store)
    staged = publish.stage_batch(spark, _next_batch(fact), target, "second")
    phases.append(seen("written"))
    read = fact.filter(F.col("source_file").isin("click.csv", "view.csv", "purchase.csv")).select("source_file").distinct()
    versions.commit(spark, store, base, {dataset: (staged.version, staged.folder)}, read)
    phases.append(seen("switched"))
    return phases[0].unionByName(phases[1]).unionByName(phases[2])


@query
def storage_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and files of a stored summary, its bytes against a listing of the files, and the projection to 500,000 rows."""
    target = scratch_path(spark, "summary")
    publish.write_by_source(_fact(spark, sf_dir).repartition(1), target, gather=False)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(target)
    listing = listed.agg(F.sum("length").alias("listed")).first()["listed"]
    found = publish.storage_footprint(spark, target)
    near = F.abs(F.col("projected_bytes") - F.col("total_bytes") * publish.PROJECTED_ROWS / F.col("row_count")) <= 1
    return found.select("file_count", "row_count", (F.col("total_bytes") == listing).alias("bytes_as_listed"), near.alias("projected_in_proportion"))


@query
def declared_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored summary read through the catalog table that its DDL declares."""
    target = scratch_path(spark, "summary")
    publish.write_summary(spark, _fact(spark, sf_dir), target)
    table = "summary_" + target.rsplit("-", 1)[-1]
    spark.sql(publish.create_table_ddl(table, path=target))
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return _steady(spark.table(table).select(*S.names(S.SUMMARY)))


# --- loads from end to end ------------------------------------------------------------------------


def _write_recordings(texts: DataFrame, folder: str, named: str | None = None) -> None:
    """The records as text files; those of track 0 go to the file ``named``, if there is one."""
    rest = texts if named is None else texts.filter("track <> 0")
    rest.select("value").write.mode("append").text(folder)
    if named is None:
        return

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lines = [value for batch in batches for value in batch["value"]]
        if lines:
            storage, inner = filesystem_of(folder)
            attempt = f"{inner}/{named}.{TaskContext.get().taskAttemptId()}.tmp"
            with storage.open_output_stream(attempt) as stream:
                stream.write(("\n".join(lines) + "\n").encode())
            storage.move(attempt, f"{inner}/{named}")
        yield pd.DataFrame({"lines": [len(lines)]})

    # One record, so one task has all of the file.
    one = texts.filter("track = 0").select("value").mapInPandas(write, "lines int")
    one.agg(F.sum("lines")).collect()


def _load(spark: SparkSession, folder: str, layers: str, serving: str, run_id: str, **options):
    return load_recordings(spark, folder, layers, serving, run_id, skipHeader="false", suffix=".txt", **options)


def _served(spark: SparkSession, serving: str) -> DataFrame:
    """What is served; part files have no name that SQL could tell."""
    return _steady(read_layer(spark, serving, S.SUMMARY)).drop("source_file")


@query
def load_recordings_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings with cut lines, loaded twice: the second run changes nothing."""
    folder, layers, serving = (scratch_path(spark, name) for name in ("recordings", "layers", "serving"))
    _write_recordings(_recording_texts(spark, sf_dir), folder)
    for run_id in ("first", "again"):
        _load(spark, folder, layers, serving, run_id)
    return _served(spark, serving)


@query
def load_gate_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load with too many rejects, then a good one of other files: only the good one is served."""
    layers, serving = scratch_path(spark, "layers"), scratch_path(spark, "serving")
    faulty, good = scratch_path(spark, "faulty"), scratch_path(spark, "good")
    texts = _recording_texts(spark, sf_dir)
    broken = F.when(F.col("track") % 4 == 1, F.replace("value", F.lit(";"), F.lit(","))).otherwise(F.col("value"))
    _write_recordings(texts.filter("track % 2 = 1").withColumn("value", broken), faulty)
    _write_recordings(texts.filter("track % 2 = 0"), good)
    statuses = [_load(spark, folder, layers, serving, run_id).status for folder, run_id in ((faulty, "bad"), (good, "good"))]
    return _served(spark, serving).withColumn("statuses", F.lit(" ".join(statuses)))


@query
def load_emptied_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file that gave a track and now gives none loses it; files that were not read again keep theirs."""
    layers, serving = scratch_path(spark, "layers"), scratch_path(spark, "serving")
    before, after = scratch_path(spark, "before"), scratch_path(spark, "after")
    texts = _recording_texts(spark, sf_dir)
    damaged = F.when(F.col("track") == 0, F.regexp_replace("value", "^([^;]*;[^;]*;)[^;]*;", "$1 none;")).otherwise(F.col("value"))
    _write_recordings(texts.filter("track % 2 = 0"), before, "track0.txt")
    _write_recordings(texts.filter("track % 2 = 1 OR track = 0").withColumn("value", damaged), after, "track0.txt")
    first = _load(spark, before, layers, serving, "before")
    served_before = first.published.rows
    # Few records at a small scale: one reject may be more than the usual share.
    _load(spark, after, layers, serving, "after", max_reject_fraction=0.5)
    return _served(spark, serving).withColumn("served_before", F.lit(served_before).cast("bigint"))


def _write_files(texts: DataFrame, folder: str, header: bool = True) -> None:
    """The records as files called by the column ``file``, in the order of their tracks; a file is what fits into one task."""

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        storage, inner = filesystem_of(folder)
        target = f"{inner}/{rows['file'].iloc[0]}"
        storage.create_dir(target.rsplit("/", 1)[0])
        lines = ["track_id; type; traveled_d; avg_speed"] * header + rows.sort_values("track")["value"].dropna().tolist()
        attempt = f"{target}.{TaskContext.get().taskAttemptId()}.tmp"
        with storage.open_output_stream(attempt) as stream:
            stream.write(("\n".join(lines) + "\n").encode())
        storage.move(attempt, target)
        return pd.DataFrame({"file": [target], "lines": [len(lines)]})

    written = texts.select("file", "track", "value").groupBy("file").applyInPandas(write, "file string, lines long")
    written.write.parquet(scratch_path(spark=texts.sparkSession, label="written"))


#: Records of a file that arrives.
ARRIVING = 64


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the file they arrive in: five sources, each with a file in every folder. The third record of every file has a
    bad number; whole files come again in a folder of their own."""
    folder = F.floor(F.col("track") / ARRIVING)
    damaged = F.regexp_replace("value", "^([^;]*;[^;]*;)[^;]*;", "$1 none;")
    texts = _recording_texts(spark, sf_dir).withColumn("folder", folder)
    third = (F.col("track") % ARRIVING).between(10, 14)
    return texts.select(
        "folder", "track", F.concat(F.lit("part"), folder.cast("string"), F.lit("/rec"), (F.col("track") % 5).cast("string"), F.lit(".csv")).alias("file"),
        F.when(third, damaged).otherwise(F.col("value")).alias("value"),
    )


def _stream_three_times(spark: SparkSession, sf_dir: str) -> tuple[str, str, int]:
    """Half of the folders arrive, then the others, then a file whose records are all bad, beside a copy of an earlier one."""
    incoming, layers, serving, checkpoint = (scratch_path(spark, name) for name in ("incoming", "layers", "serving", "checkpoint"))
    texts = _arriving(spark, sf_dir)

    def run() -> None:
        # At a small scale, one reject may be more than the usual share.
        stream_recordings(spark, incoming, layers, serving, checkpoint, max_reject_fraction=0.5).awaitTermination()

    failed = 0
    _write_files(texts.filter("folder % 2 = 0"), incoming)
    run()
    _write_files(texts.filter("folder % 2 = 1"), incoming)
    run()
    again = texts.filter("folder = 0").withColumn("file", F.concat(F.lit("again/"), "file"))
    bad = texts.filter("folder = 0").select("folder", "track", F.concat(F.lit("bad/"), "file").alias("file"), F.replace("value", F.lit(";"), F.lit(",")).alias("value"))
    _write_files(again.filter("track % 5 < 3").unionByName(bad.filter("track % 5 = 4")), incoming)
    try:
        run()
    except StreamingQueryException:
        failed += 1
    return layers, serving, failed


@query
def stream_recordings_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is served after three runs of the stream: sources hold their late files, a batch with a bad file changed nothing."""
    layers, serving, failed = _stream_three_times(spark, sf_dir)
    served = read_layer(spark, serving, S.SUMMARY)
    files = read_layer(spark, f"{layers}/ledger", S.LEDGER).groupBy("source_file").agg(F.count(F.lit(1)).alias("file_count"))
    return _steady(served).join(files, "source_file").withColumn("failed_runs", F.lit(failed))


@query
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejects that three runs of the stream leave, with the file and the number of the record in it."""
    layers, _, _ = _stream_three_times(spark, sf_dir)
    rejects = read_layer(spark, f"{layers}/rejects", S.REJECT)
    return rejects.select("source_file", F.substring_index("path", "/", -2).alias("file"), "record_no", "track_id", "reason_code")


@query
def load_header_only_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five sources, of which two are then delivered with a header only and one with other records."""
    folder, again = scratch_path(spark, "recordings"), scratch_path(spark, "again")
    layers, serving = scratch_path(spark, "layers"), scratch_path(spark, "serving")
    name = F.concat(F.lit("rec"), (F.col("track") % 5).cast("string"), F.lit("/"), F.floor(F.col("track") / ARRIVING).cast("string"), F.lit(".csv"))
    texts = _recording_texts(spark, sf_dir).withColumn("file", name)
    _write_files(texts, folder)
    load_recordings(spark, folder, layers, serving, "first", label="path")
    gone = texts.filter("track % 5 < 2").withColumn("value", F.lit(None).cast("string"))
    _write_files(gone.unionByName(texts.filter("track % 5 = 2 AND track % 2 = 0")), again)
    load_recordings(spark, again, layers, serving, "again", label="path")
    return _steady(read_layer(spark, serving, S.SUMMARY))


@query
def nested_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one name in many folders, read by byte range and line by line, under their paths."""
    folder = scratch_path(spark, "recordings")
    _write_files(_arriving(spark, sf_dir), folder)
    by_range = frames_of(parse_records(read_records(spark, folder, label="path"))).withColumn("reader", F.lit("ranges"))
    by_line = frames_of(parse_records(assemble_records(read_lines(spark, folder, "path")))).withColumn("reader", F.lit("lines"))
    return by_range.unionByName(by_line)


@query
def archive_members_of_one_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives whose members share their names and differ in their folders, stored as they are or compressed; both readers."""
    archives = scratch_path(spark, "archives")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        storage, inner = filesystem_of(archives)
        storage.create_dir(inner)
        number = int(rows["folder"].iloc[0])
        attempt = f"{inner}/{number}.{TaskContext.get().taskAttemptId()}.tmp"
        packing = zipfile.ZIP_STORED if number % 2 else zipfile.ZIP_DEFLATED
        with storage.open_output_stream(attempt) as stream, zipfile.ZipFile(stream, "w", packing) as archive:
            for member, own in rows.sort_values("track").groupby("file"):
                archive.writestr(f"{member}", "\n".join(["header", *own["value"]]))
        storage.move(attempt, f"{inner}/{number}.zip")
        return pd.DataFrame({"folder": [number]})

    texts = _arriving(spark, sf_dir).withColumn("file", F.concat(F.lit("m"), (F.col("track") % 5).cast("string"), F.lit("/rec.csv")))
    texts.groupBy("folder").applyInPandas(pack, "folder long").write.parquet(scratch_path(spark, "written"))
    by_range = frames_of(parse_records(read_records(spark, archives, label="path"))).withColumn("reader", F.lit("ranges"))
    lines = read_archive_lines(spark, archives, label="path")
    by_line = frames_of(parse_records(assemble_records(lines))).withColumn("reader", F.lit("lines"))
    return by_range.unionByName(by_line)


def _load_three_times(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Files loaded as they come: half of them, then all, one in three of the first with fewer records, then nothing new."""
    folder, raw, log = (scratch_path(spark, name) for name in ("recordings", "raw", "runs"))
    name = F.concat(F.lit("rec"), (F.col("track") % 5).cast("string"), F.lit("_"), F.col("folder").cast("string"), F.lit(".csv"))
    texts = _arriving(spark, sf_dir).withColumn("file", name)
    runs_made = []
    _write_files(texts.filter("folder % 2 = 0"), folder)
    runs_made.append(load_new_files(spark, folder, raw, log).withColumn("run", F.lit(1)))
    shorter = texts.filter(f"folder % 6 = 0 AND track % {ARRIVING} < 32")
    _write_files(texts.filter("folder % 2 = 1").unionByName(shorter), folder)
    runs_made.append(load_new_files(spark, folder, raw, log).withColumn("run", F.lit(2)))
    runs_made.append(load_new_files(spark, folder, raw, log).withColumn("run", F.lit(3)))
    return raw, runs_made[0].unionByName(runs_made[1]).unionByName(runs_made[2])


@query
def new_files_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log of three loads of a folder: what was new or changed, what was skipped, and the rows of each."""
    return _load_three_times(spark, sf_dir)[1].select("run", "source_file", "status", "rows_loaded", "rows_rejected")


@query
def new_files_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer after the same loads: changed files have their new rows only."""
    raw, log = _load_three_times(spark, sf_dir)
    hashes = log.filter("status = 'success'").groupBy("source_file").agg(F.max(F.struct("run", "file_hash"))["file_hash"].alias("last_hash"))
    rows = read_layer(spark, raw, S.RAW).join(hashes, "source_file")
    return rows.select(*S.names(S.FRAME), (F.col("file_hash") == F.col("last_hash")).alias("of_last_content"))


@query
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows: parsed frames stamped with their origin and the time of the run."""
    stamped = with_provenance(repair_frames(spark, sf_dir), "bronze/recordings.zip", datetime.datetime(2024, 1, 2, tzinfo=datetime.timezone.utc))
    return stamped.withColumn("ingested_at", F.unix_micros("ingested_at"))


@query
def exported_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary written as JSON lines and read again."""
    folder = scratch_path(spark, "export")
    publish.export_json(_fact(spark, sf_dir), folder)
    return _steady(spark.read.schema(S.SUMMARY).json(folder))


@query
def repair_accelerations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accelerations whose line ended behind the second decimal; beyond the bound of repairs there is none."""
    value = F.format_string("%.2f", F.col("lon_acc").cast("double"))
    rebuilt = repair.repair_acceleration(F.concat(value, F.lit(CUT)))
    return I.recording_frames(spark, sf_dir).select("event_id", value.cast("double").alias("plain"), rebuilt.alias("repaired"))


# --- run log -----------------------------------------------------------------------------------------


@query
def stage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_runs(I.run_log(spark, sf_dir))


@query
def failed_without_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.expr("TIMESTAMP_NTZ'2000-01-01 00:00:00'")
    return runs.failed_without_rerun(I.run_log(spark, sf_dir), as_of, hours=4000)


@query
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.pending_files(I.candidate_files(spark, sf_dir), I.run_log(spark, sf_dir))


@query
def loaded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.loaded_files(I.candidate_files(spark, sf_dir), I.run_log(spark, sf_dir))


# --- URLs --------------------------------------------------------------------------------------------


@query
def object_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "pages").select("page_id", object_name(F.col("url")).alias("object_name"))


@query
def safe_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "pages").select("page_id", safe_url(F.col("url")).alias("safe_url"))
