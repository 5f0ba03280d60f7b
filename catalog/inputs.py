"""Trajectory data derived from the given tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane import schemas as S

TYPES = [" Car", "MOTORCYCLE ", "Taxi", "bus", "Medium Vehicle ", " heavy vehicle"]
TYPES_SQL = "[" + ", ".join(f"'{t}'" for t in TYPES) + "]"
RAW_TYPES_SQL = "[" + ", ".join(f"'{t}'" for t in S.RAW_VEHICLE_TYPES) + "]"
# Frames per derived record.
FRAMES = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def _seconds(ts: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})") / F.lit(1e6)


def raw_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw frames, one per event: a track per event type and user."""
    user, event = F.col("user_id"), F.col("event_id")
    size = F.length("event_type")
    return table(spark, sf_dir, "events").select(
        event.alias("id"),
        F.concat("event_type", F.lit(".csv")).alias("source_file"),
        F.sha2(F.col("event_type"), 256).alias("file_hash"),
        user.cast("int").alias("track_id"),
        _pick(TYPES, user % 6).alias("vehicle_type"),
        ((user * 37 + size * 11) / F.lit(8.0)).alias("traveled_d_m"),
        ((user * 13 + size) / F.lit(16.0)).alias("avg_speed_ms"),
        (F.lit(37.9) + (event % 200000) / F.lit(1e6)).alias("lat"),
        (F.lit(23.6) + (event % 300000) / F.lit(1e6)).alias("lon"),
        F.col("value").alias("speed_ms"),
        ((F.col("value") - 20) / F.lit(7.0)).alias("lon_acc_ms2"),
        ((F.col("value") - 10) / F.lit(9.0)).alias("lat_acc_ms2"),
        _seconds("ts").alias("timestamp_s"),
        F.col("ts").alias("ingested_at"),
    )


RAW_SQL = f"""
select event_id as id, event_type || '.csv' as source_file, sha256(event_type) as file_hash,
  cast(user_id as integer) as track_id,
  {TYPES_SQL}[cast(user_id % 6 as integer) + 1] as vehicle_type,
  (user_id * 37 + length(event_type) * 11) / 8::double as traveled_d_m,
  (user_id * 13 + length(event_type)) / 16::double as avg_speed_ms,
  37.9::double + (event_id % 200000) / 1e6::double as lat,
  23.6::double + (event_id % 300000) / 1e6::double as lon,
  value as speed_ms,
  (value - 20) / 7::double as lon_acc_ms2, (value - 10) / 9::double as lat_acc_ms2,
  epoch_us(ts) / 1e6::double as timestamp_s, ts as ingested_at
from events"""


def dirty_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw frames with missing, out-of-range and unknown values mixed in."""
    raw = raw_frames(spark, sf_dir)
    n = F.col("id")
    null = F.lit(None)
    return raw.select(
        *[c for c in raw.columns if c not in ("vehicle_type", "lat", "lon", "speed_ms")],
        F.when(n % 211 == 0, null).when(n % 83 == 0, F.lit("Bicycle")).otherwise(F.col("vehicle_type")).alias("vehicle_type"),
        F.when(n % 101 == 0, null).when(n % 97 == 0, F.lit(38.5)).otherwise(F.col("lat")).alias("lat"),
        F.when(n % 103 == 0, F.lit(23.0)).otherwise(F.col("lon")).alias("lon"),
        F.when(n % 89 == 0, -F.col("speed_ms") - 1).otherwise(F.col("speed_ms")).alias("speed_ms"),
    ).select(*raw.columns)


DIRTY_SQL = f"""
select id, source_file, file_hash, track_id,
  case when id % 211 = 0 then null when id % 83 = 0 then 'Bicycle' else vehicle_type end as vehicle_type,
  traveled_d_m, avg_speed_ms,
  case when id % 101 = 0 then null when id % 97 = 0 then 38.5::double else lat end as lat,
  case when id % 103 = 0 then 23.0::double else lon end as lon,
  case when id % 89 = 0 then -speed_ms - 1 else speed_ms end as speed_ms,
  lon_acc_ms2, lat_acc_ms2, timestamp_s, ingested_at
from ({RAW_SQL})"""


def tied_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw frames whose times are cut to ten days, so that first and last moments repeat."""
    cut = F.floor(F.col("timestamp_s") / 864000) * F.lit(864000.0)
    return raw_frames(spark, sf_dir).withColumn("timestamp_s", cut)


TIED_SQL = f"select * replace (floor(timestamp_s / 864000) * 864000::double as timestamp_s) from ({RAW_SQL})"


def lineitem_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second shape: a track per order and return flag, a frame per line."""
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", F.lit(".csv")).alias("source_file"),
        order.cast("int").alias("track_id"),
        _pick(TYPES, order % 6).alias("vehicle_type"),
        (order / F.lit(8.0)).alias("traveled_d_m"),
        ((order % 50) / F.lit(4.0)).alias("avg_speed_ms"),
        (F.lit(37.9) + (part % 200000) / F.lit(1e6)).alias("lat"),
        (F.lit(23.6) + (F.col("l_suppkey") % 300000) / F.lit(1e6)).alias("lon"),
        F.col("l_quantity").alias("speed_ms"),
        (F.col("l_extendedprice") / F.lit(7000.0)).alias("lon_acc_ms2"),
        (F.col("l_discount") - F.col("l_tax")).alias("lat_acc_ms2"),
        F.col("l_linenumber").cast("double").alias("timestamp_s"),
    )


LINEITEM_SQL = f"""
select l_returnflag || '.csv' as source_file, cast(l_orderkey as integer) as track_id,
  {TYPES_SQL}[cast(l_orderkey % 6 as integer) + 1] as vehicle_type,
  l_orderkey / 8::double as traveled_d_m, (l_orderkey % 50) / 4::double as avg_speed_ms,
  37.9::double + (l_partkey % 200000) / 1e6::double as lat,
  23.6::double + (l_suppkey % 300000) / 1e6::double as lon,
  l_quantity as speed_ms, l_extendedprice / 7000::double as lon_acc_ms2, l_discount - l_tax as lat_acc_ms2,
  cast(l_linenumber as double) as timestamp_s
from lineitem"""


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load attempt per order."""
    status = F.col("o_orderstatus")
    failed = status == "F"
    null = F.lit(None)
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.lit("load").alias("dag_id"),
        F.lit("load_files").alias("task_id"),
        F.concat(F.lit("file"), F.col("o_custkey").cast("string"), F.lit(".csv")).alias("source_file"),
        F.concat(F.lit("h"), (F.col("o_orderkey") % 3).cast("string")).alias("file_hash"),
        F.when(failed, "failed").when(status == "O", "success").otherwise("skipped").alias("status"),
        F.when(failed, null).otherwise(F.col("o_orderkey") % 1000).alias("rows_loaded"),
        F.when(failed, null).otherwise(F.col("o_orderkey") % 7).alias("rows_rejected"),
        F.when(failed, F.col("o_orderpriority")).alias("error_message"),
        F.col("o_orderdate").alias("started_at"),
        F.col("o_orderdate").alias("finished_at"),
        F.round(F.col("o_totalprice") / 1000, 3).alias("duration_s"),
    )


RUNS_SQL = """
select 'run-' || o_orderkey as run_id, 'load' as dag_id, 'load_files' as task_id,
  'file' || o_custkey || '.csv' as source_file, 'h' || (o_orderkey % 3) as file_hash,
  case o_orderstatus when 'F' then 'failed' when 'O' then 'success' else 'skipped' end as status,
  case when o_orderstatus = 'F' then null else o_orderkey % 1000 end as rows_loaded,
  case when o_orderstatus = 'F' then null else o_orderkey % 7 end as rows_rejected,
  case when o_orderstatus = 'F' then o_orderpriority end as error_message,
  o_orderdate as started_at, o_orderdate as finished_at,
  cast(round(cast(cast(o_totalprice / 1000 as varchar) as decimal(38,15)), 3) as double) as duration_s
from orders"""


def candidate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files a loader may find: one per customer, with content hashes that partly match the run log."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("file"), key.cast("string"), F.lit(".csv")).alias("source_file"),
        F.concat(F.lit("h"), (key % 4).cast("string")).alias("file_hash"),
    )


CANDIDATES_SQL = "select 'file' || c_custkey || '.csv' as source_file, 'h' || (c_custkey % 4) as file_hash from customer"


def recording_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One frame per event as text fields; every ``FRAMES`` events in a row are one record."""
    event = F.col("event_id")
    track, index = F.floor(event / FRAMES), (event % FRAMES).cast("int")
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        event,
        F.concat(F.lit("rec"), (track % 5).cast("string"), F.lit(".csv")).alias("source_file"),
        track.alias("track"),
        index.alias("idx"),
        _pick(S.RAW_VEHICLE_TYPES, track % 6).alias("type"),
        (track * 3 / F.lit(8.0)).cast("string").alias("distance"),
        ((track % 100) / F.lit(16.0)).cast("string").alias("mean"),
        (F.lit(37.9) + (event % 200000) / F.lit(1e6)).cast("string").alias("lat"),
        (F.lit(23.6) + (event % 300000) / F.lit(1e6)).cast("string").alias("lon"),
        value.cast("string").alias("speed"),
        ((value - 20) / F.lit(7.0)).alias("a").cast("string").alias("lon_acc"),
        ((value - 10) / F.lit(9.0)).alias("b").cast("string").alias("lat_acc"),
        F.format_string("%.6f", index * 4 / F.lit(100.0)).alias("time"),
    )


RECORDING_SQL = f"""
select event_id, event_id // {FRAMES} as track, event_id % {FRAMES} as idx,
  'rec' || ((event_id // {FRAMES}) % 5) || '.csv' as source_file,
  cast(event_id // {FRAMES} as integer) as track_id,
  {RAW_TYPES_SQL}[cast((event_id // {FRAMES}) % 6 as integer) + 1] as vehicle_type,
  (event_id // {FRAMES}) * 3 / 8::double as traveled_d_m,
  ((event_id // {FRAMES}) % 100) / 16::double as avg_speed_ms,
  37.9::double + (event_id % 200000) / 1e6::double as lat,
  23.6::double + (event_id % 300000) / 1e6::double as lon,
  value as speed_ms, (value - 20) / 7::double as lon_acc_ms2, (value - 10) / 9::double as lat_acc_ms2,
  ((event_id % {FRAMES}) * 4) / 100::double as timestamp_s
from events"""


def _header() -> Column:
    fields = F.concat_ws("; ", F.col("track").cast("string"), "type", "distance", "mean")
    return F.when(F.col("idx") == 0, F.concat(fields, F.lit(";"))).otherwise(F.lit(""))


def broken_text(frames: DataFrame) -> DataFrame:
    """Add ``text``: the frame with line feeds where physical lines end.

    Depending on the event, the line ends before a ";", after one, in place of one, inside the speed, or
    inside the latitude in place of its point or its second digit. Some times lose their point as well.
    Every damage here has one reading only: a latitude cut without loss is read as whatever lies nearest
    to its neighbour, and a speed beyond the repair limit as nothing, so neither is cut that way.
    """
    fast = F.col("speed").cast("double") > S.REPAIRED_SPEED_MAX
    style = F.when((F.col("event_id") % 7 == 4) & fast, 1).otherwise(F.col("event_id") % 7)
    lat, speed = F.col("lat"), F.col("speed")
    cut_speed = F.concat(F.substring(speed, 1, 1), F.lit("\n"), F.substring(speed, 2, 100))
    rest = F.concat(
        F.concat_ws("; ", "lon", F.when(style == 4, cut_speed).otherwise(speed), "lon_acc", "lat_acc"),
        F.lit("; "),
        F.when(F.col("event_id") % 11 == 5, F.regexp_replace("time", r"\.", "\n")).otherwise(F.col("time")),
        F.lit(";"),
    )
    start = (
        F.when(style == 1, F.concat(lat, F.lit("\n; ")))
        .when(style == 2, F.concat(lat, F.lit(";\n ")))
        .when(style == 3, F.concat(lat, F.lit("\n ")))
        .when(style == 5, F.concat(F.regexp_replace(lat, r"\.", "\n"), F.lit("; ")))
        .when(style == 6, F.concat(F.substring(lat, 1, 1), F.lit("\n"), F.substring(lat, 3, 100), F.lit("; ")))
        .otherwise(F.concat(lat, F.lit("; ")))
    )
    return frames.withColumn("text", F.concat(_header(), F.lit(" "), start, rest))


def physical_lines(texts: DataFrame) -> DataFrame:
    """``lines(source_file, block, pos, line)``; parts end in the middle of records."""
    return texts.select(
        "source_file",
        F.floor(F.col("event_id") / 512).alias("block"),
        "event_id",
        F.posexplode(F.split("text", "\n")).alias("part", "line"),
    ).select("source_file", "block", (F.col("event_id") * 8 + F.col("part")).alias("pos"), "line")


def faulty_frames(frames: DataFrame) -> DataFrame:
    """Recording frames in which some tracks hold one fault."""
    kind, idx = F.col("track") % 13, F.col("idx")
    return frames.select(
        "event_id",
        "source_file",
        "track",
        "idx",
        "type",
        F.when(F.col("track") % 17 == 1, "abc").otherwise(F.col("distance")).alias("distance"),
        "mean",
        F.when((kind == 9) & (idx == 4), "39.5").otherwise(F.col("lat")).alias("lat"),
        F.when((kind == 5) & (idx == 2), "").otherwise(F.col("lon")).alias("lon"),
        F.when((kind == 7) & (idx == 3), "-1").when((kind == 1) & (idx == 6), "x.y").otherwise(F.col("speed")).alias("speed"),
        F.when((kind == 3) & (idx == 1), F.concat("lon_acc", F.lit("; 0"))).otherwise(F.col("lon_acc")).alias("lon_acc"),
        "lat_acc",
        F.when((kind == 11) & (idx == 5), "7.5").otherwise(F.col("time")).alias("time"),
    )


FAULT_SQL = """case when track % 13 = 3 and track % 17 <> 1 then 'bad_frame_width'
  when track % 17 = 1 then 'bad_header_number'
  when track % 13 = 5 then 'empty_field' when track % 13 = 1 then 'bad_number'
  when track % 13 = 11 then 'uneven_step' when track % 13 = 9 then 'outside_area'
  when track % 13 = 7 then 'bad_speed' end"""


def plain_text(frames: DataFrame) -> DataFrame:
    fields = F.concat_ws("; ", "lat", "lon", "speed", "lon_acc", "lat_acc", "time")
    return frames.withColumn("text", F.concat(_header(), F.lit(" "), fields, F.lit(";")))
