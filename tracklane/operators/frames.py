"""Logical records to frames and rejects, without a shuffle.

Every record is judged as a whole inside one row: its values sit in arrays until the verdict is
known, and only accepted records are spread into one row per frame.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane import schemas as S
from tracklane.functions.lines import CUT, join_physical_lines, strip, unquoted_fields, without_cuts
from tracklane.functions.numbers import normalise_speed, to_number
from tracklane.functions.repair import repair_cut_fields
from tracklane.operators.records import range_keys, with_offsets
from tracklane.session import scratch_path

WIDTH = S.FRAME_FIELDS
HEADER = S.HEADER_FIELDS
# Only digits, signs, points and blanks after the vehicle type. Such a record needs no look at single
# fields: its numbers are read in one go, as a JSON array.
_PLAIN = r'^[0-9 \t]*;[^;"\x00]*;[0-9+\-.eE; \t]*\z'
_JSON = {"allowNumericLeadingZeros": "true"}


def parse_records(records: DataFrame, speed_unit: str = "ms") -> DataFrame:
    """One row per record: its header, its frames as an array, and why it was rejected (null if not)."""
    kept = [c for c in records.columns if c != "text"]
    joined = records.select(*kept, join_physical_lines(F.col("text")).alias("text"))
    text = joined.select(*kept, repair_cut_fields(F.col("text")).alias("text"))
    read = text.withColumn("at_once", F.when(F.col("text").rlike(_PLAIN), _numbers_at_once(F.col("text"))))
    clean = F.col("at_once").isNotNull()
    fields = F.when(clean, F.split(F.substring_index("text", ";", HEADER), ";")).otherwise(_fields(F.col("text")))
    split = read.select(*kept, "at_once", clean.alias("clean"), fields.alias("fields"))
    last_blank = F.get("fields", F.size("fields") - 1) == ""
    sized = split.withColumn(
        "width",
        F.when(F.col("clean"), F.size("at_once") + HEADER).otherwise(
            F.size("fields") - F.when(last_blank, 1).otherwise(0)
        ),
    ).withColumn(
        "tokens",
        F.when(~F.col("clean"), F.slice("fields", F.lit(HEADER + 1), F.greatest(F.col("width") - HEADER, F.lit(0)))),
    )
    track_token = strip(F.get("fields", F.lit(0)))
    values = F.when(F.col("clean"), F.col("at_once")).otherwise(_numbers_one_by_one(F.col("tokens")))
    typed = sized.select(
        *kept,
        "clean",
        "width",
        "tokens",
        track_token.alias("track_token"),
        track_token.try_cast("int").alias("track_id"),
        strip(without_cuts(F.get("fields", F.lit(1)))).alias("vehicle_type"),
        to_number(without_cuts(F.get("fields", F.lit(2)))).alias("traveled_d_m"),
        to_number(without_cuts(F.get("fields", F.lit(3)))).alias("avg_speed_ms"),
        values.alias("values"),
    ).withColumn("frame_count", F.floor((F.col("width") - HEADER) / WIDTH).cast("int"))
    step = F.get("values", F.lit(2 * WIDTH - 1)) - F.get("values", F.lit(WIDTH - 1))
    framed = typed.withColumn("step", step).withColumn(
        "frames", F.when(_well_formed(), _frames(F.col("values"), F.col("frame_count"), speed_unit))
    )
    judged = framed.withColumn("verdict", _verdict())
    # Filters on a column are pushed below the projection that computes it, and would then repeat the
    # whole parse once per mention. They cannot pass a generator, so the result goes through one.
    result = F.struct(
        "track_token",
        "track_id",
        "vehicle_type",
        "traveled_d_m",
        normalise_speed(F.col("avg_speed_ms"), speed_unit).alias("avg_speed_ms"),
        "frames",
        F.col("verdict.reason_code").alias("reason_code"),
        F.col("verdict.detail").alias("detail"),
    )
    return judged.select(*kept, F.inline_outer(F.array(result)))


def frames_of(parsed: DataFrame) -> DataFrame:
    """One row per frame of every accepted record."""
    return (
        parsed.filter(F.col("reason_code").isNull())
        .select("source_file", "track_id", "vehicle_type", "traveled_d_m", "avg_speed_ms", F.inline("frames"))
        .select(*S.names(S.FRAME))
    )


def judged_parts(parsed: DataFrame) -> DataFrame:
    """One row per part of a file: its records ``n``, the first number in it and its rejects ``bad``. Stored, so that records are
    parsed once for whatever is asked of them."""
    bad = F.struct("seq", F.col("track_token").alias("track_id"), "reason_code", "detail")
    parts = parsed.groupBy(*range_keys(parsed), "block").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), F.collect_list(F.when(F.col("reason_code").isNotNull(), bad)).alias("bad")
    )
    path = scratch_path(parsed.sparkSession, "rejects")
    parts.write.parquet(path)
    return parsed.sparkSession.read.schema(parts.schema).parquet(path)


def rejects_in(parts: DataFrame) -> DataFrame:
    """One row per reject in judged parts, with its number in its file (``record_no``, from 1, over all records).

    Numbers are prefix sums over the parts' counts, so they do not depend on how files are cut.
    """
    keys = range_keys(parts)
    offsets = with_offsets(parts.drop("bad"), keys)
    placed = parts.filter(F.size("bad") > 0).drop("n", "first_seq").join(offsets, [*keys, "block"])
    found = placed.select(*keys, "offset", "first_seq", F.inline("bad"))
    number = F.col("offset") + F.col("seq") - F.col("first_seq") + 1
    file = F.col("path") if "path" in keys else F.lit(None).cast("string").alias("path")
    return found.select("source_file", file, number.alias("record_no"), "track_id", "reason_code", "detail")


def rejects_of(parsed: DataFrame) -> DataFrame:
    """One row per rejected record."""
    return rejects_in(judged_parts(parsed))


def worst_reject_fraction(parts: DataFrame) -> float:
    """The largest share of rejects in a single file."""
    files = parts.groupBy(*range_keys(parts)).agg((F.sum(F.size("bad")) / F.sum("n")).alias("share"))
    return files.agg(F.max("share")).first()[0] or 0.0


def with_provenance(frames: DataFrame, bronze_key: str, ingested_at: datetime.datetime) -> DataFrame:
    """Silver rows: the frames stamped with where they came from and one time for the whole run."""
    return frames.withColumn("bronze_key", F.lit(bronze_key)).withColumn(
        "ingested_at", F.lit(ingested_at).cast("timestamp")
    ).select(*S.names(S.SILVER))


def parse_counts(parsed: DataFrame) -> DataFrame:
    """Accepted records, distinct tracks, frames and rejected records, in one row."""
    accepted = F.col("reason_code").isNull()
    per_track = parsed.groupBy("source_file", F.when(accepted, F.col("track_id")).alias("track_id")).agg(
        F.count_if(accepted).alias("accepted"),
        F.sum(F.when(accepted, F.size("frames").cast("bigint"))).alias("frames"),
        F.count_if(~accepted).alias("rejected"),
    )
    return per_track.agg(
        F.coalesce(F.sum("accepted"), F.lit(0)).alias("record_count"),
        F.count("track_id").alias("track_count"),
        F.coalesce(F.sum("frames"), F.lit(0)).alias("frame_count"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected_count"),
    )


def _numbers_at_once(text: Column) -> Column:
    """All numbers after the header; null if a single one is missing or wrong."""
    header = F.length(F.substring_index(text, ";", HEADER)) + 1
    trimmed = F.rtrim(text)
    ending = F.when(trimmed.endswith(";"), 1).otherwise(0)
    body = F.substring(trimmed, header + 1, F.length(trimmed) - header - ending)
    listed = F.concat(F.lit("["), F.replace(body, F.lit(";"), F.lit(",")), F.lit("]"))
    return F.from_json(listed, "array<double>", _JSON)


def _fields(text: Column) -> Column:
    fields = F.when(text.contains('"'), unquoted_fields(text)).otherwise(F.split(text, ";"))
    return F.transform(fields, strip)


def _numbers_one_by_one(tokens: Column) -> Column:
    """Doubles for the frame tokens; null where a token is empty, damaged or no number."""
    return F.transform(tokens, lambda t: F.when(~t.contains(CUT), to_number(t)))


def _bad_token() -> Column:
    """Array position of the first token that is neither a number nor damaged, null if none."""
    positions = F.sequence(F.lit(0), F.size("tokens") - 1)
    bad = F.filter(positions, lambda k: F.get("values", k).isNull() & ~F.get("tokens", k).contains(CUT))
    return F.when(~F.col("clean") & (F.size("tokens") > 0), F.get(bad, 0))


def _well_formed() -> Column:
    """Wide enough, a whole number of frames, and a track number: the frames can be built."""
    return (
        (F.col("width") >= HEADER + WIDTH)
        & ((F.col("width") - HEADER) % WIDTH == 0)
        & F.col("track_id").isNotNull()
    )


def _frames(values: Column, count: Column, speed_unit: str) -> Column:
    def frame(i: Column) -> Column:
        at = i * WIDTH
        return F.struct(
            F.get(values, at).alias("lat"),
            F.get(values, at + 1).alias("lon"),
            normalise_speed(F.get(values, at + 2), speed_unit).alias("speed_ms"),
            F.get(values, at + 3).alias("lon_acc_ms2"),
            F.get(values, at + 4).alias("lat_acc_ms2"),
            F.get(values, at + 5).alias("timestamp_s"),
        )

    return F.transform(F.sequence(F.lit(0), count - 1), frame)


def _verdict() -> Column:
    """Why a record is rejected, as struct(reason_code, detail); null reason for an accepted one.

    The reasons are tried in a fixed order, so a record always reports the first that applies.
    """
    frames, count = F.col("frames"), F.col("frame_count")
    inside = lambda f: f["lat"].between(S.LAT_MIN, S.LAT_MAX) & f["lon"].between(S.LON_MIN, S.LON_MAX)
    speed_ok = lambda f: (f["speed_ms"] >= 0) & (f["speed_ms"] < F.lit(float("inf")))
    bad_frame = F.exists(frames, lambda f: ~(inside(f) & speed_ok(f)))
    outside = F.array_position(F.transform(frames, inside), F.lit(False))
    bad_speed = F.array_position(F.transform(frames, speed_ok), F.lit(False))

    step = F.col("step")
    tolerance = F.greatest(F.abs(step) * 0.01, F.lit(1e-6))

    def drift(i: Column) -> Column:
        at = i * WIDTH
        return F.abs((F.get("values", at + (WIDTH - 1)) - F.get("values", at - 1)) - step)

    # NaN is above every bound, infinity included, and counts as even.
    uneven = lambda i: (drift(i) > tolerance) & (drift(i) <= F.lit(float("inf")))
    steps = F.when(count >= 2, F.sequence(F.lit(1), count - 1))
    bad_token = _bad_token()
    empty_in_frame = F.exists(
        F.slice("tokens", F.floor(bad_token / WIDTH).cast("int") * WIDTH + 1, F.lit(WIDTH)), lambda t: t == ""
    )

    def reject(code: str, detail: Column) -> Column:
        return F.struct(F.lit(code).alias("reason_code"), detail.cast("string").alias("detail"))

    nothing = F.lit(None).cast("string")
    return (
        F.when(F.col("seq") == 0, reject("preamble", nothing))
        .when(F.col("width").isNull(), reject("no_text", nothing))
        .when(F.col("width") < HEADER + WIDTH, reject("too_few_fields", F.col("width")))
        .when((F.col("track_token") == "") | F.col("track_token").contains(CUT), reject("damaged_track_id", nothing))
        .when(F.col("track_id").isNull(), reject("bad_track_id", F.col("track_token")))
        .when(F.col("traveled_d_m").isNull() | F.col("avg_speed_ms").isNull(), reject("bad_header_number", nothing))
        .when((F.col("width") - HEADER) % WIDTH != 0, reject("bad_frame_width", F.col("width") - HEADER))
        .when(
            bad_token.isNotNull(),
            F.when(empty_in_frame, reject("empty_field", F.floor(bad_token / WIDTH))).otherwise(
                reject("bad_number", F.get("tokens", bad_token))
            ),
        )
        .when(
            ~F.col("clean") & F.exists("values", lambda v: v.isNull()),
            reject("unrepairable_field", F.array_position(F.transform("values", lambda v: v.isNull()), F.lit(True)) - 1),
        )
        .when((count >= 2) & (step <= 0), reject("non_positive_step", step))
        .when(F.exists(steps, uneven), reject("uneven_step", F.get(F.filter(steps, uneven), 0)))
        .when(
            bad_frame,
            F.when((outside > 0) & ((bad_speed == 0) | (outside <= bad_speed)), reject("outside_area", outside - 1)).otherwise(
                reject("bad_speed", bad_speed - 1)
            ),
        )
        .otherwise(reject(None, nothing))
    )
