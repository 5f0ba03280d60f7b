"""Data-quality checks: every row-level check of a dataset is one aggregate of a single pass."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklane import schemas as S

PASSED, FAILED, WARNING, SKIPPED = "passed", "failed", "warning", "skipped"


@dataclass(frozen=True)
class Check:
    """``observed`` is an aggregate; ``passes`` tells from it whether the data is good.

    With ``keys``, what is observed is how many rows repeat the key of another one.
    """

    name: str
    observed: Column | None
    passes: Callable[[Column], Column]
    expected: str
    warn_only: bool = False
    on_empty: bool = False
    keys: tuple[str, ...] = ()


def none_where(name: str, violation: Column, warn_only: bool = False) -> Check:
    return Check(name, F.count_if(violation), lambda n: n == 0, "0", warn_only)


def above_zero(name: str, observed: Column) -> Check:
    return Check(name, observed, lambda n: n > 0, "> 0", on_empty=True)


def equals(name: str, observed: Column, expected: int) -> Check:
    return Check(name, observed, lambda n: n == expected, str(expected))


def not_null(*columns: str) -> list[Check]:
    return [none_where(f"not_null_{c}", F.col(c).isNull()) for c in columns]


def unique(name: str, *columns: str) -> Check:
    """Rows beyond the first of each value; rows with a null in the value do not count."""
    return Check(name, None, lambda n: n == 0, "0", keys=columns)


def repeats(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row: how many rows repeat the value of another one.

    Values move as two hashes, so a row of the shuffle is four numbers however wide the key is. Rows are counted per first
    hash; where the second one differs, two values share the first, and both are counted as values of their own.
    """
    known = df.where(F.lit(True) if not columns else ~F.greatest(*[F.col(c).isNull() for c in columns], F.lit(False)))
    hashed = known.select(F.xxhash64(*columns).alias("h"), F.xxhash64(F.lit("second"), *columns).alias("g"))
    values = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("g").alias("low"), F.max("g").alias("high"))
    more = F.col("n") - F.when(F.col("low") == F.col("high"), 1).otherwise(2)
    return values.agg(F.coalesce(F.sum(more), F.lit(0)).alias("repeated"))


def accepted_values(column: str, values: list[str]) -> Check:
    return none_where(f"accepted_{column}", F.col(column).isNotNull() & ~F.col(column).isin(values))


def blank(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def outside(column: str, low: float, high: float) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """``(check, status, observed, expected, detail)`` for each check.

    All aggregates come from one pass over the data; a check of keys takes another one over its columns. On an empty dataset
    only the checks that speak about emptiness run; the others are skipped.
    """
    observed = [c.observed.cast("double").alias(f"observed_{i}") for i, c in enumerate(checks) if not c.keys]
    totals = df.agg(F.count(F.lit(1)).alias("row_total"), *observed)
    keyed = [repeats(df, c.keys).select(F.col("repeated").cast("double").alias(f"observed_{i}")) for i, c in enumerate(checks) if c.keys]
    if keyed:
        for part in keyed:
            totals = totals.unionByName(part, allowMissingColumns=True)
        # One row an aggregate; each has columns of its own.
        totals = totals.agg(*[F.max(c).alias(c) for c in totals.columns])

    def row(i: int, check: Check) -> Column:
        value = F.col(f"observed_{i}")
        good = F.coalesce(check.passes(value), F.lit(False))
        verdict = F.when(good, PASSED).otherwise(WARNING if check.warn_only else FAILED)
        if not check.on_empty:
            verdict = F.when(F.col("row_total") == 0, SKIPPED).otherwise(verdict)
        detail = F.when(verdict == FAILED, F.concat(F.lit("expected "), F.lit(check.expected)))
        return F.struct(
            F.lit(check.name).alias("check"),
            verdict.alias("status"),
            value.alias("observed"),
            F.lit(check.expected).alias("expected"),
            detail.alias("detail"),
        )

    return totals.select(F.inline(F.array(*[row(i, c) for i, c in enumerate(checks)])))


def schema_checks(spark: SparkSession, actual: T.StructType, contract: T.StructType) -> DataFrame:
    """Column names with their order, and column types, against the contract. Reads no data."""
    missing = sorted(set(contract.names) - set(actual.names))
    extra = sorted(set(actual.names) - set(contract.names))
    same_names = actual.names == contract.names
    names_detail = None if same_names else f"missing: {missing}, extra: {extra}"
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, got {actual[f.name].dataType.simpleString()}"
        for f in contract.fields
        if f.name in actual.names and actual[f.name].dataType != f.dataType
    ]
    rows = [
        ("schema_names", PASSED if same_names else FAILED, float(len(missing) + len(extra)), "contract", names_detail),
        ("schema_types", FAILED if wrong else PASSED, float(len(wrong)), "contract", "; ".join(wrong) or None),
    ]
    return spark.createDataFrame(rows, "check string, status string, observed double, expected string, detail string")


def frame_checks(expected_row_count: int | None = None) -> list[Check]:
    """Silver frames."""
    checks = [above_zero("row_count_positive", F.count(F.lit(1)))]
    if expected_row_count is not None:
        checks.append(equals("expected_row_count", F.count(F.lit(1)), expected_row_count))
    measures = ["lat", "lon", "speed_ms", "lon_acc_ms2", "lat_acc_ms2", "timestamp_s"]
    return [
        *checks,
        *not_null(*S.names(S.SILVER)),
        none_where("latitude_in_bounds", outside("lat", S.LAT_MIN, S.LAT_MAX)),
        none_where("longitude_in_bounds", outside("lon", S.LON_MIN, S.LON_MAX)),
        none_where("speed_non_negative", F.col("speed_ms") < 0),
        none_where("source_file_populated", blank("source_file")),
        none_where("bronze_key_populated", blank("bronze_key")),
        above_zero("source_files_present", F.count_distinct("source_file")),
        *[none_where(f"nan_{c}", F.isnan(c), warn_only=True) for c in measures],
    ]


def summary_checks(
    expected_trajectory_count: int | None = None, expected_frame_sum: int | None = None
) -> list[Check]:
    """Gold trajectory summary."""
    checks = [above_zero("row_count_positive", F.count(F.lit(1)))]
    if expected_trajectory_count is not None:
        checks.append(equals("expected_row_count", F.count(F.lit(1)), expected_trajectory_count))
    if expected_frame_sum is not None:
        checks.append(equals("frames_conserved", F.sum("frame_count"), expected_frame_sum))
    return [
        *checks,
        *not_null(*S.names(S.SUMMARY)),
        unique("grain_unique", *S.TRACK_KEY),
        none_where("frame_count_positive", F.col("frame_count") < 1),
        none_where("time_order", F.col("start_time_s") > F.col("end_time_s")),
        none_where("duration_non_negative", F.col("duration_s") < 0),
        none_where("distance_non_negative", F.col("traveled_d_m") < 0),
        none_where("speed_non_negative", (F.col("min_speed_ms") < 0) | (F.col("max_speed_ms") < 0)),
        none_where("source_file_populated", blank("source_file")),
    ]


def serving_checks(expected_row_count: int | None = None, expected_frame_sum: int | None = None) -> list[Check]:
    """Staged rows before they are published."""
    rows = F.count(F.lit(1))
    checks = [
        above_zero("row_count_positive", rows),
        Check("grain_unique", rows - F.count_distinct(F.struct(*S.TRACK_KEY)), lambda n: n == 0, "0"),
        Check("frame_count_positive", F.coalesce(F.min("frame_count"), F.lit(0)), lambda n: n > 0, "> 0"),
        none_where("duration_non_negative", F.col("duration_s") < 0),
        none_where("distance_non_negative", F.col("traveled_d_m") < 0),
        none_where("speed_non_negative", (F.col("min_speed_ms") < 0) | (F.col("max_speed_ms") < 0)),
        none_where("time_order", F.col("start_time_s") > F.col("end_time_s")),
        none_where("grain_not_null", F.col("source_file").isNull() | F.col("track_id").isNull()),
    ]
    if expected_row_count is not None:
        checks.append(equals("expected_row_count", rows, expected_row_count))
    if expected_frame_sum is not None:
        total = F.coalesce(F.sum("frame_count"), F.lit(0))
        checks.append(equals("expected_frame_sum", total, expected_frame_sum))
    return checks


def column_checks(layer: str) -> list[Check]:
    """Per-column tests of a layer: not-null, unique and accepted values."""
    if layer == "raw":
        return [
            *not_null(*S.names(S.RAW)),
            unique("unique_id", "id"),
            accepted_values("vehicle_type", S.RAW_VEHICLE_TYPES),
            *raw_range_checks(),
        ]
    if layer == "staging":
        return [
            *not_null("raw_id", "source_file", *S.names(S.FRAME)[1:]),
            unique("unique_raw_id", "raw_id"),
            accepted_values("vehicle_type", S.VEHICLE_TYPES),
        ]
    if layer == "summary":
        return [*not_null(*S.names(S.SUMMARY)), unique("grain_unique", *S.TRACK_KEY)]
    if layer == "fact":
        return [
            *not_null(*S.names(S.SUMMARY)),
            accepted_values("vehicle_type", S.VEHICLE_TYPES),
            unique("grain_unique", *S.TRACK_KEY),
            none_where("frame_count_positive", F.col("frame_count") < 1),
            none_where("duration_non_negative", F.col("duration_s") < 0),
            none_where("distance_non_negative", F.col("traveled_d_m") < 0),
        ]
    if layer == "vehicle_type_dim":
        return [*not_null(*S.names(S.VEHICLE_TYPE_DIM)), unique("unique_vehicle_type", "vehicle_type")]
    if layer == "serving":
        return not_null("source_file", "track_id", "vehicle_type", "frame_count")
    if layer == "runs":
        return [
            *not_null("run_id", "status", "started_at"),
            unique("unique_run_id", "run_id"),
            accepted_values("status", S.RUN_STATUSES),
        ]
    raise ValueError(f"unknown layer {layer!r}")


def raw_range_checks() -> list[Check]:
    return [
        none_where(
            "coordinates_valid",
            outside("lat", S.LAT_MIN, S.LAT_MAX) | outside("lon", S.LON_MIN, S.LON_MAX),
        ),
        none_where("speed_non_negative", F.col("speed_ms") < 0),
    ]


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def check_frames_conserved(frames: DataFrame, summary: DataFrame) -> DataFrame:
    """Usable frames against the frame total of the summary, and how many frames staging dropped."""
    from tracklane.operators.staging import has_required

    nothing = F.lit(0).cast("bigint")
    both = frames.agg(F.count_if(has_required()).alias("usable"), F.count_if(~has_required()).alias("dropped")).select(
        "usable", "dropped", nothing.alias("summed")
    ).unionByName(
        summary.agg(F.coalesce(F.sum("frame_count"), F.lit(0)).alias("summed")).select(
            nothing.alias("usable"), nothing.alias("dropped"), "summed"
        )
    )
    totals = both.agg(*[F.sum(c).alias(c) for c in ("usable", "dropped", "summed")])
    return totals.select(
        F.lit("frames_conserved").alias("check"),
        F.when(F.col("usable") == F.col("summed"), PASSED).otherwise(FAILED).alias("status"),
        F.col("summed").cast("double").alias("observed"),
        F.col("usable").cast("string").alias("expected"),
        F.concat(F.col("dropped").cast("string"), F.lit(" frames without a required value")).alias("detail"),
    )


def check_rejects(parsed_counts: DataFrame, max_fraction: float = S.MAX_REJECT_FRACTION) -> DataFrame:
    """Share of rejected records, from the counts of ``parse_counts``."""
    total = F.col("rejected_count") + F.col("record_count")
    share = F.when(total > 0, F.col("rejected_count") / total).otherwise(F.lit(0.0))
    return parsed_counts.select(
        F.lit("reject_fraction").alias("check"),
        F.when(share <= max_fraction, PASSED).otherwise(FAILED).alias("status"),
        share.alias("observed"),
        F.lit(f"<= {max_fraction}").alias("expected"),
        F.concat(F.col("rejected_count").cast("string"), F.lit(" of "), total.cast("string")).alias("detail"),
    )


def check_published(serving: DataFrame, batch: DataFrame) -> DataFrame:
    """Serving rows of the batch's sources against the batch: rows, frames, unique grain, not empty."""
    scope = serving.join(batch.select("source_file").distinct(), "source_file", "left_semi")

    def sums(df: DataFrame, side: int) -> DataFrame:
        return (
            df.groupBy(*S.TRACK_KEY)
            .agg(F.count(F.lit(1)).alias("n"), F.sum("frame_count").alias("frames"))
            .agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                F.count(F.lit(1)).alias("grain"),
                F.coalesce(F.sum("frames"), F.lit(0)).alias("frames"),
            )
            .withColumn("side", F.lit(side))
        )

    def side(column: str, number: int) -> Column:
        return F.max(F.when(F.col("side") == number, F.col(column)))

    totals = sums(scope, 0).unionByName(sums(batch, 1)).agg(
        *[side(c, n).alias(f"{c}_{n}") for c in ("rows", "grain", "frames") for n in (0, 1)]
    )
    outcomes = [
        ("serving_rows_positive", F.col("rows_0") > 0, "rows_0", F.lit("> 0")),
        ("serving_rows_eq_summary", F.col("rows_0") == F.col("rows_1"), "rows_0", F.col("rows_1").cast("string")),
        ("serving_frames_eq_summary", F.col("frames_0") == F.col("frames_1"), "frames_0", F.col("frames_1").cast("string")),
        ("grain_unique", F.col("grain_0") == F.col("rows_0"), "grain_0", F.col("rows_0").cast("string")),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            F.when(good, PASSED).otherwise(FAILED).alias("status"),
            F.col(value).cast("double").alias("observed"),
            expected.alias("expected"),
            F.lit(None).cast("string").alias("detail"),
        )
        for name, good, value, expected in outcomes
    ]
    return totals.select(F.inline(F.array(*rows)))


def check_same_row_count(name: str, actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Row counts of two datasets, for example fact and serving, or read-back and written."""
    sides = actual.agg(F.count(F.lit(1)).alias("n"), F.lit(0).alias("side")).unionByName(
        expected.agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("side"))
    )
    totals = sides.agg(
        F.max(F.when(F.col("side") == 0, F.col("n"))).alias("a"), F.max(F.when(F.col("side") == 1, F.col("n"))).alias("e")
    )
    return totals.select(
        F.lit(name).alias("check"),
        F.when(F.col("a") == F.col("e"), PASSED).otherwise(FAILED).alias("status"),
        F.col("a").cast("double").alias("observed"),
        F.col("e").cast("string").alias("expected"),
        F.lit(None).cast("string").alias("detail"),
    )


@dataclass
class CheckReport:
    """Check rows of one dataset, brought to the driver: a few dozen at most."""

    dataset: str
    rows: list = field(default_factory=list)

    def named(self, status: str) -> list[str]:
        return [r["check"] for r in self.rows if r["status"] == status]

    @property
    def passed(self) -> bool:
        return bool(self.rows) and not self.named(FAILED)

    def observed(self, check: str):
        return next((r["observed"] for r in self.rows if r["check"] == check), None)

    def summary(self) -> str:
        head = f"{self.dataset}: {'PASSED' if self.passed else 'FAILED'}"
        return "\n".join([head] + [f"  {r['status']:<8}{r['check']}: {r['observed']} ({r['expected']})" for r in self.rows])


def report(dataset: str, results: DataFrame) -> CheckReport:
    return CheckReport(dataset, results.collect())


def validate_dataset(
    spark: SparkSession, path: str, contract: T.StructType, checks: list[Check]
) -> CheckReport:
    """Read a stored layer and check it: readable, schema, then all row-level checks in one pass.

    An unreadable dataset gives one failed check and skips the others instead of raising.
    """
    shape = "check string, status string, observed double, expected string, detail string"
    try:
        df = _read_stored(spark, path)
    except Exception as error:  # noqa: BLE001 - any read error is the finding
        rows = [("readable", FAILED, None, "readable", str(error))]
        rows += [(c.name, SKIPPED, None, c.expected, None) for c in checks]
        return report(path, spark.createDataFrame(rows, shape))
    # Partition columns come back last, and Parquet forgets the declared order of the layer.
    if set(df.columns) == set(contract.names):
        df = df.select(*contract.names)
    readable = spark.createDataFrame([("readable", PASSED, 1.0, "readable", None)], shape)
    results = readable.unionByName(schema_checks(spark, df.schema, contract))
    present = [c for c in checks if _resolves(df, c)]
    absent = [(c.name, SKIPPED, None, c.expected, "column missing") for c in checks if c not in present]
    results = results.unionByName(run_checks(df, present))
    if absent:
        results = results.unionByName(spark.createDataFrame(absent, shape))
    return report(path, results)


def _read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The layer as stored, except that folder names of sources are text even if they look like numbers."""
    df = spark.read.parquet(path)
    kind = dict(df.dtypes).get("source_file")
    if kind in (None, "string") or not any("/source_file=" in f for f in df.inputFiles()[:1]):
        return df
    fields = [T.StructField(f.name, T.StringType() if f.name == "source_file" else f.dataType) for f in df.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _resolves(df: DataFrame, check: Check) -> bool:
    try:
        (df.select(*check.keys) if check.keys else df.agg(check.observed)).schema  # noqa: B018 - analysis only, no job
    except Exception:  # noqa: BLE001
        return False
    return True
