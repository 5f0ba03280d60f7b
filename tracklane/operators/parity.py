"""Field-by-field comparison of two datasets on a key, with a tolerance for floats."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklane import schemas as S
from tracklane.session import scratch_path

MISMATCHES_SHOWN = 20
KEYS_SHOWN = 10
_SIDES = (("left", "l_rows"), ("right", "r_rows"))


def compare(
    left: DataFrame,
    right: DataFrame,
    keys: list[str] = S.TRACK_KEY,
    exact: list[str] = S.SUMMARY_EXACT,
    floats: list[str] = S.SUMMARY_FLOATS,
    tolerance: float = S.PARITY_TOLERANCE,
    fields: list[str] | None = None,
) -> DataFrame:
    """``(keys…, kind, field, left_value, right_value, delta)``, one row per difference.

    ``kind`` is missing_in_right, missing_in_left, mismatch, or unclassified for a differing field that
    is listed neither as exact nor as float. A key that a side repeats stops the job with an error that names it.
    """
    found = _differences(left, right, keys, exact, floats, tolerance, fields)
    return _unique(align(left, right, keys), keys).select(*keys, F.inline(F.filter(found, lambda d: d["differs"]))).drop("differs")


def align(left: DataFrame, right: DataFrame, keys: list[str] = S.TRACK_KEY) -> DataFrame:
    """One row per key: a row of each side (``l``, ``r``; null where it has none) and how many it has (``l_rows``, ``r_rows``).

    Each side is read once; the exchange that brings its keys together serves the join as well.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.first(F.struct(*df.columns)).alias(name), F.count(F.lit(1)).alias(f"{name}_rows"))

    joined = side(left, "l").join(side(right, "r"), keys, "full_outer")
    return joined.fillna(0, ["l_rows", "r_rows"])


def repeated_keys(left: DataFrame, right: DataFrame, keys: list[str] = S.TRACK_KEY) -> DataFrame:
    """``(keys…, side, row_count)`` of every key that a side has more than once."""
    sides = F.array(*[F.struct(F.lit(name).alias("side"), F.col(rows).alias("row_count")) for name, rows in _SIDES])
    return align(left, right, keys).select(*keys, F.inline(sides)).where("row_count > 1")


def _unique(aligned: DataFrame, keys: list[str]) -> DataFrame:
    """The aligned rows; the first key found twice on a side is an error."""
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    checked = F.col("l_rows")
    for name, rows in _SIDES:
        message = F.concat(F.lit(f"duplicate key on the {name} side: "), shown)
        checked = F.when(F.col(rows) > 1, F.raise_error(message)).otherwise(checked)
    return aligned.withColumn("l_rows", checked.cast("bigint"))


def _differences(
    left: DataFrame, right: DataFrame, keys: list[str], exact: list[str], floats: list[str], tolerance: float, fields: list[str] | None
) -> Column:
    """All that may differ in an aligned row, as an array; ``differs`` tells what does."""
    if fields is None:
        fields = [c for c in left.columns if c not in keys]
    differences = []
    for name in fields:
        a, b = _side(left, "l", name), _side(right, "r", name)
        if name in floats:
            differs, kind = _floats_differ(a, b, left, right, name, tolerance), "mismatch"
        else:
            differs, kind = _values_differ(a, b, left, right, name), "mismatch" if name in exact else "unclassified"
        differences.append(
            _difference(
                differs, kind, name, a.cast("string"), b.cast("string"), F.abs(_as_double(a, left, name) - _as_double(b, right, name))
            )
        )
    here, there = F.col("l").isNotNull(), F.col("r").isNotNull()
    nothing = F.lit(None)
    unique = F.col("l_rows") <= 1  # read, so that the check of it is not pruned
    return F.array(
        _difference(here & ~there & unique, "missing_in_right", None, nothing, nothing, nothing),
        _difference(there & ~here & unique, "missing_in_left", None, nothing, nothing, nothing),
        *[_both(d, here & there & unique) for d in differences],
    )


def missing_keys(left: DataFrame, right: DataFrame, keys: list[str] = S.TRACK_KEY) -> DataFrame:
    """Keys of ``left`` that ``right`` lacks."""
    return left.select(*keys).distinct().join(right.select(*keys), keys, "left_anti")


def shared_keys(left: DataFrame, right: DataFrame, keys: list[str] = S.TRACK_KEY) -> DataFrame:
    return left.select(*keys).intersect(right.select(*keys))


def parity_totals(
    left: DataFrame,
    right: DataFrame,
    keys: list[str] = S.TRACK_KEY,
    exact: list[str] = S.SUMMARY_EXACT,
    floats: list[str] = S.SUMMARY_FLOATS,
    tolerance: float = S.PARITY_TOLERANCE,
    fields: list[str] | None = None,
) -> DataFrame:
    """One row: rows per side, keys compared, each kind of difference, and the verdict, from one join. Raises as ``compare``."""
    found = _differences(left, right, keys, exact, floats, tolerance, fields)
    kinds = F.transform(F.filter(found, lambda d: d["differs"]), lambda d: d["kind"])
    return _totals(_unique(align(left, right, keys), keys).select("l_rows", "r_rows", kinds.alias("kinds")))


def _totals(judged: DataFrame) -> DataFrame:
    total = lambda value, name: F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias(name)
    having = lambda *kinds: F.size(F.filter("kinds", lambda k: k.isin(*kinds)))
    merged = judged.agg(
        total("l_rows", "left_rows"),
        total("r_rows", "right_rows"),
        total(having("missing_in_right"), "missing_in_right"),
        total(having("missing_in_left"), "missing_in_left"),
        total(having("mismatch", "unclassified"), "field_mismatches"),
    )
    clean = (F.col("missing_in_right") + F.col("missing_in_left") + F.col("field_mismatches")) == 0
    return merged.select(
        "*",
        (F.col("left_rows") - F.col("missing_in_right")).alias("compared_keys"),
        (clean & (F.col("left_rows") == F.col("right_rows"))).alias("passed"),
    )


@dataclass
class ParityReport:
    totals: dict
    mismatches: list = field(default_factory=list)
    missing_in_right: list = field(default_factory=list)
    missing_in_left: list = field(default_factory=list)

    @property
    def passed(self) -> bool:
        return self.totals["passed"]

    def summary(self) -> str:
        lines = [f"parity: {'PASSED' if self.passed else 'FAILED'}"]
        lines += [f"  {name}: {value}" for name, value in self.totals.items() if name != "passed"]
        lines += [f"  differs  {tuple(r)}" for r in self.mismatches]
        lines += [f"  only left  {tuple(r)}" for r in self.missing_in_right]
        lines += [f"  only right {tuple(r)}" for r in self.missing_in_left]
        return "\n".join(lines)


def parity_report(left: DataFrame, right: DataFrame, keys: list[str] = S.TRACK_KEY, **options) -> ParityReport:
    """Totals and the first differences in key order. Raises when a side repeats a key."""
    spark = left.sparkSession
    # Five questions below go to the same join: align once, store what it found, ask the stored rows.
    found = _differences(left, right, keys, **({"exact": S.SUMMARY_EXACT, "floats": S.SUMMARY_FLOATS, "tolerance": S.PARITY_TOLERANCE, "fields": None} | options))
    aligned = align(left, right, keys)
    stored = scratch_path(spark, "differences")
    aligned.select(*keys, "l_rows", "r_rows", F.filter(found, lambda d: d["differs"]).alias("found")).where("l_rows <> 1 OR r_rows <> 1 OR size(found) > 0").write.parquet(stored)
    odd = spark.read.parquet(stored)
    for side, rows in _SIDES:
        repeated = odd.where(F.col(rows) > 1).select(*keys).orderBy(*keys).limit(1).collect()
        if repeated:
            raise ValueError(f"duplicate key on the {side} side: {tuple(repeated[0])}")
    differences = odd.select(*keys, F.inline("found"))

    def first(kinds: list[str], columns: list[str], count: int) -> list:
        found = differences.filter(F.col("kind").isin(kinds)).select(*columns)
        return found.orderBy(*columns[: len(keys) + 1]).limit(count).collect()

    return ParityReport(
        parity_totals(left, right, keys, **options).first().asDict(),
        first(["mismatch", "unclassified"], [*keys, "field", "left_value", "right_value"], MISMATCHES_SHOWN),
        first(["missing_in_right"], keys, KEYS_SHOWN),
        first(["missing_in_left"], keys, KEYS_SHOWN),
    )


def _side(df: DataFrame, side: str, name: str) -> Column:
    return F.col(f"{side}.{name}") if name in df.columns else F.lit(None).cast("string")


def _type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType if name in df.columns else T.StringType()


def _as_double(value: Column, df: DataFrame, name: str) -> Column:
    return value.try_cast("double") if isinstance(_type(df, name), (T.NumericType, T.StringType)) else F.lit(None).cast("double")


def _floats_differ(a: Column, b: Column, left: DataFrame, right: DataFrame, name: str, tolerance: float) -> Column:
    delta = F.abs(_as_double(a, left, name) - _as_double(b, right, name))
    # NaN is unlike everything, itself included; so is text that is no number.
    close = F.coalesce((delta <= tolerance) & ~F.isnan(delta), F.lit(False))
    return F.when(a.isNull() & b.isNull(), F.lit(False)).otherwise(~close)


def _values_differ(a: Column, b: Column, left: DataFrame, right: DataFrame, name: str) -> Column:
    kinds = [_type(left, name), _type(right, name)]
    if all(isinstance(k, T.NumericType) for k in kinds):
        same = a.eqNullSafe(b)
        for value, kind in zip((a, b), kinds):
            if isinstance(kind, (T.DoubleType, T.FloatType)):
                same = same & ~F.coalesce(F.isnan(value), F.lit(False))
        return ~same
    if kinds[0] == kinds[1]:
        return ~a.eqNullSafe(b)
    return a.isNotNull() | b.isNotNull()


def _difference(differs: Column, kind: str, name: str | None, a: Column, b: Column, delta: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        F.lit(name).cast("string").alias("field"),
        a.cast("string").alias("left_value"),
        b.cast("string").alias("right_value"),
        delta.cast("double").alias("delta"),
        differs.alias("differs"),
    )


def _both(difference: Column, aligned: Column) -> Column:
    return difference.withField("differs", difference["differs"] & aligned)
