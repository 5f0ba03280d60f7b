"""Rebuild numbers that were cut at the end of a physical line.

A cut number may have lost its decimal point or one digit. The right reading depends on values of
nearby frames, earlier repairs included, so a record is repaired as a whole, in order. That is the one
Python step of the parse, and only records with a cut field enter it: as nested array expressions the
same rules cost over a millisecond per field in the JVM and make the plan too slow to analyse. The candidates of a
single token are a column function without Python.
"""

from __future__ import annotations

import csv
import io
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklane import schemas as S
from tracklane.functions.lines import CUT

# How many frames away a neighbour, or a time to count steps from, may be.
NEIGHBOUR_REACH = 19
TIME_REACH = 49
WIDTH = S.FRAME_FIELDS
_BOUNDS = {0: (S.LAT_MIN, S.LAT_MAX), 1: (S.LON_MIN, S.LON_MAX)}
_LIMITS = {
    2: (0.0, S.REPAIRED_SPEED_MAX),
    3: (-S.REPAIRED_ACCELERATION_MAX, S.REPAIRED_ACCELERATION_MAX),
    4: (-S.REPAIRED_ACCELERATION_MAX, S.REPAIRED_ACCELERATION_MAX),
}
_TIME = 5


def candidates(token: str) -> list[str]:
    """Distinct texts a cut token may stand for, in order of preference: joined as it is, with a point
    at the cut, with a digit at the cut, with a digit in front."""
    left, _, right = token.partition(CUT)
    right = right.replace(CUT, "")
    sign = "-" if left.startswith("-") else ""
    point = [] if "." in left + right else [f"{left}.{right}"]
    inside = [f"{left}{digit}{right}" for digit in range(10)]
    in_front = [f"{sign}{digit}{left.removeprefix(sign)}{right}" for digit in range(10)]
    return list(dict.fromkeys([left + right, *point, *inside, *in_front]))


def readings(token: str, low: float, high: float) -> Iterator[float]:
    """The candidates that are numbers between the bounds."""
    for text in candidates(token):
        try:
            value = float(text)
        except ValueError:
            continue
        if low <= value <= high:
            yield value


def closest(values: Iterable[float], target: float) -> float | None:
    reachable = [v for v in values if abs(v - target) < math.inf]
    return min(reachable, key=lambda v: abs(v - target), default=None)


def rebuild(token: str, field: int, context: float | None) -> float | None:
    """The value of a cut token of a frame field, or None.

    ``context`` is a neighbouring value for a coordinate and the expected value for a time.
    """
    if field in _LIMITS:
        return next(readings(token, *_LIMITS[field]), None)
    if context is None:
        low, high = _BOUNDS.get(field, (0.0, S.REPAIRED_TIME_MAX))
        return next(readings(token, low, high), None)
    low, high = _BOUNDS.get(field, (0.0, math.inf))
    best = closest(readings(token, low, high), context)
    if field == _TIME and best is not None and abs(best - context) > abs(context) * 0.001 + 1.0:
        return None
    return best


def repair_record(text: str) -> str:
    """Record text with its cut frame fields rebuilt; a field that cannot be rebuilt keeps its mark."""
    fields = _split(text)
    body = [f.strip() for f in fields[S.HEADER_FIELDS :]]
    if body and not body[-1]:
        body.pop()
    if not body or len(body) % WIDTH:
        return text
    try:
        known = np.array([math.nan if CUT in t else float(t) for t in body]).reshape(-1, WIDTH)
    except ValueError:
        return text
    cut = np.array([CUT in t for t in body]).reshape(-1, WIDTH)
    step = _typical_step(known[:, _TIME], ~cut[:, _TIME])
    for frame, field in np.argwhere(cut).tolist():
        at = frame * WIDTH + field
        value = rebuild(body[at], field, _context(known[:, field], ~cut[:, field], frame, field, step))
        if value is None:
            return text
        known[frame, field], cut[frame, field] = value, False
        fields[S.HEADER_FIELDS + at] = repr(float(value))
    return _join(fields, quoted='"' in text)


def _context(values: np.ndarray, usable: np.ndarray, frame: int, field: int, step: float | None) -> float | None:
    if field in _LIMITS or (field == _TIME and step is None):
        return None
    near = _nearest_usable(usable, frame, TIME_REACH if field == _TIME else NEIGHBOUR_REACH)
    if near is None:
        return None
    away = (frame - near) * step if field == _TIME else 0.0
    return float(values[near] + away)


def _nearest_usable(usable: np.ndarray, frame: int, reach: int) -> int | None:
    """The closest usable frame before this one, else the closest after it."""
    first = max(0, frame - reach)
    before = np.flatnonzero(usable[first:frame])
    if before.size:
        return first + int(before[-1])
    after = np.flatnonzero(usable[frame + 1 : frame + 1 + reach])
    return frame + 1 + int(after[0]) if after.size else None


def _typical_step(times: np.ndarray, usable: np.ndarray) -> float | None:
    """Upper median of the positive time steps between usable frames, per frame of distance."""
    at = np.flatnonzero(usable)
    steps = np.diff(times[at]) / np.diff(at)
    steps = np.sort(steps[steps > 0])
    return float(steps[len(steps) // 2]) if len(steps) else None


def _split(text: str) -> list[str]:
    if '"' not in text:
        return text.split(";")
    csv.field_size_limit(2**31 - 1)
    return next(csv.reader([text], delimiter=";"))


def _join(fields: list[str], quoted: bool) -> str:
    if not quoted:
        return ";".join(fields)
    out = io.StringIO()
    csv.writer(out, delimiter=";", lineterminator="").writerow(fields)
    return out.getvalue()


# --- column functions --------------------------------------------------------------------------------


@F.pandas_udf(T.StringType())
def _repair_records(texts: pd.Series) -> pd.Series:
    return texts.map(repair_record, na_action="ignore")


def repair_cut_fields(text: Column) -> Column:
    """Rebuild the cut fields of record texts; other texts pass by without a copy to Python."""
    return F.coalesce(_repair_records(F.when(text.contains(CUT), text)), text)


def boundary_candidates(token: Column) -> Column:
    """``candidates`` of a token column, inside the JVM."""
    left = F.substring_index(token, CUT, 1)
    right = F.replace(F.substring(token, F.length(left) + 2, F.length(token)), F.lit(CUT), F.lit(""))
    plain = F.concat(left, right)
    minus = left.startswith("-")
    sign, rest = F.when(minus, "-").otherwise(""), F.when(minus, F.substring(left, 2, F.length(left))).otherwise(left)
    # Without a candidate of its own, the point repeats the plain one.
    point = F.when(plain.contains("."), plain).otherwise(F.concat(left, F.lit("."), right))
    inside = [F.concat(left, F.lit(str(d)), right) for d in range(10)]
    in_front = [F.concat(sign, F.lit(str(d)), rest, right) for d in range(10)]
    return F.array_distinct(F.array(plain, point, *inside, *in_front))


def _rebuilt(token: Column, context: Column, field: int) -> Column:
    """``rebuild`` over Arrow batches. As array expressions the choice among 22 numbers took more than four times as long."""

    @F.pandas_udf(T.DoubleType())
    def rebuilt(tokens: pd.Series, contexts: pd.Series) -> pd.Series:
        pairs = zip(tokens, contexts.astype(object).where(contexts.notna(), None))
        return pd.Series([rebuild(t, field, c) for t, c in pairs], dtype="float64")

    return rebuilt(token, context)


def repair_latitude(token: Column, neighbour: Column) -> Column:
    return _rebuilt(token, neighbour, 0)


def repair_longitude(token: Column, neighbour: Column) -> Column:
    return _rebuilt(token, neighbour, 1)


def repair_speed(token: Column) -> Column:
    return _rebuilt(token, F.lit(None).cast("double"), 2)


def repair_acceleration(token: Column) -> Column:
    return _rebuilt(token, F.lit(None).cast("double"), 3)


def repair_time(token: Column, expected: Column) -> Column:
    return _rebuilt(token, expected, _TIME)
