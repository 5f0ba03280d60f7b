"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that both Python and the JVM read as a number; the JVM alone also takes "1.0d" and hex floats.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
NAMED_NUMBER = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*$"


def round_half_up(value: Column, places: int) -> Column:
    """Round half away from zero on the value cut to eight decimals, as a DECIMAL(20, 8) would.

    Going through a decimal costs more than the rest of a frame scan. Away from a tie the scaled value
    already tells which way to go, and dividing two exact integers gives the same nearest double, so
    only values near a tie and very large ones take the slow way.
    """
    scale = F.lit(float(10**places))
    scaled = value * scale
    nearest = F.floor(scaled + F.lit(0.5))
    # The cut moves a value by at most half a unit in the eighth decimal.
    near_tie = 0.5 - 6e-9 * 10**places - 1e-6
    certain = (F.abs(scaled) < F.lit(1e9)) & (F.abs(scaled - nearest) < F.lit(near_tie))
    exact = F.round(value.try_cast("decimal(20,8)"), places).cast("double")
    return F.when(certain, nearest / scale).otherwise(F.coalesce(exact, F.round(value, places)))


def to_number(text: Column) -> Column:
    """Strict text to double: null unless the whole text is a number."""
    named = F.trim(F.lower(text))
    return (
        F.when(text.rlike(NUMBER), text.try_cast("double"))
        .when(named.rlike("nan$") & text.rlike(NAMED_NUMBER), F.lit(float("nan")))
        .when(text.rlike(NAMED_NUMBER), F.when(named.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    )


def normalise_speed(value: Column, unit: str) -> Column:
    """Speeds in m/s. ``unit`` says what the source holds."""
    if unit == "ms":
        return value
    if unit == "kmh":
        return value / F.lit(3.6)
    raise ValueError(f"speed unit must be 'ms' or 'kmh', got {unit!r}")
