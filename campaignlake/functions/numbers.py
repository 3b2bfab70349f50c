"""Rounding, safe ratios and number parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def percent(part: Column, whole: Column, digits: int | None = None, half_even: bool = False) -> Column:
    """`100 * part / whole` as a double, null for an empty whole.

    Rounds half away from zero like SQL, or half to even like data-frame libraries.
    """
    value = F.try_divide(F.lit(100.0) * part, whole.cast("double"))
    if digits is None:
        return value
    return F.bround(value, digits) if half_even else F.round(value, digits)


def ratio(part: Column, whole: Column, empty: float | None = None) -> Column:
    """Double division; `empty` (or null) where the denominator is zero."""
    value = F.try_divide(part.cast("double"), whole.cast("double"))
    return value if empty is None else F.coalesce(value, F.lit(empty))


def to_number(column: Column, errors: str = "raise", dtype: str = "double") -> Column:
    """Parse to a number; `raise` fails the job on bad text, `coerce` gives null."""
    if errors == "raise":
        return column.cast(dtype)
    if errors == "coerce":
        return column.try_cast(dtype)
    raise ValueError(f"errors must be 'raise' or 'coerce', got {errors!r}")


def fail_when(condition: Column, message: str | Column, otherwise: Column, dtype: str) -> Column:
    """`otherwise`, but the job fails with `message` on a row where `condition` holds."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(condition, F.raise_error(text).cast(dtype)).otherwise(otherwise)


def fail_rows(df: DataFrame, condition: Column, message: str | Column) -> DataFrame:
    """`df`, but the job fails with `message` on a row where `condition` holds.

    The check is a filter, so it runs whichever columns a later step reads.
    """
    text = F.lit(message) if isinstance(message, str) else message
    return df.where(F.when(condition, F.raise_error(text).cast("boolean")).otherwise(F.lit(True)))
