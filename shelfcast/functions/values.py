"""Scalar and aggregate expressions whose NULL rules differ from plain SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
BELOW_DETECTION = r"^<0.1"
BELOW_DETECTION_STRICT = r"^<0\.1$"


def number(text: Column) -> Column:
    """Text to double; NULL for anything but decimal or scientific notation, and for overflow."""
    trimmed = F.trim(text)
    value = F.when(trimmed.rlike(DECIMAL_TEXT), trimmed.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def lab_number(text: Column, strict: bool = False) -> Column:
    """Lab result text to double, a leading ``<0.1`` (below detection) read as 0.

    By default only the *prefix* is replaced, so ``<0.15`` becomes ``05`` = 5; ``strict``
    replaces nothing but the whole text ``<0.1``.
    """
    pattern = BELOW_DETECTION_STRICT if strict else BELOW_DETECTION
    return number(F.regexp_replace(text, pattern, "0"))


def is_unexpected_missing(text: Column, value: Column, strict: bool = False) -> Column:
    """True where a lab text gave no number and is not a below-detection marker (NULL text: True)."""
    pattern = BELOW_DETECTION_STRICT if strict else BELOW_DETECTION
    return value.isNull() & ~F.coalesce(text.rlike(pattern), F.lit(False))


def positive_part(v: Column) -> Column:
    """max(v, 0) that keeps NULL as NULL, which ``greatest`` would not."""
    return F.when(v > 0, v).when(v <= 0, F.lit(0.0))


def strict_sum(c: Column | str) -> Column:
    """Sum that is NULL as soon as one member is NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def config_changed(now: Column, before: Column) -> Column:
    """True if two parameter structs differ or one is missing."""
    return now.isNull() | before.isNull() | ~now.eqNullSafe(before)
