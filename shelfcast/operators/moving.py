"""Row-based moving windows over daily series.

The input has one row per key and day, so a window partition is bounded by the calendar. Frames
count rows, not days: a missing date widens the window. All columns of one call share a single
window, hence one shuffle and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = Sequence[str]


def _full(c: Column, agg: Column, frame, size: int) -> Column:
    """The aggregate where the frame holds ``size`` non-NULL values, else NULL."""
    return F.when(F.count(c).over(frame) == size, agg.over(frame))


def trailing(keys: Keys, size: int, order: str = "date"):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(1 - size, 0)


def moving_mean(c: Column | str, size: int = 5, keys: Keys = (), order: str = "date") -> Column:
    """Mean of the last ``size`` rows including this one; NULL until full or if one is NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return _full(c, F.avg(c), trailing(keys, size, order), size)


def moving_sum(c: Column | str, size: int = 3, keys: Keys = (), order: str = "date") -> Column:
    """Sum of the last ``size`` rows, with the rules of :func:`moving_mean`."""
    c = F.col(c) if isinstance(c, str) else c
    return _full(c, F.sum(c), trailing(keys, size, order), size)


def forward_sum(c: Column | str, size: int = 3, keys: Keys = (), order: str = "date") -> Column:
    """Sum of the ``size`` rows after this one; NULL where fewer follow or one is NULL."""
    c = F.col(c) if isinstance(c, str) else c
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(1, size)
    return _full(c, F.sum(c), frame, size)


def smooth(
    features: DataFrame, size: int = 7, keys: Keys = (), columns: Sequence[str] | None = None
) -> DataFrame:
    """Replace feature columns by their trailing mean."""
    columns = columns or [c for c in features.columns if c not in (*keys, "date")]
    by = "PARTITION BY " + ", ".join(f"`{k}`" for k in keys) if keys else ""
    frame = f"OVER ({by} ORDER BY date ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
    return features.selectExpr(
        *[
            f"CASE WHEN count(`{c}`) {frame} = {size} THEN avg(`{c}`) {frame} END AS `{c}`"
            if c in columns else f"`{c}`"
            for c in features.columns
        ]
    )
