"""The log of daily runs: model age and whether a run retrains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.values import config_changed
from shelfcast.settings import MODEL_FIELDS

Keys = Sequence[str]


RUN_COLUMNS = ("gap", "multi_date", *MODEL_FIELDS)


def run_gaps(dates: DataFrame, keys: Keys = (), first: int = 1) -> DataFrame:
    """Days since the previous run, ``first`` for the first."""
    w = Window.partitionBy(*keys).orderBy("date")
    return dates.withColumn(
        "gap", F.coalesce(F.datediff("date", F.lag("date").over(w)), F.lit(first))
    )


def model_age(runs: DataFrame, keys: Keys = ()) -> DataFrame:
    """Add ``age_before``, ``retrain`` and ``reason`` to the log of runs.

    ``runs`` has ``date``, ``gap``, the six model parameters and optionally ``multi_date``, which
    are replaced; other columns stay. The age is the sum of all earlier gaps: it is not reset by
    a retrain. Parameters are compared by value.
    """
    w = Window.partitionBy(*keys).orderBy("date")
    config = F.struct(*[F.col(c).cast("double").alias(c) for c in MODEL_FIELDS])
    multi = (
        F.coalesce(F.col("multi_date"), F.lit(False)) if "multi_date" in runs.columns
        else F.lit(False)
    )
    frequency = F.col("model_update_frequency")
    kept = [f"`{c}`" for c in runs.columns if c not in RUN_COLUMNS]
    aged = runs.select(
        *kept, F.col("gap").alias("_gap"), multi.alias("_multi"), frequency.alias("_frequency"),
        F.sum("gap").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("age_before"),
        config_changed(config, F.lag(config).over(w)).alias("_changed"),
    )
    reason = F.expr(
        """CASE WHEN age_before IS NULL THEN 'first' WHEN _multi THEN 'several dates'
        WHEN _changed THEN 'parameters changed'
        WHEN age_before % _frequency = 0 OR _gap > _frequency THEN 'stale' END"""
    )
    return aged.withColumn("reason", reason).select(
        *kept, "age_before", F.col("reason").isNotNull().alias("retrain"), "reason"
    )
