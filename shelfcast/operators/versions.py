"""Series as they were known at each of many runs, in one plan.

A row belongs to a date and comes with a run, by its number. What a series says about a date is a
version: valid from the run that brought something for the date until the next that did. Versions
meet the runs that need them by their interval, so the plan is the same for one run or thousands, and
late rows cost a version of their own date each, not a pass over the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Keys = Sequence[str]
RUN = "run"


def versions(rows: DataFrame, keys: Keys = ()) -> DataFrame:
    """Every row once for each run that brought something for its date, from its own run on.

    What is grouped by (keys, run, date) afterwards is a version of the date as known at that run.
    A date has few runs: usually one, and one more per late delivery.
    """
    by = [*keys, "date"]
    brought = rows.select(*by, F.col(RUN).alias("_known")).distinct()
    return (
        rows.join(brought, by).filter(F.col(RUN) <= F.col("_known"))
        .drop(RUN).withColumnRenamed("_known", RUN)
    )


def spans(series: DataFrame, keys: Keys = ()) -> DataFrame:
    """Adds ``until``, the run that replaces the version in ``run``; NULL for the last version."""
    w = Window.partitionBy(*keys, "date").orderBy(RUN)
    return series.withColumn("until", F.lead(RUN).over(w))


def _each_run(series: DataFrame, first_after: str, last_run: int) -> DataFrame:
    """One row per run from a version's own to the one before ``until`` and ``first_after``."""
    end = F.least("until", first_after, F.lit(last_run + 1))
    return (
        series.withColumn("_end", end).filter(F.col(RUN) < F.col("_end"))
        .withColumn(RUN, F.explode(F.sequence(F.col(RUN), F.col("_end") - 1)))
        .drop("until", "_end", first_after)
    )


def windows(series: DataFrame, last_run: int, size: int, keys: Keys = ()) -> DataFrame:
    """The last ``size`` dates known at each run, with their values as known then and ``back``, their
    place counted from the last one (1). ``series`` has one row per (keys, date, run) and ``until``.

    A date can leave the window only once the next ``size`` dates are known, so it is not spread over
    later runs than that.
    """
    first = series.groupBy(*keys, "date").agg(F.min(RUN).alias("_first"))
    after = Window.partitionBy(*keys).orderBy("date").rowsBetween(1, size)
    leaves = first.select(
        *keys, "date",
        F.when(F.count("_first").over(after) == size, F.max("_first").over(after)).alias("_leaves"),
    )
    spread = _each_run(series.join(leaves, [*keys, "date"]), "_leaves", last_run)
    latest = Window.partitionBy(*keys, RUN).orderBy(F.col("date").desc())
    return spread.withColumn("back", F.row_number().over(latest)).filter(F.col("back") <= size)


def window_starts(known: DataFrame, keys: Keys = ()) -> DataFrame:
    """(keys, run, start): the first date of each run's window."""
    return known.groupBy(*keys, RUN).agg(F.min("date").alias("start"))


def since(series: DataFrame, starts: DataFrame, last_run: int, keys: Keys = ()) -> DataFrame:
    """What a series says at each run about the dates from the run's ``start`` on.

    ``series`` has one row per (keys, date, run) and ``until``. A date is spread up to the last run
    that starts at or before it.
    """
    marks = starts.select(*keys, F.col("start").alias("date"), F.col(RUN).alias("_mark"))
    so_far = Window.partitionBy(*keys).orderBy("date", F.col("_mark").isNull()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    marked = (
        series.unionByName(marks, allowMissingColumns=True)
        .withColumn("_leaves", F.max("_mark").over(so_far) + 1)
        .filter(F.col(RUN).isNotNull() & F.col("_leaves").isNotNull()).drop("_mark")
    )
    return (
        _each_run(marked, "_leaves", last_run).join(starts, [*keys, RUN])
        .filter(F.col("date") >= F.col("start")).drop("start")
    )
