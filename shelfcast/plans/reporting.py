"""Usage and prediction reports built on the ordering ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.times import calendar
from shelfcast.operators.daily import census_long, last_days, skip_days
from shelfcast.operators.ledger import order_ledger
from shelfcast.operators.moving import moving_mean
from shelfcast.operators.partitioning import spread
from shelfcast.settings import Params

Keys = Sequence[str]

# Display names of the report, in order after the key columns.
REPORT_NAMES = {
    "date": "date",
    "plt_used": "Platelet usage",
    "t_pred": "Three-day prediction",
    "alert": "Alert",
    "r1": "No. expiring in 1 day",
    "r2": "No. expiring in 2 days",
    "w": "Waste",
    "x": "No. to order per prediction",
    "s": "Shortage",
    "t_adj": "Adj. three-day prediction",
    "r1_adj": "Adj. no. expiring in 1 day",
    "r2_adj": "Adj. no. expiring in 2 days",
    "w_adj": "Adj. waste",
    "x_adj": "Adj. no. to order",
    "s_adj": "Adj. shortage",
    "inv_count": "Inv. count",
    "inv_r1": "Inv. expiring in 1 day",
    "inv_r2": "Inv. expiring in 2 days",
    "inv_r3_plus": "Inv. expiring in 2+ days",
}
ADJUSTED = ("t_adj", "r1_adj", "r2_adj", "w_adj", "x_adj", "s_adj")


def naive_prediction(usage: DataFrame, keys: Keys = (), column: str = "used") -> DataFrame:
    """Three times the trailing weekly mean: a stand-in where no model is at hand."""
    return usage.select(*keys, "date", (3 * moving_mean(column, 7, keys)).alias("t_pred"))


def prediction_vs_usage(
    usage: DataFrame,
    prediction: DataFrame,
    start: Column | str | None = None,
    end: Column | str | None = None,
    keys: Keys = (),
    days_ahead: int = 2,
) -> DataFrame:
    """Every calendar day with its usage and prediction, NULL where there is none.

    Without bounds the calendar of a key runs from its first usage to ``days_ahead`` days after
    its last.
    """
    if start is not None and end is not None and not keys:
        bounds = usage.sparkSession.range(1).select(_day(start).alias("lo"), _day(end).alias("hi"))
    else:
        bounds = usage.groupBy(*keys).agg(
            (_day(start) if start is not None else F.min("date")).alias("lo"),
            (_day(end) if end is not None else F.date_add(F.max("date"), days_ahead)).alias("hi"),
        ).filter(F.col("lo").isNotNull())
    by = [*keys, "date"]
    used = usage.select(*by, F.col("used").alias("plt_used"))
    return (
        calendar(bounds, F.col("lo"), F.col("hi"), keys)
        .join(used, by, "left")
        .join(prediction.select(*by, "t_pred"), by, "left")
    )


def _day(v: Column | str) -> Column:
    return v if isinstance(v, Column) else F.lit(v).cast("date")


def usage_days(usage: DataFrame, keys: Keys = (), days_ahead: int = 2) -> DataFrame:
    """:func:`prediction_vs_usage` with :func:`naive_prediction`, from one pass over the series.

    Each row is stretched over the days up to the key's next row, the last one over
    ``days_ahead`` more; only its own day has a value.
    """
    by = ("PARTITION BY " + ", ".join(f"`{k}`" for k in keys) if keys else "") + " ORDER BY date"
    named = [f"`{k}`" for k in keys]
    return (
        usage.select(*keys, "date", "used", (3 * moving_mean("used", 7, keys)).alias("t_pred"))
        .selectExpr(
            *named, "date AS own", "used", "t_pred",
            f"coalesce(date_sub(lead(date) OVER ({by}), 1), date_add(date, {days_ahead})) AS upto",
        )
        .selectExpr(*named, "own", "used", "t_pred", "explode(sequence(own, upto)) AS date")
        .selectExpr(
            *named, "date", "CASE WHEN date = own THEN used END AS plt_used",
            "CASE WHEN date = own THEN t_pred END AS t_pred",
        )
    )


def site_days(usage: DataFrame, keys: Keys, days_ahead: int = 2) -> DataFrame:
    """Ledger input of many sites over one common calendar, hash-partitioned by the keys.

    A site without units on a day before the last data day used zero; days after it are NULL.
    The prediction is :func:`naive_prediction` on the filled series. Each row is stretched over
    the days up to the site's next row, so filling takes no join; the common span is one row, read
    from the same shuffle as the rows themselves.
    """
    reported = F.when(F.col("used").isNotNull(), F.col("date"))
    span = usage.agg(F.min(reported).alias("lo"), F.max(reported).alias("hi"))
    by = "PARTITION BY " + ", ".join(f"`{k}`" for k in keys) + " ORDER BY date"
    names = [f"`{k}`" for k in keys]
    return (
        spread(usage, keys)
        .crossJoin(F.broadcast(span))
        .selectExpr(
            *names, "date AS reported", "used", "hi",
            f"CASE WHEN row_number() OVER ({by}) = 1 THEN lo ELSE date END AS first_day",
            f"""coalesce(date_sub(lead(date) OVER ({by}), 1), date_add(hi, {days_ahead}))
                AS last_day""",
        )
        .selectExpr(
            *names, "explode(sequence(first_day, last_day)) AS date", "reported", "used", "hi"
        )
        .selectExpr(
            *names, "date",
            "CASE WHEN date = reported THEN used WHEN date <= hi THEN 0 END AS plt_used",
        )
        .withColumn("t_pred", 3 * moving_mean("plt_used", 7, keys))
    )


def prediction_report(
    days: DataFrame,
    inventory: DataFrame | None = None,
    params: Params = Params(),
    keys: Keys = (),
    offset: int | None = None,
    min_inventory: float | None = None,
    display_names: bool = True,
) -> DataFrame:
    """The ledger with the day's shelf inventory; a repeated snapshot date repeats the row."""
    ledger = order_ledger(days, params, keys, offset, min_inventory)
    stock = ("count", "r1", "r2", "r3_plus")
    if inventory is None:
        report = ledger.withColumns({f"inv_{c}": F.lit(None).cast("bigint") for c in stock})
    else:
        shelf = inventory.select(*keys, "date", *[F.col(c).alias(f"inv_{c}") for c in stock])
        report = ledger.join(shelf, [*keys, "date"], "left")
    report = report.select(*keys, *REPORT_NAMES)
    return report.withColumnsRenamed(REPORT_NAMES) if display_names else report


def adjusted_orders(ledger: DataFrame, keys: Keys = ()) -> DataFrame:
    """Usage and the adjusted columns, cut to whole numbers."""
    return ledger.select(
        *keys, "date", *[F.col(c).cast("int").alias(c) for c in ("plt_used", *ADJUSTED)]
    )


def actual_vs_remaining(ledger: DataFrame, params: Params = Params(), keys: Keys = ()) -> DataFrame:
    """Usage and remaining stock of the last ``history_window`` days as (date, type, value)."""
    shown = last_days(skip_days(ledger, params.start, keys), params.history_window, keys)
    return (
        shown.select(
            *keys, "date", F.col("plt_used").alias("actual"),
            (F.col("r1_adj") + F.col("r2_adj")).alias("remaining"),
        )
        .unpivot([*keys, "date"], ["actual", "remaining"], "type", "value")
        .filter(F.col("value").isNotNull())
    )


def stock_histogram(
    ledger: DataFrame, params: Params = Params(), keys: Keys = (), bins: int = 100
) -> DataFrame:
    """Equal-width histograms of remaining and wasted units after the first ``start`` days.

    Bins are numbered from 1 and cover each measure's own range.
    """
    long = (
        skip_days(ledger, params.start, keys)
        .select((F.col("r1_adj") + F.col("r2_adj")).alias("remaining"), F.col("w_adj").alias("wasted"))
        .unpivot([], ["remaining", "wasted"], "measure", "value")
        .filter(F.col("value").isNotNull())
    )
    # Distinct values first; the ranges are two rows, read from the same shuffle as the counts.
    counts = long.groupBy("measure", "value").agg(F.count("*").alias("n"))
    ranges = counts.groupBy("measure").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    ranged = counts.join(F.broadcast(ranges), "measure")
    step = F.try_divide((F.col("value") - F.col("lo")) * bins, F.col("hi") - F.col("lo"))
    bin_no = F.least(F.floor(F.coalesce(step, F.lit(0.0))), F.lit(bins - 1)) + 1
    return ranged.groupBy("measure", bin_no.cast("int").alias("bin")).agg(F.sum("n").alias("n"))


def of_day(series: DataFrame, date: Column | str, time: str = "date") -> DataFrame:
    """Rows of one date. Applied to a feed, the filter reaches the scan."""
    return series.filter(F.col(time).cast("date") == _day(date))


def of_latest_day(rows: DataFrame, time: str = "date") -> DataFrame:
    """Rows of the latest date.

    The date comes from a scan of the time column alone and reaches the main scan as a literal,
    where it skips row groups.
    """
    kind = rows.schema[time].dataType
    latest = rows.agg(F.max(time).cast("date").cast(kind).alias("latest"))
    return rows.filter(F.col(time) >= latest.scalar())


def latest_row(series: DataFrame, keys: Keys = ()) -> DataFrame:
    """The last row per key of a daily table, by one partial aggregation."""
    last = F.max_by(F.struct(*[f"`{c}`" for c in series.columns]), "date").alias("_last")
    return series.groupBy(*keys).agg(last).select("_last.*")


def census_of_day(wide_day: DataFrame, wards: Sequence[str], keys: Keys = ()) -> DataFrame:
    """One day's wide census as (ward, n), sorted by ward."""
    long = census_long(wide_day, wards, keys)
    return long.select(*keys, "ward", F.col("n").cast("int").alias("n")).orderBy(*keys, "ward")
