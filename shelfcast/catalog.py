"""Every operator as a query over the star-schema tables.

Each entry takes (spark, folder) and returns a DataFrame over the whole tables. Doubles are
rounded to six places at the very end, for comparison with the SQL in :mod:`shelfcast.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions import times
from shelfcast.functions.times import weekday_one_hot
from shelfcast.operators import daily, forecast, labs, ledger, moving, runs, training, versions
from shelfcast.plans import adapters, reporting
from shelfcast.settings import MODEL_FIELDS, Params

PARAMS = Params(rules=adapters.LINE_RULES, wards=tuple(adapters.WARDS))
SHORT_HISTORY = 50
SITE = ("site",)


def rounded(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        *[
            f"round(`{f.name}`, 6) AS `{f.name}`"
            if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


# --- daily series -----------------------------------------------------------------------------

def usage(spark: SparkSession, d: str) -> DataFrame:
    return daily.daily_usage(adapters.transfusion(spark, d), adapters.UNIT_TYPE)


def usage_seven_lag(spark, d):
    return usage(spark, d).withColumn("seven_lag", moving.moving_mean("used", 7))


def usage_three_day_sum(spark, d):
    return usage(spark, d).withColumn("ms3", moving.moving_sum("used", 3))


def three_day_target(spark, d):
    return forecast.three_day_target(usage(spark, d))


def site_usage(spark, d):
    return daily.daily_usage(adapters.site_transfusion(spark, d), adapters.UNIT_TYPE, keys=SITE)


def site_usage_seven_lag(spark, d):
    return site_usage(spark, d).withColumn("seven_lag", moving.moving_mean("used", 7, SITE))


def weekdays(spark, d):
    return weekday_one_hot(usage(spark, d).select("date"))


def last_days_of_usage(spark, d):
    return daily.last_days(usage(spark, d), PARAMS.history_window + 1)


def first_days_of_usage(spark, d):
    return daily.first_days(usage(spark, d), PARAMS.history_window)


# --- labs -------------------------------------------------------------------------------------

def event_values(spark, d):
    return labs.lab_values(adapters.labs(spark, d), adapters.EVENT_RULES)


def lab_clean(spark, d):
    return labs.lab_clean(event_values(spark, d))


def lab_missing_values(spark, d):
    return labs.lab_missing_values(event_values(spark, d))


def lab_summary(spark, d):
    return labs.lab_summary(event_values(spark, d), adapters.EVENT_RULES)


def lab_summary_latest_day(spark, d):
    rows = reporting.of_latest_day(adapters.labs(spark, d), "result_time")
    values = labs.lab_values(rows, adapters.EVENT_RULES)
    return labs.lab_summary(values, adapters.EVENT_RULES).drop("date")


def event_threshold_counts(spark, d):
    return labs.lab_threshold_counts(lab_clean(spark, d), adapters.EVENT_RULES)


def event_row_threshold_counts(spark, d):
    """Without collapsing equal values."""
    rows = labs.lab_clean(event_values(spark, d), dedupe="rows")
    return labs.lab_threshold_counts(rows, adapters.EVENT_RULES)


def lab_threshold_counts(spark, d):
    return labs.lab_threshold_counts(adapters.lab_lines(spark, d), adapters.LINE_RULES)


def lab_counts_wide(spark, d):
    return labs.lab_counts_wide(lab_threshold_counts(spark, d), adapters.LINE_RULES)


def lab_features_wide(spark, d):
    return labs.lab_features_wide(lab_threshold_counts(spark, d), adapters.LINE_RULES)


def lab_features_smoothed(spark, d):
    return moving.smooth(lab_features_wide(spark, d))


# --- census and inventory ---------------------------------------------------------------------

def census_counts(spark, d):
    return daily.census_counts(adapters.census(spark, d))


def census_wide(spark, d):
    return daily.census_wide(census_counts(spark, d), adapters.WARDS)


def census_day_long(spark, d):
    def latest(orders):
        return reporting.of_latest_day(orders, "o_orderdate")

    day = daily.census_counts(adapters.census(spark, d, latest))
    return reporting.census_of_day(daily.census_wide(day, adapters.WARDS), adapters.WARDS)


def missing_wards(spark, d):
    return daily.missing_wards(census_counts(spark, d), [*adapters.WARDS, "X-ICU", "Y-STEPDOWN"])


def inventory_buckets(spark, d):
    return daily.inventory_buckets(adapters.inventory(spark, d), adapters.UNIT_TYPE)


def inventory_expired_flags(spark, d):
    return daily.inventory_expiry(adapters.inventory(spark, d), adapters.UNIT_TYPE)


# --- training table and scaling ---------------------------------------------------------------

def training_table(spark, d):
    return training.training_table(
        lab_features_wide(spark, d), census_wide(spark, d), usage(spark, d)
    )


def incomplete_dates(spark, d):
    return training.incomplete_dates(
        adapters.lab_lines(spark, d), census_counts(spark, d), usage(spark, d)
    )


def scaler_fit(spark, d):
    return training.fit_scaler(training_table(spark, d))


def scaler_apply(spark, d):
    table = training_table(spark, d)
    scaler = training.fit_scaler(daily.first_days(table, PARAMS.history_window))
    return training.apply_scaler(table, scaler)


def scaler_center_only(spark, d):
    table = training_table(spark, d)
    return training.apply_scaler(table, training.fit_scaler(table), scale=False)


def rolling_scaler(spark, d):
    return training.rolling_scaler(training_table(spark, d), SHORT_HISTORY)


def site_training_table(spark, d):
    lines = adapters.regional_lines(spark, d)
    counts = labs.lab_threshold_counts(lines, adapters.LINE_RULES, SITE)
    features = labs.lab_features_wide(counts, adapters.LINE_RULES, SITE)
    census = daily.census_counts(adapters.regional_census(spark, d), SITE)
    census = daily.census_wide(census, adapters.WARDS, SITE)
    used = daily.daily_usage(lines, adapters.UNIT_TYPE, SITE)
    return training.training_table(features, census, used, SITE)


def site_rolling_scaler(spark, d):
    return training.rolling_scaler(site_training_table(spark, d), SHORT_HISTORY, keys=SITE)


def site_forecast_windows(spark, d):
    """What each model of each site is fitted on."""
    table = site_training_table(spark, d)
    flagged = run_log(table, SITE).drop("age_before", "reason")
    models = forecast.rolling_models(flagged, SITE)
    return models.select(
        *SITE, "model_date", "n", "target_sum",
        F.explode("predictor_sums").alias("predictor", "total"),
    )


def run_log(dates: DataFrame, keys=()) -> DataFrame:
    """One run per date; the window length changes once and some increments span dates."""
    fields = {c: F.lit(float(getattr(PARAMS, c))) for c in MODEL_FIELDS}
    fields["history_window"] = F.when(F.col("date") >= "1998-07-01", 100.0).otherwise(200.0)
    fields["multi_date"] = F.dayofmonth("date") == 15
    return runs.model_age(runs.run_gaps(dates, keys).withColumns(fields), keys)


def model_age_ledger(spark, d):
    log = run_log(usage(spark, d).select("date"))
    return log.withColumn("age_before", F.col("age_before").cast("int"))


def _table_with_runs(spark, d):
    return run_log(training_table(spark, d)).drop("age_before", "reason")


def last_scaler_asof(spark, d):
    return training.scaler_as_of(
        training.rolling_scaler(_table_with_runs(spark, d), SHORT_HISTORY)
    )


# --- increments -------------------------------------------------------------------------------

def _batch(spark, d, odd: int) -> DataFrame:
    """Lines of even order keys, NULL among them, or of odd ones."""
    part = F.coalesce(F.pmod("l_orderkey", F.lit(2)), F.lit(0))
    rows = adapters.transfusion(spark, d).filter(part == odd)
    return daily.daily_usage(rows, adapters.UNIT_TYPE)


def accumulate_counts(spark, d):
    return daily.accumulate([_batch(spark, d, 0), _batch(spark, d, 1)])


def late_rows_effect(spark, d):
    """What the second batch adds to dates the first one had already reported."""
    first, late = _batch(spark, d, 0), _batch(spark, d, 1)
    total = daily.accumulate([first, late])
    before = first.withColumnRenamed("used", "used_before")
    return total.join(before, "date").filter(F.col("used") > F.col("used_before"))


def multi_date_increments(spark, d):
    weekly = usage(spark, d).withColumn("increment", F.trunc("date", "week"))
    return daily.dates_per_increment(weekly, "increment")


# --- reports ----------------------------------------------------------------------------------

def prediction_vs_usage(spark, d):
    return reporting.usage_days(usage(spark, d))


def _site_ledger(spark, d):
    days = reporting.site_days(site_usage(spark, d), SITE)
    return ledger.order_ledger(days, PARAMS, SITE, partitioned=True)


def order_ledger(spark, d):
    return _site_ledger(spark, d)


def low_stock_alerts(spark, d):
    return ledger.low_stock_alerts(_site_ledger(spark, d), SITE)


def prediction_report(spark, d):
    return reporting.prediction_report(
        prediction_vs_usage(spark, d), inventory_buckets(spark, d), PARAMS
    )


def adjusted_orders(spark, d):
    return reporting.adjusted_orders(_site_ledger(spark, d), SITE)


def actual_vs_remaining(spark, d):
    return reporting.actual_vs_remaining(_site_ledger(spark, d), PARAMS, SITE)


def remaining_histogram(spark, d):
    return reporting.stock_histogram(_site_ledger(spark, d), PARAMS, SITE)


def forecast_three_day(spark, d):
    return forecast.rolling_forecast(_table_with_runs(spark, d))


def forecast_windows(spark, d):
    """What each model of :func:`forecast_three_day` was fitted on."""
    models = forecast.rolling_models(_table_with_runs(spark, d))
    return models.select(
        "model_date", "n", "target_sum", F.explode("predictor_sums").alias("predictor", "total")
    )


def forecast_gradient(spark, d):
    """Whether some slope of a model's penalised squares isn't zero at its coefficients."""
    table = _table_with_runs(spark, d)
    slopes = forecast.slopes(forecast.rolling_models(table), table)
    return slopes.groupBy("model_date").agg((F.max(F.abs("slope")) > 1e-6).alias("off_optimum"))


# --- increments by arrival, texts of files ------------------------------------------------------

def usage_as_of(spark, d):
    """Units per date as known after each of the two batches."""
    arrived = [_batch(spark, d, k).withColumn("arrival", F.lit(k + 1)) for k in (0, 1)]
    return daily.known_as_of(arrived[0].unionByName(arrived[1]), "arrival")


def windows_as_known(spark, d):
    """The last ten usage dates as known in each week; a third of the lines comes 5 days late, a third 10."""
    lines = adapters.transfusion(spark, d).filter(F.col("type") == adapters.UNIT_TYPE)
    date = F.col("issue_time").cast("date")
    late = F.coalesce(F.pmod("l_orderkey", F.lit(3)), F.lit(0)).cast("int") * 5
    week = F.floor(F.datediff(F.date_add(date, late), F.lit("1992-01-01")) / 7).cast("int")
    parts = lines.groupBy(date.alias("date"), week.alias("run")).agg(F.count(F.lit(1)).alias("used"))
    known = daily.accumulate([versions.versions(parts)], ("run",))
    last_run = parts.agg(F.max("run")).first()[0] or 0
    return versions.windows(versions.spans(known), last_run, 10)


def file_stamps(spark, d):
    """Both stamp formats, written from the orders' dates and read back."""
    clock = F.make_interval(
        hours=F.col("o_orderkey") % 24, mins=F.col("o_custkey") % 60, secs=F.col("o_orderkey") % 60
    )
    at = (F.col("o_orderdate").cast("date").cast("timestamp_ntz") + clock).alias("at")
    orders = adapters.table(spark, d, "orders").select("o_orderkey", at)
    return orders.select(
        "o_orderkey",
        times.slash_stamp(F.date_format("at", "MM/dd/yyyy  hh:mm:ssa")).alias("slash"),
        times.dash_stamp(F.date_format("at", "dd-MMM-yy HH:mm:ss")).alias("dash"),
    ).selectExpr("o_orderkey", "CAST(slash AS STRING) AS slash", "CAST(dash AS STRING) AS dash")


def file_name_parts(spark, d):
    """Dates and report names from file names, one file per order."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    name = F.concat(F.lit("/in/Report_Daily"), day, F.lit("-08-01-54.csv"))
    return adapters.table(spark, d, "orders").select(
        "o_orderkey", times.snapshot_date(name).alias("snapshot"),
        times.iso_date_in(name).alias("day"), times.report_name(name).alias("report"),
    )


def expiry_times(spark, d):
    """Expiry instants of stock from a date text and an ``HHmm`` text; a short one gives none."""
    hours = F.lpad((F.col("o_orderkey") % 25).cast("string"), 2, "0")
    stock = adapters.table(spark, d, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("exp_date"),
        F.concat(hours, F.when(F.col("o_custkey") % 10 == 0, "5").otherwise("45")).alias("exp_time"),
    )
    return daily.with_expiry_time(stock).selectExpr(
        "o_orderkey", "CAST(expiry_time AS STRING) AS expiry_time"
    )


def lab_counts_without_totals(spark, d):
    return labs.drop_suffix(lab_counts_wide(spark, d), "_N")


_PLAIN: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "daily_usage": usage,
    "usage_seven_lag": usage_seven_lag,
    "usage_three_day_sum": usage_three_day_sum,
    "three_day_target": three_day_target,
    "site_usage": site_usage,
    "site_usage_seven_lag": site_usage_seven_lag,
    "weekday_one_hot": weekdays,
    "last_days_of_usage": last_days_of_usage,
    "first_days_of_usage": first_days_of_usage,
    "lab_clean": lab_clean,
    "lab_missing_values": lab_missing_values,
    "lab_summary": lab_summary,
    "lab_summary_latest_day": lab_summary_latest_day,
    "event_threshold_counts": event_threshold_counts,
    "event_row_threshold_counts": event_row_threshold_counts,
    "lab_threshold_counts": lab_threshold_counts,
    "lab_counts_wide": lab_counts_wide,
    "lab_features_wide": lab_features_wide,
    "lab_features_smoothed": lab_features_smoothed,
    "census_counts": census_counts,
    "census_wide": census_wide,
    "census_day_long": census_day_long,
    "missing_wards": missing_wards,
    "inventory_buckets": inventory_buckets,
    "inventory_expired_flags": inventory_expired_flags,
    "training_table": training_table,
    "incomplete_dates": incomplete_dates,
    "scaler_fit": scaler_fit,
    "scaler_apply": scaler_apply,
    "scaler_center_only": scaler_center_only,
    "rolling_scaler": rolling_scaler,
    "site_training_table": site_training_table,
    "site_rolling_scaler": site_rolling_scaler,
    "site_forecast_windows": site_forecast_windows,
    "model_age_ledger": model_age_ledger,
    "last_scaler_asof": last_scaler_asof,
    "accumulate_counts": accumulate_counts,
    "late_rows_effect": late_rows_effect,
    "multi_date_increments": multi_date_increments,
    "prediction_vs_usage": prediction_vs_usage,
    "order_ledger": order_ledger,
    "low_stock_alerts": low_stock_alerts,
    "prediction_report": prediction_report,
    "adjusted_orders": adjusted_orders,
    "actual_vs_remaining": actual_vs_remaining,
    "remaining_histogram": remaining_histogram,
    "forecast_three_day": forecast_three_day,
    "forecast_windows": forecast_windows,
    "forecast_gradient": forecast_gradient,
    "usage_as_of": usage_as_of,
    "windows_as_known": windows_as_known,
    "file_stamps": file_stamps,
    "file_name_parts": file_name_parts,
    "expiry_times": expiry_times,
    "lab_counts_without_totals": lab_counts_without_totals,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def final(build):
        return lambda spark, sf_dir: rounded(build(spark, sf_dir))

    return {name: final(build) for name, build in _PLAIN.items()}
