"""Seed, daily run and backfill on the durable state."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.operators import daily, forecast, labs, runs, training, versions
from shelfcast.plans import bulk, reporting
from shelfcast.settings import MODEL_FIELDS, Params
from shelfcast.sources import checks, feeds, landing, reports
from shelfcast.sources import state as store

AS_OF = ("as_of",)


def seed(
    spark: SparkSession, folder: str, state: str, as_of: str, params: Params = Params(),
    report_folder: str | None = None,
) -> None:
    """Start the state from all historical files of a folder."""
    feed = {f.name: f for f in params.feeds}
    landed = f"{state}/landing/seed-{as_of}"
    history = bulk.process_all_labs(
        spark, folder, params.rules, report_folder, feed=feed[feeds.LABS.name],
        landing_folder=landed,
    )
    # Sorted by date, so that a later read of recent days skips most row groups.
    history = history.repartitionByRange("date", "base_name", "lab_value").sortWithinPartitions(
        "date"
    )
    store.write_day(history, state, "labs", as_of)
    stays = bulk.checked(spark, folder, feed[feeds.CENSUS.name], landing_folder=landed)
    census = bulk.finish(bulk.process_census(stays.rows), report_folder, stays)
    store.write_day(census, state, "census", as_of)
    usage = bulk.process_all_transfusion(
        spark, folder, report_folder, feed=feed[feeds.TRANSFUSION.name], landing_folder=landed
    )
    store.write_day(usage, state, "usage", as_of)
    last = store.read_day(spark, state, "usage", as_of).agg(F.max("date").alias("date"))
    day = last.withColumn("as_of", F.lit(as_of).cast("date"))
    store.write_day(store.plain_lines(day, "seed"), state, "runs", as_of)


def process_days(
    spark: SparkSession, folder: str, dates: Sequence[str], params: Params = Params(),
    report_folder: str | None = None, landing_folder: str | None = None,
) -> dict[str, DataFrame]:
    """The cleaned increments of the given days by table, each with ``as_of``.

    Every day needs one lab, one census and one transfusion file, and at most one inventory file.
    The files are parsed once, into ``landing_folder`` or a new one; checks, reports and increments
    read what has landed.
    """
    checks.require_empty(
        checks.file_cardinality_violations(spark, folder, dates, params.feeds),
        "Days without their one file of a feed",
    )
    by_name = {f.name: f for f in params.feeds}
    into = landing_folder or landing.new_folder(spark)
    rows, files = {}, {}
    for feed in params.feeds:
        pattern = feed.daily_pattern("(" + "|".join(dates) + ")")
        landed = landing.land(spark, folder, feed, into, pattern, params.rules)
        rows[feed.name] = feeds.with_as_of(landed.require_sound(feed.name), feed)
        files[feed.name] = landed.manifest
    if report_folder is not None:
        for name, done in (
            ("labs", bulk.process_labs(rows["labs"], params.rules)),
            ("census", bulk.process_census(rows["census"])),
            ("transfusion", bulk.process_transfusion(rows["transfusion"])),
            ("inventory", bulk.process_inventory(rows["inventory"])),
        ):
            reports.save_reports(done.reports, report_folder, files=files[name])
    return dict(clean_increment(by_name[name], df, params) for name, df in rows.items())


def clean_increment(
    feed: feeds.Feed, rows: DataFrame, params: Params
) -> tuple[str, DataFrame]:
    """State table and cleaned rows of a feed whose rows carry ``as_of``.

    Equal lab values collapse within a day's increment, not across increments.
    """
    if feed.name == feeds.LABS.name:
        return "labs", bulk.lab_series(rows, params.rules, AS_OF)
    if feed.name == feeds.CENSUS.name:
        return "census", daily.census_counts(rows, AS_OF)
    if feed.name == feeds.TRANSFUSION.name:
        return "usage", daily.daily_usage(rows, keys=AS_OF)
    return "inventory", daily.inventory_buckets(feeds.dated_inventory(rows), keys=AS_OF)


def several_dates(increments: Sequence[DataFrame]) -> DataFrame:
    """(as_of, multi_date) of all days: whether some feed's increment spans several dates."""
    counts = [
        df.groupBy("as_of").agg((F.countDistinct("date") > 1).alias("multi_date"))
        for df in increments
    ]
    return (
        reduce(DataFrame.unionByName, counts).groupBy("as_of")
        .agg(F.max("multi_date").alias("multi_date"))
    )


def state_table(
    spark: SparkSession, state: str, params: Params, until: str,
    also: Sequence[str] = (), last_rows: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(training table, usage, incomplete dates) of the state up to ``until`` and the days ``also``.

    With ``last_rows`` the series are cut to that many usage dates *before* smoothing; labs and
    census are read from the first of these dates on only.
    """

    def read(table: str) -> DataFrame:
        return store.read_committed(spark, state, table, until, also)

    usage = daily.accumulate([read("usage").drop("as_of")])
    lab_rows, census_rows = read("labs"), read("census")
    if last_rows is not None:
        usage = daily.last_days(usage, last_rows)
        start = usage.agg(F.min("date")).first()[0]
        lab_rows = lab_rows.filter(F.col("date") >= F.lit(start))
        census_rows = census_rows.filter(F.col("date") >= F.lit(start))
    counts = labs.lab_threshold_counts(lab_rows, params.rules)
    features = labs.lab_features_wide(counts, params.rules)
    census = daily.census_wide(census_rows, params.wards)
    table = training.training_table(features, census, usage, smoothing=params.smoothing)
    return table, usage, training.incomplete_dates(features, census, usage)


def predict_for_date(
    spark: SparkSession, folder: str, state: str, date: str, params: Params = Params(),
    prev_day: str | None = None, report_folder: str | None = None,
) -> DataFrame:
    """Fold one day's files into the state and forecast the next three days: (date, t_pred).

    The forecast's date is the last *data* date, normally the day before ``date``. Everything
    taken to the driver is a single row of the run log.
    """
    day = dt.date.fromisoformat(date)
    prev_day = prev_day or str(day - dt.timedelta(days=1))
    gap = (day - dt.date.fromisoformat(prev_day)).days
    store.require_day(spark, state, prev_day)

    increments = process_days(
        spark, folder, [date], params, report_folder, f"{state}/landing/{date}"
    )
    for table, df in increments.items():
        store.write_day(df, state, table, date)
    written = [store.read_day(spark, state, t, date) for t in ("labs", "census", "usage")]
    multi_date = several_dates(written).agg(F.max("multi_date")).first()[0]

    table, usage, incomplete = state_table(
        spark, state, params, prev_day, [date], params.history_window + 1
    )
    table = table.persist()  # one row per day of the window
    try:
        _require_complete(table, usage, incomplete)
        _retrain_and_score(spark, state, table, date, prev_day, gap, bool(multi_date), params)
    finally:
        table.unpersist()
    return store.read_day(spark, state, "prediction", date).drop("as_of")


def _require_complete(table: DataFrame, usage: DataFrame, incomplete: DataFrame) -> None:
    """Every usage date must be in the training table; the gaps are listed only if there are any."""
    if table.count() != usage.count():
        checks.require_empty(incomplete, "Usage dates that another feed lacks")


def _retrain_and_score(
    spark: SparkSession, state: str, table: DataFrame, date: str, prev_day: str, gap: int,
    multi_date: bool, params: Params,
) -> None:
    """Refit or carry over scaler and model, write the forecast and the run-log line."""
    run = _run_row(spark, state, params, prev_day, gap, multi_date)
    if run["retrain"]:
        _fit(table, state, date, params)
    else:
        for kind in ("scaler", "model"):
            kept = store.read_day(spark, state, kind, prev_day, committed=True)
            store.write_day(kept, state, kind, date)

    scored = daily.last_days(table, 1)
    prediction = forecast.score(scored, store.read_day(spark, state, "model", date))
    store.write_day(prediction, state, "prediction", date)
    line = spark.createDataFrame([run], store.TABLES["runs"].replace("date date, ", ""))
    store.write_day(scored.select("date").crossJoin(line), state, "runs", date)


def _fit(table: DataFrame, state: str, date: str, params: Params) -> None:
    window = daily.first_days(table, params.history_window)
    store.write_day(training.fit_scaler(window), state, "scaler", date)
    model = forecast.fit_model(
        table, (), params.smoothing, params.penalty_factor, params.history_window
    )
    store.write_day(model, state, "model", date)


def _run_row(
    spark: SparkSession, state: str, params: Params, prev_day: str, gap: int, multi_date: bool
) -> dict:
    """This run's line of the run log, from the previous run's line."""
    config = {c: float(getattr(params, c)) for c in MODEL_FIELDS}
    last = store.read_day(spark, state, "runs", prev_day).first()
    age = None if last is None else last["age_after"]
    if age is None:
        reason = "first"
    elif multi_date:
        reason = "several dates"
    elif any(last[c] != v for c, v in config.items()):
        reason = "parameters changed"
    elif age % params.model_update_frequency == 0 or gap > params.model_update_frequency:
        reason = "stale"
    else:
        reason = None
    return {
        "gap": gap, "age_before": age, "age_after": (age or 0) + gap,
        "retrain": reason is not None, "reason": reason, **config,
    }


def backfill(
    spark: SparkSession, folder: str, state: str, dates: Sequence[str], params: Params = Params(),
    report_folder: str | None = None,
) -> DataFrame:
    """All days of a range after a complete day, seed or run: (as_of, date, t_pred).

    The result equals that of day-by-day runs, late rows or not: each run sees every date as known
    on its day. Files are read once for all days, and all windows, models and forecasts come from one
    plan, whatever the number of days. Daily runs can go on from the last day.
    """
    dates = sorted(dates)
    before = store.latest_day(spark, state, before=dates[0])
    if before is None:
        raise store.StateError(f"The state has no complete day before {dates[0]}")
    increments = process_days(
        spark, folder, dates, params, report_folder, f"{state}/landing/{dates[0]}-{dates[-1]}"
    )
    for name, df in increments.items():
        store.write_days(df, state, name, dates)

    prior = store.read_day(spark, state, "runs", before).first()
    log = _run_log(spark, state, dates, params, before, prior).persist()  # one row per day
    try:
        _forecast_days(spark, state, dates, before, log, params)
        store.write_days(log, state, "runs", dates)
    finally:
        log.unpersist()
    return store.of_days(store.read_table(spark, state, "prediction"), dates).select(
        "as_of", "date", "t_pred"
    )


def _numbered(spark: SparkSession, dates: Sequence[str]) -> DataFrame:
    """(as_of, run) of the days, one row each."""
    lines = [(dt.date.fromisoformat(d), i) for i, d in enumerate(dates)]
    return spark.createDataFrame(lines, "as_of date, run int")


def _by_run(spark: SparkSession, state: str, table: str, dates: Sequence[str], before: str) -> DataFrame:
    """Rows of a state table by the run that brought them; what was there before came with the first."""
    rows = store.read_committed(spark, state, table, before, dates)
    runs = F.broadcast(_numbered(spark, dates))
    return (
        rows.join(runs, "as_of", "left").drop("as_of")
        .withColumn(versions.RUN, F.coalesce(versions.RUN, F.lit(0)))
    )


def tables_as_known(
    spark: SparkSession, state: str, dates: Sequence[str], before: str, log: DataFrame,
    params: Params,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(training table, usage, incomplete dates) as each run knows them, by ``run``.

    A run that retrains has its whole window, any other the rows behind its last one's means.
    """
    last_run, by = len(dates) - 1, (versions.RUN,)

    def known(table: str) -> DataFrame:
        return versions.versions(_by_run(spark, state, table, dates, before))

    usage = versions.spans(daily.accumulate([known("usage")], by))
    seen = versions.windows(usage, last_run, params.history_window + 1).persist()
    starts = versions.window_starts(seen)
    start = F.lit(starts.agg(F.min("start")).first()[0])

    counts = labs.lab_threshold_counts(known("labs").filter(F.col("date") >= start), params.rules, by)
    features = labs.lab_features_wide(counts, params.rules, by)
    census = daily.census_wide(known("census").filter(F.col("date") >= start), params.wards, by)
    features, census = [
        versions.since(versions.spans(wide), starts, last_run) for wide in (features, census)
    ]
    used = (
        seen.join(log.select(versions.RUN, training.RETRAIN), versions.RUN)
        .filter(F.col(training.RETRAIN) | (F.col("back") <= params.smoothing))
        .drop("back", training.RETRAIN)
    )
    table = training.training_table(features, census, used, by, params.smoothing)
    return table, used, training.incomplete_dates(features, census, used, by)


def _forecast_days(
    spark: SparkSession, state: str, dates: Sequence[str], before: str, log: DataFrame,
    params: Params,
) -> None:
    """Forecasts of all days, and scaler and model in force after the last one."""
    by = (versions.RUN,)
    log = log.join(F.broadcast(_numbered(spark, dates)), "as_of").select(
        "as_of", versions.RUN, training.RETRAIN
    )
    table, used, incomplete = tables_as_known(spark, state, dates, before, log, params)
    table = table.persist()  # a window per retrain, a few rows per other run
    try:
        _require_complete(table, used, incomplete)
        fits = log.filter(training.RETRAIN).select(versions.RUN)
        models = forecast.fit_model(
            table.join(F.broadcast(fits), versions.RUN), by, params.smoothing,
            params.penalty_factor, params.history_window,
        ).persist()  # one row per retrain
        old = store.read_day(spark, state, "model", before, committed=True).drop("as_of")
        all_models = models.withColumnRenamed(versions.RUN, "fitted").unionByName(
            old.withColumn("fitted", F.lit(-1))
        )
        so_far = Window.orderBy(versions.RUN).rowsBetween(Window.unboundedPreceding, 0)
        fitted = F.max(F.when(F.col(training.RETRAIN), F.col(versions.RUN))).over(so_far)
        in_force = (
            log.select(versions.RUN, F.coalesce(fitted, F.lit(-1)).alias("fitted"))
            .join(all_models, "fitted").drop("fitted")
        )
        predicted = forecast.score(daily.last_days(table, 1, by), in_force, by)
        store.write_days(
            predicted.join(log.select("as_of", versions.RUN), versions.RUN)
            .select("as_of", "date", "t_pred"),
            state, "prediction", dates,
        )
        last = fits.agg(F.max(versions.RUN)).first()[0]
        if last is None:
            for kind in ("scaler", "model"):
                kept = store.read_day(spark, state, kind, before, committed=True)
                store.write_day(kept, state, kind, dates[-1])
        else:
            window = daily.first_days(
                table.filter(F.col(versions.RUN) == last).drop(versions.RUN), params.history_window
            )
            store.write_day(training.fit_scaler(window), state, "scaler", dates[-1])
            model = models.filter(F.col(versions.RUN) == last).drop(versions.RUN)
            store.write_day(model, state, "model", dates[-1])
        models.unpersist()
    finally:
        table.unpersist()


def _run_log(
    spark: SparkSession, state: str, days: Sequence[str], params: Params, before: str, prior: Row
) -> DataFrame:
    """The lines of ``runs`` of the days, each about the last usage date known on its day."""
    written = {
        t: store.of_days(store.read_table(spark, state, t), days)
        for t in ("labs", "census", "usage")
    }
    dates = written["usage"].groupBy("as_of").agg(F.max("date").alias("data_date"))
    config = {c: F.lit(float(getattr(params, c))) for c in MODEL_FIELDS}
    lines = (
        spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "as_of date")
        .join(dates, "as_of", "left")
        .join(several_dates(list(written.values())), "as_of", "left")
        .withColumnRenamed("as_of", "date")
        .withColumns(config)
    )
    gap = (dt.date.fromisoformat(days[0]) - dt.date.fromisoformat(before)).days
    if prior["age_after"] is not None:
        # The earlier runs as one line: their age is its gap, their parameters are the last ones.
        gap = prior["age_after"]
        earlier = [dt.date.fromisoformat(before), None, False, *[prior[c] for c in MODEL_FIELDS]]
        lines = lines.unionByName(spark.createDataFrame([tuple(earlier)], lines.schema))
    gaps = runs.run_gaps(lines, first=gap).withColumn("days_since", F.col("gap"))
    latest = Window.orderBy("as_of").rowsBetween(Window.unboundedPreceding, 0)
    known = F.max("data_date").over(latest)
    aged = runs.model_age(gaps).withColumnRenamed("date", "as_of")
    return (
        aged.withColumns(config)
        .select(
            "as_of", F.greatest(known, F.lit(prior["date"])).alias("date"),
            F.col("days_since").cast("int").alias("gap"), "age_before",
            (F.coalesce("age_before", F.lit(0)) + F.col("days_since")).alias("age_after"),
            "retrain", "reason", *config,
        )
        .filter(F.col("as_of") > F.lit(before).cast("date"))
    )


def usage_and_prediction(
    spark: SparkSession, state: str, start: str, end: str
) -> DataFrame:
    """(date, plt_used, t_pred) of every day of a range, from the latest state."""
    usage = daily.accumulate([store.read_committed(spark, state, "usage").drop("as_of")])
    prediction = _latest_prediction(store.read_committed(spark, state, "prediction"))
    return reporting.prediction_vs_usage(usage, prediction, start, end)


def _latest_prediction(prediction: DataFrame) -> DataFrame:
    """One forecast per date: the last one made, where a day brought no later usage."""
    return prediction.groupBy("date").agg(F.max_by("t_pred", "as_of").alias("t_pred"))


def report_from_state(
    spark: SparkSession, state: str, start: str, end: str, params: Params = Params(),
    offset: int | None = None, min_inventory: float | None = None,
    report_folder: str | None = None, report_date: str | None = None,
) -> DataFrame:
    """Ordering report of a date range from the latest state, optionally saved."""
    days = usage_and_prediction(spark, state, start, end)
    inventory = store.read_committed(spark, state, "inventory").drop("as_of")
    report = reporting.prediction_report(days, inventory, params, (), offset, min_inventory)
    if report_folder is not None:
        date = report_date or str(dt.date.today())
        plain = reporting.prediction_report(
            days, inventory, params, (), offset, min_inventory, display_names=False
        )
        sheet = plain.withColumns(
            {
                "report": F.lit(f"prediction-report-{date}-summary"),
                "report_date": F.lit(date).cast("date"),
            }
        )
        reports.save_reports({"prediction_report": sheet}, report_folder)
    return report
