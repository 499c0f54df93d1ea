"""Semantics on hand-written rows, brute force and properties."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfcast.functions import values
from shelfcast.functions.times import WEEKDAYS, weekday_one_hot
from shelfcast.operators import daily, forecast, labs, ledger, moving, profile, runs, training
from shelfcast.plans import reporting
from shelfcast.settings import DEFAULT_RULES, HCT_RULE, MODEL_FIELDS, Params

START = dt.date(2020, 1, 1)


def day(i: int) -> dt.date:
    return START + dt.timedelta(days=i)


def series(spark, numbers, column="used", kind="double"):
    return spark.createDataFrame(
        [(day(i), v) for i, v in enumerate(numbers)], f"date date, {column} {kind}"
    )


# --- scalar and aggregate rules ---------------------------------------------------------------

def test_lab_numbers(spark):
    texts = ["12.5", " 7 ", "<0.1", "<0.15", "<051", "1e3", ".5", "5.", "-2", "1d", "NaN",
             "Infinity", "0x1A", "1e999", "see note", "", None]
    want = [12.5, 7.0, 0.0, 5.0, 0.0, 1000.0, 0.5, 5.0, -2.0] + [None] * 8
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", values.lab_number(F.col("t")).alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == want


def test_positive_part_and_strict_sum(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (2, 3.0), (2, -4.0)], "k int, v double")
    assert rows(df.select(values.positive_part(F.col("v")))) == [(0.0,), (2.0,), (3.0,), (None,)]
    got = df.groupBy("k").agg(values.strict_sum("v"))
    assert rows(got) == [(1, None), (2, -1.0)]


def test_weekdays(spark):
    got = weekday_one_hot(series(spark, range(7), kind="int").select("date")).orderBy("date").collect()
    for r in got:
        assert [d for d in WEEKDAYS if r[d]] == [WEEKDAYS[r.date.weekday()]]


# --- exact statistics -------------------------------------------------------------------------

def brute(values_):
    known = np.array([v for v in values_ if v is not None and math.isfinite(v)])
    if not len(known):
        return (0, len(values_), None, None, None, None, None, None, None)
    sd = float(known.std(ddof=1)) if len(known) > 1 else None
    return (
        len(known), len(values_) - len(known), known.min(), known.max(), known.mean(), sd,
        *[float(np.quantile(known, p)) for p in (0.25, 0.5, 0.99)],
    )


def test_profile_matches_brute_force(spark):
    rng = random.Random(5)
    groups = {
        "hot": [rng.gauss(0, 1) for _ in range(20_000)],
        "constant": [7.3] * 500,
        "ties": [rng.choice([1.0, 2.0, 2.0, 3.0]) for _ in range(1000)],
        "narrow": [100 + rng.random() * 1e-6 for _ in range(3000)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(999)],
        "one": [4.0], "two": [4.0, 9.0], "none": [None, None],
        "mixed": [None, -1.0, 0.0, -0.0, 1.0, float("nan"), float("inf")],
        "gaps": [None] * 50 + [1.0, 2.0, 3.0], None: [1.0, 5.0, None],
    }
    data = [(k, v) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(data, "k string, v double").repartition(8)
    counts = profile.value_counts(df, ["k"], "v")
    got = profile.profile(counts, ["k"], (0.25, 0.5, 0.99), {"low": F.col("value") < 2.5})
    got = {r.k: r for r in got.collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        r, want = got[k], brute(vs)
        have = (r.n, r.n_missing, r.min, r.max, r.mean, r.sd, r.q0, r.q1, r.q2)
        for h, w in zip(have, want):
            if k == "wide" and isinstance(w, float) and not math.isfinite(w):
                continue  # numpy overflows on the squares
            assert (h is None) == (w is None)
            # The spread is good to about 1e-11 of the values, however narrow the group.
            assert w is None or h == pytest.approx(w, rel=1e-9, abs=1e-11 * abs(want[3] or 0) + 1e-12)
        known = [v for v in vs if v is not None and math.isfinite(v)]
        assert r.low == sum(v < 2.5 for v in known)
        for q, below in ((r.q0, r.below_q0), (r.q1, r.below_q1), (r.q2, r.below_q2)):
            assert not known or below == sum(v < q for v in known)


def test_profile_without_quantiles(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "k string, v double")
    got = profile.profile(profile.value_counts(df, ["k"], "v"), ["k"])
    assert rows(got, "k", "n", "n_missing", "min", "mean", "sd") == [
        ("a", 1, 1, 1.0, 1.0, None), ("b", 0, 1, None, None, None),
    ]
    pairs = df.selectExpr("k", "v", "5 AS w")
    weighted = profile.value_counts(pairs, ["k"], "v", "w")
    assert rows(profile.profile(weighted, ["k"], (0.5,)), "k", "n", "q0", "sd") == [
        ("a", 5, 1.0, 0.0), ("b", 0, None, None),
    ]


def test_constant_rules_alone(spark):
    rules = [r for r in DEFAULT_RULES if not r.is_quantile]
    clean = spark.createDataFrame(
        [(day(0), "PLT", 10.0), (day(0), "PLT", 200.0)], "date date, base_name string, lab_value double"
    )
    assert rows(labs.lab_threshold_counts(clean, rules).drop("date")) == [("PLT", 2, 1, 1, 1)]


def test_labs_per_site(spark):
    clean = spark.createDataFrame(
        [(s, day(0), "WBC", float(v)) for s, top in (("a", 5), ("b", 9)) for v in range(1, top + 1)],
        "site string, date date, base_name string, lab_value double",
    )
    counts = labs.lab_threshold_counts(clean, DEFAULT_RULES, ["site"])
    assert rows(counts, "site", "n", "below", "above") == [("a", 5, 1, 4), ("b", 9, 2, 7)]
    wide = labs.lab_features_wide(counts, DEFAULT_RULES, ["site"])
    assert rows(wide, "site", "WBC_Nq") == [("a", 4), ("b", 7)]


def test_profile_reads_its_input_once(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.rand(1).alias("v"))
    got = profile.profile(profile.value_counts(df, ["k"], "v"), ["k"], (0.5,))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "ReusedExchange" in plan and plan.count("Range (0, 1000") == 1


def test_threshold_counts(spark):
    data = [(day(0), "WBC", float(v)) for v in range(1, 6)]
    data += [(day(0), "PLT", v) for v in (149.0, 150.0, 151.0, None)]
    data += [(day(0), "HGB", None), (day(0), "HCT", 1.0)]
    clean = spark.createDataFrame(data, "date date, base_name string, lab_value double")
    counts = labs.lab_threshold_counts(clean, DEFAULT_RULES)
    assert rows(counts.drop("date")) == [
        ("HGB", 1, 0, 0, 0), ("PLT", 4, 1, 2, 1), ("WBC", 5, 1, 4, 4),
    ]
    wide = labs.lab_features_wide(counts, DEFAULT_RULES)
    assert wide.columns == ["date", *[f"{r.base_name}_Nq" for r in DEFAULT_RULES]]
    assert rows(wide, "WBC_Nq", "PLT_Nq", "RDW_Nq") == [(4, 1, 0)]
    both = labs.lab_counts_wide(counts, DEFAULT_RULES)
    assert labs.drop_suffix(both, "_N").columns == wide.columns
    assert HCT_RULE.base_name not in [r.base_name for r in DEFAULT_RULES]


# --- moving windows ---------------------------------------------------------------------------

def test_moving_windows_need_full_frames(spark):
    df = series(spark, [1.0, 2.0, 3.0, None, 5.0, 6.0, 7.0])
    got = df.select(
        "date", moving.moving_mean("used", 3).alias("ma"), moving.moving_sum("used", 2).alias("ms"),
        moving.forward_sum("used", 2).alias("fw"),
    ).orderBy("date").collect()
    assert [r.ma for r in got] == [None, None, 2.0, None, None, None, 6.0]
    assert [r.ms for r in got] == [None, 3.0, 5.0, None, None, 11.0, 13.0]
    assert [r.fw for r in got] == [5.0, None, None, 11.0, 13.0, None, None]
    smoothed = moving.smooth(df, 3).orderBy("date").collect()
    assert [r.used for r in smoothed] == [r.ma for r in got]


def test_moving_windows_per_key(spark):
    df = series(spark, range(10), kind="int").crossJoin(spark.range(3).withColumnRenamed("id", "site"))
    got = df.withColumn("m", moving.moving_sum("used", 2, ["site"])).filter("date = '2020-01-02'")
    assert rows(got, "site", "m") == [(0, 1), (1, 1), (2, 1)]


# --- daily series -----------------------------------------------------------------------------

def test_accumulate_is_order_free_and_strict(spark):
    a = series(spark, [1.0, 2.0])
    b = spark.createDataFrame([(day(1), 5.0), (day(2), None)], "date date, used double")
    want = [(day(0), 1.0), (day(1), 7.0), (day(2), None)]
    assert rows(daily.accumulate([a, b])) == want == rows(daily.accumulate([b, a]))
    c = spark.createDataFrame([(day(0), 1)], "date date, other int")
    got = daily.accumulate([a, c])
    assert rows(got, "date", "used", "other") == [(day(0), None, None), (day(1), 2.0, None)]


def test_row_positions(spark):
    df = series(spark, range(10), kind="int")
    assert [r[1] for r in rows(daily.last_days(df, 3))] == [7, 8, 9]
    assert [r[1] for r in rows(daily.first_days(df, 3))] == [0, 1, 2]
    assert [r[1] for r in rows(daily.skip_days(df, 8))] == [8, 9]


def test_inventory_buckets_add_up(spark):
    df = spark.createDataFrame(
        [(day(0), t, d) for t in ("PLT", "RBC") for d in (-1.0, 0.0, 0.2, 1.0, 1.1, 2.0, 9.0, None)],
        "date date, type string, days_to_expire double",
    )
    assert rows(daily.inventory_buckets(df)) == [(day(0), 5, 2, 2, 1)]


# --- training table and scaling ---------------------------------------------------------------

@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 90
    usage = series(spark, [int(v) for v in rng.poisson(30, n)], kind="bigint")
    features = spark.createDataFrame(
        [(day(i), int(a), int(b)) for i, (a, b) in enumerate(rng.integers(0, 50, (n, 2)))],
        "date date, HGB_Nq bigint, PLT_Nq bigint",
    )
    census = spark.createDataFrame(
        [(day(i), int(a), 4) for i, a in enumerate(rng.integers(0, 9, n))],
        "date date, B1 bigint, `E2-ICU` bigint",
    )
    return training.training_table(features, census, usage).orderBy("date").cache()


def test_training_table_columns(table):
    assert table.columns == [
        "date", *WEEKDAYS, "seven_lag", "HGB_Nq", "PLT_Nq", "B1", "E2-ICU", "plt_used",
    ]
    assert table.count() == 90


def test_incomplete_dates(spark):
    usage = series(spark, [1, 2, 3], kind="int")
    labs_ = series(spark, [1, 2], "x", "int")
    census = series(spark, [1], "x", "int")
    assert rows(training.incomplete_dates(labs_, census, usage)) == [
        (day(1), "census"), (day(2), "census"), (day(2), "labs"),
    ]


def test_scaler_gives_zero_mean_and_unit_sd(table):
    scaler = training.fit_scaler(table)
    scaled = training.apply_scaler(table, scaler)
    pdf = scaled.toPandas().drop(columns=["date", "plt_used"]).astype(float)
    assert pdf["E2-ICU"].isna().all()  # constant: no scale
    live = pdf.drop(columns=["E2-ICU"])
    assert np.allclose(live.mean(), 0, atol=1e-9) and np.allclose(live.std(ddof=1), 1)
    centred = training.apply_scaler(table, scaler, scale=False).toPandas()
    assert (centred["E2-ICU"] == 0).all()
    divided = training.apply_scaler(table, scaler, center=False).toPandas()
    assert np.allclose(divided["B1"] * table.toPandas()["B1"].std(), table.toPandas()["B1"])


def test_scaler_per_key(spark, table):
    keyed = table.withColumn("site", F.lit("a")).unionByName(
        table.withColumn("site", F.lit("b")).withColumn("B1", F.col("B1") * 2)
    )
    got = training.fit_scaler(keyed, ["site"]).filter("predictor = 'B1'")
    (_, _, ca, sa), (_, _, cb, sb) = rows(got)
    assert cb == pytest.approx(2 * ca) and sb == pytest.approx(2 * sa)
    scaled = training.apply_scaler(keyed, training.fit_scaler(keyed, ["site"]), ["site"])
    assert scaled.count() == 180


def test_rolling_scaler_equals_cut_then_smooth(spark, table):
    history, k = 20, 7
    got = {
        (r.date, r.predictor): (r.center, r.scale)
        for r in training.rolling_scaler(table, history, k).collect()
    }
    pdf = table.toPandas()
    used = pdf["plt_used"].astype(float)
    for at in range(len(pdf)):
        center, scale = got[(pdf["date"][at], "seven_lag")]
        if at < history:
            assert center is None and scale is None
            continue
        cut = used[at - history : at + 1].reset_index(drop=True).rolling(k).mean()[:history]
        assert center == pytest.approx(cut.mean()) and scale == pytest.approx(cut.std())
        ward = pdf["B1"][at - history : at]
        assert got[(pdf["date"][at], "B1")] == pytest.approx((ward.mean(), ward.std()))


def test_rolling_scaler_of_equal_and_missing_values(spark):
    """Frames of equal values scale to exactly zero, also behind far larger ones."""
    history, values = 4, [1e6, 3.7, -2e5, 0.1, 0.1, None, 0.1, 0.1, 0.1, 0.3, None, None, None, None, 5.0, 0.1]
    df = spark.createDataFrame(
        [(s, day(i), v, None if i < 6 else 1.5 * i) for s in "ab" for i, v in enumerate(values)],
        "site string, date date, a double, b double",
    )
    got = {
        (r.site, r.date, r.predictor): (r.center, r.scale)
        for r in training.rolling_scaler(df, history, 1, ["site"], ["a", "b"]).collect()
    }
    assert len(got) == 2 * 2 * len(values)
    for i in range(len(values)):
        for name, series in (("a", values), ("b", [None if k < 6 else 1.5 * k for k in range(len(values))])):
            frame = [v for v in series[max(0, i - history):i] if v is not None] if i >= history else []
            center, scale = got["b", day(i), name]
            assert got["a", day(i), name] == (center, scale)
            mean = sum(frame) / len(frame) if frame else None
            assert center == (None if mean is None else pytest.approx(mean, abs=1e-9))
            if len(frame) < 2:
                assert scale is None
            elif len(set(frame)) == 1:
                assert scale == 0
            else:
                sd = (sum((v - mean) ** 2 for v in frame) / (len(frame) - 1)) ** 0.5
                assert scale == pytest.approx(sd, rel=1e-12)


# --- run log and forecast ---------------------------------------------------------------------

def test_model_age_reasons(spark):
    base = Params(model_update_frequency=4)
    data = [(0, 7, False), (1, 7, False), (2, 7, True), (3, 7, False), (4, 7, False), (10, 7, False),
            (11, 8, False), (12, 8, False)]
    df = spark.createDataFrame([(day(i), c, m) for i, c, m in data], "date date, c0 int, multi_date boolean")
    df = df.withColumns(
        {f: F.lit(getattr(base, f)) for f in MODEL_FIELDS if f != "c0"}
    )
    got = rows(runs.model_age(runs.run_gaps(df)), "age_before", "reason")
    assert got == sorted(
        [(None, "first"), (1, None), (2, "several dates"), (3, None), (4, "stale"), (5, "stale"),
         (11, "parameters changed"), (12, "stale")],
        key=lambda t: (t[0] is None, t[0] or 0),
    )


def brute_forecast(pdf, names, starts, history, k, penalty):
    """Cut, standardise, solve, score: one model at a time."""
    target = sum(pdf["plt_used"].shift(-j).astype(float) for j in (1, 2, 3))
    out, bounds = {}, [*starts, len(pdf)]
    for s, e in zip(bounds, bounds[1:]):
        x = pdf[names].iloc[s - history : s].astype(float).reset_index(drop=True)
        y = target.iloc[s - history : s].reset_index(drop=True)
        y[history - 2 :] = np.nan
        x.loc[: k - 2, [n for n in names if n == "seven_lag" or n.endswith("_Nq")]] = np.nan
        mean, sd = x.mean(), x.std()
        live = [n for n in names if sd[n] > 0]
        z = ((x - mean) / sd)[live]
        ok = z.notna().all(axis=1) & y.notna()
        z, y = z[ok], y[ok]
        design = np.column_stack([np.ones(len(z)), z - z.mean()])
        ridge = np.diag([0.0] + [penalty] * len(live))
        beta = np.linalg.solve(design.T @ design + ridge, design.T @ y)
        new = ((pdf[names].iloc[s:e].astype(float) - mean) / sd)[live] - z.mean()
        for i, v in zip(range(s, e), beta[0] + new.to_numpy() @ beta[1:]):
            out[pdf["date"][i]] = v
    return out


@pytest.mark.parametrize("block", [50, 3])
def test_rolling_forecast_equals_brute_force(spark, table, block, monkeypatch):
    monkeypatch.setattr(forecast, "BLOCK", block)
    history, penalty = 30, 2.0
    flagged = table.withColumn("retrain", F.dayofmonth("date") % 9 == 0)
    got = rows(forecast.rolling_forecast(flagged, (), history, 7, penalty))
    pdf = flagged.toPandas()
    starts = [i for i in range(history, len(pdf)) if pdf["retrain"][i]]
    want = brute_forecast(pdf, training.predictors(flagged), starts, history, 7, penalty)
    assert [d for _, d, _ in rows(table.select("date", "date", "date"))] == sorted(d for _, d, _ in got)
    assert {d for m, d, _ in got if m is not None} == set(want)
    for m, d, t in got:
        assert t is None if m is None else t == pytest.approx(want[d], rel=1e-8)


def test_slopes_are_zero_at_the_fit_only(spark, table):
    flagged = table.withColumn("retrain", F.dayofmonth("date") % 9 == 0)
    models = forecast.rolling_models(flagged, (), 30, 7, 2.0)
    got = forecast.slopes(models, flagged, (), 30, 7, 2.0).collect()
    assert len({r.model_date for r in got}) > 3 and len({r.predictor for r in got}) == len(training.predictors(flagged)) + 1
    assert max(abs(r.slope) for r in got) < 1e-8
    for moved in (models.withColumn("intercept", F.col("intercept") + 0.1),
                  models.withColumn("coef", F.transform_values("coef", lambda k, v: F.when(k == "B1", v + 0.1).otherwise(v)))):
        off = forecast.slopes(moved, flagged, (), 30, 7, 2.0).groupBy("model_date").agg(F.max(F.abs("slope")).alias("most"))
        assert min(r.most for r in off.collect()) > 0.1


def test_rolling_forecast_per_key(spark, table):
    flagged = table.withColumn("retrain", F.dayofmonth("date") % 9 == 0)
    one = rows(forecast.rolling_forecast(flagged, (), 30), "date", "t_pred")
    keyed = flagged.crossJoin(spark.createDataFrame([("a",), ("b",)], "site string"))
    both = forecast.rolling_forecast(keyed, ["site"], 30)
    for site in "ab":
        got = rows(both.filter(F.col("site") == site), "date", "t_pred")
        assert [d for d, _ in got] == [d for d, _ in one]
        assert [t or 0.0 for _, t in got] == pytest.approx([t or 0.0 for _, t in one])


# --- ledger and reports -----------------------------------------------------------------------

def pos(v):
    return None if v is None else max(v, 0)


def days_frame(spark, used, target, key=None):
    data = [(day(i), u, t) for i, (u, t) in enumerate(zip(used, target))]
    df = spark.createDataFrame(data, "date date, plt_used double, t_pred double")
    return df if key is None else df.withColumn("site", F.lit(key))


def test_ledger_by_hand(spark):
    params = Params(start=2, min_inventory=10, initial_collection=(5, 6, 7), initial_expiry=(2, 3))
    used, target = [1.0, 4.0, 3.0, 9.0, 2.0], [20.0, 21.0, 22.0, 23.0, 24.0]
    got = ledger.order_ledger(days_frame(spark, used, target), params).orderBy("date").collect()
    columns = ("r1", "r2", "w", "x", "s", "t_adj", "r1_adj", "r2_adj", "w_adj", "x_adj", "s_adj")
    table = [tuple(r[c] for c in columns) for r in got]
    assert table == [
        (0, 0, 0, 0, 0, 20, 0, 0, 0, 0, 0),
        (1, 5, 0, 5, 0, 21, 0, 0, 0, 5, 0),
        (3, 6, 0, 6, 0, 23, 0, 3, 0, 6, 0),
        (0, 7, 0, 7, 0, 26, 0, 1, 0, 7, 0),
        (5, 3, 0, 3, 0, 26, 0, 2, 0, 3, 0),
    ]
    assert [r.alert for r in got] == [True, True, True, True, True]
    first = ledger.order_ledger(
        days_frame(spark, [1.0, 20.0, 3.0], target[:3]), params
    ).orderBy("date").collect()[1]
    assert first.s == 20 - 2 + 3 - 5
    straight = ledger.order_ledger(
        days_frame(spark, [1.0, 20.0, 3.0], target[:3]), params, consistent_first_row=True
    ).orderBy("date").collect()[1]
    assert straight.s == 20 - 2 - 3 - 5


def test_ledger_nulls_spread_forward_per_key(spark):
    used = [float(v) for v in range(1, 13)]
    target = [20.0] * 12
    broken = [*used[:6], None, *used[7:]]
    df = days_frame(spark, used, target, "a").unionByName(days_frame(spark, broken, target, "b"))
    got = ledger.order_ledger(df, Params(start=3), ["site"])
    assert got.filter("site = 'a' AND r1 IS NULL").count() == 0
    assert got.filter("site = 'b' AND r1 IS NULL").count() == 6
    alone = ledger.order_ledger(days_frame(spark, used, target), Params(start=3))
    assert rows(got.filter("site = 'a'").drop("site")) == rows(alone)


def test_ledger_needs_enough_days(spark):
    df = days_frame(spark, [1.0, 2.0], [3.0, 4.0])
    with pytest.raises(Exception, match="starts after"):
        ledger.order_ledger(df, Params(start=3)).collect()
    last_row_only = ledger.order_ledger(df, Params(start=2)).orderBy("date").collect()
    assert last_row_only[1].x == 60


def test_site_days_fill_the_calendar(spark):
    usage = spark.createDataFrame(
        [("a", day(0), 4), ("a", day(3), 2), ("b", day(2), 1)], "site string, date date, used bigint"
    )
    got = rows(reporting.site_days(usage, ["site"]), "site", "date", "plt_used")
    assert got == [
        *[("a", day(i), v) for i, v in enumerate([4, 0, 0, 2, None, None])],
        *[("b", day(i), v) for i, v in enumerate([0, 0, 1, 0, None, None])],
    ]


def test_prediction_vs_usage_bounds(spark):
    usage = series(spark, [3, 4], kind="bigint")
    prediction = spark.createDataFrame([(day(1), 9.0)], "date date, t_pred double")
    got = reporting.prediction_vs_usage(usage, prediction, str(day(-1)), str(day(2)))
    assert rows(got, "date", "plt_used", "t_pred") == [
        (day(-1), None, None), (day(0), 3, None), (day(1), 4, 9.0), (day(2), None, None),
    ]


def test_report_repeats_rows_of_repeated_snapshots(spark):
    days = days_frame(spark, [1.0] * 4, [5.0] * 4)
    stock = spark.createDataFrame(
        [(day(1), 5, 1, 1, 3), (day(1), 6, 1, 1, 4)],
        "date date, count bigint, r1 bigint, r2 bigint, r3_plus bigint",
    )
    got = reporting.prediction_report(days, stock, Params(start=1))
    assert got.count() == 5 and got.columns[0] == "date" and len(got.columns) == 19
    empty = reporting.prediction_report(days, None, Params(start=1))
    assert rows(empty, "`Inv. count`") == [(None,)] * 4


def test_histogram_counts_every_value(spark):
    n = 40
    df = ledger.order_ledger(
        days_frame(spark, [float(i % 7) for i in range(n)], [9.0 + i % 5 for i in range(n)]),
        Params(start=2),
    )
    got = reporting.stock_histogram(df, Params(start=2), bins=10)
    totals = {m: n_ for m, n_ in rows(got.groupBy("measure").agg(F.sum("n")))}
    assert totals == {"remaining": n - 2, "wasted": n - 2}
    assert all(1 <= b <= 10 for _, b, _ in rows(got))


def test_views_of_a_day(spark):
    wide = spark.createDataFrame([(day(0), 1, 2), (day(1), 3, 4)], "date date, B1 int, A1 int")
    last = reporting.census_of_day(reporting.latest_row(wide), ["B1", "A1"])
    assert [tuple(r) for r in last.collect()] == [("A1", 4), ("B1", 3)]
    assert reporting.of_day(wide, str(day(0))).count() == 1
    assert rows(reporting.of_latest_day(wide), "B1") == [(3,)]


def test_parameters_are_validated():
    with pytest.raises(ValueError):
        Params(initial_collection=(1, 2))
    with pytest.raises(ValueError):
        Params(initial_expiry=(1, -2))


OUTLIER = "CASE WHEN id = 0 THEN 1001D ELSE 1000 + id / 4e8 END"


def test_parts_hold_few_values_beside_an_outlier(spark):
    """A million values within a ten-millionth of a bucket that an outlier stretches."""
    frame = spark.range(1_000_000).selectExpr("'a' AS k", f"{OUTLIER} AS v")
    counts = profile.value_counts(frame, ["k"], "v").withColumn("bucket", F.expr(profile._BUCKET))
    size = counts.groupBy("k", "bucket").agg(F.count("*").alias("bucket_values"))
    assert size.count() == 1
    cut = profile._with_cuts(counts.join(size, ["k", "bucket"]), ["k"]).withColumn("part", F.expr(profile._PART))
    parts = cut.groupBy("part").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    got = sorted(parts.collect(), key=lambda r: r.part)
    assert len(got) == 256 and max(r.n for r in got) < 6_000
    assert all(a.hi < b.lo for a, b in zip(got, got[1:]))


@pytest.mark.parametrize("shape", ["narrow", "ties", "wide", "outlier"])
def test_profile_of_values_close_together(spark, shape):
    """A group within one bucket, with and without ties, next to a NULL group."""
    value = {"narrow": "1000 + id / 20000D", "ties": "1000 + floor(id / 500) / 40D", "wide": "id * id", "outlier": OUTLIER}[shape]
    frame = spark.range(20000).selectExpr("CASE WHEN id % 3 > 0 THEN 'a' END AS k", f"CAST({value} AS DOUBLE) AS v")
    probs = (0.0, 0.25, 0.5, 0.999, 1.0)
    got = profile.profile(profile.value_counts(frame, ["k"], "v"), ["k"], probs)
    pdf = frame.toPandas()
    seen = {r.k: r for r in got.collect()}
    assert set(seen) == {None, "a"}
    for k, row in seen.items():
        v = pdf["v"][pdf["k"].isna() if k is None else pdf["k"] == k].to_numpy()
        for i, p in enumerate(probs):
            q = np.quantile(v, p)
            assert row[f"q{i}"] == pytest.approx(q, rel=1e-12)
            assert row[f"below_q{i}"] == (v < row[f"q{i}"]).sum()
