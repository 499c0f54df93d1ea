"""The training table and its standardisation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.times import WEEKDAYS, weekday_one_hot
from shelfcast.operators.moving import moving_mean, smooth

Keys = Sequence[str]
RESPONSE = "plt_used"
RETRAIN = "retrain"  # set on a training table whose rows know whether their run retrains


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in names]


def training_table(
    features: DataFrame, census: DataFrame, usage: DataFrame, keys: Keys = (), smoothing: int = 7
) -> DataFrame:
    """Usage with its trailing mean, smoothed lab features, weekdays and wards, one row per date.

    Columns come as keys, date, Mon..Sun, seven_lag, labs, wards, response. Dates missing from a
    feed drop out; :func:`incomplete_dates` lists them.
    """
    by = [*keys, "date"]
    labs = [c for c in features.columns if c not in by]
    wards = [c for c in census.columns if c not in by]
    used = usage.withColumnRenamed("used", RESPONSE).withColumn(
        "seven_lag", moving_mean(RESPONSE, smoothing, keys)
    )
    joined = used.join(smooth(features, smoothing, keys), by).join(census, by)
    return weekday_one_hot(joined).selectExpr(
        *_quoted([*by, *WEEKDAYS, "seven_lag", *labs, *wards, RESPONSE])
    )


def incomplete_dates(
    features: DataFrame, census: DataFrame, usage: DataFrame, keys: Keys = ()
) -> DataFrame:
    """Usage dates without lab features or census, with the feed that lacks them.

    Both feeds may come as raw rows: only their distinct dates take part.
    """
    by = [*keys, "date"]
    dates = usage.select(*by)
    return reduce(
        DataFrame.unionByName,
        [
            dates.join(feed.select(*by).distinct(), by, "left_anti").withColumn(
                "missing_feed", F.lit(name)
            )
            for name, feed in (("labs", features), ("census", census))
        ],
    )


def predictors(table: DataFrame, keys: Keys = ()) -> list[str]:
    return [c for c in table.columns if c not in (*keys, "date", RESPONSE, RETRAIN)]


def smoothed_columns(names: Sequence[str]) -> list[str]:
    """The predictors that are trailing means: the lag and the lab features."""
    return [c for c in names if c == "seven_lag" or c.endswith("_Nq")]


def fit_scaler(table: DataFrame, keys: Keys = ()) -> DataFrame:
    """Mean and sample standard deviation per predictor, NULLs ignored: (predictor, center, scale).

    One aggregate over all columns, then a short unpivot of its single row per key.
    """
    names = predictors(table, keys)
    wide = table.groupBy(*keys).agg(
        *[
            F.expr(f"{fn}(`{c}`) AS {out}{i}")
            for i, c in enumerate(names)
            for fn, out in (("avg", "c"), ("stddev_samp", "s"))
        ]
    )
    rows = ", ".join(f"{sql_text(c)}, c{i}, s{i}" for i, c in enumerate(names))
    return wide.selectExpr(
        *_quoted(keys), f"stack({len(names)}, {rows}) AS (predictor, center, scale)"
    )


def sql_text(name: str) -> str:
    """SQL string literal."""
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def apply_scaler(
    table: DataFrame,
    scaler: DataFrame,
    keys: Keys = (),
    center: bool = True,
    scale: bool = True,
) -> DataFrame:
    """Subtract the centre and divide by the scale, either of which may be left out.

    A zero or missing scale gives NULL. The scaler becomes one row per key with one field per
    predictor; without keys that single row is broadcast, with keys it is an ordinary join.
    """
    names = predictors(table, keys)
    params = scaler.groupBy(*keys).agg(
        *[
            F.first(
                F.when(F.col("predictor") == c, F.struct("center", "scale")), ignorenulls=True
            ).alias(f"_p{i}")
            for i, c in enumerate(names)
        ]
    )
    joined = table.join(params, list(keys)) if keys else table.crossJoin(F.broadcast(params))
    at = {c: f"_p{i}" for i, c in enumerate(names)}

    def scaled(c: str) -> str:
        v = f"CAST(`{c}` AS DOUBLE)"
        if center:
            v = f"({v} - {at[c]}.center)"
        if scale:
            v = f"try_divide({v}, {at[c]}.scale)"
        return f"{v} AS `{c}`"

    return joined.selectExpr(*[scaled(c) if c in at else f"`{c}`" for c in table.columns])


def rolling_scaler(
    table: DataFrame,
    history: int = 200,
    smoothing: int = 7,
    keys: Keys = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """For every date, the centre and scale of each predictor over the ``history`` rows before it.

    A training cut starts its trailing means afresh, so a smoothed column has no value in the
    first ``smoothing - 1`` rows of the cut and its frame is that much shorter. Dates with fewer
    than ``history`` rows before them get NULL. Returns (date, predictor, center, scale), with
    ``retrain`` if the table has it.

    The cost per row does not depend on ``history``. Each predictor of a key is a series of its own,
    in blocks as long as a frame. A frame is the end of one block and the start of the next, so
    moments that run from both ends of each block, merged in pairs, are those of all frames.
    Nothing outside a frame enters it, and a frame of equal values has a scale of exactly zero.
    """
    names = list(columns or predictors(table, keys))
    smoothed = ", ".join(sql_text(c) for c in smoothed_columns(names)) or "NULL"
    heads = _quoted([c for c in (*keys, "date", RETRAIN) if c in table.columns])
    by = ", ".join([*_quoted(keys), "predictor"])
    series, short = f"OVER (PARTITION BY {by} ORDER BY date)", history - smoothing + 1

    cells = ", ".join(f"{sql_text(c)}, CAST(`{c}` AS DOUBLE)" for c in names)
    blocks = (
        table.selectExpr(*heads, f"stack({len(names)}, {cells}) AS (predictor, v)")
        .selectExpr(
            "*", f"row_number() {series} AS row",
            f"CASE WHEN predictor IN ({smoothed}) THEN {short} ELSE {history} END AS size",
        )
        .withColumn("block", F.expr("(row - 1) div size"))
    )

    def moments(order: str, name: str) -> str:
        run = f"OVER (PARTITION BY {by}, block ORDER BY {order} ROWS UNBOUNDED PRECEDING)"
        return (
            f"named_struct('n', count(v) {run}, 'mean', avg(v) {run}, "
            f"'m2', var_pop(v) {run} * count(v) {run}) AS {name}"
        )

    run = blocks.selectExpr("*", moments("date", "starts"), moments("date DESC", "ends"))
    frames = run.selectExpr(
        *heads, "predictor", f"row > {history} AS enough", f"lag(starts, 1) {series} AS b",
        f"""CASE WHEN (row - 1) % size > 0 THEN CASE WHEN size = {history}
            THEN lag(ends, {history}) {series} ELSE lag(ends, {short}) {series} END END AS a""",
    )
    merged = frames.selectExpr(
        *heads, "predictor", "enough", "coalesce(a.n, 0) AS n1", "coalesce(b.n, 0) AS n2",
        "coalesce(a.mean, b.mean) AS mean1", "coalesce(b.mean, a.mean) AS mean2",
        "coalesce(a.m2, 0D) + coalesce(b.m2, 0D) AS m2",
    ).selectExpr(
        *heads, "predictor", "enough", "n1 + n2 AS n",
        "mean1 + (mean2 - mean1) * try_divide(n2, n1 + n2) AS mean",
        "m2 + (mean2 - mean1) * (mean2 - mean1) * n1 * try_divide(n2, n1 + n2) AS m2",
    )
    return merged.selectExpr(
        *heads, "predictor", "CASE WHEN enough THEN mean END AS center",
        "CASE WHEN enough AND n > 1 THEN sqrt(m2 / (n - 1)) END AS scale",
    )


def scaler_as_of(rolling: DataFrame, keys: Keys = ()) -> DataFrame:
    """The scaler in force on each date: that of the latest retrain up to and including it.

    ``rolling`` is a :func:`rolling_scaler` result that carries ``retrain``.
    """
    by = [*keys, "date"]
    w = (
        Window.partitionBy(*keys, "predictor")
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    own = F.when(F.col(RETRAIN), F.struct("date", "center", "scale"))
    return rolling.withColumn("_last", F.last(own, ignorenulls=True).over(w)).select(
        *by, "predictor",
        F.col("_last.date").alias("fitted_on"),
        F.col("_last.center").alias("center"),
        F.col("_last.scale").alias("scale"),
    )
