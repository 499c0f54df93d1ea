"""Three-day usage forecast: one small ridge regression per key and retrain date.

All models of a backfill are fitted at once. Consecutive retrains form a block, and a row is sent to
the blocks that train on it and to the one that scores it: blocks share one training window of
``history`` rows with their neighbours, so that few rows go to two of them, and no block grows with
the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.moving import forward_sum
from shelfcast.operators.partitioning import spread
from shelfcast.operators.training import (
    RESPONSE, RETRAIN, predictors, smoothed_columns, sql_text,
)

Keys = Sequence[str]
BLOCK = 50  # retrains fitted by one call, about a year of weekly ones


def three_day_target(usage: DataFrame, keys: Keys = (), column: str = "used") -> DataFrame:
    """What a forecast made with a day's data is about: the usage of the next three rows."""
    return usage.withColumn("y3", forward_sum(column, 3, keys))


def _window_rows(x: np.ndarray, smoothed: np.ndarray, lag: int) -> np.ndarray:
    """A cut restarts its trailing means: their first ``lag`` rows have no value."""
    x = x.copy()
    x[:lag, smoothed] = np.nan
    return x


@dataclass(frozen=True)
class _Fit:
    """A ridge regression on standardised columns, and what it was fitted on."""

    intercept: float
    coef: np.ndarray  # in the predictors' own units
    rows: np.ndarray  # the complete rows of the window


def _fit_ridge(x: np.ndarray, y: np.ndarray, penalty: float) -> _Fit:
    coef = np.zeros(x.shape[1])
    known = ~np.isnan(x)
    counts = np.maximum(known.sum(axis=0), 1)
    center = np.where(known, x, 0).sum(axis=0) / counts
    scale = np.sqrt(
        np.where(known, (x - center) ** 2, 0).sum(axis=0) / np.maximum(counts - 1, 1)
    )
    use = scale > 0
    z = (x[:, use] - center[use]) / scale[use]
    rows = ~np.isnan(z).any(axis=1) & ~np.isnan(y)
    if not rows.any():
        return _Fit(float("nan"), coef, rows)
    z, y = z[rows], y[rows]
    mean_z, mean_y = z.mean(axis=0), y.mean()
    z, y = z - mean_z, y - mean_y
    beta = np.linalg.solve(z.T @ z + penalty * np.eye(z.shape[1]), z.T @ y)
    coef[use] = beta / scale[use]
    intercept = float(mean_y - mean_z @ beta - coef[use] @ center[use])
    return _Fit(intercept, coef, rows)


def _packed(table: DataFrame, names: Sequence[str], keys: Keys) -> DataFrame:
    """Predictors in one array column, with row number and target."""
    by = "PARTITION BY " + ", ".join(f"`{k}`" for k in keys) if keys else ""
    values = ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in names)
    flag = [RETRAIN] if RETRAIN in table.columns else []
    return three_day_target(table, keys, RESPONSE).selectExpr(
        *[f"`{k}`" for k in keys], "date", *flag, "CAST(y3 AS DOUBLE) AS y3", f"array({values}) AS x",
        f"row_number() OVER ({by} ORDER BY date) AS row",
    )


def fit_model(
    cut: DataFrame, keys: Keys = (), smoothing: int = 7, penalty: float = 15.0, history: int = 200
) -> DataFrame:
    """Model of one training cut per key: (keys, predictors, intercept, coef).

    The cut is the ``history`` training rows followed by the row to score, which only lends its
    usage to the last known target. A shorter cut gives a NULL intercept.
    """
    names = predictors(cut, keys)
    smoothed = np.isin(names, smoothed_columns(names))
    packed = _packed(cut, names, keys)
    schema = T.StructType(
        [
            *[packed.schema[k] for k in keys],
            T.StructField("predictors", T.ArrayType(T.StringType())),
            T.StructField("intercept", T.DoubleType()),
            T.StructField("coef", T.ArrayType(T.DoubleType())),
        ]
    )

    def fit_cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        out = pdf[list(keys)].head(1).reset_index(drop=True)
        if not keys:
            out = pd.DataFrame(index=[0])
        intercept, coef = float("nan"), np.zeros(len(names))
        if len(pdf) > history:
            x = _window_rows(np.stack(pdf["x"].to_numpy())[:history], smoothed, smoothing - 1)
            fit = _fit_ridge(x, pdf["y3"].to_numpy(dtype=float)[:history], penalty)
            intercept, coef = fit.intercept, fit.coef
        return out.assign(predictors=[list(names)], intercept=intercept, coef=[coef.tolist()])

    return spread(packed, keys).groupBy(*keys).applyInPandas(fit_cut, schema)


def score(table: DataFrame, model: DataFrame, keys: Keys = ()) -> DataFrame:
    """(date, t_pred) by plain column arithmetic; the model is one row per key."""
    names = predictors(table, keys)
    coef = F.map_from_arrays("predictors", "coef")
    model = model.select(*keys, "intercept", coef.alias("_coef"))
    joined = table.join(model, list(keys)) if keys else table.crossJoin(F.broadcast(model))
    terms = [f"CAST(`{c}` AS DOUBLE) * _coef[{sql_text(c)}]" for c in names]
    return joined.selectExpr(
        *[f"`{k}`" for k in keys], "date", " + ".join(["intercept", *terms]) + " AS t_pred"
    )


def rolling_forecast(
    table: DataFrame,
    keys: Keys = (),
    history: int = 200,
    smoothing: int = 7,
    penalty: float = 15.0,
) -> DataFrame:
    """(date, model_date, t_pred) of every date; NULL before the first retrain with a full window.

    ``table`` is a training table with a ``retrain`` flag. A model trains on the ``history`` rows
    before its retrain date, as far as their three-day target is known by then, and scores the
    rows from that date up to the next retrain. One pass over the table: windows tell each row
    its blocks of models.
    """
    uses, smoothed = _blocks(table, keys, history)
    heads = [*keys, "block"]
    schema = T.StructType(
        [
            *[uses.schema[k] for k in keys],
            T.StructField("model_date", T.DateType()),
            T.StructField("date", T.DateType()),
            T.StructField("t_pred", T.DoubleType()),
        ]
    )

    def fit_and_score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        row, own = pdf["row"].to_numpy(), pdf["own"].to_numpy(dtype=bool)
        x, dates = np.stack(pdf["x"].to_numpy()), pdf["date"].to_numpy()
        model_date = np.full(len(pdf), None, dtype=object)
        t_pred = np.full(len(pdf), np.nan)
        # A later model overwrites what an earlier one said about its rows.
        for start, fit, _ in _models(pdf, smoothed, history, smoothing, penalty):
            scored = own & (row >= row[start])
            model_date[scored] = dates[start]
            t_pred[scored] = fit.intercept + x[scored] @ fit.coef
        return pdf.loc[own, [*keys, "date"]].assign(model_date=model_date[own], t_pred=t_pred[own])

    done = spread(uses, heads).groupBy(*heads).applyInPandas(fit_and_score, schema)
    return done.withColumn("t_pred", F.nanvl("t_pred", F.lit(None).cast("double")))


def rolling_models(
    table: DataFrame,
    keys: Keys = (),
    history: int = 200,
    smoothing: int = 7,
    penalty: float = 15.0,
) -> DataFrame:
    """The models behind :func:`rolling_forecast`, one row per key and retrain date.

    Columns: model_date, n (complete training rows), target_sum, predictor_sums (a map, over those
    rows), intercept and coef (a map).
    """
    names = predictors(table, keys)
    uses, smoothed = _blocks(table, keys, history)
    heads = [*keys, "block"]
    lists = T.ArrayType(T.DoubleType())
    schema = T.StructType(
        [
            *[uses.schema[k] for k in keys],
            T.StructField("model_date", T.DateType()), T.StructField("n", T.LongType()),
            T.StructField("target_sum", T.DoubleType()), T.StructField("sums", lists),
            T.StructField("intercept", T.DoubleType()), T.StructField("coefs", lists),
        ]
    )

    def fit_all(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        x, dates = np.stack(pdf["x"].to_numpy()), pdf["date"].to_numpy()
        out = []
        for start, fit, (train, y) in _models(pdf, smoothed, history, smoothing, penalty):
            sums = x[train][fit.rows].sum(axis=0).tolist()
            out.append((
                *pdf.iloc[start][list(keys)], dates[start], int(fit.rows.sum()),
                float(y[fit.rows].sum()), sums, fit.intercept, fit.coef.tolist(),
            ))
        return pd.DataFrame(out, columns=schema.names)

    named = F.array(*[F.lit(n) for n in names])
    return (
        spread(uses, heads).groupBy(*heads).applyInPandas(fit_all, schema)
        .withColumn("predictor_sums", F.map_from_arrays(named, "sums"))
        .withColumn("coef", F.map_from_arrays(named, "coefs"))
        .drop("sums", "coefs")
    )


def slopes(
    models: DataFrame, table: DataFrame, keys: Keys = (), history: int = 200, smoothing: int = 7,
    penalty: float = 15.0,
) -> DataFrame:
    """(model_date, predictor, slope) of :func:`rolling_models` at their coefficients, all zero at the
    optimum: the derivative of the penalised squares by each standardised coefficient, and by the
    intercept (predictor NULL).

    Worked out from the training rows and the stored coefficients alone, without the solver: a
    model meets the rows of its window by their numbers.
    """
    names = predictors(table, keys)
    short = smoothed_columns(names)
    lag = smoothing - 1 if short else 0
    named = "array(" + ", ".join(sql_text(c) for c in names) + ")"
    rows = _packed(table, names, keys)
    by = [*keys, "model_date"]
    firsts = rows.select(*keys, F.col("date").alias("model_date"), F.col("row").alias("first"))
    windows = models.join(firsts, by).selectExpr(
        *[f"`{c}`" for c in by], "first", "intercept",
        f"transform({named}, c -> coef[c]) AS coefs",
        f"explode(sequence(first - {history}, first - 1)) AS row",
    )
    uses = windows.join(rows.select(*keys, "row", "x", "y3"), [*keys, "row"]).selectExpr(
        "*", f"""CASE WHEN row >= first - {history} + {lag} AND row <= first - 3 AND forall(x, v -> v IS NOT NULL)
            THEN intercept + aggregate(zip_with(x, coefs, (v, c) -> v * c), 0D, (a, b) -> a + b) - y3
            END AS residual""",
    )
    cells = uses.selectExpr(
        *[f"`{c}`" for c in by], "row", "first", "coefs", "residual",
        "posexplode(concat(x, array(1D))) AS (place, v)",
    ).selectExpr(
        *[f"`{c}`" for c in by], "residual", "v", "row", "first",
        f"get({named}, place) AS predictor", "coalesce(get(coefs, place), 0D) AS coef",
    )
    late = F.col("predictor").isin(short) & (F.col("row") < F.col("first") - history + lag)
    known = F.when(~F.coalesce(late, F.lit(False)), F.col("v"))
    sums = cells.groupBy(*by, "predictor", "coef").agg(
        F.sum(F.col("v") * F.col("residual")).alias("cross"), F.stddev_samp(known).alias("scale")
    )
    slope = F.when(F.col("predictor").isNull(), F.col("cross")).when(
        F.col("scale") > 0, F.col("cross") / F.col("scale") + penalty * F.col("coef") * F.col("scale")
    ).otherwise(F.col("coef"))
    return sums.select(*by, "predictor", slope.alias("slope"))


def _models(
    pdf: pd.DataFrame, smoothed: np.ndarray, history: int, smoothing: int, penalty: float
) -> Iterator[tuple[int, _Fit, tuple[np.ndarray, np.ndarray]]]:
    """Of each retrain in a block, by date: its position, its fit, and the window and targets used."""
    row, x, y = pdf["row"].to_numpy(), np.stack(pdf["x"].to_numpy()), pdf["y3"].to_numpy(dtype=float)
    for start in np.flatnonzero(pdf["fits"].to_numpy(dtype=bool)):
        first = row[start]
        train = (row >= first - history) & (row < first)
        known = np.where(row[train] <= first - 3, y[train], np.nan)
        window = _window_rows(x[train], smoothed, smoothing - 1)
        yield start, _fit_ridge(window, known, penalty), (train, known)


def _blocks(table: DataFrame, keys: Keys, history: int) -> tuple[DataFrame, np.ndarray]:
    """Each row once for every block of retrains that needs it, and which predictors are smoothed.

    ``own`` rows are scored by the block's models, or by none in block -1; ``fits`` marks its
    retrains.
    """
    names = predictors(table, keys)
    smoothed = np.isin(names, smoothed_columns(names))
    part = "PARTITION BY " + ", ".join(f"`{k}`" for k in keys) if keys else ""
    so_far = f"({part} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    fits = f"{RETRAIN} AND row > {history}"
    rows = _packed(table, names, keys).selectExpr(
        "*", f"coalesce({fits}, false) AS fits",
        f"(count_if({fits}) OVER {so_far} - 1) div {BLOCK} AS at",
        f"count_if({fits}) OVER {so_far} > 0 AS known",
    )
    uses = rows.selectExpr(
        "*",
        f"""collect_set(CASE WHEN fits THEN at END) OVER ({part} ORDER BY date
            ROWS BETWEEN 1 FOLLOWING AND {history} FOLLOWING) AS trains""",
    ).selectExpr(
        *[f"`{k}`" for k in keys], "date", "row", "x", "y3", "fits", "at", "known",
        "explode(array_union(trains, array(CASE WHEN known THEN at ELSE -1 END))) AS block",
    ).selectExpr(
        *[f"`{k}`" for k in keys], "date", "row", "x", "y3", "block",
        "block = CASE WHEN known THEN at ELSE -1 END AS own",
        "fits AND at = block AS fits",
    )
    return uses, smoothed
