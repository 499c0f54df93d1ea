"""Exact per-group statistics and quantiles without gathering a group in one task.

The rows are first reduced to (group, value, n), combined on the map side. Values are then put
in ordered buckets, and only a group's bucket totals are brought together to find the buckets
that hold the wanted ranks. Those with many different values are cut again at approximate quantiles
of these, into parts with about as many values each, wherever in the bucket they lie. The
rows of just the parts that hold a wanted rank are ranked, each part on its own. A group with a
third of all rows is thus spread over its values, buckets and parts, also where all its values lie
close together or beside an outlier.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS_PER_E = 256  # a bucket spans 0.4 % of its values
PART_VALUES = 4096  # different values that a bucket may have before it is cut
PARTS = 16  # squared, the parts of a bucket that is cut
_SHIFT = 200_000  # above BUCKETS_PER_E * |ln v| of every double

# Integer that never decreases as the value grows; NULL for NULL.
_BUCKET = f"""CAST(CASE WHEN value > 0 THEN floor(ln(value) * {BUCKETS_PER_E}) + {_SHIFT}
    WHEN value < 0 THEN -(floor(ln(-value) * {BUCKETS_PER_E}) + {_SHIFT})
    WHEN value = 0 THEN 0 END AS INT)"""
# A value inside the bucket, up to rounding.
_CENTRE = f"(sign(bucket) * exp((abs(bucket) - {_SHIFT}) / {BUCKETS_PER_E}))"


def value_counts(
    rows: DataFrame, keys: Sequence[str], value: str, weight: str | None = None
) -> DataFrame:
    """(keys, value, n). NaN and infinities count as missing."""
    v = F.col(value).cast("double")
    finite = F.when(F.abs(v) < float("inf"), v)
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return (
        rows.select(*keys, finite.alias("value"), *([weight] if weight else []))
        .groupBy(*keys, "value")
        .agg(n.alias("n"))
    )


def profile(
    counts: DataFrame,
    keys: Sequence[str],
    probs: Sequence[float] = (),
    tallies: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Statistics of every group of a ``value_counts`` table.

    Columns: ``n`` (values), ``n_missing``, ``min``, ``max``, ``mean``, ``sd``; per probability
    ``i`` the linearly interpolated quantile ``q{i}`` and ``below_q{i}``, the number of values
    under it; and per tally the number of values for which its condition holds. Quantiles are
    order statistics of the data, interpolated; ``sd`` is good to about 1e-11 of the values.
    """
    if not keys:
        raise ValueError("profile needs at least one key column")
    tallies = dict(tallies or {})
    counts = counts.withColumn("bucket", F.expr(_BUCKET))
    stats = _group_stats(_bucket_totals(counts, keys, tallies), keys, tallies)
    names = ["n", "n_missing", "min", "max", "mean", "sd", *tallies]
    firsts = [F.expr(f"first(`{c}`) AS `{c}`") for c in names]
    if not probs:
        return stats.groupBy(*keys).agg(*firsts)

    low = [f"floor((n - 1) * {p!r}D)" for p in probs]
    high = [f"least({x} + 1, n - 1)" for x in low]
    wanted = " OR ".join(
        f"(before <= {rank} AND {rank} < before + known)" for rank in [*low, *high]
    )
    ranked = _rank_within_parts(counts, stats.filter(f"n = 0 OR {wanted}"), keys, wanted)

    def at(rank: str, out: str, name: str) -> Column:
        return F.expr(f"max(CASE WHEN start <= {rank} AND {rank} < end THEN {out} END) AS {name}")

    picked = ranked.groupBy(*keys).agg(
        *firsts,
        *[
            column
            for i in range(len(probs))
            for column in (
                at(low[i], "value", f"lo{i}"),
                at(high[i], "value", f"hi{i}"),
                at(low[i], "start", f"under{i}"),
                at(low[i], "end", f"upto{i}"),
            )
        ],
    )
    parts = range(len(probs))
    quantiles = [
        f"lo{i} + ((n - 1) * {probs[i]!r}D - {low[i]}) * (hi{i} - lo{i}) AS q{i}" for i in parts
    ]
    below = [f"CASE WHEN q{i} > lo{i} THEN upto{i} ELSE under{i} END AS below_q{i}" for i in parts]
    return picked.selectExpr("*", *quantiles).selectExpr(
        *_names(keys), *_names(names), *[f"q{i}" for i in parts], *below
    )


def _names(columns: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def _bucket_totals(counts: DataFrame, keys: Sequence[str], tallies: Mapping[str, Column]):
    """Per bucket: count, extremes, and moments about the bucket's own centre."""
    return (
        counts.groupBy(*keys, "bucket")
        .agg(
            F.expr("sum(n) AS bucket_n"),
            F.expr("count(*) AS bucket_values"),
            F.expr("min(value) AS bucket_min"),
            F.expr("max(value) AS bucket_max"),
            F.expr(f"sum((value - {_CENTRE}) * n) AS s1"),
            F.expr(f"sum((value - {_CENTRE}) * (value - {_CENTRE}) * n) AS s2"),
            *[F.sum(F.when(cond, F.col("n")).otherwise(0)).alias(c) for c, cond in tallies.items()],
        )
        .selectExpr(
            *_names(keys), "bucket", "bucket_n", "bucket_values", "bucket_min", "bucket_max",
            *_names(tallies),
            "CASE WHEN bucket IS NULL THEN 0 ELSE bucket_n END AS known",
            f"{_CENTRE} + s1 / bucket_n AS bucket_mean",
            "greatest(s2 - s1 * s1 / bucket_n, 0D) AS bucket_m2",
        )
    )


def _group_stats(hist: DataFrame, keys: Sequence[str], tallies: Mapping[str, Column]) -> DataFrame:
    """Bucket rows with their group's statistics and the number of values in earlier buckets.

    ``known`` is a bucket's number of values, 0 for the bucket of missing ones.
    """
    by = ", ".join(_names(keys))
    ordered = f"PARTITION BY {by} ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING"
    group = f"OVER ({ordered} AND UNBOUNDED FOLLOWING)"  # one sort serves both frames
    earlier = f"OVER ({ordered} AND 1 PRECEDING)"
    hist = hist.selectExpr(
        *_names(keys), "bucket", "bucket_n", "bucket_values", "known", "bucket_mean", "bucket_m2",
        f"sum(known) {group} AS n",
        f"sum(bucket_n - known) {group} AS n_missing",
        f"min(bucket_min) {group} AS min",
        f"max(bucket_max) {group} AS max",
        f"sum(bucket_mean * known) {group} / nullif(sum(known) {group}, 0) AS mean",
        f"coalesce(sum(known) {earlier}, 0) AS before",
        *[f"sum(`{c}`) {group} AS `{c}`" for c in tallies],
    )
    m2 = f"sum(bucket_m2 + known * (bucket_mean - mean) * (bucket_mean - mean)) {group}"
    return hist.selectExpr(
        *_names(keys), "bucket", "bucket_values", "known", "before", "n", "n_missing",
        "min", "max", "mean",
        f"CASE WHEN n > 1 THEN sqrt({m2} / (n - 1)) END AS sd",
        *_names(tallies),
    )


def _rank_within_parts(
    counts: DataFrame, buckets: DataFrame, keys: Sequence[str], wanted: str
) -> DataFrame:
    """Rows of the wanted parts of the given buckets, with the ranks [start, end) of their value.

    Keys are compared null-safe: a NULL key is a group like any other, and no filter gets in
    between that would keep both readers of ``counts`` from sharing its shuffle.
    """
    spans = buckets.select(*keys, "bucket", "bucket_values")
    rows = _join(counts.withColumnRenamed("n", "value_n"), spans, [*keys, "bucket"])
    rows = _with_cuts(rows, keys).withColumn("part", F.expr(_PART))
    rows = rows.select(*keys, "bucket", "part", "value", "value_n")
    parts = rows.groupBy(*keys, "bucket", "part").agg(F.sum("value_n").alias("part_n"))
    by = ", ".join([*_names(keys), "bucket"])
    parts = (
        _join(parts, buckets.drop("bucket_values"), [*keys, "bucket"])
        .withColumn(
            "before",
            F.expr(
                f"""before + coalesce(sum(part_n) OVER (PARTITION BY {by} ORDER BY part
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"""
            ),
        )
        .withColumn("known", F.expr("CASE WHEN bucket IS NULL THEN 0 ELSE part_n END"))
        .filter(f"n = 0 OR {wanted}")
        .drop("known", "part_n")
    )
    return (
        _join(rows, parts, [*keys, "bucket", "part"])
        .withColumn(
            "start",
            F.expr(
                f"""before + coalesce(sum(value_n) OVER (PARTITION BY {by}, part ORDER BY value
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"""
            ),
        )
        .withColumn("end", F.expr("start + value_n"))
    )


# Place of the value among the cuts, looked up in two steps; 0 without cuts.
_BELOW = f"transform(sequence(1, {PARTS - 1}), i -> cuts[i * {PARTS} - 1])"
_COARSE = f"size(filter({_BELOW}, c -> c < value))"
_PART = f"""CASE WHEN cuts IS NULL OR value IS NULL THEN 0
    ELSE transform(array({_COARSE}), k -> k * {PARTS}
        + size(filter(slice(cuts, k * {PARTS} + 1, {PARTS - 1}), c -> c < value)))[0] END"""


def _with_cuts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``cuts``, the values that divide the rows of a bucket of many values into equal parts.

    They are approximate quantiles of its different values, which partial sketches of a fixed size
    give; buckets of few values have none. Null-safe like :func:`_join`, and the rows of a bucket
    that is not cut stay.
    """
    points = ", ".join(f"{k}D / {PARTS * PARTS}" for k in range(1, PARTS * PARTS))
    cuts = (
        rows.filter((F.col("bucket_values") > PART_VALUES) & F.col("value").isNotNull())
        .groupBy(*keys, "bucket")
        .agg(F.expr(f"percentile_approx(value, array({points}), {10 * PARTS * PARTS})").alias("cuts"))
    )
    on = [*keys, "bucket"]
    named = cuts.withColumnsRenamed({c: f"_{c}" for c in on})
    same = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_{c}`")) for c in on])
    return rows.join(named, same, "left").drop(*[f"_{c}" for c in on])


def _join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on columns of equal name, NULL equal to NULL."""
    named = right.withColumnsRenamed({c: f"_{c}" for c in on})
    same = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_{c}`")) for c in on])
    return left.join(named, same).drop(*[f"_{c}" for c in on])
