"""Lab results: cleaning, daily quality summary, missing values and threshold features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.values import is_unexpected_missing, lab_number
from shelfcast.operators.profile import profile, value_counts
from shelfcast.settings import LabRule, by_rule, rule_names

Keys = Sequence[str]


def lab_values(
    rows: DataFrame, rules: Sequence[LabRule], keys: Keys = (), strict: bool = False
) -> DataFrame:
    """Results of the configured labs as (date, base_name, lab_value, ord_value)."""
    return rows.filter(F.col("base_name").isin(rule_names(rules))).select(
        *keys,
        F.col("result_time").cast("date").alias("date"),
        "base_name",
        lab_number(F.col("ord_value"), strict).alias("lab_value"),
        "ord_value",
    )


def lab_clean(values: DataFrame, keys: Keys = (), dedupe: str = "values") -> DataFrame:
    """The cleaned long series.

    With ``dedupe='values'`` equal values of a lab on a day collapse, so later counts are of
    *distinct* values; ``'rows'`` keeps every result.
    """
    out = values.select(*keys, "date", "base_name", "lab_value")
    if dedupe == "values":
        return out.dropDuplicates()
    if dedupe == "rows":
        return out
    raise ValueError("dedupe must be 'values' or 'rows'")


def lab_missing_values(values: DataFrame, keys: Keys = (), strict: bool = False) -> DataFrame:
    """Texts that are neither numbers nor below-detection markers."""
    return values.filter(
        is_unexpected_missing(F.col("ord_value"), F.col("lab_value"), strict)
    ).select(*keys, "date", "base_name", "ord_value")


def lab_summary(values: DataFrame, rules: Sequence[LabRule], keys: Keys = ()) -> DataFrame:
    """Ten statistics per (date, lab). A lab with no number on a day has NULL statistics."""
    by = [*keys, "date", "base_name"]
    abnormal = by_rule(F.col("base_name"), rules, lambda r: r.abnormal(F.col("value")))
    stats = profile(
        value_counts(values, by, "lab_value"), by, (0.25, 0.5, 0.75), {"abnormal_n": abnormal}
    )
    return stats.select(
        *by,
        (F.col("n") + F.col("n_missing")).alias("total_n"),
        F.col("n_missing").alias("missing_n"),
        "abnormal_n",
        "min",
        F.col("q0").alias("q25"),
        F.col("q1").alias("median"),
        F.col("q2").alias("q75"),
        "max",
        "mean",
        "sd",
    )


def lab_threshold_counts(clean: DataFrame, rules: Sequence[LabRule], keys: Keys = ()) -> DataFrame:
    """Per (date, lab): rows, values below and at-or-above the lab's threshold, and the one counted."""
    by = [*keys, "date", "base_name"]
    name = F.col("base_name")
    probs = sorted({r.threshold for r in rules if r.is_quantile})
    under = F.coalesce(
        by_rule(
            name, rules,
            lambda r: F.lit(False) if r.is_quantile else F.col("value") < F.lit(float(r.threshold)),
        ),
        F.lit(False),
    )
    clean = clean.filter(name.isin(rule_names(rules)))
    stats = profile(value_counts(clean, by, "lab_value"), by, probs, {"below_const": under})
    below = by_rule(
        name, rules,
        lambda r: F.col(f"below_q{probs.index(r.threshold)}") if r.is_quantile
        else F.col("below_const"),
    )
    side = by_rule(name, rules, lambda r: F.lit(r.count_side))
    return (
        stats.select(
            *by,
            (F.col("n") + F.col("n_missing")).alias("n"),
            F.coalesce(below, F.lit(0)).cast("bigint").alias("below"),
            F.col("n").alias("known"),
        )
        .withColumn("above", F.col("known") - F.col("below"))
        .withColumn("nq", F.when(side == "above", F.col("above")).otherwise(F.col("below")))
        .drop("known")
    )


def feature_column(base_name: str) -> str:
    return f"{base_name}_Nq"


def lab_features_wide(counts: DataFrame, rules: Sequence[LabRule], keys: Keys = ()) -> DataFrame:
    """One ``<lab>_Nq`` column per lab, 0 where a lab has no result that day."""
    names = rule_names(rules)
    wide = counts.groupBy(*keys, "date").pivot("base_name", names).agg(F.sum("nq"))
    wide = wide.withColumnsRenamed({n: feature_column(n) for n in names})
    return wide.fillna(0, [feature_column(n) for n in names])


def lab_counts_wide(counts: DataFrame, rules: Sequence[LabRule], keys: Keys = ()) -> DataFrame:
    """Row counts (``_N``) and threshold counts (``_Nq``) side by side, from one pivot."""
    names = rule_names(rules)
    wide = (
        counts.groupBy(*keys, "date")
        .pivot("base_name", names)
        .agg(F.sum("n").alias("N"), F.sum("nq").alias("Nq"))
    )
    return wide.fillna(0, [c for c in wide.columns if c not in (*keys, "date")])


def drop_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """All columns but those whose name ends in ``suffix``."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.endswith(suffix)])
