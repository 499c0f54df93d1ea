"""Feeds to daily series: ward census, units used and shelf inventory.

Counting is a two-stage aggregate (partial on the map side), so a ward, type or day holding a
large share of the rows does not end up in one task. A feed that is already pre-counted passes
its count column as ``weight``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.values import strict_sum

Keys = Sequence[str]


def _size(weight: str | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight).cast("bigint")


def census_counts(rows: DataFrame, keys: Keys = (), weight: str | None = None) -> DataFrame:
    """Patients per (date, ward): every ward seen, configured or not."""
    return (
        rows.select(*keys, F.col("location_time").cast("date").alias("date"), "ward",
                    *([weight] if weight else []))
        .groupBy(*keys, "date", "ward")
        .agg(_size(weight).alias("n"))
    )


def census_wide(counts: DataFrame, wards: Sequence[str], keys: Keys = ()) -> DataFrame:
    """One column per configured ward, 0 where a ward has no patients or no data at all."""
    wide = counts.groupBy(*keys, "date").pivot("ward", list(wards)).agg(F.sum("n"))
    return wide.fillna(0, list(wards))


def census_long(wide: DataFrame, wards: Sequence[str], keys: Keys = ()) -> DataFrame:
    """Wide census back to (date, ward, n)."""
    return wide.unpivot([*keys, "date"], [f"`{w}`" for w in wards], "ward", "n")


def missing_wards(counts: DataFrame, wards: Sequence[str]) -> DataFrame:
    """Configured wards that never occur in the data."""
    spark = counts.sparkSession
    wanted = spark.createDataFrame([(w,) for w in wards], "ward string")
    return wanted.join(counts.select("ward").distinct(), "ward", "left_anti")


def daily_usage(
    rows: DataFrame, unit_type: str = "PLT", keys: Keys = (), weight: str | None = None
) -> DataFrame:
    """Units of one type issued per date; rows without type are not counted."""
    return (
        rows.filter(F.col("type") == unit_type)
        .select(*keys, F.col("issue_time").cast("date").alias("date"), *([weight] if weight else []))
        .groupBy(*keys, "date")
        .agg(_size(weight).alias("used"))
    )


def inventory_expiry(rows: DataFrame, unit_type: str = "PLT") -> DataFrame:
    """All units of the type with an ``already_expired`` flag (NULL shelf life: NULL flag)."""
    return rows.filter(F.col("type") == unit_type).withColumn(
        "already_expired", F.col("days_to_expire") <= 0
    )


def with_expiry_time(rows: DataFrame) -> DataFrame:
    """Expiry instant from the date text and an ``HHmm`` time text."""
    digits = F.regexp_replace(F.concat(F.col("exp_date"), F.lit(" "), F.col("exp_time")), r"\D", "")

    def part(at: int, n: int) -> Column:
        return F.substring(digits, at, n).try_cast("int")

    stamp = F.when(
        F.length(digits) == 12,
        F.try_make_timestamp_ntz(
            part(1, 4), part(5, 2), part(7, 2), part(9, 2), part(11, 2), F.lit(0)
        ),
    )
    return rows.withColumn("expiry_time", stamp)


def inventory_buckets(
    rows: DataFrame, unit_type: str = "PLT", keys: Keys = (), weight: str | None = None
) -> DataFrame:
    """Unexpired units per snapshot date, split by days of shelf life left."""
    days = F.col("days_to_expire")

    def tally(cond: Column) -> Column:
        n = F.lit(1) if weight is None else F.col(weight)
        return F.sum(F.when(cond, n).otherwise(0)).cast("bigint")

    return (
        rows.filter((F.col("type") == unit_type) & (days > 0))
        .groupBy(*keys, "date")
        .agg(
            _size(weight).alias("count"),
            tally(days <= 1).alias("r1"),
            tally((days > 1) & (days <= 2)).alias("r2"),
            tally(days > 2).alias("r3_plus"),
        )
    )


def accumulate(parts: Sequence[DataFrame], keys: Keys = ()) -> DataFrame:
    """Union of daily series, summed by date: late rows add to the date they belong to.

    A column missing from one part counts as NULL there, and NULL makes the sum NULL.
    """
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    by = [*keys, "date"]
    return union.groupBy(*by).agg(
        *[strict_sum(F.col(f"`{c}`")).alias(c) for c in union.columns if c not in by]
    )


def known_as_of(parts: DataFrame, arrival: str, keys: Keys = ()) -> DataFrame:
    """Per date and arrival, the total of all rows that had come by then.

    ``parts`` has one row per (keys, date, arrival); a date has as many rows as arrivals brought
    something for it.
    """
    so_far = (
        Window.partitionBy(*keys, "date").orderBy(arrival)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    values = [c for c in parts.columns if c not in (*keys, "date", arrival)]
    return parts.select(
        *keys, "date", arrival, *[F.sum(c).over(so_far).alias(c) for c in values]
    )


def dates_per_increment(series: DataFrame, increment: str) -> DataFrame:
    """Increments that carry more than one date, which forces a retrain."""
    return (
        series.groupBy(increment)
        .agg(F.countDistinct("date").alias("n_dates"))
        .filter(F.col("n_dates") > 1)
    )


def last_days(series: DataFrame, n: int, keys: Keys = ()) -> DataFrame:
    """The latest ``n`` rows per key."""
    return _ranked(series, F.col("date").desc(), keys).filter(F.col("_at") <= n).drop("_at")


def first_days(series: DataFrame, n: int, keys: Keys = ()) -> DataFrame:
    """The earliest ``n`` rows per key."""
    return _ranked(series, F.col("date"), keys).filter(F.col("_at") <= n).drop("_at")


def skip_days(series: DataFrame, n: int, keys: Keys = ()) -> DataFrame:
    """All but the earliest ``n`` rows per key."""
    return _ranked(series, F.col("date"), keys).filter(F.col("_at") > n).drop("_at")


def _ranked(series: DataFrame, order: Column, keys: Keys) -> DataFrame:
    return series.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))

