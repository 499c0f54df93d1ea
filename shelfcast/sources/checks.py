"""Checks on incoming files. Each returns the offending rows; an empty result means all is well."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources import feeds
from shelfcast.sources.feeds import FEEDS, Feed

# Fewest and most files a day may have per feed.
FILES_PER_DAY = {"labs": (1, 1), "census": (1, 1), "transfusion": (1, 1), "inventory": (0, 1)}


class FeedError(ValueError):
    """A feed failed a check that stops processing."""


def empty_files(spark: SparkSession, folder: str, feed: Feed, pattern: str | None = None) -> DataFrame:
    """Files of the feed that hold no data row."""
    pattern = pattern or feed.pattern
    seen = feeds.read_feed(spark, folder, feed, pattern).select("file_name").distinct()
    listed = feeds.list_files(spark, folder, pattern).select("file_name")
    return listed.join(seen, "file_name", "left_anti")


def bad_timestamps(rows: DataFrame, stamp: str) -> DataFrame:
    """Files with rows whose time stamp could not be parsed, and how many."""
    return rows.filter(F.col(stamp).isNull()).groupBy("file_name").agg(F.count("*").alias("n"))


def file_problems(
    spark: SparkSession, folder: str, feed: Feed, rows: DataFrame, bad: Column,
    pattern: str | None = None,
) -> DataFrame:
    """Both checks above in one pass: (file_name, n_rows, n_bad) of files that fail either."""
    per_file = rows.groupBy("file_name").agg(
        F.count("*").alias("n_rows"), F.count_if(bad).alias("n_bad")
    )
    listed = feeds.list_files(spark, folder, pattern or feed.pattern).select("file_name")
    return (
        listed.join(per_file, "file_name", "left")
        .fillna(0, ["n_rows", "n_bad"])
        .filter((F.col("n_rows") == 0) | (F.col("n_bad") > 0))
    )


def file_counts(
    spark: SparkSession, folder: str, dates: Sequence[str] | None = None,
    wanted_feeds: Sequence[Feed] = tuple(FEEDS.values()),
) -> DataFrame:
    """(feed, date, n_files) of the daily files; with ``dates``, days without a file count 0."""
    files = feeds.list_files(spark, folder)

    def of(feed: Feed) -> DataFrame:
        date = F.regexp_extract("file_name", feed.daily_pattern(f"({feeds.DAY})"), 1).try_cast("date")
        return files.select(F.lit(feed.name).alias("feed"), date.alias("date"), "file_name").filter(
            F.col("date").isNotNull()
        )

    found = reduce(DataFrame.unionByName, [of(f) for f in wanted_feeds])
    found = found.groupBy("feed", "date").agg(F.countDistinct("file_name").alias("n_files"))
    if dates is None:
        return found
    wanted = spark.createDataFrame(
        [(f.name, d) for f in wanted_feeds for d in dates], "feed string, date string"
    ).withColumn("date", F.col("date").cast("date"))
    return wanted.join(found, ["feed", "date"], "left").fillna(0, ["n_files"])


def file_cardinality_violations(
    spark: SparkSession, folder: str, dates: Sequence[str],
    wanted_feeds: Sequence[Feed] = tuple(FEEDS.values()),
) -> DataFrame:
    """Days with too few or too many files of a feed."""
    counts = file_counts(spark, folder, dates, wanted_feeds)
    allowed = reduce(
        lambda acc, kv: acc | ((F.col("feed") == kv[0]) & F.col("n_files").between(*kv[1])),
        FILES_PER_DAY.items(),
        F.lit(False),
    )
    return counts.filter(~allowed)


def require_empty(violations: DataFrame, message: str) -> None:
    """Stop if a check found something; only a few examples come to the driver."""
    found = violations.take(5)
    if found:
        raise FeedError(f"{message}: {[r.asDict() for r in found]}")
