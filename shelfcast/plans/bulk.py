"""Whole folders of feed files to cleaned series and per-file quality reports.

All files of a feed are one read. What is done per file is grouped by file name, so thousands of
files are one job, and a file with most of the rows is spread like any other data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators import daily, labs
from shelfcast.settings import DEFAULT_RULES, DEFAULT_WARDS, LabRule
from shelfcast.sources import feeds, landing, reports

FILE = ("file_name",)


@dataclass(frozen=True)
class Processed:
    """A cleaned series and its reports by sheet."""

    data: DataFrame
    reports: dict[str, DataFrame] = field(default_factory=dict)


def lab_series(
    rows: DataFrame, rules: Sequence[LabRule], keys: Sequence[str] = (), dedupe: str = "values"
) -> DataFrame:
    return labs.lab_clean(labs.lab_values(rows, rules, keys), keys, dedupe)


def process_labs(
    rows: DataFrame, rules: Sequence[LabRule] = DEFAULT_RULES, dedupe: str = "values"
) -> Processed:
    """Lab rows of any number of files. Equal values collapse across all of them."""
    values = labs.lab_values(rows, rules, FILE)
    return Processed(
        lab_series(rows, rules, dedupe=dedupe),
        {
            "lab_missing_values": reports.of_file(labs.lab_missing_values(values, FILE)),
            "lab_summary": reports.of_file(labs.lab_summary(values, rules, FILE)),
        },
    )


def process_census(rows: DataFrame) -> Processed:
    """Census rows. A date that occurs in several files is summed."""
    per_file = daily.census_counts(rows, FILE)
    return Processed(daily.census_counts(rows), {"census_summary": reports.of_file(per_file)})


def process_transfusion(rows: DataFrame) -> Processed:
    """Issue rows. A date that occurs in several files is summed."""
    per_file = daily.daily_usage(rows, keys=FILE)
    return Processed(daily.daily_usage(rows), {"usage_summary": reports.of_file(per_file)})


def process_inventory(rows: DataFrame, date: str | None = None) -> Processed:
    """Inventory rows. Two snapshots of one date stay two rows."""
    rows = feeds.dated_inventory(rows, date)
    per_file = daily.inventory_buckets(rows, keys=FILE)
    expiry = daily.with_expiry_time(daily.inventory_expiry(rows))
    return Processed(per_file.drop("file_name"), {"inventory_expiry": reports.of_file(expiry)})


def process_all_labs(
    spark: SparkSession, folder: str, rules: Sequence[LabRule] = DEFAULT_RULES,
    report_folder: str | None = None, pattern: str | None = None, dedupe: str = "values",
    feed: feeds.Feed = feeds.LABS, landing_folder: str | None = None,
) -> DataFrame:
    landed = checked(spark, folder, feed, pattern, rules, landing_folder)
    return finish(process_labs(landed.rows, rules, dedupe), report_folder, landed)


def process_all_census(
    spark: SparkSession, folder: str, wards: Sequence[str] = DEFAULT_WARDS,
    report_folder: str | None = None, pattern: str | None = None,
    feed: feeds.Feed = feeds.CENSUS, landing_folder: str | None = None,
) -> DataFrame:
    """One row per date, one column per configured ward."""
    landed = checked(spark, folder, feed, pattern, landing_folder=landing_folder)
    return daily.census_wide(finish(process_census(landed.rows), report_folder, landed), wards)


def process_all_transfusion(
    spark: SparkSession, folder: str, report_folder: str | None = None,
    pattern: str | None = None, feed: feeds.Feed = feeds.TRANSFUSION,
    landing_folder: str | None = None,
) -> DataFrame:
    landed = checked(spark, folder, feed, pattern, landing_folder=landing_folder)
    return finish(process_transfusion(landed.rows), report_folder, landed)


def process_all_inventory(
    spark: SparkSession, folder: str, report_folder: str | None = None,
    pattern: str | None = None, feed: feeds.Feed = feeds.INVENTORY,
    landing_folder: str | None = None,
) -> DataFrame:
    landed = checked(spark, folder, feed, pattern, landing_folder=landing_folder)
    return finish(process_inventory(landed.rows), report_folder, landed)


def checked(
    spark: SparkSession, folder: str, feed: feeds.Feed, pattern: str | None = None,
    rules: Sequence[LabRule] = DEFAULT_RULES, landing_folder: str | None = None,
) -> landing.Landed:
    """A feed's files after the checks that stop processing: files without rows, and unparseable
    time stamps. They are parsed once, into ``landing_folder`` or a new one."""
    into = landing_folder or landing.new_folder(spark)
    landed = landing.land(spark, folder, feed, into, pattern, rules)
    landed.require_sound(feed.name)
    return landed


def finish(done: Processed, report_folder: str | None, landed: landing.Landed) -> DataFrame:
    """The cleaned series, its reports written if a folder is given."""
    if report_folder is not None:
        reports.save_reports(done.reports, report_folder, files=landed.manifest)
    return done.data
