"""Raw feed files taken in once: typed rows and one line per file, as Parquet.

The raw text is parsed by the job that writes the rows. Checks, reports and series read what it
wrote. Patient identifiers never land.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfcast.settings import DEFAULT_RULES, LabRule, rule_names
from shelfcast.sources import checks, feeds

BAD = "bad_stamp"


@dataclass(frozen=True)
class Landed:
    """Typed ``rows`` with their file_name, and the ``manifest`` (file_name, n_rows, n_bad) of all
    files, those without rows among them. ``n_rows`` and ``n_bad`` are the totals seen on the way."""

    rows: DataFrame
    manifest: DataFrame
    n_rows: int
    n_bad: int

    def problems(self) -> DataFrame:
        """Files without rows or with rows whose time stamp could not be parsed."""
        return self.manifest.filter((F.col("n_rows") == 0) | (F.col("n_bad") > 0))

    def require_sound(self, name: str) -> DataFrame:
        """The rows; FeedError if some file has a problem."""
        checks.require_empty(self.problems(), f"No data or bad time stamps in {name} files")
        return self.rows


def new_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a local session without one gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("name a landing folder, or set spark.checkpoint.dir to a shared one")
        base = f"file://{os.path.join(tempfile.gettempdir(), 'landing')}"
    return f"{base.rstrip('/')}/landing-{uuid.uuid4().hex}"


def bad_stamp(feed: feeds.Feed, rules: Sequence[LabRule] = DEFAULT_RULES):
    """True for rows without the time stamp the feed must have; labs need it for configured names."""
    if feed.name == feeds.LABS.name:
        return F.col("result_time").isNull() & F.col("base_name").isin(rule_names(rules))
    if feed.name == feeds.CENSUS.name:
        return F.col("location_time").isNull()
    if feed.name == feeds.TRANSFUSION.name:
        return F.col("issue_time").isNull()
    return F.lit(False)


def land(
    spark: SparkSession, folder: str, feed: feeds.Feed, into: str, pattern: str | None = None,
    rules: Sequence[LabRule] = DEFAULT_RULES, format: str = "csv",
) -> Landed:
    """Parse the feed's files of ``folder`` once, into ``{into}/{feed}``; what was there is replaced."""
    pattern = pattern or feed.pattern
    path, seen = f"{into}/{feed.name}", Observation()
    bad = F.coalesce(bad_stamp(feed, rules), F.lit(False))
    raw = feeds.read_feed(spark, folder, feed, pattern, format).withColumn(BAD, bad)
    raw.observe(
        seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(BAD).alias("n_bad")
    ).write.mode("overwrite").parquet(f"{path}/rows")
    rows = spark.read.schema(raw.schema).parquet(f"{path}/rows")
    per_file = rows.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(BAD).alias("n_bad")
    )
    listed = feeds.list_files(spark, folder, pattern).select("file_name")
    manifest = listed.join(per_file, "file_name", "left").fillna(0, ["n_rows", "n_bad"])
    manifest.write.mode("overwrite").parquet(f"{path}/files")
    return Landed(
        rows.drop(BAD), spark.read.schema(manifest.schema).parquet(f"{path}/files"),
        seen.get["n_rows"], seen.get["n_bad"],
    )
