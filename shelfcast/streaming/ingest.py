"""Continuous file ingest into the durable state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfcast.plans.increments import clean_increment
from shelfcast.settings import Params
from shelfcast.sources import checks, feeds, landing
from shelfcast.sources import state as store


def taken_table(feed: feeds.Feed) -> str:
    """State table of the files a feed's days were written from."""
    return f"files_{feed.name}"


def writer(
    feed: feeds.Feed, state: str, params: Params = Params(), replace: bool = False
) -> Callable[[DataFrame, int], None]:
    """Micro-batch function: clean the new files and write their days' partitions.

    The files a day was written from are part of the state. A retried batch has the same files and
    writes the same partitions. Another file for a day, in the batch or from an earlier one, stops the
    stream before anything changes, or, with ``replace``, takes the place of the earlier one's rows; of
    two in one batch the one whose name sorts last does. A day that had its line in ``runs`` loses
    it first, so that it counts again only once it is whole.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        rows = feeds.with_as_of(batch, feed).persist()
        try:
            bad = rows.filter(landing.bad_stamp(feed, params.rules)).select("file_name")
            checks.require_empty(bad, f"Bad time stamps in {feed.name} files")
            files = rows.select("as_of", "file_name").distinct()
            days = [str(r["as_of"]) for r in files.select("as_of").distinct().collect()]
            if replace:
                last = files.groupBy("as_of").agg(F.max("file_name").alias("file_name"))
                files, used = last, rows.join(last, ["as_of", "file_name"], "left_semi")
            else:
                known = store.of_days(store.read_table(spark, state, taken_table(feed)), days)
                each = files.unionByName(known).distinct().groupBy("as_of").count()
                checks.require_empty(
                    each.filter("count > 1"), f"Several {feed.name} files for a day"
                )
                used = rows
            store.open_days(spark, state, days)
            table, increment = clean_increment(feed, used, params)
            store.write_days(increment, state, table, days)
            store.write_days(files, state, taken_table(feed), days)
        finally:
            rows.unpersist()

    return write


def ingest(
    spark: SparkSession, folder: str, state: str, checkpoint: str, params: Params = Params(),
    replace: bool = False, **options: str,
) -> list[StreamingQuery]:
    """One query per feed that takes in all files present and ends; run it again for new ones.

    ``replace`` lets a later file for a day replace an earlier one, see :func:`writer`.
    """
    return [
        feeds.stream_feed(spark, folder, feed, **options)
        .filter(F.col("file_name").rlike(feed.daily_pattern()))
        .writeStream.foreachBatch(writer(feed, state, params, replace))
        .option("checkpointLocation", f"{checkpoint}/{feed.name}")
        .trigger(availableNow=True)
        .start()
        for feed in params.feeds
    ]


def close_days(spark: SparkSession, state: str) -> None:
    """Give the ingested days whose three required feeds are there their line in ``runs``.

    From then on they are part of the state. No forecast was made on them, so the next run fits
    anew.
    """
    days = [
        store.read_table(spark, state, t).groupBy("as_of").agg(F.max("date").alias("date"))
        for t in ("usage", "labs", "census")
    ]
    whole = days[0].join(days[1].select("as_of"), "as_of").join(days[2].select("as_of"), "as_of")
    done = store.read_table(spark, state, "runs").select("as_of")
    lines = store.plain_lines(whole.join(done, "as_of", "left_anti"), "ingested").persist()
    try:
        new = [str(r["as_of"]) for r in lines.select("as_of").collect()]
        if new:
            store.write_days(lines, state, "runs", new)
    finally:
        lines.unpersist()
