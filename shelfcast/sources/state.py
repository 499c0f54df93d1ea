"""Durable state: one Parquet table per kind of data, partitioned by the day of the increment.

State as of a day is every increment up to that day. Nothing is written in place: each write of a day
is an attempt, a folder of its own below the day's, and counts from its line in the log ``writes``,
which comes after its files. A day's line in ``runs`` commits the day: readers take, of each table, the
last attempt before that line. So a run that repeats a day leaves the old one to readers until its
own line is there, a run that breaks off changes nothing, and a table read earlier stays as it was.
Attempts are numbered by the clock; one run at a time writes a state, or one stream for each table.
The log, a line per day, table and write, is read on the driver; :func:`vacuum` keeps it short.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from shelfcast.settings import MODEL_FIELDS
from shelfcast.sources.feeds import FEEDS

# Columns of the tables, without ``as_of``.
TABLES = {
    "labs": "date date, base_name string, lab_value double",
    "census": "date date, ward string, n bigint",
    "usage": "date date, used bigint",
    "inventory": "date date, count bigint, r1 bigint, r2 bigint, r3_plus bigint",
    "runs": "date date, gap int, age_before bigint, age_after bigint, retrain boolean, "
    "reason string, " + ", ".join(f"{c} double" for c in MODEL_FIELDS),
    "scaler": "predictor string, center double, scale double",
    "model": "predictors array<string>, intercept double, coef array<double>",
    "prediction": "date date, t_pred double",
    **{f"files_{feed}": "file_name string" for feed in FEEDS},
}
#: One line per day and write: the attempt that holds the table's rows of that day.
WRITES = "table string, as_of date, attempt bigint"


class StateError(RuntimeError):
    """The state a run builds on is missing."""


_clock, _last_attempt = threading.Lock(), 0


def _next_attempt() -> int:
    """Microseconds of the clock, never the same twice in a process."""
    global _last_attempt
    with _clock:
        _last_attempt = max(time.time_ns() // 1000, _last_attempt + 1)
        return _last_attempt


def _log(spark: SparkSession, state: str, table: str, days: Sequence[str], attempt: int) -> None:
    """The days' rows in a table are those of the attempt from here on.

    Each write of the log has a folder of its own, as several streams write at a time.
    """
    lines = [(table, dt.date.fromisoformat(d), attempt) for d in days]
    df = spark.createDataFrame(lines, WRITES).coalesce(1)
    df.write.parquet(f"{state}/writes/{attempt}")


def write_day(df: DataFrame, state: str, table: str, as_of: str) -> None:
    """Replace one day's rows, also by nothing."""
    attempt = _next_attempt()
    df.drop("as_of").write.parquet(f"{state}/{table}/as_of={as_of}/attempt={attempt}")
    _log(df.sparkSession, state, table, [as_of], attempt)


def write_days(df: DataFrame, state: str, table: str, days: Sequence[str]) -> None:
    """Replace the rows of ``days``, also of those that ``df`` (with ``as_of``) has no rows of.

    The rebalance gives each day few files and still splits a day that is too large for one task.
    All days change at once.
    """
    attempt = _next_attempt()
    (
        df.hint("rebalance", "as_of")
        .withColumn("attempt", F.lit(attempt))
        .write.mode("append")
        .partitionBy("as_of", "attempt")
        .parquet(f"{state}/{table}")
    )
    _log(df.sparkSession, state, table, days, attempt)


def of_days(df: DataFrame, days: Sequence[str]) -> DataFrame:
    return df.filter(F.col("as_of").isin([dt.date.fromisoformat(d) for d in days]))


def open_days(spark: SparkSession, state: str, days: Sequence[str]) -> None:
    """Take back the days' lines in ``runs``, for increments that others will complete."""
    if days:
        _log(spark, state, "runs", days, _next_attempt())


def _read(spark: SparkSession, path: str, schema: str, **options: bool) -> DataFrame:
    try:
        return spark.read.schema(schema).options(**options).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _writes(spark: SparkSession, state: str) -> DataFrame:
    return _read(spark, f"{state}/writes", WRITES, recursiveFileLookup=True)


def _last(
    log: Sequence[Row], table: str, until: dict[dt.date, int] | None = None
) -> dict[dt.date, int]:
    """The last attempt of each day, or that before the day's number in ``until``."""
    last: dict[dt.date, int] = {}
    for name, day, attempt in log:
        if name == table and (until is None or attempt <= until.get(day, -1)):
            last[day] = max(attempt, last.get(day, 0))
    return last


def _rows(
    spark: SparkSession, state: str, table: str, attempts: dict[dt.date, int]
) -> DataFrame:
    """Rows of the days' attempts, by a condition on partitions alone."""
    df = _read(spark, f"{state}/{table}", f"{TABLES[table]}, as_of date, attempt bigint")
    folders = [f"{day}/{attempt}" for day, attempt in sorted(attempts.items())]
    return df.filter(F.concat_ws("/", "as_of", "attempt").isin(folders)).drop("attempt")


def _lines(spark: SparkSession, state: str, log: Sequence[Row]) -> dict[dt.date, int]:
    """The days that have their line in ``runs`` and its attempt."""
    last = _last(log, "runs")
    there = _rows(spark, state, "runs", last).select("as_of").collect()
    return {r["as_of"]: last[r["as_of"]] for r in there}


def read_table(spark: SparkSession, state: str, table: str) -> DataFrame:
    """A state table with ``as_of`` as last written, also on days that are not complete."""
    return _rows(spark, state, table, _last(_writes(spark, state).collect(), table))


def read_committed(
    spark: SparkSession, state: str, table: str, until: str | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """Rows of the days that have their line in ``runs``, up to ``until``, as of that line.

    The days ``also``, those a run is at work on, are as last written.
    """
    log = _writes(spark, state).collect()
    days = _last(log, table, _lines(spark, state, log))
    if until is not None:
        days = {d: a for d, a in days.items() if str(d) <= until}
    own = {dt.date.fromisoformat(d) for d in also}
    days = {d: a for d, a in days.items() if d not in own}
    days |= {d: a for d, a in _last(log, table).items() if d in own}
    return _rows(spark, state, table, days)


def read_day(
    spark: SparkSession, state: str, table: str, day: str, committed: bool = False
) -> DataFrame:
    """One day's rows of a table as last written, or those of its line in ``runs``."""
    read = read_committed if committed else read_table
    return of_days(read(spark, state, table), [day])


def vacuum(spark: SparkSession, state: str, keep: dt.timedelta = dt.timedelta(days=7)) -> int:
    """Delete attempts that no reader needs, and merge the log's files; the number deleted.

    An attempt goes once the day's line in ``runs`` points at a later one of its table and that line is
    older than ``keep``, so that readers have as long to finish. The log's lines that stay are written
    in one file before the old files go: meanwhile there are lines twice, which changes nothing.
    Nothing else may be writing the state.
    """
    before = time.time_ns() // 1000 - keep // dt.timedelta(microseconds=1)
    lines = _writes(spark, state)
    files, log = lines.inputFiles(), sorted(set(lines.collect()))
    committed = _lines(spark, state, log)
    old = {d: a for d, a in committed.items() if a < before}
    past = [
        (table, day, attempt)
        for table in TABLES
        for now in [_last(log, table, old)]
        for name, day, attempt in log
        if name == table and attempt < now.get(day, -1)
    ]
    gone = _delete(
        spark, [f"{state}/{table}/as_of={day}/attempt={attempt}" for table, day, attempt in past]
    )
    if len(files) > 1:
        left = spark.createDataFrame(sorted(set(map(tuple, log)) - set(past)), WRITES)
        left.coalesce(1).write.parquet(f"{state}/writes/{_next_attempt()}")
        _delete(spark, {f.rsplit("/", 1)[0] for f in files})
    return gone


def _delete(spark: SparkSession, paths: Iterable[str]) -> int:
    """Delete folders; the number of those that were there."""
    conf, gone = spark._jsc.hadoopConfiguration(), 0
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(at.getFileSystem(conf).delete(at, True))
    return gone


def latest_day(spark: SparkSession, state: str, before: str | None = None) -> str | None:
    """Last day that is complete, optionally before a given one."""
    days = read_table(spark, state, "runs")
    if before is not None:
        days = days.filter(F.col("as_of") < F.lit(before).cast("date"))
    newest = days.agg(F.max("as_of")).first()[0]
    return None if newest is None else str(newest)


def require_day(spark: SparkSession, state: str, day: str) -> None:
    if not read_day(spark, state, "runs", day).take(1):
        raise StateError(f"The state has no complete day {day}")


def plain_lines(days: DataFrame, reason: str) -> DataFrame:
    """Lines of ``runs`` for days (as_of, date) on which no model was at work."""
    nothing = {"gap": "int", "age_before": "bigint", "age_after": "bigint"}
    return days.select(
        "as_of", "date", *[F.lit(None).cast(kind).alias(c) for c, kind in nothing.items()],
        F.lit(False).alias("retrain"), F.lit(reason).alias("reason"),
        *[F.lit(None).cast("double").alias(c) for c in MODEL_FIELDS],
    )
