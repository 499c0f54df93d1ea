"""Running daily counts over a stream, open to late rows for good.

There is no watermark: a row for an old date must still change that date. State is one number
per date (and ward), far smaller than the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from shelfcast.operators import daily


def running_usage(stream: DataFrame, unit_type: str = "PLT", keys: Sequence[str] = ()) -> DataFrame:
    """Units used per date so far; write it in update mode."""
    return daily.daily_usage(stream, unit_type, keys)


def running_census(stream: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Patients per (date, ward) so far; write it in update mode."""
    return daily.census_counts(stream, keys)


def write_updates(
    counts: DataFrame, path: str, checkpoint: str, by: Sequence[str] = ("date",),
    value: str = "used", every: int = 50,
) -> DataStreamWriter:
    """Sink of changed counts, one partition per micro-batch; a retried batch replaces its own.

    After ``every`` batches they are merged into a base, so that readers need no more than one row
    per group and the updates of as many batches, however long the stream has run.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/updates/batch={batch_id}")
        if (batch_id + 1) % every == 0:
            compact(batch.sparkSession, path, by, value, batch_id)

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )


def compact(spark: SparkSession, path: str, by: Sequence[str], value: str, until: int) -> None:
    """Merge base and updates up to batch ``until`` into a new base.

    The new base counts from its line in ``bases`` on, which comes last: a merge that breaks off
    leaves the old base in force, and its repetition replaces what it left behind.
    """
    merged = _known(spark, path, by, value, until).drop("batch")
    merged.write.mode("overwrite").parquet(f"{path}/base/upto={until}")
    line = spark.createDataFrame([(until,)], "upto bigint")
    line.coalesce(1).write.mode("append").parquet(f"{path}/bases")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _known(
    spark: SparkSession, path: str, by: Sequence[str], value: str, until: int | None = None
) -> DataFrame:
    """(by, value, batch): the last update of every group, up to batch ``until``."""
    bases = _read(spark, f"{path}/bases")
    upto = None if bases is None else bases.agg(F.max("upto")).first()[0]
    rows = spark.read.parquet(f"{path}/updates").select(*by, value, "batch")
    if until is not None:
        rows = rows.filter(F.col("batch") <= until)
    if upto is not None:
        base = spark.read.parquet(f"{path}/base").filter(F.col("upto") == upto)
        rows = rows.filter(F.col("batch") > upto).unionByName(
            base.select(*by, value, F.col("upto").cast("int").alias("batch"))
        )
    return rows.groupBy(*by).agg(
        F.max_by(value, "batch").alias(value), F.max("batch").alias("batch")
    )


def current_counts(spark: SparkSession, path: str, by: Sequence[str], value: str) -> DataFrame:
    """Latest count per group, from the last base and the updates after it."""
    return _known(spark, path, by, value).drop("batch")
