"""Report tables: one per sheet, partitioned by report date and report name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.times import iso_date_in, report_name


def of_file(df: DataFrame) -> DataFrame:
    """Label a per-file report with its name and the date in it (NULL if there is none)."""
    return df.withColumns(
        {"report": report_name(F.col("file_name")), "report_date": iso_date_in(F.col("file_name"))}
    ).drop("file_name")


PLACE = ("report_date", "report")


def save_reports(
    sheets: Mapping[str, DataFrame], folder: str, format: str = "parquet",
    files: DataFrame | None = None,
) -> None:
    """Write every sheet. A report replaces its own earlier version only, also if it has no date.

    ``files`` (file_name) are all files of the run. Reports on them that have no rows any more lose
    those of an earlier run too.
    """
    for sheet, df in sheets.items():
        df = df.persist() if files is not None else df
        try:
            gone = [] if files is None else _emptied(df, files, f"{folder}/{sheet}", format)
            (
                df.hint("rebalance", *PLACE)
                .write.format(format)
                .mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("header", "true")
                .partitionBy(*PLACE)
                .save(f"{folder}/{sheet}")
            )
            nothing = df.limit(0).drop(*PLACE)
            for path in gone:
                nothing.write.format(format).mode("overwrite").option("header", "true").save(path)
        finally:
            if files is not None:
                df.unpersist()


def _emptied(df: DataFrame, files: DataFrame, path: str, format: str) -> list[str]:
    """Folders of reports on ``files`` that an earlier run gave rows and ``df`` doesn't.

    Only the names of these, of which there are few, come to the driver.
    """
    spark = df.sparkSession
    try:
        stored = spark.read.format(format).option("header", "true").load(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return []
    if not set(PLACE) <= set(stored.columns):
        return []
    old = stored.select(*PLACE).distinct()

    def same(other: DataFrame, how: str) -> DataFrame:
        there = other.select(*[F.col(c).alias(f"_{c}") for c in PLACE])
        equal = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PLACE]
        return old.join(there, equal[0] & equal[1], how)

    old = same(of_file(files.select("file_name")), "left_semi")
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return [
        f"{path}/report_date={r['report_date'] or '__HIVE_DEFAULT_PARTITION__'}/report={escape(r['report'])}"
        for r in same(df, "left_anti").collect()
    ]


def read_report(spark: SparkSession, folder: str, sheet: str, date: str) -> DataFrame:
    """The report of one date; of several, the one whose name sorts last."""
    day = spark.read.parquet(f"{folder}/{sheet}").filter(
        F.col("report_date") == F.lit(date).cast("date")
    )
    last = day.agg(F.max("report").alias("_last"))
    return (
        day.crossJoin(F.broadcast(last))
        .filter(F.col("report") == F.col("_last"))
        .drop("_last", "report", "report_date")
    )
