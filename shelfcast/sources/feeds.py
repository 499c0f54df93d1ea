"""The four daily feeds: declared layouts, scans of whole folders, and per-date file selection.

A feed is one directory read. The file a row came from stays as ``file_name``; regular
expressions on it are pushed into the file listing, so files of other feeds are not opened.
Every column is read as text and cast with ``try_`` functions: an unparseable cell is NULL.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions import times, values

DAY = r"\d{4}-\d{2}-\d{2}"
CASTS = {
    "text": lambda c: c,
    "int": lambda c: F.trim(c).try_cast("int"),
    "id": lambda c: values.number(c).try_cast("bigint"),
    "double": values.number,
    "slash": times.slash_stamp,
    "dash": times.dash_stamp,
}
# The same, for columns of typed files.
TYPES = {
    "text": "string", "int": "int", "id": "bigint", "double": "double",
    "slash": "timestamp_ntz", "dash": "timestamp_ntz",
}


@dataclass(frozen=True)
class Feed:
    """Layout of one feed. ``drop`` names the patient identifiers, which never leave the scan."""

    name: str
    columns: dict[str, str]
    pattern: str
    daily: str
    drop: tuple[str, ...] = ()
    separator: str = "\t"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def daily_pattern(self, date: str = DAY) -> str:
        return self.daily % date


# Column names and types of the feeds, and their file names (regular expressions).
LABS = Feed(
    name="labs",
    columns={
        "ORDER_PROC_ID": "int", "LINE": "int", "PAT_ENC_CSN_ID": "id",
        "ADMIT_CONF_STAT_C": "int", "DISCH_CONF_STAT_C": "int",
        "PAT_ID": "text", "PAT_MRN_ID": "text", "PROC_CODE": "text", "DESCRIPTION": "text",
        "BASE_NAME": "text", "COMMON_NAME": "text", "ORD_VALUE": "text",
        "ORDERING_DATE": "slash", "ORDER_TIME": "dash", "RESULT_TIME": "dash",
        "ORDER_STATUS_C": "int", "RESULT_STATUS_C": "int",
        "SERV_AREA_ID": "text", "PARENT_HOSPITAL": "text",
    },
    pattern="LAB-BB-CSRP-CBC*",
    daily="LAB-BB-CSRP-CBC_Daily%s-",
    drop=("PAT_ID", "PAT_MRN_ID"),
)
CENSUS = Feed(
    name="census",
    columns={
        "PAT_MRN_ID": "text", "PAT_ID": "text", "LOCATION_ID": "int", "LOCATION_NAME": "text",
        "EVENT_TYPE": "text", "LOCATION_DT": "slash", "ADMIT_DT": "slash", "DISCH_DT": "text",
        "CENSUS_INCLUSN_YN": "text", "PAT_ENC_CSN_ID": "id", "PARENT_HOSPITAL": "text",
    },
    pattern="LAB-BB-CSRP-Census*",
    daily="LAB-BB-CSRP-Census_Daily%s-",
    drop=("PAT_ID", "PAT_MRN_ID"),
)
TRANSFUSION = Feed(
    name="transfusion",
    columns={
        "Type": "text", "DIN": "text", "Product Code": "text", "Donation Code": "text",
        "Division": "text", "UIP": "int", "UnitABO": "text", "UnitRh": "text",
        "Exp. Date/Time": "slash", "Issue Date/Time": "slash", "Issue to Location": "text",
        "Issue to Sub Location": "text", "Recip. MRN": "text", "Recip. ABO": "text",
        "Recip. Rh": "text",
    },
    pattern="LAB-BB-CSRP-Transfused*",
    daily="LAB-BB-CSRP-Transfused Product Report_Daily%s-",
    drop=("Recip. MRN",),
)
INVENTORY = Feed(
    name="inventory",
    columns={
        "Type": "text", "Days to Expire": "double", "Exp. Date": "text", "Exp. Time": "text",
    },
    pattern="Daily_Product_Inventory_Report_Morning_To_Folder*",
    daily="Daily_Product_Inventory_Report_Morning_To_Folder%s-",
    separator=",",
)
FEEDS = {f.name: f for f in (LABS, CENSUS, TRANSFUSION, INVENTORY)}

# Names after the scan: no spaces, dots or slashes from here on.
RENAMES = {
    "BASE_NAME": "base_name", "ORD_VALUE": "ord_value", "RESULT_TIME": "result_time",
    "LOCATION_NAME": "ward", "LOCATION_DT": "location_time",
    "Type": "type", "Issue Date/Time": "issue_time", "Days to Expire": "days_to_expire",
    "Exp. Date": "exp_date", "Exp. Time": "exp_time",
}


def column_name(raw: str) -> str:
    """Spark-friendly name of a feed column."""
    plain = "".join(ch if ch.isalnum() else "_" for ch in raw.lower())
    return RENAMES.get(raw, "_".join(p for p in plain.split("_") if p))


def _typed(raw: DataFrame, feed: Feed) -> DataFrame:
    def cell(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if isinstance(raw.schema[name].dataType, T.StringType):
            return CASTS[kind](F.when(~c.isin("", "NA"), c))
        return c.try_cast(TYPES[kind])

    return raw.select(
        *[
            cell(name, kind).alias(column_name(name))
            for name, kind in feed.columns.items()
            if name not in feed.drop
        ],
        _file_name().alias("file_name"),
    )


def _file_name() -> Column:
    """Plain file name of a row; Spark reports it percent-encoded, a plus sign as it is."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def _csv_options(feed: Feed) -> dict[str, str]:
    return {
        "sep": feed.separator,
        "header": "true",
        "enforceSchema": "false",  # a file whose header isn't the one it is read by is an error
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
    }


class HeaderError(ValueError):
    """A file's header lacks a column, or has one twice."""


def layouts(
    spark: SparkSession, folder: str, feed: Feed, pattern: str | None = None
) -> dict[tuple[str, ...], list[str]]:
    """The feed's files by their header, as written. Of each file only the first line is read; a
    file without any is left out, and a missing folder has none."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    top = jvm.org.apache.hadoop.fs.Path(folder)
    files = top.getFileSystem(conf)
    named = re.compile(pattern or feed.pattern)
    found: dict[tuple[str, ...], list[str]] = {}
    for place in files.globStatus(top) or []:
        for one in files.listStatus(place.getPath()) if place.isDirectory() else [place]:
            path = one.getPath()
            name = path.getName()
            if one.isDirectory() or name[0] in "._" or not named.search(name):
                continue
            header = _first_line(jvm, files, codecs, path)
            if header is not None:
                cells = tuple(c.strip().strip('"') for c in header.split(feed.separator))
                found.setdefault(cells, []).append(path.toString())
    for cells, paths in found.items():
        missing = [c for c in feed.columns if cells.count(c) != 1]
        if missing:
            raise HeaderError(f"header of {feed.name} file {paths[0]}: {missing} not there once")
    return found


def _first_line(jvm, files, codecs, path) -> str | None:
    stream = files.open(path)
    try:
        codec = codecs.getCodec(path)
        plain = codec.createInputStream(stream) if codec else stream
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        return lines.readLine()
    finally:
        stream.close()


def _read_csv(spark: SparkSession, paths: Sequence[str], feed: Feed, header: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return spark.read.schema(schema).options(**_csv_options(feed)).csv(list(paths))


def read_feed(
    spark: SparkSession, folder: str, feed: Feed, pattern: str | None = None, format: str = "csv"
) -> DataFrame:
    """All rows of a feed's files in ``folder`` whose name matches ``pattern`` (a regex).

    Columns are found by the file's header: files in other orders, or with more columns, read
    alike. ``format`` may also be a columnar one with the declared column names, typed or as text;
    ``folder`` may also be a single file.
    """
    pattern = pattern or feed.pattern

    def of_feed(raw: DataFrame) -> DataFrame:
        return _typed(raw.filter(_file_name().rlike(pattern)), feed)

    if format != "csv":
        return of_feed(spark.read.format(format).load(folder))
    found = layouts(spark, folder, feed, pattern)
    if len(found) <= 1:
        header = next(iter(found), tuple(feed.columns))
        return of_feed(_read_csv(spark, [folder], feed, header))
    escaped = {h: [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths] for h, paths in found.items()}
    return reduce(
        DataFrame.unionByName, [of_feed(_read_csv(spark, p, feed, h)) for h, p in escaped.items()]
    )


def read_feed_for_dates(
    spark: SparkSession, folder: str, feed: Feed, dates: Sequence[str] | None = None
) -> DataFrame:
    """Rows of the daily increment files, with the file's date as ``as_of``.

    ``dates`` (ISO texts) narrows the listing to those days; None takes every daily file.
    """
    if dates is None:
        pattern = feed.daily_pattern()
    else:
        pattern = feed.daily_pattern("(" + "|".join(dates) + ")")
    return with_as_of(read_feed(spark, folder, feed, pattern), feed)


def with_as_of(rows: DataFrame, feed: Feed) -> DataFrame:
    """Rows of daily files with the date in the file's name as ``as_of``."""
    date = F.regexp_extract("file_name", feed.daily_pattern(f"({DAY})"), 1)
    return rows.withColumn("as_of", date.try_cast("date"))


def stream_feed(spark: SparkSession, folder: str, feed: Feed, **options: str) -> DataFrame:
    """The same scan as an unbounded source that picks up each new file once."""
    raw = (
        spark.readStream.schema(feed.schema)
        .options(**_csv_options(feed))
        .options(**options)
        .csv(folder)
    )
    return _typed(raw.filter(_file_name().rlike(feed.pattern)), feed)


def list_files(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """Names of the files in a folder. The content column is pruned, so nothing is read."""
    files = spark.read.format("binaryFile").load(folder).select(_file_name().alias("file_name"))
    return files.filter(F.col("file_name").rlike(pattern)) if pattern else files


def dated_inventory(rows: DataFrame, date: str | None = None) -> DataFrame:
    """Inventory rows with their snapshot date: the given one, or the day before the file's."""
    when = F.lit(date).cast("date") if date else times.snapshot_date(F.col("file_name"))
    return rows.withColumn("date", when)
