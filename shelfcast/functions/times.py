"""Time-stamp texts, file-name dates and calendars.

Stamps are built with ``try_make_timestamp_ntz`` from their parts, so a bad text is NULL under
ANSI mode too, white space is elastic, and the session time zone plays no role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")

_SLASH = r"^\d{1,2}/\d{1,2}/\d{4}\s+\d{1,2}:\d{1,2}:\d{1,2}\s*[AP]M$"
_DASH = r"^\d{1,2}-[A-Z]{3}-\d{2}\s+\d{1,2}:\d{1,2}:\d{1,2}$"


def _int(c: Column) -> Column:
    return c.try_cast("int")


def slash_stamp(text: Column) -> Column:
    """``04/09/2018  11:59:00PM``, any white space before the time and before AM/PM."""
    text = F.upper(F.trim(text))
    part = F.split(F.regexp_replace(text, r"\s*[AP]M$", ""), r"[/:\s]+")
    hour = _int(part[3])
    hour24 = F.when(hour.between(1, 12), hour % 12 + F.when(text.endswith("PM"), 12).otherwise(0))
    return F.when(
        text.rlike(_SLASH),
        F.try_make_timestamp_ntz(
            _int(part[2]), _int(part[0]), _int(part[1]), hour24, _int(part[4]),
            part[5].try_cast("decimal(16,6)"),
        ),
    )


def dash_stamp(text: Column) -> Column:
    """``09-Apr-18 08:01:54``; two-digit years from 70 on are in the 1900s."""
    text = F.upper(F.trim(text))
    part = F.split(text, r"[-:\s]+")
    at = F.instr(F.lit(MONTHS), part[1])
    month = F.when((at > 0) & (at % 3 == 1), ((at + 2) / 3).cast("int"))
    year = _int(part[2])
    return F.when(
        text.rlike(_DASH),
        F.try_make_timestamp_ntz(
            year + F.when(year >= 70, 1900).otherwise(2000), month, _int(part[0]), _int(part[3]),
            _int(part[4]), part[5].try_cast("decimal(16,6)"),
        ),
    )


def file_date(file_name: Column) -> Column:
    """First ``yyyy-mm-dd`` style run of digits and dashes in a file name, as a date."""
    run = F.regexp_extract(file_name, r"([0-9\-]+)", 1)
    return F.substring(run, 1, 10).try_cast("date")


def iso_date_in(text: Column) -> Column:
    """First ``yyyy-mm-dd`` anywhere in a text, as a date."""
    return F.regexp_extract(text, r"(\d{4}-\d{2}-\d{2})", 1).try_cast("date")


def snapshot_date(file_name: Column) -> Column:
    """A morning snapshot file describes the day before the date in its name."""
    return F.date_sub(file_date(file_name), 1)


def report_name(file_name: Column) -> Column:
    """File name without folder and extension, plus ``-summary``."""
    base = F.element_at(F.split(file_name, "/"), -1)
    return F.concat(F.regexp_replace(base, r"\.[A-Za-z0-9]+$", ""), F.lit("-summary"))


def weekday_one_hot(df: DataFrame, date: str = "date") -> DataFrame:
    """Seven 0/1 columns Mon..Sun, independent of locale."""
    return df.selectExpr(
        "*", *[f"CAST(weekday(`{date}`) = {k} AS INT) AS {d}" for k, d in enumerate(WEEKDAYS)]
    )


def calendar(bounds: DataFrame, start: Column, end: Column, keys: list[str] | tuple = ()) -> DataFrame:
    """One row per key and day from ``start`` to ``end`` inclusive; ``bounds`` has one row per key."""
    return bounds.select(*keys, F.explode(F.sequence(start, end)).alias("date"))
