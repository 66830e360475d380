"""Feed dates. The run date is always an argument, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats: dates in rows, dates in file names, times in snapshot names.
ROW_DATE = "yyyy/MM/dd"
FILE_DATE = "yyyyMMdd"
SNAPSHOT_TIME = "yyyyMMdd_HHmmss"


def as_date(value: Column | dt.date | str) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value).cast("date")


def days_before(run_date: Column | dt.date | str, days_ago: int) -> Column:
    return F.date_sub(as_date(run_date), days_ago)


def date_text(c: Column, pattern: str = ROW_DATE) -> Column:
    return F.date_format(c, pattern)


def parse_row_date(c: Column) -> Column:
    """``yyyy/MM/dd`` text to date, null when it is none."""
    return F.try_to_timestamp(c, F.lit(ROW_DATE)).cast("date")


def feed_path(run_date: Column | dt.date | str, days_ago: int, suffix: str, folder: str = "") -> Column:
    """Path of a day's feed file: ``<folder>/<yyyyMMdd><suffix>``."""
    name = F.concat(date_text(days_before(run_date, days_ago), FILE_DATE), F.lit(suffix))
    return F.concat(F.lit(folder.rstrip("/") + "/"), name) if folder else name
