"""Column operators of the feed path."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.dates import date_text, days_before
from feedloom.functions.text import to_number, whole_number_text

# The date column, the two feeds cut out of a wide report, the new name of
# the click column, and the numeric columns of the classroom counts.
DATE_COLUMN = "日付"
SS_COLUMNS = ("日付", "広告名", "クリック数")
CV_COLUMNS = ("日付", "広告名", "応募完了（CV）")
SESSION_NAMES = {"クリック数": "セッション数"}
COUNT_COLUMNS = ("教室グループID", "企業ID", "都道府県", "プラン", "掲載設定数", "急募求人数")


def quoted(name: str) -> Column:
    """A column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[quoted(c).cast("string").alias(c) for c in df.columns])


def fill_blank(df: DataFrame) -> DataFrame:
    """Every column as text, null as the empty text."""
    return df.select(*[F.coalesce(quoted(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def stamp_date(df: DataFrame, run_date: dt.date | str | Column, days_ago: int, name: str = DATE_COLUMN) -> DataFrame:
    """Add the day ``days_ago`` days before the run date as ``yyyy/MM/dd`` text."""
    return df.withColumn(name, date_text(days_before(run_date, days_ago)))


def rename_columns(df: DataFrame, names: Mapping[str, str] = SESSION_NAMES) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def reindex_columns(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """The named columns in that order. One that is missing becomes null, or an error if strict."""
    missing = [c for c in columns if c not in df.columns]
    if strict and missing:
        raise ValueError(f"columns {missing} are missing")
    return df.select(
        *[quoted(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
    )


def coerce_numeric(df: DataFrame, columns: Sequence[str] = COUNT_COLUMNS) -> DataFrame:
    """The listed columns as double, null where they hold no number; all others as text."""
    return df.select(
        *[to_number(quoted(c)).alias(c) if c in columns else quoted(c).cast("string").alias(c) for c in df.columns]
    )


def whole_numbers(df: DataFrame) -> DataFrame:
    """Floating columns as text without decimals, all others as text, null as the empty text."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[
            whole_number_text(quoted(c)).alias(c)
            if c in floating
            else F.coalesce(quoted(c).cast("string"), F.lit("")).alias(c)
            for c in df.columns
        ]
    )


def metric_text(c: Column) -> Column:
    """A metric as it is written to a feed: numbers without decimals, other text unchanged."""
    number = to_number(c)
    return F.when(number.isNotNull(), whole_number_text(number)).otherwise(F.coalesce(c.cast("string"), F.lit("")))


def split_feed(
    report: DataFrame,
    feeds: Mapping[str, Sequence[str]] | None = None,
    keys: Sequence[str] = SS_COLUMNS[:2],
) -> dict[str, DataFrame]:
    """One wide report as its feeds, the SS and the CV feed unless told otherwise.

    Every feed is a projection of the same report; its scan reads that feed's columns only.
    """
    wanted = feeds or {"ss": SS_COLUMNS, "cv": CV_COLUMNS}
    return {
        feed: reindex_columns(report, columns).select(
            *[quoted(c) if c in keys else metric_text(quoted(c)).alias(c) for c in columns]
        )
        for feed, columns in wanted.items()
    }
