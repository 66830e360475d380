"""What was repaired, dropped or not found, as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.text import clean_currency
from feedloom.sources.feeds import CURRENCY_COLUMN
from feedloom.sources.records import CSV_RECORDS, file_pieces

ISSUES = "feed string, file_name string, issue string, detail string, field_count int, record_number long"


def ragged_rows(scanned: DataFrame, feed: str, width: int) -> DataFrame:
    """Rows of a wrong width, from a scan made ``with_source``: file, raw record, field count, number of the record in its file.

    A row of the right width that carries a raw record broke another CSV rule.
    """
    issue = (
        F.when(F.col("field_count") > width, "long_row").when(F.col("field_count") < width, "short_row").otherwise("bad_row")
    )
    return scanned.where(F.col("raw_record").isNotNull()).select(
        F.lit(feed).alias("feed"), "file_name", issue.alias("issue"), F.col("raw_record").alias("detail"), "field_count", "record_number"
    )


def header_issues(spark: SparkSession, feed: str, header: Sequence[str]) -> DataFrame:
    """Blank and repeated header cells."""
    rows, seen = [], set()
    for i, cell in enumerate(header):
        name = cell.strip()
        if not name:
            rows.append((feed, None, "blank_header", f"column {i + 1}", len(header), 1))
        elif name in seen:
            rows.append((feed, None, "repeated_header", name, len(header), 1))
        seen.add(name)
    return spark.createDataFrame(rows, ISSUES)


def missing_feeds(spark: SparkSession, missing: Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame([(feed, None, "missing_feed", why, None, None) for feed, why in missing.items()], ISSUES)


def lost_signs(raw: DataFrame, feed: str, column: str = CURRENCY_COLUMN) -> DataFrame:
    """Money values whose minus sign the cleaning removes; ``raw`` is scanned with no currency column."""
    value = F.col(f"`{column}`")
    return raw.where(F.regexp_like(value, F.lit(r"^\s*[-−－▲△]")) & (clean_currency(value) != value)).select(
        F.lit(feed).alias("feed"),
        F.lit(None).cast("string").alias("file_name"),
        F.lit("lost_sign").alias("issue"),
        value.alias("detail"),
        F.lit(None).cast("int").alias("field_count"),
        F.lit(None).cast("long").alias("record_number"),
    )


def profile_csv(spark: SparkSession, path: str | Sequence[str], multi_line: bool | None = True) -> DataFrame:
    """``(row_count, max_fields)`` of CSV text, the header row counted; 0 and 0 when empty.

    Blank lines are rows without fields, line ends and commas inside quotes do not count. Only quotes, commas and line
    ends are looked at, which have the same bytes in UTF-8 and windows-31j. Records are cut in parts of the files; a lone carriage return
    outside quotes ends a row. ``False`` is for files known to hold no quoted line end: one pass, line by line. Two numbers per task are shuffled.
    """
    if multi_line is False:
        pieces = spark.read.text(path).select(F.col("value").alias("text"))
    else:
        pieces = file_pieces(spark, path, CSV_RECORDS).select(F.rtrim(F.col("raw").cast("string"), F.lit("\r")).alias("text"))
    bare = F.regexp_replace("text", r'"[^"]*+(?:"|$)', "x")
    lines = pieces.select(F.explode(F.split(bare, "\r")).alias("line"))
    fields = F.when(F.col("line") == "", 0).otherwise(F.size(F.split("line", ",")))
    return lines.agg(F.count("*").alias("row_count"), F.coalesce(F.max(fields), F.lit(0)).alias("max_fields"))
