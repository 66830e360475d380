"""Feed writers. The history is Parquet, partitioned by day, and a day is written whole."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.dates import as_date, parse_row_date
from feedloom.operators.columns import DATE_COLUMN, quoted, whole_numbers
from feedloom.session import JAPANESE, allow_japanese

DAY = "feed_date"
FILE = "feed_file"
MODIFIED = "feed_modified"
DELIVERIES = "_deliveries"  # readers pass over folders whose names begin so


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (DAY,), rebalance: bool = False) -> None:
    """Overwrite the partitions that occur in ``df`` and leave all others alone.

    ``rebalance`` is for writes of many days at once: rows are gathered by partition first, and
    AQE splits a large day and joins small ones, so there are few files and no hot task.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def write_feed_csv(df: DataFrame, path: str, encoding: str = JAPANESE) -> None:
    """A feed as CSV files with header: floating numbers without decimals, null as nothing."""
    allow_japanese(df.sparkSession)
    (
        whole_numbers(df)
        .write.mode("overwrite")
        .option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("emptyValue", "")
        # Values keep the blanks at their ends.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def with_day(
    feed: DataFrame, day: Column | dt.date | str | None = None, date_column: str = DATE_COLUMN, strict: bool = True
) -> DataFrame:
    """Add the partition column: a given day, or the row's own date text.

    A row whose text is no date fails the job, because rows without a day would replace one
    another in the history. With ``strict=False`` they are kept under a null day.
    """
    if day is not None:
        return feed.withColumn(DAY, as_date(day))
    text = quoted(date_column)
    parsed = parse_row_date(text)
    if strict:
        problem = F.concat(F.lit(f"{date_column} holds no date: "), F.coalesce(text, F.lit("null")))
        parsed = F.when(parsed.isNull(), F.raise_error(problem).cast("date")).otherwise(parsed)
    return feed.withColumn(DAY, parsed)


def append_feed(
    feed: DataFrame,
    history: str,
    mode: str = "day",
    by: Sequence[str] = (DAY,),
    rebalance: bool = False,
    source: str | None = None,
) -> None:
    """Add a feed, with its ``feed_date``, to the history.

    A history that a file stream also writes is laid out by day and source file. ``source`` names the batch there: what is
    replaced is then a day's rows from this source.

    ``mode='day'`` replaces the days that occur in the feed, so a second run changes nothing. A
    day that the feed has no row of stays as it was.
    ``mode='raw'`` adds the rows to what is there, by position: a second run doubles them.
    """
    if source is not None:
        feed, by = feed.withColumn(FILE, F.lit(source)), (DAY, FILE)
    if mode == "day":
        write_parquet(feed, history, by, rebalance)
    elif mode == "raw":
        names = history_columns(feed.sparkSession, history, feed.columns)
        feed.toDF(*names).write.mode("append").partitionBy(*by).parquet(history)
    else:
        raise ValueError(f"mode must be 'day' or 'raw', not {mode!r}")


def append_newest(feed: DataFrame, history: str) -> None:
    """Add rows of files, with ``feed_date``, ``feed_file`` and ``feed_modified``, so that each day holds its newest file alone.

    The files of every day that were ever delivered this way are listed in a table beside the days. Of a day's files the one modified last
    wins, ties to the later name: its rows replace those of the others, and rows of an older file that comes late are not
    written. Run again with the same rows nothing changes, whatever step a failed run had reached: first the list grows, then
    the winners' rows are written, then the folders of files that lost go. Rows without a day stay by file. Rows that
    ``append_feed`` writes with another ``source`` are not touched. The list has a row per file and day; only what the feed's own days lost
    comes to the driver.
    """
    spark = feed.sparkSession
    listing = f"{history.rstrip('/')}/{DELIVERIES}"
    home = spark._jvm.org.apache.hadoop.fs.Path(listing)
    system = home.getFileSystem(spark._jsc.hadoopConfiguration())
    earlier = [x.getPath() for x in system.listStatus(home)] if system.exists(home) else []
    shape = f"{DAY} date, {FILE} string, {MODIFIED} timestamp"
    arrived = feed.where(F.col(DAY).isNotNull()).groupBy(DAY, FILE).agg(F.max(MODIFIED).alias(MODIFIED))
    known = arrived.select(DAY, FILE, MODIFIED)
    for path in earlier:  # one, or two where a run failed between writing and removing
        known = known.unionByName(spark.read.schema(shape).parquet(path.toString()))
    version = f"{listing}/{uuid.uuid4().hex}"
    known.groupBy(DAY, FILE).agg(F.max(MODIFIED).alias(MODIFIED)).write.parquet(version)

    deliveries = spark.read.schema(shape).parquet(version)
    winners = deliveries.groupBy(DAY).agg(F.max_by(FILE, F.struct(MODIFIED, FILE)).alias("_winner"))
    rows = feed.join(winners, DAY, "left").where(F.col(FILE).eqNullSafe(F.coalesce("_winner", FILE)))
    write_parquet(rows.select(*[c for c in feed.columns if c != MODIFIED]), history, (DAY, FILE))

    days = feed.select(DAY).distinct()
    lost = deliveries.join(winners, DAY).join(days, DAY, "left_semi").where(F.col(FILE) != F.col("_winner"))
    for row in lost.select(DAY, FILE).collect():
        remove_file(spark, history, row[DAY], row[FILE])
    for path in earlier:
        system.delete(path, True)


def remove_file(spark: SparkSession, history: str, day: dt.date, file: str) -> None:
    """Delete the folder of one file of a day, if there is one."""
    home = spark._jvm.org.apache.hadoop.fs.Path(f"{history.rstrip('/')}/{DAY}={day:%Y-%m-%d}")
    system = home.getFileSystem(spark._jsc.hadoopConfiguration())
    # Spark writes some characters of a partition's value as % and two digits
    held = [x.getPath() for x in system.listStatus(home)] if system.exists(home) else []
    for path in held:
        if unquote(path.getName()) == f"{FILE}={file}":
            system.delete(path, True)


def history_columns(spark: SparkSession, history: str, default: Sequence[str]) -> list[str]:
    try:
        return spark.read.parquet(history).columns
    except AnalysisException:
        return list(default)


def append_rows(history: DataFrame, feed: DataFrame) -> DataFrame:
    """Rows of the feed behind those of the history, columns matched by position."""
    return history.union(feed)


def keep_last_days(history: DataFrame, days: int, day: str = DAY) -> DataFrame:
    """Rows of the newest ``days`` distinct days.

    The oldest day to keep is looked up first: one value, from partial results of one short row
    per day. As a plain filter it then prunes partitions, or row groups where there are none.
    """
    newest = history.select(day).where(quoted(day).isNotNull()).distinct().orderBy(quoted(day).desc()).limit(days)
    oldest = newest.agg(F.min(day)).first()[0]
    return history.where(quoted(day) >= F.lit(oldest)) if oldest is not None else history.limit(0)


def remove_day(spark: SparkSession, history: str, day: dt.date, column: str = DAY) -> None:
    """Delete a day's folder of a history, if there is one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{history.rstrip('/')}/{column}={day:%Y-%m-%d}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_old_days(spark: SparkSession, history: str, days: int, day: str = DAY) -> list[str]:
    """Delete the day folders of a history but the newest ``days``; gives the names of those that went.

    Only the listing of the history is read. Folders of no day, and files beside them, stay.
    """
    home = spark._jvm.org.apache.hadoop.fs.Path(history)
    system = home.getFileSystem(spark._jsc.hadoopConfiguration())
    held = {x.getPath().getName(): x.getPath() for x in system.listStatus(home) if x.isDirectory()}
    dated = sorted(name for name in held if re.fullmatch(re.escape(day) + r"=\d{4}-\d{2}-\d{2}", name))
    old = dated[: max(0, len(dated) - days)]
    for name in old:
        system.delete(held[name], True)
    return old


def clear_table(df: DataFrame, path: str) -> None:
    """Write the table without rows; its columns stay."""
    df.limit(0).write.mode("overwrite").parquet(path)
