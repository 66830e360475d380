"""The daily drop folder as a file stream.

Each run takes in the files that are new since the last one and stops. State is the checkpoint's
list of files; rows need none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom.functions.text import clean_currency
from feedloom.operators.columns import DATE_COLUMN, quoted
from feedloom.session import JAPANESE, allow_japanese
from feedloom.sinks.feeds import DAY, FILE, MODIFIED, append_feed, append_newest, with_day
from feedloom.sources.feeds import CURRENCY_COLUMN, text_schema


def stream_feed(
    spark: SparkSession,
    folder: str,
    names: Sequence[str],
    encoding: str = JAPANESE,
    currency_column: str | None = CURRENCY_COLUMN,
    max_files: int | None = None,
    check_header: bool = True,
) -> DataFrame:
    """The folder's CSV files as a stream of text rows with their file's name and the time it was modified.

    ``names`` are the normalised header names; a stream's schema must be known before it starts. Every file's header must
    have these cells; without ``check_header`` (for headers with blank or repeated cells) only their number counts.
    """
    allow_japanese(spark)
    reader = (
        spark.readStream.schema(text_schema(names))
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("encoding", encoding)
        # a file whose header differs fails the run, and is named
        .option("enforceSchema", not check_header)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.csv(folder)

    def cell(name: str):
        value = F.coalesce(quoted(name), F.lit(""))
        return (clean_currency(value) if name == currency_column else value).alias(name)

    metadata = (F.col("_metadata.file_name").alias(FILE), F.col("_metadata.file_modification_time").alias(MODIFIED))
    return rows.select(*[cell(n) for n in names], *metadata)


def append_stream(
    rows: DataFrame, history: str, checkpoint: str, date_column: str = DATE_COLUMN, available_now: bool = True, newest_wins: bool = False
) -> StreamingQuery:
    """Write a feed stream into the history.

    The unit that is replaced is a day's rows from one file. Two files of one day may so arrive in
    different micro-batches, and a micro-batch that is run again after a failure changes nothing. Batches join the same history
    with ``append_feed(..., source=...)``.

    With ``newest_wins`` a day's files are deliveries of one report, of which the newest holds: a corrected file takes the place of the earlier
    one, and an older file that comes late changes nothing (:func:`feedloom.sinks.feeds.append_newest`).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        feed = with_day(batch, date_column=date_column, strict=False)
        if not newest_wins:
            append_feed(feed.drop(MODIFIED), history, by=(DAY, FILE))
            return
        kept = feed.persist()  # read once: listed, then written
        try:
            append_newest(kept, history)
        finally:
            kept.unpersist()

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
