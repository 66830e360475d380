"""Numbered batches for a row-limited target, and the run log."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.session import work_path

# Rows per batch and the columns of the target range.
BATCH_ROWS = 1000
FIRST_CELL, LAST_CELL = "A", "ZZ"

_PARTITION_BITS = 33
RUN_LOG = "run_id string, stage string, status string, rows bigint, error string, detail string"


def number_rows(df: DataFrame, order_by: Sequence[str] = (), name: str = "row_index", unique: bool = False) -> DataFrame:
    """Add a gapless 0-based ``row_index`` in the order given, ties in file order; or in file order.

    File order is by path, then by place in the file; rows that do not come straight from files have the order of their
    partitions. Rows are written with their place, and read back before they are sorted and again before they
    are counted; with ``unique`` no two rows have one key, and the first of the two writes is left out. What is numbered is so fixed on disk, and a lost executor cannot shift a number.
    The place breaks ties, so a sort key that fills a third of the rows is still spread over many
    tasks. One short row per partition, its number of rows, is all that meets in one task.
    """
    if unique and order_by:
        places = []
        ordered = df
    else:
        places = ["_file", "_block", "_from"]
        ordered = _write_places(df.withColumns({"_file": F.input_file_name(), "_block": F.input_file_block_start()})).withColumnRenamed("_at", "_from")
    keys = [*order_by, *places]
    placed = _write_places(ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*places))
    part = F.shiftright("_at", _PARTITION_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select(
        "_part", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(W.partitionBy()).alias("total_rows")
    )
    inside = F.col("_at").bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    # One row per written partition; Spark broadcasts it while it is small.
    return (
        placed.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(name, F.col("_before") + inside)
        .drop("_part", "_before", "_at")
    )


def _write_places(df: DataFrame) -> DataFrame:
    """The rows with ``_at``, partition and place inside it in one number, from a written table."""
    path = work_path(df.sparkSession, "numbered")
    df.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def export_batches(
    df: DataFrame, order_by: Sequence[str] = (), batch_rows: int = BATCH_ROWS, has_header: bool = True
) -> DataFrame:
    """Add ``row_index``, ``batch_num`` (from 1), ``total_batches`` and the ``range_text`` of the batch."""
    numbered = number_rows(df, order_by)
    batch = F.expr(f"row_index div {int(batch_rows)}")
    begin = F.lit(2 if has_header else 1) + batch * batch_rows
    size = F.least(F.lit(batch_rows).cast("bigint"), F.col("total_rows") - batch * batch_rows)
    return numbered.select(
        *df.columns,
        "row_index",
        (batch + 1).alias("batch_num"),
        F.expr(f"(total_rows + {int(batch_rows) - 1}) div {int(batch_rows)}").alias("total_batches"),
        F.concat(F.lit(FIRST_CELL), begin, F.lit(":" + LAST_CELL), begin + size - 1).alias("range_text"),
    )


def batch_report(batches: DataFrame) -> DataFrame:
    """One row per batch: number, range and rows."""
    return batches.groupBy("batch_num", "total_batches", "range_text").agg(F.count("*").alias("row_count"))


def deliver_batches(batches: DataFrame, send: Callable[[str, pd.DataFrame], None]) -> DataFrame:
    """Call ``send(range_text, rows)`` for every batch and report each as a row.

    A batch that fails is reported and does not stop the rest. A batch has a fixed number of
    rows at most, so a group is small. Spark may repeat a lost task: a range is written again
    with the same rows.
    """

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row_index")
        status, detail = "ok", ""
        try:
            send(rows["range_text"].iloc[0], rows.drop(columns=["batch_num", "total_batches", "range_text", "row_index"]))
        except Exception as error:
            status, detail = "failed", f"{type(error).__name__}: {error}"
        return pd.DataFrame(
            {
                "batch_num": [rows["batch_num"].iloc[0]],
                "range_text": [rows["range_text"].iloc[0]],
                "row_count": [len(rows)],
                "status": [status],
                "detail": [detail],
            }
        )

    shape = "batch_num bigint, range_text string, row_count bigint, status string, detail string"
    return batches.groupBy("batch_num").applyInPandas(one, shape)


def append_run_log(rows: DataFrame, path: str) -> str | None:
    """Append rows to the run log. A failure is returned as text and never raised."""
    try:
        rows.write.mode("append").parquet(path)
    except Exception as error:
        return f"{type(error).__name__}: {error}"
    return None


def log_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), RUN_LOG)
