"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from feedloom.session import work_path

# Spark removes the shuffle files of an execution at its end where this is on.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# White space of word and line rules: blank and the five control characters 09-0D.
BLANKS = "\t\n\x0b\x0c\r "


def settle(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write the rows to the shared folder, with the given options of the Parquet writer, and read them back.

    This cuts the lineage (a lost executor never repeats the work before it), fixes the rows, and lets
    Spark know the table's true size, so that it broadcasts it only below its own threshold. The shuffles that made the rows are
    not needed once they are written, and go.
    """
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    for tables in _RECORDS:
        tables.append(path)
    return spark.read.schema(df.schema).parquet(path)


_RECORDS: list[list[str]] = []


@contextmanager
def recorded(tables: list[str]) -> Iterator[None]:
    """The folders of the tables that are settled inside are added to the list."""
    _RECORDS.append(tables)
    try:
        yield
    finally:
        _RECORDS.remove(tables)


def remove_tables(spark: SparkSession, tables: list[str]) -> None:
    """Delete folders of settled tables that nothing reads any more, and empty the list."""
    while tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(tables.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType | str) -> DataFrame:
    """Apply a function to every Arrow batch; batches stay small, so a task never holds its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = function(batch)
            if out is not None:
                yield out

    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kind_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def arrow_kind(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)
