"""Query registry and input helpers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from feedloom.session import JAPANESE, allow_japanese, work_path

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL where there is one."""

    def add(run: Query) -> Query:
        REGISTRY[run.__name__] = Entry(run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_lines(df: DataFrame, line: Column, header: str | None, name: str, encoding: str = JAPANESE) -> str:
    """Write ready-made CSV lines, each file with the header line; gives the folder."""
    spark = df.sparkSession
    allow_japanese(spark)
    path = work_path(spark, name)
    (
        df.select(line.alias(header or "line"))
        .write.option("header", header is not None)
        .option("sep", "\x01")
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("encoding", encoding)
        .csv(path)
    )
    return path
