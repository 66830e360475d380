"""Readers for page snapshots and element documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.dates import SNAPSHOT_TIME, date_text
from feedloom.functions.urls import page_slug

SNAPSHOT_NAME = r"^(.*)_(\d{8}_\d{6})\.html$"

ELEMENT = T.StructType(
    [
        T.StructField("element_name", T.StringType()),
        T.StructField("element_type", T.StringType()),
        T.StructField("selectors", T.MapType(T.StringType(), T.StringType())),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("visible_text", T.StringType()),
        T.StructField("recommendations", T.StringType()),
    ]
)
ELEMENT_LIST = T.StructType([T.StructField("elements", T.ArrayType(ELEMENT))])
ELEMENT_DOCUMENT = T.StructType(
    [
        T.StructField("section", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("elements", ELEMENT_LIST),
    ]
)


def snapshot_name(url: Column, captured_at: Column) -> Column:
    """File name of a page's snapshot: slug, time and ``.html``."""
    return F.concat(page_slug(url), F.lit("_"), date_text(captured_at, SNAPSHOT_TIME), F.lit(".html"))


def parse_snapshot_name(file_name: Column) -> Column:
    """``(page_slug, captured_at)`` of a file name, both null unless it ends in a valid time."""
    stamp = F.nullif(F.regexp_extract(file_name, SNAPSHOT_NAME, 2), F.lit(""))
    captured = F.try_to_timestamp(stamp, F.lit(SNAPSHOT_TIME))
    slug = F.when(captured.isNotNull(), F.regexp_extract(file_name, SNAPSHOT_NAME, 1))
    return F.struct(slug.alias("page_slug"), captured.alias("captured_at"))


def scan_pages(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Snapshot files as ``(file_name, page_slug, captured_at, html)``."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("html")
    )
    parts = parse_snapshot_name(F.col("file_name"))
    return files.select("file_name", parts.alias("p"), "html").select("file_name", "p.page_slug", "p.captured_at", "html")


def scan_elements(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Element documents as one row per element, with its section, time text and place in the list.

    Documents written as JSON lines read faster with ``multi_line=False``.
    """
    documents = spark.read.schema(ELEMENT_DOCUMENT).option("multiLine", multi_line).json(path)
    return documents.select("section", "timestamp", F.posexplode("elements.elements").alias("pos", "element")).select(
        "section", "timestamp", "pos", "element.*"
    )
