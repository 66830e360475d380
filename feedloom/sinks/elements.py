"""Element documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.elements import is_excluded

RECORD = ("element_name", "element_type", "selectors", "attributes", "visible_text", "recommendations")


def element_documents(elements: DataFrame, page: str = "page_id", pos: str = "pos") -> DataFrame:
    """``(section, page, elements)`` from a flat element table: one document per section and page.

    A document holds the elements of one page, so no group outgrows a page however many pages a
    section has. Elements keep their order.
    """
    listed = F.collect_list(F.struct(F.col(pos).alias("pos"), F.struct(*_record(elements)).alias("element")))
    in_order = F.array_sort(listed, lambda a, b: a["pos"] - b["pos"])
    documents = elements.groupBy("section", page).agg(in_order.alias("listed"))
    items = F.transform("listed", lambda e: e["element"])
    return documents.select("section", page, F.struct(items.alias("elements")).alias("elements"))


def page_documents(inventories: DataFrame, page: str = "page_id") -> DataFrame:
    """The same documents from pages that still hold their records as an array: nothing is shuffled."""
    kept = F.filter("records", lambda r: ~is_excluded(F.col("section"), r["element_name"]))
    items = F.transform(
        kept, lambda r: F.struct(*[(r[c] if c != "recommendations" else F.lit("")).alias(c) for c in RECORD])
    )
    return inventories.select("section", page, F.struct(items.alias("elements")).alias("elements"))


def _record(elements: DataFrame) -> list:
    return [F.col(c) if c in elements.columns else F.lit("").alias(c) for c in RECORD]


def write_elements(documents: DataFrame, path: str, rebalance: bool = True) -> None:
    """Documents as JSON lines, one folder per section; the section stays in each document.

    A section that occurs in the documents is replaced, all others in the folder stay.

    Rebalancing gathers a section's documents into few files and splits a large section. With one
    section there is nothing to gather.
    """
    placed = documents.withColumn("section_dir", F.col("section"))
    if rebalance:
        placed = placed.hint("rebalance", "section_dir")
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("section_dir").json(path)
