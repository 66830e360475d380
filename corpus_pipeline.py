"""The corpus pipeline: quality rules, line dedup, near copies, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written and read again as the next one's ``docs``.
All but the last return the columns of the documents; only rows that a stage rejects go, only text that it
rejects is cut, and ``n_chars`` (where there is such a column) follows the text. Null ids and texts, repeated rows and
empty tables are handled as each operator's docstring says. A stage's output must be written before the next stage is called on it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm.common import recorded, remove_tables, settle, table
from feedloom.llm.jaccard import jaccard_components
from feedloom.llm.lines import drop_repeated_lines
from feedloom.llm.packing import pack_documents
from feedloom.llm.pii import redact_pii
from feedloom.llm.quality import quality_rules

ORACLE_SQL = None  # the likelihood ratio, the contexts and the packing have no form in SQL


def _like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The documents' own columns, with the length of the text brought up to date."""
    if "n_chars" in docs.columns:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", F.coalesce(size, F.col("n_chars")))
    return changed.select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_rules(docs, trusted).where("kept").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go from all but one of them; every document stays."""
    return _like(docs, drop_repeated_lines(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at 0.8 the document with the smallest id stays.

    Of several rows with that id one of each text stays, upper and lower case and blanks aside; rows without words only where the
    id has no other. Rows with a null id all stay.
    """
    classes = jaccard_components(docs, size=5, percent=80)
    first = classes.groupBy("doc_id").agg(F.min("component_id").alias("component_id")).where("doc_id = component_id").select("doc_id")
    named = docs.join(first, "doc_id", "left_semi")
    own = Window.partitionBy("doc_id")
    words = F.nullif(F.trim(F.regexp_replace(F.lower("text"), r"[\x20\x09-\x0D]+", " ")), F.lit(""))
    # texts are looked at only where an id has several rows
    counted = named.withColumn("__rows", F.count(F.lit(1)).over(own)).withColumn("__words", F.when(F.col("__rows") > 1, F.xxhash64(words)))
    worded = counted.withColumn("__filled", (F.col("__rows") == 1) | words.isNotNull())
    ranked = worded.withColumns(
        {"__any": F.bool_or("__filled").over(own), "__n": F.row_number().over(Window.partitionBy("doc_id", "__words").orderBy("text"))}
    )
    kept = ranked.where((F.col("__n") == 1) & (F.col("__filled") | ~F.col("__any"))).select(docs.columns)
    return kept.unionByName(docs.where("doc_id is null"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text gives way to its kind in brackets; every document stays."""
    return _like(docs, redact_pii(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of token ids, each with its sequence and its offset there."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, added_tokens=True)


_INNER: list[str] = []


def staged(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, which first removes the inner tables of the stage before it.

    Its input is that stage's written output, so nothing reads them any more, also if an executor is lost now.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove_tables(spark, _INNER)
        with recorded(_INNER):
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality rules", staged(quality)),
    ("line dedup", staged(line_dedup)),
    ("n-gram Jaccard join", staged(near_copies)),
    ("PII", staged(personal_data)),
    ("best-fit packing", staged(packing)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return last(spark, docs, sf_dir)
