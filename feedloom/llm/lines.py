"""Line dedup: drop long lines that many documents share, but for one document that keeps them."""

from __future__ import annotations

from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import BLANKS, arrow_kind, kind_of, map_batches, settle

MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit hash of the stripped, A-Z lower-cased line; None if it is too short to count."""
    stripped = line.strip(BLANKS)
    return blake2b(stripped.encode().lower(), digest_size=16).digest() if len(stripped) >= min_chars else None


def line_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc, key)``: the distinct keys of every document's lines."""
    kind = arrow_kind(docs, doc_id)

    def keys(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [list({k for x in (t or "").split("\n") if (k := line_key(x, min_chars))}) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(kind), pa.array(found, pa.list_(pa.binary()))], ["doc", "keys"])

    found = map_batches(docs.select(doc_id, text), keys, f"doc {kind_of(docs, doc_id)}, keys array<binary>")
    return found.select("doc", F.explode("keys").alias("key"))


def drop_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """The documents without the lines that at least ``min_docs`` documents share.

    A line's key is the line stripped of blanks and tabs at both ends with A-Z lower-cased. Keys of at least
    ``min_chars`` code points found in ``min_docs`` documents or more lose all their lines, except in the largest
    ``doc_id`` that holds them. Columns: those of ``docs`` with the shorter text, ``n_lines`` (before) and
    ``n_dropped``; columns of these two names are replaced.

    Null or empty text: one empty line; a null text stays null. Rows of one id are one document; rows without an id count
    together as one, below all others. An empty table gives an empty table.

    Keys are counted with partial results, so a line in every document is one row per task. The (document, key)
    pairs to drop are joined to the texts by document, which is never hot.
    """
    keys = settle(line_keys(docs, doc_id, text, min_chars), "line-keys")
    # only documents of several rows can hold a key more than once
    repeated = settle(docs.groupBy(F.col(doc_id).alias("doc")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc"), "line-repeated")
    counted = keys
    if not repeated.isEmpty():
        many = repeated.select(F.col("doc").alias("__d"))
        same = F.col("doc").eqNullSafe(F.col("__d"))
        counted = keys.join(many, same, "left_anti").unionByName(keys.join(many, same, "left_semi").distinct())
    common = settle(
        counted.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("last")).where(F.col("n") >= min_docs).select("key", "last"),
        "line-common",
    )
    drops = (
        keys.join(common, "key")
        .where(~F.col("doc").eqNullSafe(F.col("last")))
        .groupBy(F.col("doc").alias("__doc"))
        .agg(F.collect_set("key").alias("__keys"))
    )
    kept = docs.drop("n_lines", "n_dropped")
    joined = kept.join(drops, F.col(doc_id).eqNullSafe(F.col("__doc")), "left").select(*kept.columns, "__keys")
    schema = T.StructType([*kept.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    place = kept.columns.index(text)

    def rebuild(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, counts, dropped = [], [], []
        for value, gone in zip(batch.column(place).to_pylist(), batch.column("__keys").to_pylist(), strict=True):
            lines = (value or "").split("\n")
            gone = set(gone or ())
            left = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
            texts.append(value if len(left) == len(lines) else "\n".join(left))
            counts.append(len(lines))
            dropped.append(len(lines) - len(left))
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        columns[place] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())], [f.name for f in schema])

    return map_batches(joined, rebuild, schema)
