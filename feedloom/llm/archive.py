"""Fixity audit of web archives: Merkle trees over records and ordered offset ranges.

An archive is a table of records ``(volume, number, offset, record)``: WARC records in the order in which a volume holds
them. Every volume has a tree: its leaves are the records, its inner nodes ranges of records and offsets. Two replicas are
compared root by root; only where hashes differ are the branches below compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import settle

PER_VOLUME = 256  # records of a volume
FAN_OUT = 16  # children of a node; PER_VOLUME is a power of it


def warc_record(record_id: Column, url: Column, body: Column) -> Column:
    """The text of a WARC response record; nulls count as empty."""
    body, url = F.coalesce(body, F.lit("")), F.coalesce(url, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:"),
        F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def numbered(rows: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """The rows with their place in the given order, from 0: a range sort, and one count for each partition."""
    placed = settle(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"__part": F.spark_partition_id(), "__pos": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}),
        "numbered",
    )
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__pos").alias("__first"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(counts.select("__part", "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")), "numbered-parts")
    return placed.join(offsets, "__part").withColumn(name, F.col("__pos") - F.col("__first") + F.col("__before")).select(*rows.columns, name)


def laid_out(records: DataFrame) -> DataFrame:
    """``(volume, number, offset, record)`` of records with a number: offsets follow from the lengths in each volume."""
    before = Window.partitionBy("volume").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    rows = records.withColumn("volume", F.floor(F.col("number") / PER_VOLUME))
    offset = F.coalesce(F.sum(F.octet_length("record")).over(before), F.lit(0)).cast("long")
    return rows.withColumn("offset", offset).select("volume", "number", "offset", "record")


def leaves(archive: DataFrame) -> DataFrame:
    """``(volume, number, offset, length, digest, copies)``: records by hash; repeated rows are one leaf with a count."""
    rows = archive.select("volume", "number", "offset", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))
    return rows.groupBy("volume", "number", "offset", "length", "digest").agg(F.count(F.lit(1)).alias("copies"))


def nodes(rows: DataFrame) -> dict[int, DataFrame]:
    """``(volume, node, first, last, hash)`` by level: a node hashes its offset range and its children in order."""
    slot = F.pmod("number", F.lit(PER_VOLUME))
    text = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("number", "offset", "length", "digest", "copies")))
    level = rows.select("volume", slot.alias("node"), F.col("offset").alias("first"), (F.col("offset") + F.col("length")).alias("last"), F.sha2(text, 256).alias("hash"))
    found, size, depth = {}, PER_VOLUME, 0
    while size > 1:
        parent = F.floor(F.col("node") / FAN_OUT)
        level = (
            level.groupBy("volume", parent.alias("node"))
            .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sort_array(F.collect_list(F.struct("node", "first", "hash"))).alias("c"))
            .select("volume", "node", "first", "last", F.sha2(F.concat_ws(":", F.col("first").cast("string"), F.col("last").cast("string"), F.array_join("c.hash", ",")), 256).alias("hash"))
        )
        size, depth = size // FAN_OUT, depth + 1
        found[depth] = level
    return found


def _unlike(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes of either side whose hash the other side does not have."""
    both = a.select(*keys, F.col("hash").alias("x")).join(b.select(*keys, F.col("hash").alias("y")), keys, "full")
    return both.where(~F.col("x").eqNullSafe(F.col("y"))).select(*keys)


def damage(left: DataFrame, right: DataFrame, left_nodes: dict[int, DataFrame], right_nodes: dict[int, DataFrame]) -> DataFrame:
    """``(volume, number, offset, status)``: the records that differ, found from the roots downwards.

    ``changed``: other bytes or copies; ``moved``: the same bytes elsewhere; ``missing``, ``added``: only left or right. The offset is the
    left side's where it has one.
    """
    top = max(left_nodes)
    open_ = _unlike(left_nodes[top], right_nodes[top], ["volume", "node"])
    for depth in range(top - 1, 0, -1):
        below = lambda level: level.withColumn("parent", F.floor(F.col("node") / FAN_OUT)).join(open_.withColumnRenamed("node", "parent"), ["volume", "parent"], "left_semi")  # noqa: B023, E731
        open_ = settle(_unlike(below(left_nodes[depth]), below(right_nodes[depth]), ["volume", "node"]), "open-branches")
    slot = F.floor(F.pmod("number", F.lit(PER_VOLUME)) / FAN_OUT).alias("node")
    sides = [
        rows.select("*", slot)
        .join(open_, ["volume", "node"], "left_semi")
        .groupBy("volume", "number")
        .agg(
            F.min("offset").alias("offset"),
            F.sort_array(F.collect_list(F.struct("offset", "copies"))).alias("places"),
            F.sort_array(F.collect_list(F.struct("digest", "copies"))).alias("bytes"),
        )
        for rows in (left, right)
    ]
    a, b = sides[0].alias("a"), sides[1].alias("b")
    status = (
        F.when(F.col("b.bytes").isNull(), "missing")
        .when(F.col("a.bytes").isNull(), "added")
        .when(F.col("a.bytes") != F.col("b.bytes"), "changed")
        .when(F.col("a.places") != F.col("b.places"), "moved")
    )
    both = a.join(b, ["volume", "number"], "full").select("volume", "number", F.coalesce("a.offset", "b.offset").alias("offset"), status.alias("status"))
    return both.where("status is not null")


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per volume: ``volume, n_records, n_bytes, root, replica_root, intact, damaged``.

    ``left`` and ``right`` are replicas of an archive, ``(volume, number, offset, record)``; ``damaged`` lists the records that differ, as
    ``number:offset:status`` in order, and is empty for an intact volume. Counts are the left side's. A volume that one side lacks has a
    null root there. Null records count as empty ones, repeated rows as copies of one record. A volume has at most
    ``PER_VOLUME`` numbers, so no group grows with the archive. Two empty tables give an empty table.
    """
    sides = [settle(leaves(x.withColumn("record", F.coalesce("record", F.lit("").cast(x.schema["record"].dataType)))), "leaves") for x in (left, right)]
    trees = [{depth: settle(level, "tree-level") for depth, level in nodes(rows).items()} for rows in sides]
    top = max(trees[0])
    roots = [tree[top].select("volume", F.col("hash").alias(name)) for tree, name in zip(trees, ("root", "replica_root"), strict=True)]
    sums = sides[0].groupBy("volume").agg(F.sum("copies").alias("n_records"), F.sum(F.col("length") * F.col("copies")).alias("n_bytes"))
    found = damage(*sides, *trees).groupBy("volume").agg(F.sort_array(F.collect_list(F.struct("number", "offset", "status"))).alias("d"))
    listed = found.select("volume", F.array_join(F.transform("d", lambda x: F.concat_ws(":", x["number"].cast("string"), x["offset"].cast("string"), x["status"])), ",").alias("damaged"))
    return (
        roots[0]
        .join(roots[1], "volume", "full")
        .join(sums, "volume", "left")
        .join(listed, "volume", "left")
        .select(
            "volume",
            F.coalesce("n_records", F.lit(0)).alias("n_records"),
            F.coalesce("n_bytes", F.lit(0)).alias("n_bytes"),
            "root",
            "replica_root",
            F.col("root").eqNullSafe(F.col("replica_root")).alias("intact"),
            F.coalesce("damaged", F.lit("")).alias("damaged"),
        )
    )
