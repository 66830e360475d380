"""Merkle manifest of a dataset: a tree of hashes per group of rows, and a tree over the groups' roots.

Rows of a group are leaves in a given order; runs of 16 nodes are hashed to one until one is left. The nodes of a tree
lie in van Emde Boas order: the tree is cut at half its height, the top part is stored first, then every part below it, each in the
same way. Parts of four levels are blocks: a block is built, and its siblings are found, by the arithmetic of addresses in one task, and
the blocks' roots are the leaves of the blocks above them. So a tree of n leaves takes one round per power of 65,536, no
task holds more than a block and the roots below it, and a group that holds most rows is many blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache
from itertools import chain, groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import settle

FAN_OUT = 16
LEVELS = 4  # levels of nodes in a block
LEAVES = FAN_OUT ** (LEVELS - 1)  # of a block
CHILDREN = FAN_OUT**LEVELS  # roots of lower blocks below a block

PATH = "array<struct<left: binary, right: binary>>"


def leaf_hash(*values: Column) -> Column:
    """SHA-256 of values as text, each with its length in bytes before it, ``-`` for null, so that no two rows read alike."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def node_hash(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def levels_of(size: int) -> int:
    """Levels of nodes of a tree with so many leaves."""
    levels = 1
    while size > 1:
        size, levels = -(-size // FAN_OUT), levels + 1
    return levels


def nodes_of(levels: int) -> int:
    """Nodes of a whole tree with so many levels."""
    return (FAN_OUT**levels - 1) // (FAN_OUT - 1)


@cache
def _cut(levels: int) -> tuple[int, int]:
    """Levels above and below the cut: half of them, the lower part rounded up to a power of two, so that parts line up."""
    low = 1 << ((levels - 1).bit_length() - 1)
    return levels - low, low


def address(levels: int, depth: int, index: int) -> int:
    """The place of a node, counted from the root down and from the left, in the layout of a tree of so many levels."""
    place = 0
    while levels > 1:
        top, low = _cut(levels)
        if depth < top:
            levels = top
            continue
        depth -= top
        part, index = divmod(index, FAN_OUT**depth)
        place += nodes_of(top) + part * nodes_of(low)
        levels = low
    return place


@lru_cache(maxsize=8)
def _places(levels: int) -> list[list[int]]:
    """Addresses in a block by level, leaves first."""
    return [[address(levels, depth, i) for i in range(FAN_OUT**depth)] for depth in range(levels - 1, -1, -1)]


def block_start(size: int, tier: int, block: int) -> tuple[int, int]:
    """Where a block begins in the layout of its whole tree, and its levels."""
    levels = levels_of(size)
    own = min(LEVELS, levels - LEVELS * tier)
    return address(levels, levels - LEVELS * tier - own, block), own


def build_block(leaves: list[bytes], levels: int) -> list[bytes | None]:
    """The nodes of a block by address; None where the tree ends earlier."""
    at, stored = _places(levels), [None] * nodes_of(levels)
    width = len(leaves)
    for place, leaf in zip(at[0], leaves, strict=False):
        stored[place] = leaf
    for level in range(1, levels):
        for parent in range(-(-width // FAN_OUT)):
            run = range(FAN_OUT * parent, min(FAN_OUT * (parent + 1), width))
            stored[at[level][parent]] = node_hash([stored[at[level - 1][i]] for i in run])
        width = -(-width // FAN_OUT)
    return stored


def siblings(stored: list[bytes | None], levels: int, leaf: int) -> list[tuple[bytes, bytes]]:
    """From a leaf up to the block's root: the hashes left and right of each node among its parent's children."""
    at, path = _places(levels), []
    for level in range(levels - 1):
        run = at[level][leaf // FAN_OUT * FAN_OUT : leaf // FAN_OUT * FAN_OUT + FAN_OUT]
        here = leaf % FAN_OUT
        path.append((b"".join(stored[i] for i in run[:here]), b"".join(stored[i] or b"" for i in run[here + 1 :])))
        leaf //= FAN_OUT
    return path


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that follows from a leaf and its siblings."""
    for left, right in path:
        leaf = hashlib.sha256(f"{left.hex()}{leaf.hex()}{right.hex()}".encode()).digest()
    return leaf


def path_hash(path: list[tuple[bytes, bytes]]) -> str:
    found = hashlib.sha256()
    for left, right in path:
        found.update(left.hex().encode())
        found.update(right.hex().encode())
    return found.hexdigest()


def _tier_of(size: Column, tier: int) -> Column:
    """Whether a tree's root lies in this tier."""
    below = size > FAN_OUT ** (LEVELS * tier - 1) if tier else F.lit(True)
    return below & (size <= FAN_OUT ** (LEVELS * tier + LEVELS - 1))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of one block after another; batches are sorted by tree and block."""
    rows = chain.from_iterable(batch.to_pylist() for batch in batches)
    return groupby(rows, key=lambda r: (r["tree"], r["block"]))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, 500)):
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], f.type) for i, f in enumerate(schema)], schema=schema)


def _by_block(df: DataFrame, rows, schema: str | T.StructType, *order: str) -> DataFrame:
    """Apply a generator of rows to the sorted rows of every block."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(chain.from_iterable(rows(key, group) for key, group in _groups(batches)), arrow)

    return df.repartition("tree", "block").sortWithinPartitions("tree", "block", *order).mapInArrow(run, schema)


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """The rows with ``size`` and ``number``: how many rows their tree has, and their place in it, from 0.

    One range sort and a count per partition and tree, so a tree with most rows is spread like others. Equal rows are
    interchangeable.
    """
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = settle(
        rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order).withColumns({"__part": F.spark_partition_id(), "__pos": place}), "manifest-order"
    )
    counts = placed.groupBy("__part", tree).agg(F.count(F.lit(1)).alias("n"), F.min("__pos").alias("__first"))
    own = Window.partitionBy(tree)
    earlier = own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = settle(
        counts.select("__part", tree, "__first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"), F.sum("n").over(own).alias("size")), "manifest-counts"
    )
    number = (F.col("__pos") - F.col("__first") + F.col("__before")).alias("number")
    return placed.join(before, ["__part", tree]).select(*rows.columns, "size", number)


def stored_tiers(leaves: DataFrame) -> list[DataFrame]:
    """``(tree, size, block, address, hash, is_root)`` of all nodes by tier, from leaves ``(tree, size, number, hash)``.

    ``address`` is the node's place in the layout of its tree; ``is_root`` marks the root of a block. Tiers above the leaves hash
    16 roots of lower blocks to each of their own leaves.
    """
    schema = "tree string, size long, block long, address long, hash binary, is_root boolean"
    largest = leaves.agg(F.max("size")).first()[0] or 1
    tiers, rows = [], leaves.select("tree", "size", F.floor(F.col("number") / LEAVES).alias("block"), "number", "hash")
    for tier in range(-(-levels_of(largest) // LEVELS)):

        def build(key: tuple, group: Iterator[dict], tier: int = tier) -> Iterator[tuple]:
            first = next(group)
            hashes = [first["hash"], *(r["hash"] for r in group)]
            if tier:
                hashes = [node_hash(hashes[i : i + FAN_OUT]) for i in range(0, len(hashes), FAN_OUT)]
            start, levels = block_start(first["size"], tier, key[1])
            for place, found in enumerate(build_block(hashes, levels)):
                if found is not None:
                    yield key[0], first["size"], key[1], start + place, found, place == 0

        tiers.append(settle(_by_block(rows, build, schema, "number"), "manifest-tier"))
        above = tiers[-1].where(F.col("is_root") & (F.col("size") > FAN_OUT ** (LEVELS * tier + LEVELS - 1)))
        rows = above.select("tree", "size", F.floor(F.col("block") / CHILDREN).alias("block"), F.col("block").alias("number"), "hash")
    return tiers


def tree_roots(tiers: list[DataFrame]) -> DataFrame:
    """``(tree, size, hash)``: the root of every tree."""
    tops = [nodes.where(F.col("is_root") & _tier_of(F.col("size"), tier)).select("tree", "size", "hash") for tier, nodes in enumerate(tiers)]
    found = tops[0]
    for top in tops[1:]:
        found = found.unionByName(top)
    return found


def prove(tiers: list[DataFrame], claims: DataFrame, tops: DataFrame, with_path: bool = False) -> DataFrame:
    """The claims with ``proof_sha256`` and ``folded``: the hash of all siblings from leaf to root, and the root that the claim gives.

    ``claims``: ``(tree, size, number, claim, …)``, the place of a leaf and the hash it is said to have. ``tops``: ``(tree, size, path, subroot,
    root)``, a row per tree: what lies above it, and two roots that are passed on to the rows. ``with_path`` adds the siblings, left and
    right of each node. Siblings are looked up by address in the stored blocks, from the top tier down.
    """
    carried = [f for f in claims.schema if f.name not in ("tree", "size", "number", "claim", "proof_sha256", "folded", "subroot", "root", "path")]
    path_schema = f"tree string, size long, block long, path {PATH}, subroot binary, root binary"
    null = {"place": "long", "hash": "binary", "path": PATH, "subroot": "binary", "root": "binary"}

    def shaped(df: DataFrame, kind: int, extra: list[Column] = ()) -> DataFrame:
        columns = [F.col(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in null.items()]
        return df.select("tree", "size", "block", F.lit(kind).alias("kind"), *columns, *extra)

    def opened(tier: int, key: tuple, group: Iterator[dict]) -> tuple:
        """The block's nodes by address, its levels and what lies above; the group's other rows are left."""
        rows = iter(group)
        row = next(rows, None)
        above: dict = {"path": [], "subroot": None, "root": None}
        stored, start, levels = [], 0, 0
        while row is not None and row["kind"] < 2:
            if row["kind"] == 0:
                above = row
            else:
                if not stored:
                    start, levels = block_start(row["size"], tier, key[1])
                    stored = [None] * nodes_of(levels)
                stored[row["place"] - start] = row["hash"]
            row = next(rows, None)
        path = [(p["left"], p["right"]) for p in above["path"] or []]
        return stored, levels, path, above, chain([row] if row else [], rows)

    paths = None
    for tier in range(len(tiers) - 1, -1, -1):
        nodes = tiers[tier].withColumn("place", F.col("address"))
        own = tops.where(_tier_of(F.col("size"), tier)).select("tree", "size", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
        paths = own if paths is None else own.unionByName(paths)
        if tier:

            def lower(key: tuple, group: Iterator[dict], tier: int = tier) -> Iterator[tuple]:
                stored, levels, path, above, children = opened(tier, key, group)
                for run in _runs(children):
                    hashes = [r["hash"] for r in run]
                    upper = siblings(stored, levels, run[0]["place"] // FAN_OUT % LEAVES) + path
                    for i, r in enumerate(run):
                        step = (b"".join(hashes[:i]), b"".join(hashes[i + 1 :]))
                        steps = [{"left": a, "right": b} for a, b in [step, *upper]]
                        yield r["tree"], r["size"], r["place"], steps, above["subroot"], above["root"]

            children = tiers[tier - 1].where(F.col("is_root") & (F.col("size") > FAN_OUT ** (LEVELS * tier - 1)))
            children = children.select("tree", "size", F.floor(F.col("block") / CHILDREN).alias("block"), F.col("block").alias("place"), "hash")
            rows = shaped(paths, 0).union(shaped(nodes, 1)).union(shaped(children, 2))
            paths = settle(_by_block(rows, lower, path_schema, "kind", "place"), "manifest-paths")

    names = [f.name for f in carried]
    kind = T.StructType(carried)
    at = claims.select("tree", "size", F.floor(F.col("number") / LEAVES).alias("block"), F.col("number").alias("place"), F.col("claim").alias("hash"), F.struct(*names).alias("carried"))
    rows = (
        shaped(paths, 0, [F.lit(None).cast(kind).alias("carried")])
        .union(shaped(nodes, 1, [F.lit(None).cast(kind).alias("carried")]))
        .union(shaped(at, 2, ["carried"]))
    )

    def proofs(key: tuple, group: Iterator[dict]) -> Iterator[tuple]:
        stored, levels, path, above, found = opened(0, key, group)
        for r in found:
            whole = siblings(stored, levels, r["place"] % LEAVES) + path
            folded = fold(r["hash"], whole)
            steps = ([{"left": a, "right": b} for a, b in whole],) if with_path else ()
            yield r["tree"], r["size"], r["place"], r["hash"], above["subroot"], above["root"], path_hash(whole), folded, *steps, *(r["carried"][n] for n in names)

    head = "tree string, size long, number long, claim binary, subroot binary, root binary, proof_sha256 string, folded binary" + f", path {PATH}" * with_path
    schema = T.StructType([*T._parse_datatype_string(head).fields, *carried])
    return _by_block(rows, proofs, schema, "kind", "place")


def _runs(rows: Iterator[dict]) -> Iterator[list[dict]]:
    for _, run in groupby(rows, key=lambda r: r["place"] // FAN_OUT):
        yield list(run)


@dataclass
class Manifest:
    """``leaves`` with their place, the stored ``tiers`` of the groups' trees, and ``tops``: what lies above each group."""

    leaves: DataFrame
    tiers: list[DataFrame]
    tops: DataFrame
    top_tiers: list[DataFrame]


def dataset_manifest(rows: DataFrame, group: str, order: list[str], leaf: str = "leaf") -> Manifest:
    """The manifest of rows that have the hash of their content in ``leaf`` (see ``leaf_hash``).

    A group's leaves are ordered by ``order``, nulls first, ties by their hash; rows that are equal throughout are leaves of their own. Groups
    are ordered as text by their bytes, null first; a null group is a group like others. Columns ``tree``, ``size`` and ``number`` of the
    rows are replaced. An empty table has no nodes and no root.
    """
    kept = rows.drop("tree", "size", "number")
    keyed = kept.withColumn("tree", F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")))
    leaves = settle(numbered(keyed, "tree", [*order, leaf]), "manifest-leaves")
    tiers = stored_tiers(leaves.withColumn("hash", F.col(leaf)))
    groups = tree_roots(tiers).select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("size").alias("leaves"), "hash")
    placed = settle(numbered(groups, "tree", ["group"]), "manifest-groups")
    top_tiers = stored_tiers(placed)
    ends = tree_roots(top_tiers).select("tree", "size", F.lit(None).cast(PATH).alias("path"), F.lit(None).cast("binary").alias("subroot"), F.col("hash").alias("root"))
    above = prove(top_tiers, placed.withColumnRenamed("hash", "claim"), ends, with_path=True)
    tops = settle(above.select(F.col("group").alias("tree"), F.col("leaves").alias("size"), "path", F.col("claim").alias("subroot"), "root"), "manifest-tops")
    return Manifest(leaves, tiers, tops, top_tiers)


def verify(manifest: Manifest, claim: str) -> DataFrame:
    """Every leaf's row with ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``; hashes as lowercase hex.

    ``claim`` names the column with the hash that a row's content has now; a null one counts as 32 zero bytes. The root is
    folded anew from it and the stored siblings; ``verified`` says whether it is the manifest's root.
    """
    zero = F.lit(bytes(32))
    claims = manifest.leaves.withColumn("claim", F.coalesce(F.col(claim), zero))
    found = prove(manifest.tiers, claims, manifest.tops)
    hexed = lambda c: F.lower(F.hex(c))
    return found.withColumns(
        {"subroot": hexed("subroot"), "folded_root": hexed("folded"), "verified": F.col("folded") == F.col("root"), "root": hexed("root")}
    ).drop("tree", "size", "claim", "folded")
