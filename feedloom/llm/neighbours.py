"""Approximate nearest neighbours by shifted Hilbert curves.

Vectors are projected at random to a few dimensions, shifted, and ordered along a Hilbert curve; this is done several
times. Spark range-partitions each order, blocks of neighbouring vectors are packed, and a query is compared with the
blocks around its own on every curve. The results of all curves are merged and reranked by exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_kind, kind_of, map_batches, settle

CURVES = 8
DIMENSIONS = 8  # of a projection
BITS = 7  # of a coordinate; DIMENSIONS * BITS < 64
BLOCK = 256  # vectors of a block
SEED = 7
SAMPLE = 64  # queries whose exact neighbours set the width of the window
COVERAGE = 0.95  # share of those neighbours that some curve's window must hold
SPARE = 2  # candidates that are reranked for each that is asked for
GROUP = 64  # neighbouring blocks that one task compares with the queries around them


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """The place of each point (rows of whole numbers below ``2 ** bits``) along a Hilbert curve, after Skilling's rule."""
    axes = points.astype(np.uint64).T.copy()
    zero, one = np.uint64(0), np.uint64(1)
    for q in (one << np.uint64(i) for i in range(bits - 1, 0, -1)):
        low = q - one
        for axis in axes:
            flip = (axis & q) != zero
            swap = np.where(flip, zero, (axes[0] ^ axis) & low)
            axes[0] ^= np.where(flip, low, swap)
            axis ^= swap
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    turn = np.zeros(axes.shape[1], np.uint64)
    for q in (one << np.uint64(i) for i in range(bits - 1, 0, -1)):
        turn ^= np.where((axes[-1] & q) != zero, q - one, zero)
    axes ^= turn
    key = np.zeros(axes.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << one) | ((axis >> np.uint64(bit)) & one)
    return key


def curve_keys(vectors: np.ndarray, curve: int) -> np.ndarray:
    """The keys of unit vectors on a curve: random projection, even spread of each coordinate, random shift."""
    size = vectors.shape[1]
    random = np.random.default_rng((SEED, curve))
    axes, _ = np.linalg.qr(random.standard_normal((size, min(size, DIMENSIONS))))
    spread = 1 / (1 + np.exp(np.clip(-1.702 * np.sqrt(size) * (vectors @ axes), -700, 700)))
    cells = ((spread + random.random(axes.shape[1])) / 2 * (1 << BITS)).astype(np.int64)
    return hilbert_keys(np.clip(cells, 0, (1 << BITS) - 1), BITS).view(np.int64)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=1e-300)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cosine(a: Column, b: Column) -> Column:
    """In double precision, summed in order; scaled by the largest components where a sum of squares would leave the range."""

    def of(x: Column, y: Column) -> Column:
        total = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
        parts = F.struct(total(x, y).alias("xy"), total(x, x).alias("xx"), total(y, y).alias("yy"))
        plain = lambda t: t["xx"].between(1e-280, 1e280) & t["yy"].between(1e-280, 1e280)
        return F.element_at(F.transform(F.array(parts), lambda t: F.when(plain(t), t["xy"] / (F.sqrt(t["xx"]) * F.sqrt(t["yy"])))), 1)

    def scaled(x: Column) -> Column:
        largest = F.array_max(F.transform(x, lambda v: F.abs(v.cast("double"))))
        return F.element_at(F.transform(F.array(largest), lambda m: F.transform(x, lambda v: v.cast("double") / m)), 1)

    return F.coalesce(of(a, b), of(scaled(a), scaled(b)))


def _usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.select(F.col(vec_id).alias("id"), F.col(embedding).alias("vector")).where(
        F.col("id").isNotNull() & F.forall("vector", fine) & F.exists("vector", lambda x: x != 0)
    )


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """``(vector, rep, ids)``: the distinct vectors with their ``k + 1`` smallest ids; only these leave a task."""
    first = Window.partitionBy("vector").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    return few.groupBy("vector").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids"))


def _ordered(classes: DataFrame, size: int) -> DataFrame:
    """``(curve, rank, rep, vector)``: every class on every curve, in order."""
    kind, name = arrow_kind(classes, "rep"), kind_of(classes, "rep")

    def run(batch: pa.RecordBatch):
        unit = _unit(_matrix(batch.column(1), size))
        keys = np.concatenate([curve_keys(unit, c) for c in range(CURVES)])
        curve = np.repeat(np.arange(CURVES, dtype=np.int32), len(unit))
        return pa.RecordBatch.from_arrays([pa.array(curve), pa.array(keys), pa.concat_arrays([batch.column(0).cast(kind)] * CURVES)], ["curve", "key", "rep"])

    keys = map_batches(classes.select("rep", "vector"), run, f"curve int, key long, rep {name}")
    placed = settle(
        keys.repartitionByRange("curve", "key", "rep")
        .sortWithinPartitions("curve", "key", "rep")
        .select("curve", "rep", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("pos")),
        "curve-orders",
    )
    counts = placed.groupBy("curve", "part").agg(F.min("pos").alias("start"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n"), "curve-offsets")
    return placed.join(offsets, ["curve", "part"]).select("curve", (F.col("pos") - F.col("start") + F.col("before")).alias("rank"), "rep")


def _packs(ranks: DataFrame, classes: DataFrame) -> DataFrame:
    """``(curve, block, reps, data)``: one row for each block of at most ``BLOCK`` vectors."""
    rows = ranks.join(classes.select("rep", "vector"), "rep")
    return (
        rows.groupBy("curve", F.floor(F.col("rank") / BLOCK).alias("block"))
        .agg(F.collect_list(F.struct("rep", "vector")).alias("rows"))
        .select("curve", "block", F.col("rows.rep").alias("reps"), F.flatten("rows.vector").alias("data"))
    )


def _best(unit_queries: np.ndarray, unit_others: np.ndarray, own: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and scores of each query's ``k`` best; of equal ones those that come first."""
    scores = unit_queries @ unit_others.T
    if own is not None:
        scores[own] = -np.inf
    k = min(k, scores.shape[1])
    if k < scores.shape[1]:
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        # the scores above the k-th, then as many equal to it as there is room for
        above, even = scores > least, scores == least
        chosen = above | (even & (np.cumsum(even, axis=1) <= k - above.sum(axis=1, keepdims=True)))
    else:
        chosen = np.ones(scores.shape, bool)
    rows, columns = np.nonzero(chosen)
    return rows, columns, scores[rows, columns]


class _Search:
    """The best candidates of queries that meet one block of vectors after another."""

    def __init__(self, spare: int):
        self.spare = spare
        self.blocks: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray] | None] = []

    def ask(self, block: int, reps: np.ndarray, unit: np.ndarray) -> None:
        self.blocks.append((block, reps, unit))
        self.found.append(None)

    def meet(self, block: int, reps: np.ndarray, unit: np.ndarray, width: int) -> None:
        order = np.argsort(reps, kind="stable")  # equal scores go to the smaller id
        reps, unit = reps[order], unit[order]
        for i, (own, asking, asked) in enumerate(self.blocks):
            if abs(own - block) <= width:
                rows, columns, scores = _best(asked, unit, None, self.spare)
                new = (rows, reps[columns], scores)
                if self.found[i] is not None:
                    new = tuple(np.concatenate(pair) for pair in zip(self.found[i], new, strict=True))
                    order = np.lexsort((new[1], -new[2], new[0]))
                    row = new[0][order]
                    nth = np.arange(len(row)) - np.searchsorted(row, row)
                    keep = order[nth < self.spare]
                    new = tuple(x[keep] for x in new)
                self.found[i] = new

    def result(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for (_, asking, _), found in zip(self.blocks, self.found, strict=True):
            if found is not None:
                yield asking[found[0]], found[1], found[2]


def window_width(asked: DataFrame, classes: DataFrame, ranks: DataFrame, size: int, k: int) -> int:
    """Blocks on each side of a query's own that hold ``COVERAGE`` of the neighbours of a sample of queries.

    The neighbours of ``SAMPLE`` queries are found among all vectors; only those few places come to the driver.
    """
    sample = asked.select("rep").distinct().orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).join(classes, "rep").select("rep", "vector").collect()
    if not sample:
        return 0
    ids = np.array([r["rep"] for r in sample])
    unit = _unit(np.array([r["vector"] for r in sample], np.float64))
    name = kind_of(classes, "rep")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if not batch.num_rows:
            return None
        reps = batch.column(0).to_numpy(zero_copy_only=False)
        q, c, s = _best(unit, _unit(_matrix(batch.column(1), size)), ids[:, None] == reps[None, :], k)
        keep = np.isfinite(s)
        return pa.RecordBatch.from_arrays([pa.array(ids[q][keep]), pa.array(reps[c][keep]), pa.array(s[keep])], ["rep", "other", "score"])

    near = map_batches(classes.select("rep", "vector"), run, f"rep {name}, other {name}, score double")
    order = Window.partitionBy("rep").orderBy(F.desc("score"), "other")
    pairs = settle(near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("rep", "other"), "sample-neighbours")
    at = ranks.select("curve", "rep", F.floor(F.col("rank") / BLOCK).alias("block"))
    places = pairs.join(at, "rep").join(at.toDF("curve", "other", "place"), ["curve", "other"])
    gaps = places.groupBy("rep", "other").agg(F.min(F.abs(F.col("block") - F.col("place"))).alias("gap")).select("gap").collect()
    gaps = sorted(r["gap"] for r in gaps)
    return int(gaps[min(len(gaps) - 1, ceil(COVERAGE * len(gaps)))]) if gaps else 0


def nearest(vectors: DataFrame, query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for the rows where ``query`` holds, the ``k`` nearest rows found.

    Nearness is the cosine of the original vectors in double precision; ties go to the smaller id. All rows but the
    query's own are candidates; with fewer than ``k``, all of them are given.

    Null or all-zero vectors, vectors with null or non-finite components and rows with a null id take no part. Vectors are
    compared with those of their own length; each length is searched on its own. Rows of one vector are one class on the curves and are listed by id, so
    a vector that a third of all rows share is one entry. Repeated ids are rows of their own. An empty table or no
    query gives an empty table. Ties are of scores as computed: of more than ``SPARE * (k + 1)`` unlike vectors whose cosines with a query
    differ by rounding alone, those with the largest rounded score are reranked.
    """
    rows = _usable(vectors, vec_id, embedding)
    wanted = _usable(vectors.where(query), vec_id, embedding)
    # only lengths that a query has are searched; a table has one, or a few with ragged rows
    sizes = sorted(r["size"] for r in wanted.select(F.size("vector").alias("size")).distinct().collect()) or [1]
    found = [_nearest(rows.where(F.size("vector") == size), wanted.where(F.size("vector") == size), size, k) for size in sizes]
    return reduce(DataFrame.unionByName, found)


def _nearest(rows: DataFrame, wanted: DataFrame, size: int, k: int) -> DataFrame:
    """``nearest`` for the vectors of one length."""
    classes = settle(_classes(rows, k), "vector-classes")
    asked = settle(wanted.join(classes.select("vector", "rep"), "vector").select(F.col("id").alias("query_id"), "rep"), "vector-queries")
    ranks = settle(_ordered(classes, size), "vector-ranks")
    width = window_width(asked, classes, ranks, size, k)
    kind, name = arrow_kind(classes, "rep"), kind_of(classes, "rep")
    # blocks go by groups of neighbours; a query's block goes to the groups that its window reaches
    group = lambda block: F.floor(block / GROUP)
    asking = _packs(ranks.join(asked.select("rep").distinct(), "rep", "left_semi"), classes).select(
        "curve", F.explode(F.sequence(group(F.col("block") - width), group(F.col("block") + width))).alias("group"), F.lit(0).alias("kind"), "block", "reps", "data"
    )
    others = _packs(ranks, classes).select("curve", group(F.col("block")).alias("group"), F.lit(1).alias("kind"), "block", "reps", "data")
    met = asking.unionByName(others).repartition("curve", "group").sortWithinPartitions("curve", "group", "kind", "block")
    spare = SPARE * (k + 1)

    def run(batches):
        def rows(search: _Search):
            for asking_, other, score in search.result():
                yield pa.RecordBatch.from_arrays([pa.array(asking_).cast(kind), pa.array(other).cast(kind), pa.array(score)], ["rep", "other", "near"])

        at, search = None, _Search(spare)
        # one block is some hundred kilobytes, so rows are taken out of their batch one by one
        for batch in batches:
            for i in range(batch.num_rows):
                curve, group_, kind_, block = (batch.column(c)[i].as_py() for c in range(4))
                if (curve, group_) != at:
                    yield from rows(search)
                    at, search = (curve, group_), _Search(spare)
                reps = batch.column(4)[i].values.to_numpy(zero_copy_only=False)
                unit = _unit(batch.column(5)[i].values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size))
                if kind_ == 0:
                    search.ask(block, reps, unit)
                else:
                    search.meet(block, reps, unit, width)
        yield from rows(search)

    found = met.mapInArrow(run, f"rep {name}, other {name}, near double").groupBy("rep", "other").agg(F.max("near").alias("near"))
    order = Window.partitionBy("rep").orderBy(F.desc("near"), "other")
    best = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= spare).select("rep", "other")
    exact = (
        best.join(classes.select("rep", F.col("vector").alias("v")), "rep")
        .join(classes.select(F.col("rep").alias("other"), F.col("vector").alias("w"), "ids"), "other")
        .select("rep", "ids", cosine(F.col("v"), F.col("w")).alias("score"))
    )
    listed = asked.join(exact, "rep").select("query_id", F.explode("ids").alias("vec_id"), "score").where("query_id <> vec_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return listed.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
