"""Quality classifier: neighbour voting among labelled documents in a latent-semantic space.

Features are hashed byte n-grams of the text and of its shape (letters, capitals and digits as one sign each). A bounded sample
of labelled documents gives their weights and the leading directions (a truncated singular value decomposition). The
sample's vectors are broadcast; every document is compared with all of them, block by block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_kind, kind_of, map_batches, settle

PER_LABEL = 1500  # labelled rows of each label that the model is fitted on, at most
BUCKETS = 1 << 11  # of each of the two kinds of n-grams; a power of two
DIRECTIONS = 32
NEIGHBOURS = 15
SHARPNESS = 4  # power of a similarity that makes its vote
DOUBT = 0.01  # weight of the overall share beside the votes
DOCS_AT_ONCE = 256
BYTES_AT_ONCE = 1 << 20
SEED = 7

_SHAPE = np.arange(256, dtype=np.uint32)
_SHAPE[[*range(97, 123), *range(128, 256)]] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 57


def _grams(codes: np.ndarray, size: int) -> np.ndarray:
    value = np.zeros(len(codes) - size + 1, np.uint32)
    for i in range(size):
        value = value * np.uint32(65599) + codes[i : len(codes) - size + 1 + i]
    value = (value ^ (value >> np.uint32(15))) * np.uint32(2654435761)
    return np.bincount(value >> np.uint32(33 - BUCKETS.bit_length()), minlength=BUCKETS)


def features(text: str | None) -> np.ndarray:
    """Counts of hashed byte trigrams, and of hashed 4-grams of shapes, over the whole text."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    counts = np.zeros(2 * BUCKETS, np.int64)
    for begin in range(0, max(len(data) - 2, 0), BYTES_AT_ONCE):
        part = data[begin : begin + BYTES_AT_ONCE + 2]
        counts[:BUCKETS] += _grams(part.astype(np.uint32), 3)
        part = data[begin : begin + BYTES_AT_ONCE + 3]
        if len(part) > 3:
            counts[BUCKETS:] += _grams(_SHAPE[part], 4)
    return counts


@dataclass
class Space:
    """What scoring needs; its size is bounded by the parameters above."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def place(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_unit(np.log1p(counts) * self.weights) @ self.directions)

    def score(self, counts: np.ndarray) -> np.ndarray:
        share = self.labels.mean() if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(counts), share)
        similar = np.maximum(self.place(counts) @ self.vectors.T, 0)
        k = min(NEIGHBOURS, len(self.labels))
        nearest = np.argpartition(-similar, k - 1, axis=1)[:, :k]
        votes = np.take_along_axis(similar, nearest, 1) ** SHARPNESS
        return np.clip(((votes * self.labels[nearest]).sum(axis=1) + DOUBT * share) / (votes.sum(axis=1) + DOUBT), 0, 1)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Space:
    """The space of a sample: of each label (0 and 1) the ``PER_LABEL`` rows whose ids hash lowest.

    ``labels`` holds only the rows that may be learned from. Null ids and labels are passed over, of several labels of one
    id the smallest counts.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.min(label).alias("__label"))
    order = Window.partitionBy("__label").orderBy(F.xxhash64("__id"), "__id")
    sample = settle(known.withColumn("n", F.row_number().over(order)).where(F.col("n") <= PER_LABEL).drop("n"), "label-sample")
    chosen = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(sample), "__id")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [features(t) for t in batch.column(0).to_pylist()]
        kinds = (pa.list_(pa.int32()), pa.list_(pa.int32()))
        buckets = [np.flatnonzero(x).tolist() for x in found]
        counts = [x[x > 0].tolist() for x in found]
        return pa.RecordBatch.from_arrays([batch.column(1).cast(kind), pa.array(batch.column(2).to_pylist(), pa.int32()), *(pa.array(x, k) for x, k in zip((buckets, counts), kinds, strict=True))], ["id", "label", "buckets", "counts"])

    kind = arrow_kind(docs, doc_id)
    sparse = map_batches(chosen.select("__text", "__id", "__label"), run, f"id {kind_of(docs, doc_id)}, label int, buckets array<int>, counts array<int>")
    rows = sorted(sparse.groupBy("id", "label").agg(F.min(F.struct("buckets", "counts")).alias("x")).select("id", "label", "x.*").collect(), key=lambda r: r["id"])
    counts = np.zeros((len(rows), 2 * BUCKETS), np.float32)
    for i, r in enumerate(rows):
        counts[i, r["buckets"]] = r["counts"]
    used = (counts > 0).sum(axis=0)
    weights = (np.log((1 + len(rows)) / (1 + used)) + 0.1).astype(np.float32)
    matrix = _unit(np.log1p(counts) * weights)
    space = Space(weights, _leading(matrix, DIRECTIONS), np.zeros((0, 0)), np.array([r["label"] for r in rows], np.float64))
    space.vectors = space.place(counts)
    return space


def _leading(matrix: np.ndarray, size: int) -> np.ndarray:
    """The leading right singular directions, by subspace iteration."""
    size = min(size, *matrix.shape) if len(matrix) else 1
    basis = np.random.default_rng(SEED).standard_normal((matrix.shape[1], size + 8)).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis)) if len(matrix) else (basis, None)
    _, _, turn = np.linalg.svd(matrix @ basis, full_matrices=False) if len(matrix) else (None, None, np.eye(basis.shape[1]))
    return (basis @ turn.T)[:, :size]


def quality_scores(docs: DataFrame, space: Space, text: str = "text", name: str = "score") -> DataFrame:
    """The documents with the score, from 0 to 1, that neighbours' labels give their text (a column of that name is replaced).

    A text without features (null, or under three bytes) has the sample's share of label 1; without any labels every
    score is 0.5. Rows are scored one by one, so repeated rows score alike and an empty table gives an empty table.
    Nothing is shuffled; the space is broadcast, its size is fixed.
    """
    from pyspark.sql import types as T

    kept = docs.drop(name)
    place = kept.columns.index(text)
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [np.zeros(0)]
        for begin in range(0, batch.num_rows, DOCS_AT_ONCE):
            texts = batch.column(place).slice(begin, DOCS_AT_ONCE).to_pylist()
            scores.append(shared.value.score(np.array([features(t) for t in texts], np.float32)))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores).astype(np.float64))], [f.name for f in schema])

    return map_batches(kept, run, schema)


def in_fold(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    return F.crc32(doc_id.cast("string")) % folds == fold
