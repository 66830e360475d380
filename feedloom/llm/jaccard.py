"""N-gram Jaccard join: parity sketches, a pigeonhole join per size band, exact verification, linked classes.

A document's set holds its distinct k-word shingles. The sketch of a set has a fixed number of cells; every
shingle's hash is XOR-ed into the cell that the hash names. A shingle of two sets cancels out, so the number of
cells in which two sketches differ (their Hamming distance over cells) is at most the size of the sets' symmetric
difference. With more cells than the largest symmetric difference that a linked pair can have, at least one
cell of a linked pair is equal: an equi-join on (size band, cell, value) loses no link.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_kind, kind_of, map_batches, settle
from feedloom.llm.components import connect

WORDS_KEPT = 300_000  # entries of a worker's word-hash memory; it is emptied when full
BAND_RATIO = 1.4
EXTRA_CELLS = 1.3  # cells of a sketch for each cell that a set enters
BITS = 8  # parity bits for each shingle in which linked sets may differ
FILTER_BITS = 25  # of the bitmap that passes over documents without near copies: 4 MB
BLOCK = 2048  # most members of a key that one group holds; a larger key is compared block by block

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; a shorter text is one shingle, no words none."""
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))] if words else [], np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total = mix(total + hashes[i : i + n] * _MULTIPLIERS[i % 5])
    return np.unique(total)


def bands(size: int, percent: int) -> list[tuple[int, int]]:
    """``(band, largest size whose band it is)`` for every band in which a set of this size is entered.

    A pair is found in the band of its smaller set, so a set also enters the bands of the smaller sets that it
    could be linked with.
    """
    least = -(-size * percent // 100)
    found, low, band = [], 1, 0
    while low <= size:
        high = max(low, int(low * BAND_RATIO))
        if high >= least:
            found.append((band, high))
        low, band = high + 1, band + 1
    return found


def sketches(shingles: np.ndarray, percent: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """``(band, keys, bits)`` for each band: the join keys of the set's fullest cells, and its parity bits.

    Sets linked at ``percent`` differ in at most ``t = high * (100 - percent) / percent`` shingles, high being the
    most that the smaller set can have. Every set enters its ``t + 1`` fullest cells (ties: the lower number), of
    which at most ``t`` are unlike the other set's. So both sets enter an equal cell; and the fuller of those two
    cells, being equal in both, is among the fullest of both: a linked pair always meets. A band in which linked
    sets are equal needs no key: equal sets are classed beforehand.
    """
    found = []
    for band, high in bands(len(shingles), percent):
        t = high * (100 - percent) // percent
        if not t:
            continue
        m = int(np.ceil(EXTRA_CELLS * (t + 1)))
        cell = ((shingles >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        count = np.bincount(cell, minlength=m)
        filled = np.flatnonzero(count)
        starts = (np.cumsum(count) - count)[filled]
        value = np.zeros(m, np.uint64)
        value[filled] = np.bitwise_xor.reduceat(shingles[order], starts)
        places = ((shingles & np.uint64(0xFFFFFFFF)) % np.uint64(64 * -(-BITS * (t + 1) // 64))).astype(np.int64)
        bits = np.packbits(np.bincount(places, minlength=64 * -(-BITS * (t + 1) // 64)).astype(np.uint8) & 1)
        tag = np.arange(m, dtype=np.uint64) * np.uint64(1 << 20) + count.astype(np.uint64)
        key = (mix(mix(value) + mix(tag)) & ~np.uint64(63)) | np.uint64(band)
        found.append((band, key[np.argsort(-count, kind="stable")[: t + 1]], bits))
    return found


def _sizes(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``(doc, n, print)``: the set's size and its 128-bit fingerprint."""
    kind = arrow_kind(docs, doc_id)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, size) for t in batch.column(1).to_pylist()]
        prints = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).cast(kind), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary())], ["doc", "n", "print"]
        )

    return map_batches(docs.select(doc_id, text), run, f"doc {kind_of(docs, doc_id)}, n long, print binary")


def _entries(docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """``(key, first, others)``: per batch of documents one row for each key, however many documents have it."""
    kind = arrow_kind(docs, doc_id)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        ids = np.array(batch.column(0).cast(kind).to_pylist())
        seen, keys, places = {}, [], []
        for i, value in enumerate(batch.column(1).to_pylist()):
            if value is None or ids[i] is None:
                continue
            shingles = shingle_set(value, size)
            if len(shingles) and seen.setdefault(shingles.tobytes(), i) == i:
                found = [key for _, key, _ in sketches(shingles, percent)]
                keys += found
                places += [np.full(len(key), i) for key in found]
        if not keys:
            return None
        key, place = np.concatenate(keys), np.concatenate(places)
        order = np.lexsort((ids[place], key))
        key, doc = key[order], ids[place[order]]
        if not len(key):
            return None
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size_of = np.diff(np.append(start, len(key)))
        rest = np.ones(len(key), bool)
        rest[start] = False
        offsets = np.concatenate([[0], np.cumsum(size_of - 1)]).astype(np.int32)
        others = pa.ListArray.from_arrays(pa.array(offsets), pa.array(doc[rest], kind))
        return pa.RecordBatch.from_arrays([pa.array(key[start].view(np.int64)), pa.array(doc[start], kind), others], ["key", "first", "others"])

    name = kind_of(docs, doc_id)
    return map_batches(docs.select(doc_id, text), run, f"key long, first {name}, others array<{name}>")


def _verified(pairs: DataFrame, texts: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets have the similarity."""
    sides = [texts.select(F.col(doc_id).alias(x), F.col(text).alias(f"text_{x}")) for x in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "text_a", "text_b")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        last, known = None, np.zeros(0, np.uint64)
        linked = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if last != y:
                last, known = y, shingle_set(y, size)
            other = shingle_set(x, size)
            common = len(np.intersect1d(known, other, assume_unique=True))
            linked.append(100 * common >= percent * (len(known) + len(other) - common))
        keep = pa.array(linked, pa.bool_())
        return pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    name = kind_of(texts, doc_id)
    return map_batches(both, run, f"a {name}, b {name}")


def _members(docs: DataFrame, named: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """``(key, place, total, doc)`` of the keys that two documents or more have, numbered within the key.

    Copies enter together with the document that stands for them, which takes their place where a key is shared: so the
    texts need not be filtered, and the few shared keys are all that is joined.
    """
    by_key = Window.partitionBy("key")
    shared = (
        _entries(docs, doc_id, text, size, percent)
        .withColumn("n", F.sum(F.size("others") + 1).over(by_key))
        .where("n > 1")
        .select("key", F.explode(F.concat(F.array("first"), "others")).alias("doc"))
    )
    names = named.where("rep is not null").select("doc", "rep").distinct()
    reps = settle(shared.join(names, "doc").select("key", F.col("rep").alias("doc")).distinct(), "sketch-keys")
    order = by_key.orderBy("doc")
    return (
        reps.withColumns({"total": F.count(F.lit(1)).over(by_key), "place": F.row_number().over(order) - 1})
        .where("total > 1")
        .select("key", "place", "total", "doc")
    )


def _only(docs: DataFrame, wanted: DataFrame, doc_id: str) -> DataFrame:
    """The documents whose id is wanted, and a few others: a bitmap of hashed ids passes over the rest where they are read.

    The bitmap has ``2 ** FILTER_BITS`` bits at any size, so it may be broadcast; the more ids, the more others pass.
    """
    place = F.pmod(F.xxhash64(doc_id), F.lit(1 << FILTER_BITS)) + 1  # from 1, as the bitmap functions count
    found = (
        wanted.select(place.alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        .collect()
    )
    bitmap = np.zeros((1 << FILTER_BITS) // 8 + 8192, np.uint8)
    for r in found:
        begin = (r["bucket"] - 1) * 4096
        bitmap[begin : begin + 4096] |= np.frombuffer(r["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    # bucket and position as the bitmap functions count them
    marked = docs.select("*", ((F.bitmap_bucket_number(place) - 1) * 32768 + F.bitmap_bit_position(place)).alias("__at"))
    schema = docs.schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
        keep = (shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        kept = batch.filter(pa.array(keep.astype(bool)))
        return pa.RecordBatch.from_arrays(kept.columns[:-1], [f.name for f in schema])

    return map_batches(marked, run, schema)


def _bits(docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """``(doc, band, n, bits)``: the parity bits of every set in its bands."""
    kind = arrow_kind(docs, doc_id)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [])
        for i, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shingles = shingle_set(value, size)
            for band, _, bits in sketches(shingles, percent):
                for column, x in zip(out, (i, band, len(shingles), bits.tobytes()), strict=True):
                    column.append(x)
        kinds = (kind, pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["doc", "band", "n", "bits"])

    return map_batches(docs.select(doc_id, text), run, f"doc {kind_of(docs, doc_id)}, band int, n long, bits binary")


def _near(bits: np.ndarray, n: np.ndarray, i: int, others: np.ndarray, percent: int) -> np.ndarray:
    """Which of the others may be linked with i: the parity bits differ in no more places than linked sets can."""
    distance = np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1, dtype=np.int64)
    return others[distance * (100 + percent) <= (100 - percent) * (n[others] + n[i])]


def _pairs_of_group(bits: np.ndarray, n: np.ndarray, label: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int, all_pairs: bool):
    """Pairs of places of a group whose bits allow a link. Without ``all_pairs`` a spanning forest of them."""
    same = left is right
    if all_pairs:
        for k, i in enumerate(left):
            others = right[k + 1 :] if same else right
            others = others[label[others] != label[i]]
            yield from ((i, j) for j in _near(bits, n, i, others, percent))
        return
    open_left, open_right = list(left), set(right.tolist())
    queue: list[tuple[int, bool]] = []
    waiting = set(left.tolist())
    while queue or waiting:
        if not queue:
            i = open_left.pop(0)
            if i not in waiting:
                continue
            queue.append((i, True))
            waiting.discard(i)
            if same:
                open_right.discard(i)
        i, on_left = queue.pop()
        rest = open_right if on_left else waiting
        others = np.fromiter(rest, np.int64, len(rest))
        for j in _near(bits, n, i, others, percent):
            rest.discard(int(j))
            if same:
                waiting.discard(int(j))
            queue.append((int(j), same or not on_left))
            yield (i, j)


def _candidates(members: DataFrame, percent: int, all_pairs: bool) -> DataFrame:
    """``(a, b)`` within each key: compared block by block, by parity bits."""
    kind = arrow_kind(members, "doc")
    name = kind_of(members, "doc")
    blocks = F.ceil(F.col("total") / BLOCK)
    own = F.floor(F.col("place") / BLOCK)
    dealt = (
        members.withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
        .withColumns({"low": F.least(own, "other"), "high": F.greatest(own, "other"), "right": own > F.col("other")})
        .select("key", "low", "high", "right", "doc", "label", "n", "bits")
        .repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high", "right")
    )

    def group(rows: list[dict]) -> list[tuple]:
        bits = np.frombuffer(b"".join(r["bits"] for r in rows), np.uint64).reshape(len(rows), -1)
        n, label = np.array([r["n"] for r in rows]), np.array([r["label"] for r in rows])
        right = np.array([r["right"] for r in rows])
        sides = [np.arange(len(rows))] * 2 if rows[0]["low"] == rows[0]["high"] else [np.flatnonzero(~right), np.flatnonzero(right)]
        if not len(sides[0]) or not len(sides[1]):
            return []
        return [(min(rows[i]["doc"], rows[j]["doc"]), max(rows[i]["doc"], rows[j]["doc"])) for i, j in _pairs_of_group(bits, n, label, *sides, percent, all_pairs) if label[i] != label[j]]

    def run(batches):
        last, rows, found = None, [], set()
        for batch in batches:
            for r in batch.to_pylist():
                if (at := (r["key"], r["low"], r["high"])) != last:
                    if len(rows) > 1:
                        found.update(group(rows))
                    last, rows = at, []
                rows.append(r)
            if len(found) > 10_000:
                yield _table(found, kind)
                found = set()
        if len(rows) > 1:
            found.update(group(rows))
        yield _table(found, kind)

    return dealt.mapInArrow(run, f"a {name}, b {name}").distinct()


def _table(pairs: set, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], kind) for i in (0, 1)], ["a", "b"])


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``: one row per document with its class of linked documents.

    A-Z is lower-cased, words are split at blanks; the set holds the distinct ``size``-word shingles (with fewer
    words the whole sequence). Two documents link when ``100 * intersection >= percent * union``; the class is
    named by the smallest id reachable by links, the own one included. All links count: none is sampled or capped.

    Null or blank text has an empty set and links with nothing. Rows with a null id are given back, linked with
    nothing. Rows of one id are one document: each has the ``n_shingles`` of its own text, all texts' links count, and rows with a set share a class. An empty table gives an empty table.

    Copies are classed by a 128-bit fingerprint with partial results, so a group of copies is one row per task,
    and one document stands for them. Its near copies are found by the sketch join; a hot key is compared
    in blocks of at most 2,048 documents, first along a spanning forest. After the forest's links are verified, all
    remaining pairs of documents in unlike classes that the bits allow are verified too.
    """
    docs = docs.select(doc_id, text)
    sizes = settle(_sizes(docs, doc_id, text, size), "shingle-sizes")
    prints = sizes.where("print is not null and doc is not null").groupBy("doc").agg(F.min("print").alias("x"), F.max("print").alias("y"))
    if not prints.where("x <> y").isEmpty():
        return _by_text(docs, sizes, doc_id, text, size, percent)
    classes = settle(sizes.where("print is not null and doc is not null").groupBy("print").agg(F.min("doc").alias("rep")), "shingle-classes")
    named = sizes.join(classes, "print", "left").select("doc", "n", F.when(F.col("doc").isNotNull(), F.coalesce("rep", "doc")).alias("rep"))
    members = settle(_members(docs, named, doc_id, text, size, percent), "sketch-members")
    wanted = members.select(F.col("doc").alias(doc_id)).distinct()
    texts = settle(_only(docs, wanted, doc_id).join(wanted, doc_id, "left_semi").dropDuplicates([doc_id]), "sketch-texts")
    bits = settle(_bits(texts, doc_id, text, size, percent), "sketch-bits")

    def candidates(rows: DataFrame, all_pairs: bool) -> DataFrame:
        banded = rows.withColumn("band", F.col("key").bitwiseAND(63).cast("int"))
        return _candidates(banded.join(bits, ["doc", "band"]), percent, all_pairs)

    tried = settle(candidates(members.withColumn("label", F.col("doc")), False), "sketch-pairs")
    links = settle(_verified(tried, texts, doc_id, text, size, percent), "sketch-links")
    labels = connect(links)
    labelled = members.join(labels, F.col("doc") == F.col("node"), "left").select(*members.columns, F.coalesce("label", "doc").alias("label"))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
    more = candidates(labelled.join(mixed, "key", "left_semi"), True).join(tried, ["a", "b"], "left_anti")
    late = settle(_verified(settle(more, "sketch-more"), texts, doc_id, text, size, percent), "sketch-late")
    if not late.isEmpty():
        labels = connect(links.unionByName(late))
    found = named.join(labels, F.col("rep") == F.col("node"), "left")
    return found.select(F.col("doc").alias(doc_id), F.col("n").alias("n_shingles"), F.coalesce("label", "rep").alias("component_id"))


def _by_text(docs: DataFrame, sizes: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """``jaccard_components`` where ids have several unlike sets: sets are joined first, by their fingerprints, then ids through their sets."""
    named = settle(_prints(docs, doc_id, text, size), "shingle-prints")
    nodes = jaccard_components(named.where("node is not null").select("node", text), "node", text, size, percent)
    labels = settle(nodes.select("node", F.col("component_id").alias("label")).distinct(), "print-labels")
    held = settle(named.where("doc is not null and node is not null").select("doc", "node").distinct().join(labels, "node").select("doc", "label").distinct(), "print-documents")
    links = held.join(held.groupBy("doc").agg(F.min("label").alias("b")), "doc").where("label <> b").select(F.col("label").alias("a"), "b").distinct()
    joined = held.join(connect(links).withColumnRenamed("label", "whole"), F.col("label") == F.col("node"), "left").select("doc", F.coalesce("whole", "label").alias("whole"))
    first = joined.groupBy("whole").agg(F.min("doc").alias("component_id"))
    ids = settle(joined.join(first, "whole").groupBy("doc").agg(F.min("component_id").alias("component_id")), "print-components")
    found = sizes.select("doc", "n").join(ids, "doc", "left")
    return found.select(F.col("doc").alias(doc_id), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id"))


def _prints(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``(doc, node, text)``: the documents with their set's fingerprint as text, null for an empty set."""
    kind = arrow_kind(docs, doc_id)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s := shingle_set(t, size)) else None for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(kind), pa.array(found, pa.string()), batch.column(1)], ["doc", "node", text])

    return map_batches(docs.select(doc_id, text), run, f"doc {kind_of(docs, doc_id)}, node string, `{text}` string")
