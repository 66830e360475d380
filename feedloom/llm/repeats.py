"""Suffix-array dedup: remove every byte covered by a long string that occurs somewhere else too.

A string of ``length`` bytes is sorted as the suffix that starts there. Sorting all suffixes of a corpus would
move each of them; here equal strings are first brought together by what they share, and only suffixes that may
have an equal one are sorted:

* The anchor of a string is the smallest hash among its substrings of ``gram`` bytes. Consecutive strings with one
  anchor make a run; equal strings have equal anchors at equal distances. A run whose anchor no other run
  has holds no repeated string; runs that all have one text repeat as a whole.
* The runs left (those of unlike texts around one anchor, as at the ends of a passage) are cut by distance into
  slices of 32 strings and dealt out by the bytes that all strings of the slice share. In each group the suffixes are
  sorted by a mergesort that compares prefix hashes, and neighbours of ``length`` common bytes are verified.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import arrow_kind, kind_of, map_batches, settle
from feedloom.llm.jaccard import mix
from feedloom.llm.suffixes import PrefixHashes, repeated

LENGTH = 400
GRAM = 160
SLICE = 32
BLOCK = 1 << 19  # a text is read in blocks of so many strings; a run that a block's end cuts is two runs
GROUP = 2000  # slices of one group that are sorted together; larger groups are counted by digest
BATCH = 4 << 20  # bytes of slices sorted at a time


def runs(data: np.ndarray, length: int, gram: int):
    """``(hash, start, anchor, count)`` of each run of strings of a text that have one anchor."""
    wide = length - gram + 1
    for begin in range(0, len(data) - length + 1, BLOCK):
        part = data[begin : begin + BLOCK + length - 1]
        grams = mix(PrefixHashes(part).grams(gram))
        least, width = grams, 1
        while 2 * width <= wide:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        if width < wide:
            least = np.minimum(least[: len(least) - (wide - width)], least[wide - width :])
        heads = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]])).tolist()
        for start, stop in zip(heads, [*heads[1:], len(least)], strict=True):
            value = least[start]
            for anchor in (np.flatnonzero(grams[start : stop - 1 + wide] == value) + start).tolist():
                # the leftmost smallest substring is the anchor
                count = min(stop, anchor + 1) - start
                if count > 0:
                    yield int(value), begin + start, begin + anchor, count
                    start += count


def _print(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def _runs(docs: DataFrame, doc_id: str, text: str, length: int, gram: int) -> DataFrame:
    """``(hash, print, doc, row, start, lead, count)``: the runs of every text, with a fingerprint of their bytes."""
    kind = arrow_kind(docs, doc_id)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [], [], [], [])
        for doc, row, value in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            raw = (value or "").encode()
            if len(raw) < length:
                continue
            for gram_hash, start, anchor, count in runs(np.frombuffer(raw, np.uint8), length, gram):
                signed = gram_hash - (1 << 64) if gram_hash >> 63 else gram_hash
                values = (signed, _print(raw[start : start + count - 1 + length]), doc, row, start, anchor - start, count)
                for column, x in zip(out, values, strict=True):
                    column.append(x)
        kinds = (pa.int64(), pa.int64(), kind, pa.int64(), pa.int32(), pa.int16(), pa.int16())
        names = ["hash", "print", "doc", "row", "start", "lead", "count"]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names)

    rows = docs.select(doc_id, F.xxhash64(text).alias("row"), text)
    return map_batches(rows, run, f"hash long, print long, doc {kind_of(docs, doc_id)}, row long, start int, lead short, count short")


def _texts(mixed: DataFrame, docs: DataFrame, doc_id: str, text: str, length: int) -> DataFrame:
    """``(hash, print, lead, count, data)``: the bytes of one run of every unlike text."""
    place = F.struct("doc", "row", "start", "lead", "count")
    one = mixed.groupBy("hash", "print").agg(F.min(place).alias("at")).select("hash", "print", "at.*")
    wanted = one.groupBy(F.col("doc").alias("__doc"), F.col("row").alias("__row")).agg(
        F.collect_list(F.struct("hash", "print", "start", "lead", "count")).alias("__runs")
    )
    rows = docs.select(F.col(doc_id).alias("__id"), F.xxhash64(text).alias("__hash"), F.col(text).alias("__text"))
    # rows of one id and one text are one source
    found = wanted.join(rows, F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__hash"))).select("__runs", "__text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [], [])
        for items, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = value.encode()
            for r in items:
                values = (r["hash"], r["print"], r["lead"], r["count"], raw[r["start"] : r["start"] + r["count"] - 1 + length])
                for column, x in zip(out, values, strict=True):
                    column.append(x)
        kinds = (pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["hash", "print", "lead", "count", "data"])

    return map_batches(found, run, "hash long, print long, lead short, count short, data binary")


def _slices(texts: DataFrame, length: int, with_data: bool) -> DataFrame:
    """``(key, hash, print, first, far, data)``: slices of runs, keyed by the bytes that all strings of the slice share.

    ``first`` is the slice's first string in the run, ``far`` that string's distance to the anchor.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [], [], [])
        for r in batch.to_pylist():
            for part in range((r["lead"] - r["count"] + 1) // SLICE, r["lead"] // SLICE + 1):
                first = max(0, r["lead"] - (part * SLICE + SLICE - 1))
                last = min(r["count"] - 1, r["lead"] - part * SLICE)
                near = r["lead"] - part * SLICE  # the string nearest to the anchor, inside the run or not
                core = r["data"][near : near + length - SLICE + 1]
                key = _print(b"%d %d " % (r["hash"], part) + core)
                data = r["data"][first : last + length] if with_data else None
                for column, x in zip(out, (key, r["hash"], r["print"], first, r["lead"] - first, data), strict=True):
                    column.append(x)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["key", "hash", "print", "first", "far", "data"])

    return map_batches(texts, run, "key long, hash long, print long, first short, far short, data binary")


_FOUND = "hash long, print long, first short, last short"


def _spans(rows: list[dict], length: int) -> list[tuple]:
    """The repeated strings of a few groups of slices, as ``(hash, print, first, last)``."""
    data = np.frombuffer(b"".join(r["data"] for r in rows), np.uint8)
    sizes = np.array([len(r["data"]) for r in rows])
    begin = np.cumsum(sizes) - sizes
    counts = sizes - length + 1
    row = np.repeat(np.arange(len(rows)), counts)
    step = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    keys = {k: i for i, k in enumerate(dict.fromkeys(r["key"] for r in rows))}
    key = np.array([keys[r["key"]] for r in rows])[row]
    far = np.array([r["far"] for r in rows])[row] - step
    group = key * 4096 + far + 2048
    order = np.argsort(group, kind="stable")
    places, group = (begin[row] + step)[order], group[order]
    twice = group[1:] == group[:-1]
    partner = np.concatenate([[False], twice]) | np.concatenate([twice, [False]])
    hits = repeated(PrefixHashes(data), places[partner], group[partner], length)
    owner = np.searchsorted(begin, hits, side="right") - 1
    at = hits - begin[owner]
    heads = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)])) if len(hits) else np.zeros(0, np.int64)
    tails = np.append(heads[1:], len(hits)) - 1
    return [
        (rows[o]["hash"], rows[o]["print"], rows[o]["first"] + x, rows[o]["first"] + y)
        for o, x, y in zip(owner[heads].tolist(), at[heads].tolist(), at[tails].tolist(), strict=False)
    ]


def _batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int16(), pa.int16())
    return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)], ["hash", "print", "first", "last"])


def _sorted_groups(slices: DataFrame, length: int) -> DataFrame:
    """Suffix sort of every group of slices."""

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if size >= BATCH and r["key"] != rows[-1]["key"]:
                    yield _batch(_spans(rows, length))
                    rows, size = [], 0
                rows.append(r)
                size += len(r["data"])
        if rows:
            yield _batch(_spans(rows, length))

    return slices.repartition("key").sortWithinPartitions("key").mapInArrow(run, _FOUND)


def _counted_groups(slices: DataFrame, length: int) -> DataFrame:
    """The same for very large groups: strings are counted by a 128-bit digest, with partial results."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [])
        for r in batch.to_pylist():
            for i in range(len(r["data"]) - length + 1):
                digest = blake2b(b"%d " % (r["far"] - i) + r["data"][i : i + length], digest_size=16).digest()
                for column, x in zip(out, (digest, r["hash"], r["print"], r["first"] + i), strict=True):
                    column.append(x)
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int16())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["digest", "hash", "print", "first"])

    strings = settle(map_batches(slices, run, "digest binary, hash long, print long, first short"), "large-groups")
    often = strings.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    return strings.join(often, "digest").select("hash", "print", "first", F.col("first").alias("last"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The documents with ``spans`` (removed runs of bytes, as start and stop), ``n_bytes``, ``n_removed`` and ``kept`` bytes.

    A text is its UTF-8 bytes; each byte covered by a string of ``length`` bytes that also starts anywhere else, in
    the same or another row, is removed. Strings overlap freely, never cross rows, and are judged on the input.
    Columns of ``docs`` named like the four new ones are replaced.

    Null or short text: nothing is removed; a null text has no bytes. Repeated rows are rows like others, so each
    repeats the other. Null ids are kept. An empty table gives an empty table.

    A hot passage is one row per task in every count; joins on it have one row on the other side. Only the text
    of rows is shuffled whole, by row. Equality of whole runs rests on a hash of the anchor and a fingerprint of the
    run, 64 bits each; sorted suffixes are compared byte by byte.
    """
    kept = docs.drop("spans", "n_bytes", "n_removed", "kept")
    found = settle(_runs(docs, doc_id, text, length, gram), "runs")
    often = found.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("print").alias("x"), F.max("print").alias("y")).where("n > 1")
    # written, so that the join reads two plain tables and a hot anchor's partition can be split
    often = settle(often.select("hash", (F.col("x") != F.col("y")).alias("mixed")), "shared-anchors")
    shared = settle(found.join(often, "hash"), "shared-runs")
    mixed = shared.where("mixed")
    texts = settle(_texts(mixed, docs, doc_id, text, length).dropDuplicates(["hash", "print"]), "run-texts")
    groups = settle(_slices(texts, length, False).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "slice-groups")
    slices = _slices(texts, length, True).join(groups, "key")
    strings = _sorted_groups(slices.where(F.col("n") <= GROUP).drop("n"), length)
    if not (large := groups.where(F.col("n") > GROUP)).isEmpty():
        strings = strings.union(_counted_groups(_slices(texts, length, True).join(large, "key").drop("n"), length))
    parts = strings.groupBy("hash", "print").agg(F.collect_list(F.struct("first", "last")).alias("parts"))
    copies = mixed.groupBy("hash", "print").agg(F.count(F.lit(1)).alias("n"))
    verdicts = settle(copies.join(parts, ["hash", "print"], "left").where("n > 1 or parts is not null"), "run-verdicts")
    whole = F.array(F.struct(F.lit(0).alias("first"), (F.col("count") - 1).alias("last")))
    ranges = F.when((F.col("n") > 1) | ~F.col("mixed"), whole).otherwise(
        F.col("parts").cast("array<struct<first:int,last:int>>")
    )
    sure = shared.where("not mixed").withColumns({"n": F.lit(2).cast("long"), "parts": F.lit(None).cast(verdicts.schema["parts"].dataType)})
    judged = mixed.join(verdicts, ["hash", "print"]).unionByName(sure)
    spans = (
        judged.select("doc", "row", "start", F.explode(ranges).alias("r"))
        .select("doc", "row", F.struct((F.col("start") + F.col("r.first")).alias("start"), (F.col("start") + F.col("r.last") + length).alias("stop")).alias("span"))
        .groupBy(F.col("doc").alias("__doc"), F.col("row").alias("__row"))
        .agg(F.collect_set("span").alias("__spans"))
    )
    joined = kept.join(spans, F.col(doc_id).eqNullSafe(F.col("__doc")) & (F.xxhash64(text) == F.col("__row")), "left").select(*kept.columns, "__spans")
    return _cut(joined, kept, text)


def _cut(joined: DataFrame, kept: DataFrame, text: str) -> DataFrame:
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    new = [T.StructField("spans", span), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.BinaryType())]
    schema = T.StructType([*kept.schema.fields, *new])
    place = kept.columns.index(text)
    kinds = (pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.int64(), pa.int64(), pa.binary())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [])
        for value, items in zip(batch.column(place).to_pylist(), batch.column("__spans").to_pylist(), strict=True):
            raw = (value or "").encode()
            merged: list[list[int]] = []
            for start, stop in sorted((x["start"], x["stop"]) for x in items or ()):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], stop)
                else:
                    merged.append([start, stop])
            pieces, at = [], 0
            for start, stop in merged:
                pieces.append(raw[at:start])
                at = stop
            pieces.append(raw[at:])
            spans = [{"start": x, "stop": y} for x, y in merged]
            for column, x in zip(out, (spans, len(raw), sum(y - x for x, y in merged), b"".join(pieces)), strict=True):
                column.append(x)
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], [f.name for f in schema])

    return map_batches(joined, run, schema)
