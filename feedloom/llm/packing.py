"""Best-fit packing of tokenized documents into sequences of fixed capacity.

Pieces of one length are alike, so the packing is planned on the number of pieces of each length: a table
of ``capacity`` rows at any size of the corpus. The plan says where the pieces of a length with ranks from x to y
go; ranks are given by counting in each partition, and every piece then finds its place by itself.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import arrow_kind, kind_of, map_batches, settle
from feedloom.llm.tokens import parts, splitter

CAPACITY = 1024
END_ID = 2
WORDS_KEPT = 400_000
AT_ONCE = 250  # words encoded as one text; a word of a longer text takes the library more time
BLANK = "Ġ"  # as byte-level tokenizers write it
SPACED = re.compile(" [A-Za-zÀ-ÖØ-öø-ÿ]+")


class _Words:
    """Ids of words by a tokenizer file; its byte-level splitting is the pattern's, so words are encoded one by one and kept.

    A blank and letters are one word, whatever blank follows them, and only their first token holds a blank: many such words
    are encoded as one text.
    """

    def __init__(self, path: str, pattern: str, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens  # their strings in a text are ordinary text
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        self.split = splitter(pattern)
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.first = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.first[[i for token, i in vocabulary.items() if token.startswith(BLANK)]] = True

    def _learn(self, words: set[str]) -> None:
        spaced = [word for word in words if SPACED.fullmatch(word)]
        others = list(words.difference(spaced))
        chunks = [spaced[i : i + AT_ONCE] for i in range(0, len(spaced), AT_ONCE)]
        for chunk, out in zip(chunks, self.tokenizer.encode_batch_fast(["".join(c) for c in chunks], add_special_tokens=False), strict=True):
            ids = np.array(out.ids, "<u4")
            starts = np.flatnonzero(self.first[ids])
            if len(starts) != len(chunk) or starts[0]:  # a tokenizer that writes or splits words in another way
                others += chunk
                continue
            raw, places = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
            self.known.update((word, raw[begin:end]) for word, begin, end in zip(chunk, places, places[1:], strict=False))
        for word, found in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            self.known[word] = array("I", found.ids).tobytes()

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as uint32 bytes."""
        for part in parts(texts):
            if len(self.known) > WORDS_KEPT:
                self.known.clear()
            # the pattern would cut an added token, so the library takes a text that holds one as a whole
            whole = {text for text in part if any(x in text for x in self.added)}
            split = [[] if text in whole else self.split(text) for text in part]
            self._learn(set(chain.from_iterable(split)).difference(self.known))
            for text, words in zip(part, split, strict=True):
                if text in whole:
                    yield array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
                else:
                    yield b"".join(map(self.known.__getitem__, words))


@lru_cache(maxsize=1)
def _words(path: str, pattern: str, added_tokens: bool) -> _Words:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one thread
    return _Words(path, pattern, added_tokens)


def token_pieces(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True, added_tokens: bool = False
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, ids)``: every document's ids and an end id, cut only where longer than a sequence.

    All pieces but the first are full. A null text counts as empty: its only id is the end id. Repeated rows and null
    ids give pieces like others; an empty table gives none. ``ids`` is left out without ``with_ids``.
    With ``added_tokens`` the strings of the file's added tokens in a text are those tokens, as the library has it; else
    they are ordinary text.
    """
    kind = arrow_kind(docs, doc_id)
    end = np.array([end_id], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [], [], [])
        words = _words(path, pattern, added_tokens)
        for doc, found in zip(batch.column(0).to_pylist(), words.encode(batch.column(1).to_pylist()), strict=True):
            raw = found + end
            size = len(raw) // 4
            first = (size - 1) % capacity + 1
            for piece, start in enumerate([0, *range(first, size, capacity)]):
                length = capacity if piece else first
                part = raw[4 * start : 4 * (start + length)]
                for column, x in zip(out, (doc, piece, start, length, zlib.crc32(part), part), strict=True):
                    column.append(x)
        kinds = (kind, pa.int32(), pa.int64(), pa.int64(), pa.int64())
        columns = [pa.array(x, k) for x, k in zip(out, kinds, strict=False)]
        names = [doc_id, "piece", "start", "length", "ids_crc32"]
        if with_ids:
            ends = np.cumsum([0, *out[3]]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(out[5]), np.int32))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    schema = f"`{doc_id}` {kind_of(docs, doc_id)}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return map_batches(docs.select(doc_id, text), run, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, rank, count, sequence, per_sequence, offset)`` rows that place all pieces of each length.

    Pieces above a third of the capacity go at most two to a sequence: from the longest on, each is matched with the
    longest that fits beside it. Smaller pieces, from the longest on, go to the smallest gap that holds them. Pieces
    and sequences that are alike are handled together, so the work depends on the capacity alone.
    """
    left = {n: c for n, c in counts.items() if c}
    rank = dict.fromkeys(left, 0)
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by gap: (first sequence, number)
    rows, sequence = [], 0

    def put(length: int, count: int, at: int, each: int, offset: int) -> None:
        rows.append((length, rank[length], count, at, each, offset))
        rank[length] += count
        left[length] -= count

    large = [n for n in sorted(left, reverse=True) if 3 * n > capacity]
    for n in large:
        while left[n]:
            mate = next((m for m in large if m <= min(n, capacity - n) and left[m] > (m == n)), None)
            if mate is None:
                number = left[n]
                put(n, number, sequence, 1, 0)
                gaps[capacity - n].append((sequence, number))
            elif mate == n:
                number = left[n] // 2
                put(n, 2 * number, sequence, 2, 0)
                gaps[capacity - 2 * n].append((sequence, number))
            else:
                number = min(left[n], left[mate])
                put(n, number, sequence, 1, 0)
                put(mate, number, sequence, 1, n)
                gaps[capacity - n - mate].append((sequence, number))
            sequence += number
    for n in sorted((m for m in left if 3 * m <= capacity), reverse=True):
        while left[n]:
            gap = next((g for g in range(n, capacity + 1) if gaps[g]), None)
            if gap is None:
                gap, number = capacity, -(-left[n] // (capacity // n))
                gaps[capacity].append((sequence, number))
                sequence += number
            at, number = gaps[gap].pop()
            each = gap // n
            full = min(number, left[n] // each)
            if full:
                put(n, full * each, at, each, capacity - gap)
                gaps[gap - each * n].append((at, full))
            elif left[n]:
                full, rest = 1, left[n]
                put(n, rest, at, rest, capacity - gap)
                gaps[gap - rest * n].append((at, 1))
            if number > full:
                gaps[gap].append((at + full, number - full))
    return rows


def pack(pieces: DataFrame, order: list[str], length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset`` (columns of these names are replaced).

    Lengths are from 1 to ``capacity``; other lengths raise an error. ``order`` names columns that number pieces of one length
    within a partition; equal rows are interchangeable. An empty table gives an empty table.
    """
    kept = pieces.drop("sequence_id", "offset")
    fixed = settle(kept.withColumn("__part", F.spark_partition_id()), "pieces")
    counts = settle(fixed.groupBy("__part", F.col(length).alias("__length")).agg(F.count(F.lit(1)).alias("__n")), "piece-counts")
    histogram = {r["__length"]: r["n"] for r in counts.groupBy("__length").agg(F.sum("__n").alias("n")).limit(capacity + 1).collect()}
    if any(n is None or not 1 <= n <= capacity for n in histogram):
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    rows = np.array(plan(histogram, capacity), np.int64).reshape(-1, 6)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    earlier = Window.partitionBy("__length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    inside = Window.partitionBy("__part", length).orderBy(*order)
    ranked = (
        fixed.withColumn("__rank", F.row_number().over(inside) - 1)
        .join(before.withColumnsRenamed({"__part": "__p"}), (F.col("__part") == F.col("__p")) & (F.col(length) == F.col("__length")))
        .select(*kept.columns, (F.col("__rank") + F.col("__before")).alias("__rank"))
    )
    at_length, names = kept.columns.index(length), [*kept.columns, "sequence_id", "offset"]
    keys = rows[:, 0] << 44 | rows[:, 1]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        size = batch.column(at_length).to_numpy(zero_copy_only=False).astype(np.int64)
        rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
        row = rows[np.searchsorted(keys, size << 44 | rank, side="right") - 1]
        nth = rank - row[:, 1]
        sequence, offset = row[:, 3] + nth // row[:, 4], row[:, 5] + nth % row[:, 4] * size
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names)

    schema = T.StructType([*kept.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return map_batches(ranked, run, schema)


def pack_documents(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True, added_tokens: bool = False) -> DataFrame:
    """All documents, tokenized, cut and packed: see ``token_pieces`` and ``pack``."""
    pieces = token_pieces(docs, path, pattern, doc_id, text, capacity, end_id, with_ids, added_tokens)
    return pack(pieces, [doc_id, "piece", "ids_crc32"], "length", capacity)
