"""Byte-level BPE: encoding by recursive DuckDB queries in each partition, decoding by ordered aggregation.

A text is split by the tokenizer's pattern; each match is a word. A task sends the words it has not met before to
DuckDB as rows (word, list of tokens). A recursive query joins neighbouring tokens to the merge table and contracts each
word's leftmost pair of least rank, until no word has a pair left. A word without a pair leaves the recursion.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import batched, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WORDS_KEPT = 400_000  # words that a worker remembers: half of them the last ones met, half those before
CHARS_AT_ONCE = 2_000_000  # of texts whose words are looked up together
WORDS_AT_ONCE = 40_000  # words of one recursive query
LONG_WORD = 64  # bytes; the rounds of a longer word would cost the square of its length, so it is merged with a heap
TOKENS_AT_ONCE = 200_000  # tokens of one decoding query, for which 60 MB are enough; a longer list takes several

ENCODE = """
WITH RECURSIVE state AS (
  SELECT word, ids, true AS open FROM start
  UNION ALL
  SELECT s.word, CASE WHEN b.spot IS NULL THEN s.ids ELSE list_concat(list_append(s.ids[:b.spot - 1], b.merged), s.ids[b.spot + 2:]) END, b.spot IS NOT NULL
  FROM state s
  LEFT JOIN (SELECT p.word, min(m.merged) AS merged, arg_min(p.pos, m.merged::BIGINT * 65536 + p.pos) AS spot
             FROM (SELECT word, unnest(ids[:-2]) AS l, unnest(ids[2:]) AS r, generate_subscripts(ids[2:], 1) AS pos FROM state WHERE open) p
             JOIN merges m ON m.l = p.l AND m.r = p.r
             GROUP BY p.word) b ON b.word = s.word
  WHERE s.open)
SELECT word, ids FROM state WHERE NOT open ORDER BY word
"""

DECODE = """
SELECT t.doc, string_agg(v.text, '' ORDER BY t.pos) AS text, bool_or(v.text IS NULL) AS unknown
FROM tokens t LEFT JOIN vocabulary v ON v.token = t.token GROUP BY t.doc ORDER BY t.doc
"""


def parts(texts: list[str | None], chars: int = CHARS_AT_ONCE) -> Iterable[list[str]]:
    """The texts, a few at a time: as many as have so many characters together, one at least."""
    part, size = [], 0
    for text in texts:
        part.append(text or "")
        size += len(part[-1])
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


# the usual pattern of byte-level tokenizers, and the same for texts of characters below U+0250, where the standard library is twice as fast
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LATIN = {"letter": "A-Za-zªµºÀ-ÖØ-öø-ɏ", "number": "0-9²³¹¼½¾", "space": " \t-\r\x85\xa0"}
LATIN_WORD = re.compile(" ?[{letter}]+|'(?:s|t|re|ve|m|ll|d)| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+".format(**LATIN))
BEYOND_LATIN = re.compile("[^\x00-ɏ]")


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The matches of a pattern in a text, in turn."""
    found = regex.compile(pattern).findall
    if pattern != BYTE_LEVEL:
        return found
    return lambda text: found(text) if BEYOND_LATIN.search(text) else LATIN_WORD.findall(text)


class BytePairs:
    """A vocabulary of byte strings by rank, its merge table, and a DuckDB connection in this process."""

    def __init__(self, path: str, pattern: str):
        import duckdb

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.split = splitter(pattern)
        self.matches = regex.compile(pattern).finditer
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        pairs = [
            (self.ranks[t[:i]], self.ranks[t[i:]], rank) for t, rank in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        self._table("merges", {name: [p[i] for p in pairs] for i, name in enumerate(("l", "r", "merged"))})
        # a byte is the character 256 above it, since a string may not hold any byte
        texts = ["".join(chr(256 + b) for b in token) for token in self.ranks]
        self._table("vocabulary", {"token": list(self.ranks.values()), "text": texts})

    def _table(self, name: str, columns: dict[str, list]) -> None:
        kinds = {k: pa.string() if k == "text" else pa.int32() for k in columns}
        rows = pa.table({k: pa.array(v, kinds[k]) for k, v in columns.items()})
        self.db.register("rows", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM rows")
        self.db.unregister("rows")

    def _ask(self, name: str, rows: pa.Table, query: str) -> pa.Table:
        self.db.register(name, rows)
        found = self.db.sql(query).to_arrow_table()
        self.db.unregister(name)
        return found

    def _learn(self, words: Iterable[str]) -> None:
        short = []
        for word in words:
            raw = word.encode()
            if raw in self.ranks:
                self.known[word] = self.ranks[raw].to_bytes(4, "little")
            elif len(raw) > LONG_WORD:
                self.known[word] = np.array(self.merge_long(raw), np.int32).tobytes()
            else:
                short.append((word, raw))
        for i in range(0, len(short), WORDS_AT_ONCE):
            part = short[i : i + WORDS_AT_ONCE]
            ends = np.cumsum([0, *(len(raw) for _, raw in part)]).astype(np.int32)
            letters = np.frombuffer(b"".join(raw for _, raw in part), np.uint8)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(self.bytes[letters]))
            start = pa.table({"word": pa.array(np.arange(len(part), dtype=np.int32)), "ids": ids})
            found = self._ask("start", start, ENCODE)["ids"].combine_chunks()
            tokens, ends = found.values.to_numpy().astype(np.int32).tobytes(), (found.offsets.to_numpy() * 4).tolist()
            self.known.update((word, tokens[begin:end]) for (word, _), begin, end in zip(part, ends, ends[1:], strict=False))

    def merge_long(self, raw: bytes) -> list[int]:
        """The same rule for one long word: a heap gives the leftmost pair of least rank."""
        parts = {i: raw[i : i + 1] for i in range(len(raw))}
        after = {i: i + 1 for i in range(len(raw) - 1)}
        before = {j: i for i, j in after.items()}
        heap = [(rank, i, 2) for i in range(len(raw) - 1) if (rank := self.ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)

        def offer(i: int | None) -> None:
            if i is not None and i in after and (rank := self.ranks.get(parts[i] + parts[after[i]])) is not None:
                heapq.heappush(heap, (rank, i, len(parts[i]) + len(parts[after[i]])))

        while heap:
            _, i, size = heapq.heappop(heap)
            if i not in parts or i not in after or len(parts[i]) + len(parts[after[i]]) != size:
                continue
            j = after.pop(i)
            parts[i] += parts.pop(j)
            if (k := after.pop(j, None)) is not None:
                after[i], before[k] = k, i
            offer(i)
            offer(before.get(i))
        return [self.ranks[parts[i]] for i in sorted(parts)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as int32 bytes."""
        found: list[bytes] = []
        for part in parts(texts):
            long = part.pop() if len(part[-1]) > CHARS_AT_ONCE else None
            found += self._ids([self.split(text) for text in part])
            if long:  # its words would take many times its size
                words = (match[0] for match in self.matches(long))
                found.append(b"".join(self._ids([some])[0] for some in batched(words, WORDS_KEPT)))
        return found

    def _ids(self, split: list[Iterable[str]]) -> list[bytes]:
        """The ids of each list of words."""
        if len(self.known) > WORDS_KEPT // 2:
            self.earlier, self.known = self.known, {}
        new = set(chain.from_iterable(split)).difference(self.known)
        met = new.intersection(self.earlier)
        self.known.update((word, self.earlier[word]) for word in met)
        self._learn(new - met)
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def decode(self, ids: list[np.ndarray]) -> list[bytes | None]:
        """The bytes of each list of ids; None if it holds an unknown id."""
        self.known, self.earlier = {}, {}  # decoding needs no words, and a worker that has encoded is used again
        docs = np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) for x in ids])
        every = np.concatenate([np.zeros(0, np.int32), *ids])
        found: list[list[bytes | None]] = [[] for _ in ids]
        for i in range(0, len(every), TOKENS_AT_ONCE):
            doc, token = docs[i : i + TOKENS_AT_ONCE], every[i : i + TOKENS_AT_ONCE]
            tokens = pa.table({"doc": pa.array(doc), "pos": pa.array(np.arange(len(doc), dtype=np.int32)), "token": pa.array(token)})
            rows = self._ask("tokens", tokens, DECODE)
            for at, text, unknown in zip(*(rows[c].to_pylist() for c in ("doc", "text", "unknown")), strict=True):
                found[at].append(None if unknown else text.encode("utf-16-le")[::2])
        return [None if None in some else b"".join(some) for some in found]


@lru_cache(maxsize=1)
def _pairs(path: str, pattern: str) -> BytePairs:
    return BytePairs(path, pattern)


def pieces(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, a few at a time: as many as have that size together, one at least. A null has no size."""
    ends, begin = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False)), 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = min(int(np.searchsorted(ends, before + most)) + 1, len(ends))
        yield batch.slice(begin, end - begin)
        begin = end


def _id_lists(column: pa.Array) -> list[np.ndarray]:
    return [np.array(x if x is not None else [], np.int32) for x in column.to_numpy(zero_copy_only=False)]


def bpe_encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The documents with the token ids of the whole text (an existing column of that name is replaced).

    ``path`` names a file of ranks that every executor has: a base64 token and its rank per line. No special tokens.
    Null and empty texts have no ids. Rows are never compared, so repeated rows and null ids need no rule. An empty table
    gives an empty table. Nothing is shuffled.
    """
    kept = docs.drop(ids)
    place = kept.columns.index(text)
    schema = T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, pc.binary_length(batch.column(place)), CHARS_AT_ONCE):
                found = _pairs(path, pattern).encode(piece.column(place).to_pylist())
                ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), np.int32)))
                yield pa.RecordBatch.from_arrays([*piece.columns, lists], [f.name for f in schema])

    return kept.mapInArrow(run, schema)


def bpe_decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", raw: str = "decoded") -> DataFrame:
    """The rows with the bytes of their token ids (an existing column of that name is replaced).

    Null and empty lists give no bytes; a list with an unknown id gives null. Tokens join the vocabulary and are
    aggregated in order, some hundred thousand at a time, also those of one long list.
    """
    kept = docs.drop(raw)
    place = kept.columns.index(ids)
    schema = T.StructType([*kept.schema.fields, T.StructField(raw, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, pc.list_value_length(batch.column(place)), TOKENS_AT_ONCE):
                out = _pairs(path, pattern).decode(_id_lists(piece.column(place)))
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(out, pa.binary())], [f.name for f in schema])

    return kept.mapInArrow(run, schema)
