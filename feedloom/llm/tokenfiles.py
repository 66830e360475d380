"""Token ids of a corpus as Arrow files of equal-length sequences.

A corpus is one stream of ids, its documents in order, each with an end id. Every task cuts its range of the stream into
sequences of fixed length and writes them as record batches of two fixed-size lists, ``ids`` and ``mask`` (false: padding at
the end of a file). All batches of a file but the last hold the same number of sequences, so sequence k lies in batch
``k // BATCH`` and is read from a mapped file without a copy. Beside each file lies a second one with the documents'
places. The table of all files, the manifest, is written last: what a lost task left behind is in no manifest.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_kind, kind_of, settle
from feedloom.session import work_path

LENGTH = 1024  # tokens of a sequence; a multiple of 8, so that masks begin at whole bytes
BATCH = 256  # sequences of a record batch
FILE_SEQUENCES = 1 << 16  # sequences of a file, more or less
EXTENT = 4096  # sequences looked up by one key
PIECES_KEPT = 1_200_000  # that a worker remembers: half of them the last ones met, half those before
BYTES_KEPT = 64  # longer pieces are encoded each time
BYTES_AT_ONCE = 2_000_000  # of texts whose pieces are looked up together
AT_ONCE = 250  # words encoded as one text; a word of a longer text takes the library more time
WORD_END = "</w>"
# a line of letters, A-Z, a-z, À-Ö, Ø-ö and ø-ÿ in UTF-8, and the punctuation behind them, or another line
PIECE = re.compile(rb"((?:[A-Za-z]++|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])++)([.,;:!?]*+)\n|(.*+)\n")

MANIFEST = "part int, nth int, file string, n_documents long, n_tokens long, n_sequences long"


class _Ids:
    """Ids of texts by a tokenizer file that drops white space and lower-cases: pieces between blanks are encoded one by one and kept.

    No token spans a blank, nor the place between letters and punctuation behind them. Letters alone are one word to the
    tokenizer, which ends in a token with the mark of a word's end, so many such words are encoded as one text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.letter, self.kind = ("H", "<u2") if len(vocabulary) <= 1 << 16 else ("I", "<u4")
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def _look(self, piece: bytes) -> bytes | None:
        return self.known.get(piece) or self.earlier.get(piece)

    def _words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of words of letters."""
        found = {}
        chunks = [words[i : i + AT_ONCE] for i in range(0, len(words), AT_ONCE)]
        for chunk, out in zip(chunks, self.tokenizer.encode_batch_fast([b" ".join(c).decode() for c in chunks], add_special_tokens=False), strict=True):
            ids = np.array(out.ids, self.kind)
            ends = (np.flatnonzero(self.last[ids]) + 1) * ids.itemsize
            if len(ends) != len(chunk):  # a tokenizer that cuts words of letters
                found |= self._others(chunk)
                continue
            raw, ends = ids.tobytes(), ends.tolist()
            found.update((word, raw[begin:end]) for word, begin, end in zip(chunk, [0, *ends], ends, strict=False))
        return found

    def _others(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        outs = self.tokenizer.encode_batch_fast([piece.decode() for piece in pieces], add_special_tokens=False)
        return {piece: array(self.letter, out.ids).tobytes() for piece, out in zip(pieces, outs, strict=True)}

    def _learn(self, pieces: set[bytes]) -> dict[bytes, bytes]:
        """The ids of pieces that are not known."""
        found = {piece: self.earlier[piece] for piece in pieces.intersection(self.earlier)}
        new = list(pieces.difference(found))
        # no piece holds a line's end; all are cut in one pass
        cut = PIECE.findall(b"".join([piece + b"\n" for piece in new]))
        words = {part: self._look(part) for part in {word for word, _, _ in cut}}
        marks = {part: self._look(part) for part in {behind for _, behind, _ in cut}}
        words.update(self._words([w for w, ids in words.items() if ids is None and w]))
        marks.update(self._others([m for m, ids in marks.items() if ids is None]))
        found.update((piece, words[word] + marks[behind]) for piece, (word, behind, _) in zip(new, cut, strict=True) if word)
        found |= marks
        found.update((word, ids) for word, ids in words.items() if word)
        found |= self._others([other for _, _, other in cut if other])
        return found

    def encode(self, texts: list[bytes | None]) -> Iterator[bytes]:
        """The ids of each UTF-8 text as little-endian bytes of ``kind``."""
        rows, gaps, size = [], [], 0
        for text in texts:
            raw = text or b""
            # A-Z may be lower-cased at once unless a mark may join a letter or there is an added token
            pieces = (raw if b"\xcc" in raw or b"\xcd" in raw or b"<|" in raw else raw.lower()).split()
            row = list(map(self.known.get, pieces))
            gaps.append([(i, pieces[i]) for i in _nones(row)])
            rows.append(row)
            size += len(raw)
            if size >= BYTES_AT_ONCE:
                yield from self._filled(rows, gaps)
                rows, gaps, size = [], [], 0
        yield from self._filled(rows, gaps)

    def _filled(self, rows: list[list], gaps: list[list]) -> Iterator[bytes]:
        found = self._learn({piece for gap in gaps for _, piece in gap})
        for row, gap in zip(rows, gaps, strict=True):
            for i, piece in gap:
                row[i] = found[piece]
            yield b"".join(row)
        if len(self.known) > PIECES_KEPT // 2:
            self.earlier, self.known = self.known, {}
        self.known.update((piece, ids) for piece, ids in found.items() if len(piece) <= BYTES_KEPT)


def _nones(row: list) -> Iterator[int]:
    """Where a list holds None."""
    at = -1
    for _ in range(row.count(None)):
        at = row.index(None, at + 1)
        yield at


@lru_cache(maxsize=1)
def _ids(path: str) -> _Ids:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one thread
    return _Ids(path)


def _place(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class _Writer:
    """One file of sequences and its file of documents."""

    def __init__(self, folder: str, kind: str, id_kind: pa.DataType, length: int):
        self.file, self.length, self.kind = f"{folder}/{uuid.uuid4().hex}.arrow", length, kind
        system, path = _place(self.file)
        self.value = pa.uint16() if kind == "<u2" else pa.uint32()
        self.schema = pa.schema({"ids": pa.list_(self.value, length), "mask": pa.list_(pa.bool_(), length)})
        self.doc_schema = pa.schema({"doc": id_kind, "start": pa.int64(), "n_tokens": pa.int64()})
        self.sinks = [system.open_output_stream(p) for p in (path, f"{path}.documents")]
        self.ids = pa.ipc.new_file(self.sinks[0], self.schema)
        self.docs = pa.ipc.new_file(self.sinks[1], self.doc_schema)
        self.waiting = bytearray()
        self.rows: list[tuple] = []
        self.n_documents = self.n_tokens = self.n_sequences = 0

    def add(self, doc, raw: bytes) -> None:
        size = len(raw) // int(self.kind[2])
        self.rows.append((doc, self.n_tokens, size))
        self.n_tokens += size
        self.n_documents += 1
        self.waiting += raw
        whole = BATCH * self.length * int(self.kind[2])
        if len(self.waiting) >= whole:
            full = len(self.waiting) // whole * whole
            view = memoryview(bytes(self.waiting[:full]))
            for i in range(0, full, whole):
                self._sequences(np.frombuffer(view[i : i + whole], self.kind))
            del self.waiting[:full]
        if len(self.rows) >= 10_000:
            self._documents()

    def _sequences(self, tokens: np.ndarray) -> None:
        pad = -len(tokens) % self.length
        mask = np.arange(len(tokens) + pad) < len(tokens)
        ids = pa.FixedSizeListArray.from_arrays(pa.array(np.pad(tokens, (0, pad)), self.value), self.length)
        self.ids.write_batch(pa.record_batch([ids, pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))
        self.n_sequences += len(ids)

    def _documents(self) -> None:
        columns = [pa.array([r[i] for r in self.rows], f.type) for i, f in enumerate(self.doc_schema)]
        self.docs.write_batch(pa.record_batch(columns, schema=self.doc_schema))
        self.rows = []

    def close(self) -> tuple:
        if self.waiting:
            self._sequences(np.frombuffer(bytes(self.waiting), self.kind))
        self._documents()
        for x in (self.ids, self.docs, *self.sinks):
            x.close()
        return self.file, self.n_documents, self.n_tokens, self.n_sequences


def write_token_files(
    docs: DataFrame, path: str, folder: str | None = None, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end_id: int = 1, file_sequences: int = FILE_SEQUENCES
) -> DataFrame:
    """Write the ids of all documents in ascending ``doc_id`` order; gives the manifest, a row per file.

    ``path`` names a tokenizer file that drops white space and that every executor has; added tokens in a text are
    tokens, none is added but the end id. ``folder`` is a new folder that all executors share, any address that Arrow's file
    systems know. Manifest: ``file``, its documents, tokens and sequences, and ``first_token`` and ``first_sequence``: how
    many lie in the files before it. Ids take two bytes where the vocabulary allows, else four.

    A null text counts as empty: its only id is the end id. Null ids come first; rows of one id are documents of their own, in the
    order of their texts. Other columns are not read. An empty table gives an empty manifest.

    The texts are shuffled once, by ranges of ``doc_id`` and, within one id, of the text's hash. A task holds one batch
    of sequences; a file is closed after the document that brings it to ``file_sequences``.
    """
    if length % 8:
        raise ValueError("the length of sequences must be a multiple of 8")
    folder = folder or work_path(docs.sparkSession, "token-files")
    system, place = _place(folder)
    system.create_dir(place)
    id_kind = arrow_kind(docs, doc_id)
    names = [part.split()[0] for part in MANIFEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, writer, nth = _ids(path), None, 0
        end = np.array([end_id], words.kind).tobytes()
        for batch in batches:
            part = batch.column(2)
            for doc, raw in zip(batch.column(0).to_pylist(), words.encode(batch.column(1).cast(pa.binary()).to_pylist()), strict=True):
                writer = writer or _Writer(folder, words.kind, id_kind, length)
                writer.add(doc, raw + end)
                if writer.n_tokens >= file_sequences * length:
                    yield row(part, nth, writer)
                    writer, nth = None, nth + 1
        if writer:
            yield row(part, nth, writer)

    def row(part: pa.Array, nth: int, writer: _Writer) -> pa.RecordBatch:
        values = (part[0].as_py(), nth, *writer.close())
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    ordered = (
        docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
        .repartitionByRange("doc", F.xxhash64("text"))
        .sortWithinPartitions("doc", F.xxhash64("text"), "text")
        .select("doc", "text", F.spark_partition_id().alias("part"))
    )
    files = settle(ordered.mapInArrow(run, MANIFEST), "token-manifest")
    # a row per file: a sum over the files of each range, then over the ranges, whose number is a setting
    ranges = files.groupBy("part").agg(F.sum("n_tokens").alias("t"), F.sum("n_sequences").alias("s"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = ranges.select("part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("t", "s")))
    inside = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    first = [(F.col(c) + F.coalesce(F.sum(n).over(inside), F.lit(0))).alias(name) for c, n, name in (("t", "n_tokens", "first_token"), ("s", "n_sequences", "first_sequence"))]
    placed = files.join(before, "part").select("part", "nth", "file", "n_documents", "n_tokens", "n_sequences", *first)
    return settle(placed.drop("part", "nth"), "token-manifest-placed")


class TokenFile:
    """A written file: its sequences and documents by number. A local file is mapped, and sequences are views of it."""

    def __init__(self, file: str):
        system, path = _place(file)
        local = system.type_name == "local"
        self.sources = [pa.memory_map(p) if local else system.open_input_file(p) for p in (path, f"{path}.documents")]
        self.ids, self.docs = map(pa.ipc.open_file, self.sources)
        self.length = self.ids.schema.field("ids").type.list_size
        self._last: tuple[int, pa.RecordBatch | None] = (-1, None)

    def batch(self, number: int) -> pa.RecordBatch:
        if self._last[0] != number:
            self._last = (number, self.ids.get_batch(number))
        return self._last[1]

    def sequence(self, number: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of the sequence with this number in the file."""
        batch, at = self.batch(number // BATCH), number % BATCH
        return batch.column(0).values.slice(at * self.length, self.length).to_numpy(), batch.column(1).values.slice(at * self.length, self.length)

    def tokens(self, start: int, size: int) -> Iterator[np.ndarray]:
        """The ids from a place of the file's stream on, batch by batch."""
        whole = BATCH * self.length
        for number in range(start // whole, -(-(start + size) // whole)):
            values = self.batch(number).column(0).values.to_numpy()
            yield values[max(start - number * whole, 0) : start + size - number * whole]

    def documents(self) -> Iterator[pa.RecordBatch]:
        return map(self.docs.get_batch, range(self.docs.num_record_batches))

    def close(self) -> None:
        self._last = (-1, None)
        for x in self.sources:
            x.close()


def read_token_documents(manifest: DataFrame, id_type: str = "long", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read from the files.

    ``start`` counts the ids of all documents before it; the checksum covers the ids as little-endian unsigned 32-bit integers.
    Every file is one task's work.
    """
    schema = f"`{doc_id}` {id_type}, start long, n_tokens long, ids_crc32 long"
    names = [doc_id, "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for file, first in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                stored = TokenFile(file)
                for docs in stored.documents():
                    sums = []
                    for start, size in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist(), strict=True):
                        crc = 0
                        for ids in stored.tokens(start, size):
                            crc = zlib.crc32(ids.astype("<u4"), crc)
                        sums.append(crc)
                    starts = docs.column(1).to_numpy() + first
                    yield pa.RecordBatch.from_arrays([docs.column(0), pa.array(starts), docs.column(2), pa.array(sums, pa.int64())], names)
                stored.close()

    files = manifest.select("file", "first_token")
    return files.repartition(max(1, files.count())).mapInArrow(run, schema)


def read_sequences(manifest: DataFrame, wanted: DataFrame, number: str = "sequence") -> DataFrame:
    """``(sequence, ids, mask)`` of the sequences with the wanted numbers in the whole corpus, each opened where it lies.

    A number that is null or beyond the last sequence gives no row; a number asked for twice gives one.
    """
    last = F.col("first_sequence") + F.col("n_sequences")
    files = manifest.where("n_sequences > 0").select(
        "file", "first_sequence", last.alias("last"), F.explode(F.sequence(F.floor(F.col("first_sequence") / EXTENT), F.floor((last - 1) / EXTENT))).alias("extent")
    )
    asked = wanted.select(F.col(number).cast("long").alias("sequence")).where("sequence >= 0").distinct()
    found = (
        asked.withColumn("extent", F.floor(F.col("sequence") / EXTENT))
        .join(files, "extent")
        .where("sequence >= first_sequence and sequence < last")
        .select("sequence", "file", (F.col("sequence") - F.col("first_sequence")).alias("at"))
        .repartition("file", F.floor(F.col("at") / EXTENT))
        .sortWithinPartitions("file", "at")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored, opened = None, None
        for rows in batches:
            for begin in range(0, rows.num_rows, BATCH):
                part = rows.slice(begin, BATCH).to_pylist()
                ids, masks = [], []
                for r in part:
                    if r["file"] != opened:
                        if stored:
                            stored.close()
                        stored, opened = TokenFile(r["file"]), r["file"]
                    values, mask = stored.sequence(r["at"])
                    ids.append(values.tolist())
                    masks.append(mask.to_pylist())
                columns = [pa.array([r["sequence"] for r in part], pa.int64()), pa.array(ids, pa.list_(pa.int64())), pa.array(masks, pa.list_(pa.bool_()))]
                yield pa.RecordBatch.from_arrays(columns, ["sequence", "ids", "mask"])
        if stored:
            stored.close()

    return found.mapInArrow(run, "sequence long, ids array<long>, mask array<boolean>")
