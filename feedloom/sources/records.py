"""Pieces of text files that span lines, read in parallel: CSV records with quoted line ends, sections under headings.

Spark reads files in splits, line by line. Where a piece begins may hang on all the text before it: a quote may be open. So every
split is summed up for either case in one pass, a row per split; what holds where a split begins follows from the splits before
it, as a running composition; and a second pass cuts the lines into pieces and numbers them. A piece that crosses splits leaves
parts, which are put together by its number. Lines are byte-true, so this is safe in UTF-8 and windows-31j, where no character of
two or more bytes holds the byte of a quote, a comma or a line end.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.session import work_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package

SPLITS = "path string, start long, out_open boolean, in_open boolean, out_count long, in_count long, lead long, returns boolean"
# Spark fails on bytes that are no character unless this is on.
REPLACE_BAD_BYTES = "spark.sql.legacy.codingErrorAction"
PARTS = "path string, number long, start long, whole boolean, lead long, returns boolean, raw binary"

# A blank line, also as the first of a file with a byte order mark.
BLANK_LINES = [b"", b"\r", b"\xef\xbb\xbf", b"\xef\xbb\xbf\r"]

# One field in a line that begins outside quotes, up to its comma: what follows a closing quote counts as it stands.
_FIELD = r'(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^",][^,]*)?,'
_OPEN = r'"(?:[^"]|"")*$'
LEAVES_OPEN = rf"^(?:\xEF\xBB\xBF)?(?:{_FIELD})*{_OPEN}"
STAYS_OPEN = rf'^(?:[^"]|"")*$|^(?:[^"]|"")*"(?:[^",][^,]*)?,(?:{_FIELD})*{_OPEN}'


@dataclass(frozen=True)
class Pieces:
    """How lines make pieces.

    ``moves`` gives for each line whether something is open after it, if nothing was open before it and if something was;
    ``begins`` whether a line begins a piece, given what is open before it. With ``ends`` a piece is over where nothing is
    open; else it goes on to the next beginning.
    """

    moves: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
    begins: Callable[[pa.Array, np.ndarray], np.ndarray]
    ends: bool


def _csv_moves(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A quote opens at the begin of a field only and closes unless it is doubled, as the CSV reader has it."""
    opens, stays = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    if len(quoted):
        some = lines.take(pa.array(quoted))
        opens[quoted] = pc.match_substring_regex(some, LEAVES_OPEN).to_numpy(zero_copy_only=False)
        stays[quoted] = pc.match_substring_regex(some, STAYS_OPEN).to_numpy(zero_copy_only=False)
    return opens, stays


def _no_moves(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(len(lines), bool), np.ones(len(lines), bool)


CSV_RECORDS = Pieces(_csv_moves, lambda lines, open_: ~open_, True)


def sections_of(mark: str) -> Pieces:
    """Sections that begin with lines that begin with the mark."""
    return Pieces(_no_moves, lambda lines, open_: pc.starts_with(lines, mark).to_numpy(zero_copy_only=False).astype(bool), False)


def states(out: np.ndarray, into: np.ndarray, open_: bool) -> tuple[np.ndarray, bool]:
    """What is open before each line, and after the last, if that is ``open_`` before the first.

    A line that ends alike in either case fixes the state, a line that turns it counts; so no loop over lines is needed.
    """
    size = len(out)
    turns = np.append(0, np.cumsum(out & ~into))
    fixed = np.maximum.accumulate(np.append(0, np.where(out == into, np.arange(1, size + 1), 0)))
    base = np.append(open_, out)[fixed]
    after = base ^ ((turns - turns[fixed]) & 1).astype(bool)
    return after[:-1], bool(after[-1])


def file_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(path, start, at, line)``: lines as bytes with their file, where their split begins, and a number that grows in it."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").cast("binary").alias("line"),
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Rows of one split after another; a split may go on in the next batch."""
    for batch in batches:
        size = batch.num_rows
        if not size:
            continue
        path, start = batch.column(0), batch.column(1).to_numpy()
        other = pc.not_equal(path.slice(1), path.slice(0, size - 1)).to_numpy(zero_copy_only=False).astype(bool) | (start[1:] != start[:-1])
        for a, b in pairwise([0, *(np.flatnonzero(other) + 1).tolist(), size]):
            yield (path[a].as_py(), int(start[a])), batch.slice(a, b - a)


def split_states(lines: DataFrame, kind: Pieces) -> DataFrame:
    """``(path, start, open, open_after, before, lead, returns)`` of every split.

    ``open`` and ``open_after``: what is open where it begins and where it ends; ``before``: how many pieces begin before it; ``lead``: blank lines
    that its file begins with; ``returns``: whether its file's first line ends in a carriage return. One pass over the lines, a row per split is shuffled. The result is written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, ends, counts = None, [False, True], [0, 0]
        lead, blank, returns = 0, True, False

        def row() -> pa.RecordBatch:
            values = [*split, *ends, *counts, lead, returns]
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [p.split()[0] for p in SPLITS.split(", ")])

        for key, part in _runs(batches):
            if key != split:
                if split:
                    yield row()
                split, ends, counts = key, [False, True], [0, 0]
                lead, blank, returns = 0, True, part.column(3)[0].as_py().endswith(b"\r")
            text = part.column(3)
            if blank:
                filled = np.flatnonzero(~pc.is_in(text, pa.array(BLANK_LINES)).to_numpy(zero_copy_only=False).astype(bool))
                blank, lead = not len(filled), lead + int(filled[0] if len(filled) else len(text))
            out, into = kind.moves(text)
            for i in (0, 1):
                before, ends[i] = states(out, into, ends[i])
                counts[i] += int(kind.begins(text, before).sum())
        if split:
            yield row()

    sums = lines.mapInArrow(run, SPLITS)
    order = Window.partitionBy("path").orderBy("start")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col("out_open") & ~F.col("in_open")
    counted = sums.withColumn("turns", F.sum(turns.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    fixed = F.when(F.col("out_open") == F.col("in_open"), F.struct("out_open", "turns"))
    known = counted.withColumns({"fixed": F.last(fixed, ignorenulls=True).over(earlier), "turned": F.coalesce(F.lag("turns").over(order), F.lit(0))})
    odd = (F.col("turned") - F.coalesce(F.col("fixed.turns"), F.lit(0))) % 2 == 1
    opened = known.withColumn("open", F.coalesce(F.col("fixed.out_open"), F.lit(False)) != odd)
    placed = opened.withColumns(
        {
            "open_after": F.when(F.col("open"), F.col("in_open")).otherwise(F.col("out_open")),
            "count": F.when(F.col("open"), F.col("in_count")).otherwise(F.col("out_count")),
        }
    ).withColumns(
        {
            "before": F.coalesce(F.sum("count").over(earlier), F.lit(0)),
            "lead": F.first("lead").over(order),
            "returns": F.first("returns").over(order),
        }
    )
    target = work_path(lines.sparkSession, "splits")
    placed.select("path", "start", "open", "open_after", "before", "lead", "returns").write.parquet(target)
    return lines.sparkSession.read.parquet(target)


class _Cutter:
    """Cuts the lines of a split into pieces. The piece that is open at its begin has the number of pieces begun before."""

    def __init__(self, kind: Pieces, key: tuple[str, int], open_: bool, before: int, lead: int, returns: bool):
        self.kind, self.key, self.open, self.number = kind, key, open_, before
        self.lead, self.returns = lead, returns
        self.whole = False
        self.waiting: list[pa.Array] = []
        self.rows: list[tuple[int, bool, bytes]] = []

    def add(self, lines: pa.Array) -> pa.RecordBatch | None:
        out, into = self.kind.moves(lines)
        before, self.open = states(out, into, self.open)
        at = np.flatnonzero(self.kind.begins(lines, before))
        self.waiting.append(lines.slice(0, at[0]) if len(at) else lines)
        if not len(at):
            return None
        self._close(True)
        ends = pa.array(at, pa.int32())
        complete = pc.binary_join(pa.ListArray.from_arrays(ends, lines), b"\n")  # all pieces but the last
        numbers = np.arange(self.number + 1, self.number + len(at))
        self.number += len(at)
        self.whole, self.waiting = True, [lines.slice(at[-1])]
        early, self.rows = self.rows, []
        numbers = np.append(np.array([r[0] for r in early], np.int64), numbers)
        whole = np.append(np.array([r[1] for r in early], bool), np.ones(len(complete), bool))
        return self._batch(numbers, whole, pa.concat_arrays([pa.array([r[2] for r in early], pa.binary()), complete]))

    def _close(self, over: bool) -> None:
        lines = [x for part in self.waiting for x in part.to_pylist()]
        if lines:
            self.rows.append((self.number, self.whole and over, b"\n".join(lines)))
        self.waiting = []

    def last(self) -> pa.RecordBatch:
        self._close(self.kind.ends and not self.open)
        numbers, whole, raw = zip(*self.rows, strict=True) if self.rows else ((), (), ())
        return self._batch(np.array(numbers, np.int64), np.array(whole, bool), pa.array(raw, pa.binary()))

    def _batch(self, numbers: np.ndarray, whole: np.ndarray, raw: pa.Array) -> pa.RecordBatch:
        size = len(numbers)
        path, start = pa.array([self.key[0]] * size, pa.string()), pa.array(np.full(size, self.key[1], np.int64))
        lead, returns = pa.array(np.full(size, self.lead, np.int64)), pa.array(np.full(size, self.returns))
        return pa.RecordBatch.from_arrays([path, pa.array(numbers), start, pa.array(whole), lead, returns, raw], [p.split()[0] for p in PARTS.split(", ")])


def _cut(lines: DataFrame, known: DataFrame, kind: Pieces) -> DataFrame:
    """The pieces and parts of pieces of the splits in ``known``.

    No hint: Spark broadcasts the row per split while that is small; beyond, the lines are shuffled by split, and the sort
    brings them in order again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = None
        for key, part in _runs(batches):
            if cutter is None or cutter.key != key:
                if cutter:
                    yield cutter.last()
                cutter = _Cutter(kind, key, *(part.column(i)[0].as_py() for i in range(4, 8)))
            found = cutter.add(part.column(3))
            if found is not None:
                yield found
        if cutter:
            yield cutter.last()

    placed = lines.join(known.drop("open_after"), ["path", "start"]).sortWithinPartitions("path", "start", "at")
    return placed.select("path", "start", "at", "line", "open", "before", "lead", "returns").mapInArrow(run, PARTS)


def _joined(parts: DataFrame) -> DataFrame:
    """Parts put together in the order of their splits. Bytes pass through text columns unchanged."""
    listed = F.sort_array(F.collect_list(F.struct("start", F.col("raw").cast("string").alias("part"))))
    return parts.groupBy("path", "number", "lead", "returns").agg(F.array_join(F.transform(listed, lambda p: p["part"]), "\n").cast("binary").alias("raw"))


def file_pieces(spark: SparkSession, path: str | Sequence[str], kind: Pieces) -> DataFrame:
    """``(path, number, lead, returns, raw)``: the pieces of each file, numbered from 1, without their last line end.

    ``lead`` and ``returns`` are those of ``split_states``. Lines before a file's first piece have number 0. Two passes over the text, both by split; where pieces cross splits, a third
    one, in which only those splits are cut again. A piece that never ends, such as a quote that stays open to the end of a large file,
    is one row, as it is for a reader of whole files, but for the file's last line end.
    """
    lines = file_lines(spark, path)
    known = split_states(lines, kind)
    found = _cut(lines, known, kind)
    if not kind.ends:
        return _joined(found)
    whole = found.where("whole").select("path", "number", "lead", "returns", "raw")
    crossing = known.where("open or open_after")
    if crossing.isEmpty():
        return whole
    target = work_path(spark, "crossing")
    _joined(_cut(lines, crossing, kind).where("not whole")).write.parquet(target)
    return whole.unionByName(spark.read.parquet(target))


def csv_records(spark: SparkSession, path: str | Sequence[str], encoding: str) -> DataFrame:
    """``(path, number, header, raw, record)``: the records of CSV files, numbered from 1 in their file, blank lines counted.

    ``header`` marks a file's first record that is not blank. ``raw`` is the text as it stands, without its line end; in ``record`` line ends
    inside quotes are newlines, if the file has carriage returns at line ends. A byte order mark is gone. Bytes that are no character
    become the replacement character, as in the CSV reader. A carriage return alone ends no record.
    """
    spark.conf.set(REPLACE_BAD_BYTES, "true")
    text = F.decode(F.col("raw"), encoding)
    size = F.char_length(text)
    text = F.when(F.col("returns") & F.endswith(text, F.lit("\r")), F.left(text, size - 1)).otherwise(text)
    text = F.when((F.col("number") == 1) & F.startswith(text, F.lit("\ufeff")), F.substr(text, F.lit(2))).otherwise(text)
    records = file_pieces(spark, path, CSV_RECORDS).select("path", "number", (F.col("number") == F.col("lead") + 1).alias("header"), "returns", text.alias("raw"))
    record = F.when(F.col("returns"), F.replace("raw", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("raw"))
    return records.select("path", "number", "header", "raw", record.alias("record"))
