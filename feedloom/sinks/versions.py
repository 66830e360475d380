"""A feed history whose days are replaced, and removed, in one step under its readers.

Every write goes to a folder of its own, and a numbered pointer file then says which folder holds each day. A reader takes the
pointer with the highest number, so it sees a write as a whole or not at all; a write that fails, or a job that dies between
writing and pointing, leaves the days as they were. The pointer has an entry per day, however many rows a day has.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.sinks.feeds import DAY

POINTERS, DATA, VERSION = "_pointers", "data", "feed_version"


class CommitConflict(RuntimeError):
    """Another job has changed the history in the meantime; nothing of this one shows."""


@dataclass(frozen=True)
class Pointer:
    """State of a history: the folder of each day, and the columns of its rows."""

    number: int = 0
    days: dict[str, str] = field(default_factory=dict)
    columns: dict | None = None

    def text(self) -> str:
        return json.dumps({"days": self.days, "columns": self.columns}, sort_keys=True)


def _files(spark: SparkSession, path: str):
    home = spark._jvm.org.apache.hadoop.fs.Path(path)
    return home, home.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    home, system = _files(spark, path)
    return [x.getPath().getName() for x in system.listStatus(home)] if system.exists(home) else []


def current(spark: SparkSession, history: str) -> Pointer:
    """The newest pointer of a history; an empty one where there is none."""
    numbers = [int(name) for name in _names(spark, f"{history}/{POINTERS}") if name.isdigit()]
    if not numbers:
        return Pointer()
    path, system = _files(spark, f"{history}/{POINTERS}/{max(numbers):020d}")
    stream = system.open(path)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Pointer(max(numbers), found["days"], found["columns"])


def _point(spark: SparkSession, history: str, pointer: Pointer) -> None:
    """Write the pointer under its number, all of it at once; fails if that number is taken."""
    target, system = _files(spark, f"{history}/{POINTERS}/{pointer.number:020d}")
    draft, _ = _files(spark, f"{history}/{POINTERS}/.{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(pointer.text().encode()))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    qualified = [system.makeQualified(path) for path in (draft, target)]
    try:
        context.rename(*qualified, plain)  # never onto a file that is there
    except Exception as problem:
        system.delete(draft, False)
        if system.exists(target):
            raise CommitConflict(f"pointer {pointer.number} of {history} has been written by another job") from problem
        raise


def _day(value: dt.date | str) -> str:
    return value if isinstance(value, str) else f"{value:%Y-%m-%d}"


def replace_days(feed: DataFrame, history: str, clear: Sequence[dt.date | str] = (), rebalance: bool = False) -> Pointer:
    """The feed's days, by its ``feed_date``, replace those of the history; days of ``clear`` that it has no row of go with the same step.

    Rows without a day are one day of their own. Columns are matched by name; the feed's are those of the history from then on, and
    older days have nulls for those they lack. ``rebalance`` gathers rows by day for feeds of many days; AQE splits a large day. A job that finds the history changed since it began fails with ``CommitConflict``.
    """
    spark, history = feed.sparkSession, history.rstrip("/")
    before = current(spark, history)
    version = uuid.uuid4().hex
    folder = f"{history}/{DATA}/{VERSION}={version}"
    (feed.hint("rebalance", DAY) if rebalance else feed).write.partitionBy(DAY).parquet(folder)
    written = [name.split("=", 1)[1] for name in _names(spark, folder) if name.startswith(f"{DAY}=")]
    days = {day: held for day, held in before.days.items() if day not in {_day(d) for d in clear}}
    days |= dict.fromkeys(written, version)
    pointer = Pointer(before.number + 1, days, json.loads(feed.drop(DAY).schema.json()))
    _point(spark, history, pointer)
    return pointer


def drop_days(spark: SparkSession, history: str, keep: Callable[[str], bool]) -> Pointer:
    """Take the days out of the history whose date text ``keep`` denies, in one step; their files stay until :func:`sweep`."""
    history = history.rstrip("/")
    before = current(spark, history)
    pointer = Pointer(before.number + 1, {day: held for day, held in before.days.items() if keep(day)}, before.columns)
    _point(spark, history, pointer)
    return pointer


def keep_newest_days(spark: SparkSession, history: str, days: int) -> Pointer:
    """Only the newest days with a date stay."""
    dated = sorted(day for day in current(spark, history.rstrip("/")).days if day[:1].isdigit())
    kept = set(dated[max(0, len(dated) - days) :])
    return drop_days(spark, history, lambda day: day in kept)


def read_history(spark: SparkSession, history: str, pointer: Pointer | None = None) -> DataFrame:
    """The rows of all days that the newest pointer, or a given older one, names, with ``feed_date``.

    Folders are named to Spark, so no listing decides what is read, and filters on the day prune them.
    """
    history = history.rstrip("/")
    pointer = pointer or current(spark, history)
    if pointer.columns is None:
        raise ValueError(f"no history in {history}")
    columns = T.StructType.fromJson(pointer.columns)
    schema = T.StructType([*columns.fields, T.StructField(VERSION, T.StringType()), T.StructField(DAY, T.DateType())])
    paths = [f"{history}/{DATA}/{VERSION}={version}/{DAY}={day}" for day, version in sorted(pointer.days.items())]
    if not paths:
        return spark.createDataFrame([], schema).drop(VERSION)
    return spark.read.schema(schema).option("basePath", f"{history}/{DATA}").parquet(*paths).select(*[F.col(f"`{c}`") for c in columns.names], DAY)


def sweep(spark: SparkSession, history: str, keep: int = 1) -> int:
    """Delete all pointers but the newest ``keep``, and the day folders that none of those names; gives the number of folders.

    For a time when no reader works on an older pointer and no job is writing.
    """
    history = history.rstrip("/")
    numbers = sorted(int(name) for name in _names(spark, f"{history}/{POINTERS}") if name.isdigit())
    gone = numbers[: max(0, len(numbers) - keep)]
    held = set()
    for number in numbers[len(gone) :]:
        path, system = _files(spark, f"{history}/{POINTERS}/{number:020d}")
        stream = system.open(path)
        try:
            held |= set(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["days"].items())
        finally:
            stream.close()
    count = 0
    for version in _names(spark, f"{history}/{DATA}"):
        folder = f"{history}/{DATA}/{version}"
        days = [name for name in _names(spark, folder) if name.startswith(f"{DAY}=")]
        old = [name for name in days if (name.split("=", 1)[1], version.split("=", 1)[1]) not in held]
        for path in [folder] if len(old) == len(days) else [f"{folder}/{name}" for name in old]:
            home, system = _files(spark, path)
            system.delete(home, True)
        count += len(old)
    for number in gone:
        path, system = _files(spark, f"{history}/{POINTERS}/{number:020d}")
        system.delete(path, False)
    return count
