"""CSV feed readers.

Headers are read once on the driver (one record) and turned into an explicit schema,
so no reader infers types and every value stays text. Rows go through Spark's CSV
source: rows of a wrong width are cut or padded and keep their raw record beside them.
"""

from __future__ import annotations

import csv
import datetime as dt
import io
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import clean_currency
from feedloom.session import JAPANESE, allow_japanese
from feedloom.sources.records import csv_records

# The money column that is cleaned while a feed is read, the three columns
# of the wide report, the feeds with the ends of their file names, and the name parts
# by which downloaded reports are told apart.
CURRENCY_COLUMN = "売上金額"
REPORT_COLUMNS = ("広告名", "クリック数", "応募完了（CV）")
FEED_SUFFIXES = {"cv_attr": "_CVrepo.csv", "cv": "_CV.csv", "ss": "_SS.csv"}
REPORT_TOKENS = ("detail_analyze", "cv_attr")

RAW_RECORD = "_raw_record"


def csv_reader(spark: SparkSession, encoding: str = JAPANESE, multi_line: bool = True) -> DataFrameReader:
    """Quoted newlines and doubled quotes as in RFC 4180. A multi-line file is read by one task."""
    allow_japanese(spark)
    return (
        spark.read.option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW_RECORD)
    )


def reading(spark: SparkSession, path: str | Sequence[str]) -> str:
    """How the files are to be read: ``lines``, ``records`` or ``whole``.

    Spark may read line by line unless a line leaves a quote open, or holds white space only, which it drops then: such
    files are cut into records first (:func:`feedloom.sources.records.csv_records`), in parts too. Only a lone carriage return,
    whose meaning hangs on the file's first line end, needs the file whole. Lines are split at newlines alone and read
    byte-true, which is safe in UTF-8 and windows-31j. Two answers per task are shuffled.
    """
    line = F.rtrim(F.col("value"), F.lit("\r"))
    lone = (F.octet_length("value") - F.octet_length(line) > 1) | F.contains(line, F.lit("\r"))
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))
    white = F.regexp_like(line, F.lit(r"^[\x00-\x20]+$"))
    found = spark.read.text(path, lineSep="\n").agg(F.bool_or(lone).alias("lone"), F.bool_or((quotes % 2 == 1) | white).alias("cut")).first()
    return "whole" if found["lone"] else "records" if found["cut"] else "lines"


def may_be_split(spark: SparkSession, path: str | Sequence[str]) -> bool:
    """True when reading the files line by line gives the same rows as reading each whole."""
    return reading(spark, path) == "lines"


def read_header(spark: SparkSession, path: str | Sequence[str], encoding: str = JAPANESE) -> list[str]:
    """Cells of the first record, blanks included; an empty list for an empty file.

    One small job: with a schema of one column nothing is inferred, and a record of several
    cells keeps its raw text.
    """
    schema = text_schema(["_first", RAW_RECORD])
    first = csv_reader(spark, encoding).schema(schema).csv(path).limit(1).collect()
    if not first:
        return []
    if first[0][RAW_RECORD] is None:
        return [first[0]["_first"] or ""]
    return next(csv.reader(io.StringIO(first[0][RAW_RECORD].removeprefix("\ufeff"))))


def file_headers(spark: SparkSession, path: str | Sequence[str], encoding: str = JAPANESE) -> DataFrame:
    """``(header, files)``: the distinct first lines of the files, with the paths of the files that have each.

    One pass over the text; a line per file is shuffled.
    """
    allow_japanese(spark)
    first = (
        spark.read.text(path)
        .where("_metadata.file_block_start = 0")
        .select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("at"))
        .groupBy("path")
        .agg(F.min_by("value", "at").alias("line"))
    )
    text = F.decode(F.col("line").cast("binary"), encoding)
    return first.groupBy(F.replace(text, F.lit("\ufeff"), F.lit("")).alias("header")).agg(F.sort_array(F.collect_list("path")).alias("files"))


def header_width(header: Sequence[str]) -> int:
    """Number of header cells that are not blank."""
    return sum(1 for cell in header if cell.strip())


def unique_names(names: Sequence[str]) -> list[str]:
    """Repeats get ``_1``, ``_2`` ...: the first number that is still free."""
    taken: dict[str, None] = {}
    for name in names:
        number = 0
        candidate = name
        while candidate in taken:
            number += 1
            candidate = f"{name}_{number}"
        taken[candidate] = None
    return list(taken)


def normalise_header(header: Sequence[str]) -> list[str]:
    """Strip the cells, drop blank ones, make repeats unique."""
    return unique_names([cell.strip() for cell in header if cell.strip()])


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def scan_feed(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    encoding: str = JAPANESE,
    blank_header: str = "truncate",
    multi_line: bool | None = True,
    currency_column: str | None = CURRENCY_COLUMN,
    header: Sequence[str] | None = None,
    with_source: bool = False,
) -> DataFrame:
    """A feed as text columns: ragged rows repaired, no nulls, currency cleaned.

    ``blank_header='truncate'`` drops blank header cells and cuts rows from the right, so
    values behind a blank cell in the middle move left. ``'align'`` drops that cell's column
    instead. ``with_source`` adds ``file_name``, ``raw_record`` (null unless the row had a
    wrong width), ``field_count`` and ``record_number`` for the quality report: the header is record 1 and blank lines count.

    Every file must have the header of the first: where that header's cells are plain names Spark compares each file's as
    it reads it, and fails with the file's name; other headers are compared beforehand, in one pass. Files whose columns
    differ in order are read with :func:`scan_mixed_feed`.

    With ``multi_line`` a file is read by one task. For large files say ``None``: one parallel pass finds out how
    they are read in parts, line by line or cut into records (see :func:`reading`). ``False`` skips that
    pass for files known to hold no quoted newline and no line of white space only. ``with_source`` always reads records in parts.
    """
    if blank_header not in ("truncate", "align"):
        raise ValueError(f"blank_header must be 'truncate' or 'align', not {blank_header!r}")
    raw_header = list(header) if header is not None else read_header(spark, path, encoding)
    names = normalise_header(raw_header)
    if not names:
        raise ValueError(f"no header in {path}")
    if blank_header == "align":
        fresh = iter(names)
        read_names = [next(fresh) if cell.strip() else f"\0{i}" for i, cell in enumerate(raw_header)]
    else:
        read_names = names
    wanted = list(columns) if columns is not None else names
    missing = [c for c in wanted if c not in names]
    if missing:
        raise ValueError(f"columns {missing} are not in the header of {path}")

    plain = raw_header == read_names
    way = "records" if with_source else {True: "whole", False: "lines"}.get(multi_line) or reading(spark, path)
    if not plain and header is None:
        require_one_header(spark, path, encoding)

    def cell(name: str, value: Column) -> Column:
        value = F.coalesce(value, F.lit(""))
        return (clean_currency(value) if name == currency_column else value).alias(name)

    if way == "records":
        rows, value = parsed_records(spark, path, read_names, encoding, plain)
        cells = [cell(name, value[name]) for name in wanted]
        if with_source:
            cells += [
                F.substring_index("path", "/", -1).alias("file_name"),
                F.when(F.col("cells")[RAW_RECORD].isNotNull(), F.col("raw")).alias("raw_record"),
                F.coalesce(field_count(F.col("cells")[RAW_RECORD]), F.lit(len(read_names))).alias("field_count"),
                F.col("number").alias("record_number"),
            ]
        return rows.select(*cells)
    reader = csv_reader(spark, encoding, way == "whole").option("header", True).option("enforceSchema", not plain)
    raw = reader.schema(text_schema(read_names)).csv(path)
    return raw.select(*[cell(name, _quoted(name)) for name in wanted])


def parsed_records(spark: SparkSession, path: str | Sequence[str], names: Sequence[str], encoding: str, plain: bool) -> tuple[DataFrame, dict[str, Column]]:
    """Records without headers and blank lines, parsed into ``cells``, and the cell of each name.

    A file whose header is not made of the names fails the read, and is named, where the names are as they stand in the file.
    """
    schema = ", ".join([*(f"c{i} string" for i in range(len(names))), f"{RAW_RECORD} string"])
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW_RECORD}
    rows = csv_records(spark, path, encoding).where("record <> ''").withColumn("cells", F.from_csv("record", schema, options))
    value = {name: F.col("cells")[f"c{i}"] for i, name in enumerate(names)}
    is_header = F.col("header")
    if plain:
        alike = [F.lower(F.coalesce(value[name], F.lit(""))) == name.lower() for name in names]
        right = F.forall(F.array(*alike), lambda x: x) & F.col("cells")[RAW_RECORD].isNull()
        problem = F.raise_error(F.concat(F.lit("another header in "), F.col("path"))).cast("boolean")
        is_header = F.when(is_header & ~right, problem).otherwise(is_header)
    return rows.where(~is_header), value


def require_one_header(spark: SparkSession, path: str | Sequence[str], encoding: str = JAPANESE) -> None:
    headers = file_headers(spark, path, encoding).orderBy(F.size("files").desc(), "header").limit(2).collect()
    if len(headers) > 1:
        raise ValueError(f"headers differ: {headers[1]['files'][0]} does not begin like {headers[0]['files'][0]}")


def scan_mixed_feed(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], encoding: str = JAPANESE, **options) -> DataFrame:
    """Files whose headers hold the columns in any order, matched by name.

    There is one scan per distinct header. A file without one of the columns fails the read, and is named.
    """
    parts = []
    for row in file_headers(spark, path, encoding).collect():
        cells = next(csv.reader(io.StringIO(row["header"] or "")), [])
        missing = [c for c in columns if c not in normalise_header(cells)]
        if missing:
            raise ValueError(f"columns {missing} are not in the header of {row['files'][0]}")
        parts.append(scan_feed(spark, row["files"], columns, encoding, header=cells, **options))
    if not parts:
        raise ValueError(f"no header in {path}")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def field_count(record: Column) -> Column:
    """Number of fields of a raw record; commas inside quotes do not count.

    A doubled quote ends one quoted span and begins the next, so a plain span pattern is enough; it runs in
    linear time and constant stack.
    """
    fields = F.split(F.regexp_replace(record, r'"[^"]*+"', ""), ",", -1)
    return F.when(record.isNotNull(), F.size(fields))


@cache
def japanese_bytes() -> str:
    """The byte sequences of windows-31j as a pattern for bytes read one by one as characters.

    Made from the codec: the bytes that stand alone, and for each set of second bytes the first bytes that take it.
    """

    def known(*values: int) -> bool:
        try:
            bytes(values).decode("cp932")
        except UnicodeDecodeError:
            return False
        return True

    def listed(values: Sequence[int]) -> str:
        return "[" + "".join(f"\\x{v:02X}" for v in values) + "]"

    single = [a for a in range(256) if known(a)]
    pairs: dict[tuple[int, ...], list[int]] = {}
    for a in set(range(256)).difference(single):
        second = tuple(b for b in range(256) if known(a, b))
        if second:
            pairs.setdefault(second, []).append(a)
    return "|".join([listed(single) + "++", *(listed(sorted(first)) + listed(second) for second, first in sorted(pairs.items()))])


def is_japanese(line: Column) -> Column:
    """Whether bytes are windows-31j throughout: nothing is left when all its sequences are taken out, from the left."""
    return F.regexp_replace(F.decode(line.cast("binary"), "ISO-8859-1"), japanese_bytes(), "") == ""


def file_encodings(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(path, file_name, encoding)`` of every file: UTF-8 if its bytes allow, else windows-31j.

    ``encoding`` is null where neither fits. Files are read as split, byte-true lines and only a
    yes or no per file is shuffled. The second test runs on lines that failed the first, with built-in functions too.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), "value"
    )
    utf8 = lines.groupBy("path", "file_name").agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"))
    others = lines.where(~F.is_valid_utf8("value"))
    japanese = others.groupBy("path").agg(
        F.bool_and(is_japanese(F.col("value"))).alias("japanese")
    )
    encoding = F.when(F.col("utf8"), "UTF-8").when(F.col("japanese"), JAPANESE)
    return utf8.join(japanese, "path", "left").select("path", "file_name", encoding.alias("encoding"))


def scan_any_encoding(spark: SparkSession, path: str | Sequence[str], **options) -> DataFrame:
    """CSV files of mixed encodings, each decoded by the encoding its bytes fit.

    Fails when a file fits none. The verdicts collected here are one short row per file, the
    same amount as the file list the driver holds anyway. All files must share one header.
    """
    verdicts = file_encodings(spark, path).collect()
    bad = sorted(v.file_name for v in verdicts if v.encoding is None)
    if bad:
        raise ValueError(f"no known encoding fits: {', '.join(bad)}")
    parts = []
    names: list[str] | None = None
    for encoding in ("UTF-8", JAPANESE):
        files = sorted(v.path for v in verdicts if v.encoding == encoding)
        if not files:
            continue
        part = scan_feed(spark, files, encoding=encoding, **options)
        if names is not None and part.columns != names:
            raise ValueError(f"headers differ: {names} and {part.columns}")
        names = part.columns
        parts.append(part)
    if not parts:
        raise ValueError(f"no rows in {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def folder_entries(spark: SparkSession, folder: str) -> DataFrame:
    """``(name, path, modified)`` of a folder's files, empty ones too, and of folders of part files written by Spark.

    The folder's listing comes from its file system; names that begin with a dot or an underscore are passed over. A folder of
    part files is as new as its newest file.
    """
    home = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = home.getFileSystem(spark._jsc.hadoopConfiguration())

    def newest(status) -> int:
        inside = system.listStatus(status.getPath()) if status.isDirectory() else ()
        return max((x.getModificationTime() for x in inside), default=status.getModificationTime())

    shown = [x for x in system.listStatus(home) if x.getPath().getName()[:1] not in "._"]
    rows = [(x.getPath().getName(), x.getPath().toString(), newest(x) / 1000) for x in shown]
    listed = spark.createDataFrame(rows, "name string, path string, at double")
    return listed.select("name", "path", F.timestamp_seconds("at").alias("modified"))


def latest_file(spark: SparkSession, folder: str, tokens: Sequence[str] = REPORT_TOKENS) -> DataFrame:
    """``(token, path, modified)``: the folder's newest entry whose name holds the token, ties to the later name."""
    hits = F.filter(F.array(*[F.lit(t) for t in tokens]), lambda t: F.contains("name", t))
    return (
        folder_entries(spark, folder)
        .select("path", "modified", F.explode(hits).alias("token"))
        .groupBy("token")
        .agg(F.max_by("path", F.struct("modified", "path")).alias("path"), F.max("modified").alias("modified"))
    )


def feed_file_names(run_date: dt.date, days_ago: int, suffixes: Mapping[str, str] = FEED_SUFFIXES) -> dict[str, str]:
    """Feed name to file name for the day ``days_ago`` days before ``run_date``."""
    day = (run_date - dt.timedelta(days=days_ago)).strftime("%Y%m%d")
    return {feed: f"{day}{suffix}" for feed, suffix in suffixes.items()}


@dataclass
class FeedScan(Mapping):
    """Feeds that were found with their files, and those that were not with the reason."""

    frames: dict[str, DataFrame] = field(default_factory=dict)
    paths: dict[str, str] = field(default_factory=dict)
    missing: dict[str, str] = field(default_factory=dict)

    def __getitem__(self, feed: str) -> DataFrame:
        return self.frames[feed]

    def __iter__(self) -> Iterator[str]:
        return iter(self.frames)

    def __len__(self) -> int:
        return len(self.frames)


def scan_feeds(spark: SparkSession, folder: str, files: Mapping[str, str], **options) -> FeedScan:
    """Read each feed's file; a missing or empty one is noted and does not stop the others.

    A file name is known by its day and its end: of files that begin with the same eight digits and end alike the
    newest is taken, whatever stands between.
    """
    listed = {row["name"]: row["modified"] for row in folder_entries(spark, folder).collect()}

    def known(name: str) -> str | None:
        day, end = name[:8], name[8:]
        like = [x for x in listed if day.isdigit() and end and x.startswith(day) and x.endswith(end)]
        return name if name in listed else max(like, key=lambda x: (listed[x], x), default=None)

    found = FeedScan()
    for feed, name in files.items():
        present = known(name)
        if present is None:
            found.missing[feed] = f"not found or empty: {name}"
            continue
        try:
            path = f"{folder.rstrip('/')}/{present}"
            found.frames[feed] = scan_feed(spark, path, **options)
            found.paths[feed] = path
        except ValueError as error:
            found.missing[feed] = str(error)
    return found
