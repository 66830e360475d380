"""Readers for the selector catalogue and the instruction text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.text import strip_u
from feedloom.sources.feeds import parsed_records, read_header
from feedloom.sources.records import REPLACE_BAD_BYTES, file_pieces, sections_of

CATALOGUE_COLUMNS = ("group", "name", "selector_type", "selector_value")

# Login selectors that hold when the catalogue file names none.
DEFAULT_SELECTORS = [
    ("login", "username", "xpath", '//input[@name="username" or @id="username" or contains(@class, "username")]'),
    ("login", "password", "xpath", '//input[@name="password" or @id="password" or @type="password"]'),
    (
        "login",
        "submit",
        "xpath",
        '//button[@type="submit" or contains(@class, "submit") or contains(@class, "login")]',
    ),
]


def scan_selectors(spark: SparkSession, path: str | Sequence[str], defaults: bool = True) -> DataFrame:
    """Catalogue ``(group, name, selector_type, selector_value)``, last entry of a name wins.

    The first file's header names the columns of all; without one of the four there are no entries. Files count in the order of
    their paths, entries by their record's number in the file: files are read in parts and partial results are merged by that order.
    """
    names = read_header(spark, path, "UTF-8")
    if set(CATALOGUE_COLUMNS) <= set(names):
        rows, cells = parsed_records(spark, path, names, "UTF-8", False)
        ordered = rows.select(*[cells[c].alias(c) for c in CATALOGUE_COLUMNS], F.struct("path", "number").alias("at"))
        last = F.max_by(F.struct("selector_type", "selector_value"), "at")
        read = ordered.groupBy("group", "name").agg(last.alias("s")).select("group", "name", "s.*")
    else:
        read = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in CATALOGUE_COLUMNS))
    return with_default_selectors(read) if defaults else read


def with_default_selectors(catalogue: DataFrame) -> DataFrame:
    """Add the built-in login selectors that the catalogue does not name."""
    spark = catalogue.sparkSession
    built_in = spark.createDataFrame(DEFAULT_SELECTORS, catalogue.select(*CATALOGUE_COLUMNS).schema)
    return catalogue.unionByName(built_in.join(catalogue, ["group", "name"], "left_anti"))


# Markers of the instruction text.
SECTION = "## "
URL_MARK = "--url"
CODE_MARK = "--ログインコード"
PREREQUISITE_MARK = "--前提操作"
PREREQUISITES = "前提操作"
ELEMENTS = "取得要素"
OPERATIONS = "操作手順"


def scan_instructions(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Instruction files as one row per section, with ``file_name``; see :func:`instruction_sections`.

    Files are read in parts, line by line. A section's number follows from the headings before it in its file, and only its own lines meet.
    """
    spark.conf.set(REPLACE_BAD_BYTES, "true")
    found = file_pieces(spark, path, sections_of(SECTION)).where("number > 0")
    text = F.replace(F.decode("raw", "UTF-8"), F.lit("\r\n"), F.lit("\n"))
    sections = found.select(
        F.substring_index("path", "/", -1).alias("file_name"),
        F.col("number").cast("int").alias("section_pos"),
        F.rtrim(F.substr(text, F.lit(len(SECTION) + 1)), F.lit("\r")).alias("body"),
    )
    return _read_sections(sections, "file_name")


def instruction_sections(texts: DataFrame, content: str, *keys: str) -> DataFrame:
    """Texts as one row per ``## n. name`` section.

    Columns: the keys, ``section_pos``, ``title``, ``section`` (name without number), ``url``,
    ``elements``, ``operations``, ``login_code`` and ``prerequisites`` (type and value).
    Each section is read on its own, so none takes in lines or the address of another.
    """
    clean = F.replace(F.col(content), F.lit("\r\n"), F.lit("\n"))
    pieces = F.split(clean, r"(?m)^## ", -1)
    sections = texts.select(*keys, F.posexplode(pieces).alias("section_pos", "body")).where("section_pos > 0")
    return _read_sections(sections, *keys)


def _read_sections(sections: DataFrame, *keys: str) -> DataFrame:
    """``(keys, section_pos, body)`` as the columns of :func:`instruction_sections`; a body begins behind its heading's mark."""
    lines = F.transform(F.split("body", "\n", -1), strip_u)
    rows = sections.select(*keys, "section_pos", lines.alias("lines")).withColumn("blocks", _blocks(F.col("lines")))
    title = F.concat(F.lit(SECTION), F.element_at("lines", 1))
    blocks = F.col("blocks")
    return rows.select(
        *keys,
        "section_pos",
        strip_u(title).alias("title"),
        F.regexp_replace(F.element_at("lines", 1), r"^\d+\.\s*", "").alias("section"),
        _address(F.col("lines")).alias("url"),
        _under(blocks, ELEMENTS).alias("elements"),
        _operations(_under(blocks, OPERATIONS)).alias("operations"),
        _line_after(F.col("lines"), CODE_MARK).alias("login_code"),
        _prerequisites(_under(blocks, PREREQUISITES)).alias("prerequisites"),
    )


def _next_line(lines: Column, line: Column) -> Column:
    """The line behind the first line equal to ``line``, null when it is blank or absent."""
    return F.nullif(F.try_element_at(lines, (F.array_position(lines, line) + 1).cast("int")), F.lit(""))


def _last_text(values: Column) -> Column:
    return F.coalesce(F.try_element_at(F.filter(values, lambda v: v.isNotNull()), F.lit(-1)), F.lit(""))


def _line_after(lines: Column, mark: str) -> Column:
    hits = F.filter(lines, lambda l: F.contains(l, F.lit(mark)) & ~F.contains(l, F.lit(URL_MARK)) & ~F.startswith(l, F.lit("@")))
    return _last_text(F.transform(hits, lambda l: _next_line(lines, l)))


def _address(lines: Column) -> Column:
    def candidate(line: Column) -> Column:
        return F.when(F.contains(line, F.lit(URL_MARK)), _next_line(lines, line)).when(
            F.startswith(line, F.lit("@")), strip_u(F.substr(line, F.lit(2)))
        )

    return _last_text(F.transform(lines, candidate))


def _blocks(lines: Column) -> Column:
    """Lines of a section as texts, one per heading: the heading's name, then its content lines.

    Address and login-code lines do not end a heading's content and are no content themselves.
    Blank lines go first, so a blank line can then mark where a heading starts.
    """

    def kept(line: Column) -> Column:
        aside = F.contains(line, F.lit(URL_MARK)) | F.startswith(line, F.lit("@")) | F.contains(line, F.lit(CODE_MARK))
        return (line != "") & ~aside & ~F.startswith(line, F.lit("##"))

    def marked(line: Column) -> Column:
        return (
            F.when(F.contains(line, F.lit(PREREQUISITE_MARK)), F.lit("\n" + PREREQUISITES))
            .when(F.startswith(line, F.lit("--")), F.concat(F.lit("\n"), strip_u(F.substr(line, F.lit(3)))))
            .otherwise(line)
        )

    # The first line is the title and never content.
    body = F.slice(lines, F.lit(2), F.greatest(F.size(lines), F.lit(1)))
    text = F.array_join(F.transform(F.filter(body, kept), marked), "\n")
    return F.split(F.concat(F.lit("\n"), text), "\n\n", -1)


def _under(blocks: Column, heading: str) -> Column:
    """Content lines under a heading."""
    named = F.filter(blocks, lambda b: F.substring_index(b, "\n", 1) == heading)
    rows = F.transform(named, lambda b: F.split(b, "\n", -1))
    return F.flatten(F.transform(rows, lambda r: F.slice(r, F.lit(2), F.size(r))))


def _operations(lines: Column) -> Column:
    found = F.transform(lines, lambda l: F.regexp_extract(l, r"^\p{Nd}+\.[\s\p{Z}]+(.+)$", 1))
    return F.transform(F.filter(found, lambda o: o != ""), strip_u)


def _prerequisites(lines: Column) -> Column:
    return F.transform(
        F.filter(lines, lambda l: F.contains(l, F.lit(" "))),
        lambda l: F.struct(
            F.substring_index(l, " ", 1).alias("type"), F.substr(l, F.instr(l, " ") + 1).alias("value")
        ),
    )


def find_section(sections: DataFrame, name: str) -> DataFrame:
    """Sections whose title holds the name."""
    return sections.where(F.contains("title", F.lit(name)))
