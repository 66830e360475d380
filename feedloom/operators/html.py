"""Page HTML to elements: the only step that needs Python workers.

``parse_pages`` replaces the ``html`` column of a page table by an ``elements`` array, one
entry per tag in document order. Page operators then work inside that array, so nothing is
shuffled between parsing a page and reporting on it. ``html_elements`` gives the same as a
flat table.

Parsing rules: void tags close at once; an end tag closes up to the nearest open tag of its
name and is ignored when there is none; tags left open end with the page. ``text`` is all text
below the tag without scripts, styles, templates, ruby notes and comments, entities decoded,
stripped at both ends; ``text_nodes`` are the tag's own text pieces as they stand.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import strip_u

ELEMENTS = T.ArrayType(
    T.StructType(
        [
            T.StructField("pos", T.IntegerType()),
            T.StructField("parent_pos", T.IntegerType()),
            T.StructField("last_pos", T.IntegerType()),
            T.StructField("tag", T.StringType()),
            T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
            T.StructField("text_at", T.IntegerType()),
            T.StructField("text_size", T.IntegerType()),
            T.StructField("text", T.StringType()),
            T.StructField("text_nodes", T.ArrayType(T.StringType())),
        ]
    )
)

# Tags without content, and tags whose text is not page text.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
SILENT_TAGS = frozenset("rp rt script style template".split())

BYTES_PER_BATCH = 4 << 20


@dataclass(frozen=True)
class Wanted:
    """Which tags leave the parser. A tag is kept when any rule holds; no rules keeps all.

    ``text`` is ``'full'`` (each element carries its text), ``'span'`` (the page carries its text
    once as ``page_text`` and :func:`span_text` cuts an element's part out) or ``'none'``. Text of
    nested containers repeats page text, so keep few tags with ``'full'``, or use ``'span'``.
    ``attrs=False`` leaves the attribute maps empty where only tags are counted.
    """

    tags: Sequence[str] = ()
    class_words: Sequence[str] = ()
    attributes: Sequence[str] = ()
    text: str = "full"
    attrs: bool = True

    def keeps(self, tag: str, attrs: dict[str, str]) -> bool:
        if not (self.tags or self.class_words or self.attributes):
            return True
        if tag in self.tags or any(a in attrs for a in self.attributes):
            return True
        classes = attrs.get("class", "").lower()
        return bool(classes) and any(w in classes for w in self.class_words)


class _PageReader(HTMLParser):
    """Notes for every tag where it starts, where its subtree ends and which text lies inside."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags: list[str] = []
        self.attrs: list[dict[str, str]] = []
        self.parents: list[int | None] = []
        self.last: list[int] = []
        self.text_span: list[list[int]] = []
        self.nodes: list[list[str]] = []
        self.chunks: list[str] = []
        self._open: list[int] = []
        self._open_count: Counter[str] = Counter()
        self._silent = 0
        self._joined = False

    def handle_starttag(self, tag, attrs):
        pos = len(self.tags)
        self.tags.append(tag)
        self.attrs.append({name: value or "" for name, value in attrs})
        self.parents.append(self._open[-1] if self._open else None)
        self.last.append(pos)
        self.text_span.append([len(self.chunks), len(self.chunks)])
        self.nodes.append([])
        self._joined = False
        if tag not in VOID_TAGS:
            self._open.append(pos)
            self._open_count[tag] += 1
            self._silent += tag in SILENT_TAGS

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._close_top()

    def handle_endtag(self, tag):
        if self._open_count[tag]:
            while self._close_top() != tag:
                pass

    def handle_data(self, data):
        if self._silent or not data:
            return
        self.chunks.append(data)
        if self._open:
            nodes = self.nodes[self._open[-1]]
            if self._joined:
                nodes[-1] += data
            else:
                nodes.append(data)
            self._joined = True

    def handle_comment(self, data):
        self._joined = False

    def _close_top(self) -> str:
        pos = self._open.pop()
        self.last[pos] = len(self.tags) - 1
        self.text_span[pos][1] = len(self.chunks)
        self._open_count[self.tags[pos]] -= 1
        self._silent -= self.tags[pos] in SILENT_TAGS
        self._joined = False
        return self.tags[pos]

    def read(self, html: str) -> None:
        self.feed(html)
        self.close()
        while self._open:
            self._close_top()


def _portions(pages: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and length of runs of pages of a few megabytes, so results are handed on in small batches."""
    start = total = 0
    for i, size in enumerate(pc.binary_length(pages).to_pylist()):
        if i > start and total + (size or 0) > BYTES_PER_BATCH:
            yield start, i - start
            start, total = i, 0
        total += size or 0
    if len(pages) > start:
        yield start, len(pages) - start


def _to_arrow(pages: Sequence[str | None], wanted: Wanted) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Element lists of some pages as one Arrow list column, with error texts and page texts."""
    ends, errors, page_texts = [0], [], []
    pos, parent, last, tags, texts = [], [], [], [], []
    text_at, text_size = [], []
    attr_ends, attr_names, attr_values = [0], [], []
    node_ends, nodes = [0], []
    for html in pages:
        reader = _PageReader()
        error = None
        try:
            reader.read(html or "")
        except Exception as problem:  # a page the parser gives up on counts as empty
            error, reader = f"{type(problem).__name__}: {problem}", _PageReader()
        chunk_at = [0, *accumulate(len(chunk) for chunk in reader.chunks)]
        page_texts.append("".join(reader.chunks) if wanted.text == "span" else None)
        for i, tag in enumerate(reader.tags):
            attrs = reader.attrs[i]
            if not wanted.keeps(tag, attrs):
                continue
            pos.append(i)
            parent.append(reader.parents[i])
            last.append(reader.last[i])
            tags.append(tag)
            if wanted.attrs:
                attr_names.extend(attrs.keys())
                attr_values.extend(attrs.values())
            attr_ends.append(len(attr_names))
            start, end = reader.text_span[i]
            text_at.append(chunk_at[start])
            text_size.append(chunk_at[end] - chunk_at[start])
            texts.append("".join(reader.chunks[start:end]).strip() if wanted.text == "full" else None)
            if wanted.text != "none":
                nodes.extend(reader.nodes[i])
            node_ends.append(len(nodes))
        ends.append(len(pos))
        errors.append(error)
    string, int32 = pa.string(), pa.int32()
    elements = pa.StructArray.from_arrays(
        [
            pa.array(pos, int32),
            pa.array(parent, int32),
            pa.array(last, int32),
            pa.array(tags, string),
            pa.MapArray.from_arrays(pa.array(attr_ends, int32), pa.array(attr_names, string), pa.array(attr_values, string)),
            pa.array(text_at, int32),
            pa.array(text_size, int32),
            pa.array(texts, string),
            pa.ListArray.from_arrays(pa.array(node_ends, int32), pa.array(nodes, string)),
        ],
        names=[f.name for f in ELEMENTS.elementType.fields],
    )
    listed = pa.ListArray.from_arrays(pa.array(ends, int32), elements)
    return listed, pa.array(errors, string), pa.array(page_texts, string)


def span_text(page_text: Column, element: Column) -> Column:
    """Text of an element, cut out of the page's text."""
    return strip_u(F.substr(page_text, element["text_at"] + 1, element["text_size"]))


def spread(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Give every core some pages where a table has fewer partitions than there are cores.

    Parsing is the costly part, and a small file is one partition. Use it on a table as read from files, where the number of
    partitions is known without running anything. Large tables come with more partitions than cores and are not shuffled.
    """
    cores = pages.sparkSession.sparkContext.defaultParallelism
    return pages.repartition(cores, key) if pages.rdd.getNumPartitions() < cores else pages


def parse_pages(pages: DataFrame, wanted: Wanted = Wanted(), html: str = "html") -> DataFrame:
    """Replace the HTML column by ``elements`` and ``parse_error``; all other columns stay.

    Pages are parsed where they are, without a shuffle. Filters do not pass the Python step, so
    filter pages and drop columns before it.
    """
    keep = [f for f in pages.schema.fields if f.name != html]
    added = [T.StructField("elements", ELEMENTS), T.StructField("parse_error", T.StringType())]
    if wanted.text == "span":
        added.append(T.StructField("page_text", T.StringType()))
    schema = T.StructType(keep + added)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, count in _portions(batch.column(html)):
                part = batch.slice(start, count)
                made = _to_arrow(part.column(html).to_pylist(), wanted)
                columns = [part.column(f.name) for f in keep] + list(made[: len(added)])
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return pages.mapInArrow(parse, schema)


def html_elements(pages: DataFrame, wanted: Wanted = Wanted(), html: str = "html") -> DataFrame:
    """One row per element: the page's columns, then the element's with id, name and classes."""
    parsed = parse_pages(pages, wanted, html).drop("parse_error")
    keep = [c for c in parsed.columns if c != "elements"]
    return parsed.select(*keep, F.inline("elements")).select(
        *keep,
        "pos",
        "parent_pos",
        "last_pos",
        "tag",
        F.col("attrs")["id"].alias("id"),
        F.col("attrs")["name"].alias("name"),
        F.filter(F.split(F.col("attrs")["class"], r"\s+"), lambda c: c != "").alias("classes"),
        "attrs",
        "text",
        "text_nodes",
    )


# The parser travels with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
