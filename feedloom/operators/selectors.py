"""Selector catalogue operators."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.arrays import attr, bind, is_marked, marks
from feedloom.operators.html import Wanted, parse_pages, span_text
from feedloom.operators.selector_forms import BELOW, CHILD, ROOT, Form, Step, fits, fits_row, key_of, selector_forms
from feedloom.session import work_path

IN_PLACE = 200  # selectors that are evaluated as expressions where a page is parsed; more go by an index of elements
MATCH = "struct<pos:int,tag:string,text:string>"
TERM = T.StructType([T.StructField(n, T.StringType()) for n in ("op", "name", "value")])
FORMS = T.StructType(
    [
        T.StructField("group", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("form", T.IntegerType()),
        T.StructField("nth", T.IntegerType()),
        T.StructField("relations", T.ArrayType(T.StringType())),
        T.StructField("keys", T.ArrayType(T.ArrayType(TERM))),
        T.StructField("ways", T.ArrayType(T.ArrayType(T.ArrayType(TERM)))),
    ]
)
TESTED = ("pos", "parent_pos", "last_pos", "tag", "attrs", "text_nodes")  # what steps ask of an element
HITS = "array<struct<step:int,pos:int,parent_pos:int,last_pos:int>>"


def lookup_selector(requests: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Add type and value of the requested ``(group, name)``; null where there is none.

    No broadcast hint: the catalogue is small as a rule, and AQE broadcasts it when it is.
    """
    return requests.join(catalogue, ["group", "name"], "left")


def selectors_per_group(catalogue: DataFrame) -> DataFrame:
    return catalogue.groupBy("group").agg(F.count_distinct("name").alias("selector_count"))


def first_match(elements: Column, form: Form) -> Column:
    """The element a selector form means: of those that pass its steps the n-th in document order."""

    def narrow(above: Column | None, rest: Sequence[Step]) -> Column:
        (relation, ways), later = rest[0], rest[1:]

        def passes(e: Column) -> Column:
            if relation == ROOT:
                return fits(e, ways) & e["parent_pos"].isNull()
            if above is None:
                return fits(e, ways)
            return fits(e, ways) & is_marked(above, e["pos"] if relation == BELOW else e["parent_pos"])

        hits = F.filter(elements, passes)
        if not later:
            return F.try_element_at(hits, F.lit(form.nth))
        return bind(marks(hits, inside=later[0][0] == BELOW), lambda marked: narrow(marked, later))

    return narrow(None, form.steps)


def resolve_selectors(
    pages: DataFrame,
    catalogue: DataFrame,
    html: str = "html",
    requests: DataFrame | None = None,
    key: str = "page_id",
    hits_only: bool = False,
    in_place: int = IN_PLACE,
) -> DataFrame:
    """Evaluate catalogue selectors on pages.

    ``requests``, rows of ``(key, group, name)``, say which selectors a page is asked for: only those are evaluated, and only
    they give rows; the catalogue is cut down to them before anything else. Without requests every selector is tried on every
    page; ``hits_only`` then leaves out what was not found. Columns: the page's, ``group``, ``name``, ``supported``, ``found``, and
    ``pos``, ``tag`` and ``text`` of the first match. A page is parsed once.

    Up to ``in_place`` selectors become expressions and are evaluated where a page is parsed; then nothing but the requests, gathered by
    page, is shuffled. More selectors stay a table: see :func:`find_by_index`. The rows are the same, given one catalogue row for a name.
    """
    named = catalogue.select("group", "name", "selector_type", "selector_value")
    if requests is not None:
        # null-safe: a catalogue may have entries without a group
        wanted = requests.select(F.col("group").alias("_g"), F.col("name").alias("_n")).distinct()
        named = named.join(wanted, F.col("group").eqNullSafe(F.col("_g")) & F.col("name").eqNullSafe(F.col("_n")), "left_semi")
    rows = named.limit(in_place + 1).collect()
    if len(rows) > in_place:
        return _resolved_by_index(pages, named, html, requests, key, hits_only)
    if requests is not None:
        asked = requests.groupBy(key).agg(F.collect_set(F.struct("group", "name")).alias("_asked"))
        pages = pages.join(asked, key)
    parsed = parse_pages(pages, Wanted(text="span"), html)
    keep = [c for c in parsed.columns if c not in ("elements", "parse_error", "page_text", "_asked")]
    nothing = F.lit(None).cast(MATCH)

    def shown(form: Form) -> Column:
        def told(m: Column) -> Column:
            text = span_text(F.col("page_text"), m).alias("text")
            return F.when(m.isNotNull(), F.struct(m["pos"].alias("pos"), m["tag"].alias("tag"), text))

        return bind(first_match(F.col("elements"), form), told)

    def entry(row: Mapping[str, str]) -> Column:
        forms = selector_forms(row["selector_type"], row["selector_value"])
        name = (F.lit(row["group"]).cast("string").alias("group"), F.lit(row["name"]).cast("string").alias("name"))
        match = F.array_min(F.array_compact(F.array(*map(shown, forms)))) if forms else nothing
        made = F.struct(*name, F.lit(forms is not None).alias("supported"), match.alias("match"))
        return made if requests is None else F.when(F.array_contains("_asked", F.struct(*name)), made)

    shape = f"array<struct<group:string,name:string,supported:boolean,match:{MATCH}>>"
    entries = [entry(r.asDict()) for r in rows]
    listed = F.array_compact(F.array(*entries).cast(shape)) if entries else F.array().cast(shape)
    found = parsed.select(*keep, F.inline(listed))
    if hits_only:
        found = found.where("match is not null")
    return _result(found, keep)


def _result(found: DataFrame, keep: Sequence[str]) -> DataFrame:
    return found.select(
        *keep,
        "group",
        "name",
        "supported",
        F.col("match").isNotNull().alias("found"),
        F.col("match.pos").alias("pos"),
        F.col("match.tag").alias("tag"),
        F.col("match.text").alias("text"),
    )


def form_rows(catalogue: DataFrame) -> DataFrame:
    """Catalogue rows as one row per form, tests and relations as data; a selector that is not supported gives one row without steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        term = lambda t: dict(zip(("op", "name", "value"), t, strict=True))
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                forms = selector_forms(r["selector_type"], r["selector_value"])
                if forms is None:
                    out.append({"group": r["group"], "name": r["name"]})
                for i, form in enumerate(forms or []):
                    steps = {
                        "relations": [relation for relation, _ in form.steps],
                        "keys": [[term(key_of(way)) for way in ways] for _, ways in form.steps],
                        "ways": [[list(map(term, way)) for way in ways] for _, ways in form.steps],
                    }
                    out.append({"group": r["group"], "name": r["name"], "form": i, "nth": form.nth, **steps})
            yield pa.RecordBatch.from_pylist(out, to_arrow_schema(FORMS))

    return catalogue.select("group", "name", "selector_type", "selector_value").mapInArrow(run, FORMS)


def _kept(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hashed(op: Column | str, name: Column | str, value: Column | str) -> Column:
    return F.xxhash64(*(F.lit(x) if isinstance(x, str) else x for x in (op, name, value)))


def element_keys(e: Column) -> Column:
    """Hashes of all that an index holds of an element: tag, attributes with and without their values, classes."""
    pairs = F.map_entries(e["attrs"])
    classes = F.filter(F.split(F.coalesce(attr(e, "class"), F.lit("")), r"\s"), lambda c: c != "")
    return F.array_distinct(
        F.concat(
            F.array(_hashed("any", "", ""), _hashed("tag", "", e["tag"])),
            F.transform(pairs, lambda p: _hashed("has", p["key"], "")),
            F.transform(pairs, lambda p: _hashed("equals", p["key"], p["value"])),
            F.transform(classes, lambda c: _hashed("class", "", c)),
        )
    )


def find_by_index(parsed: DataFrame, forms: DataFrame) -> DataFrame:
    """``(_row, form_id, pos)``: what each form means on each page.

    ``parsed``: ``(_row, elements)``; ``forms``: rows of :func:`form_rows` with a ``form_id``. Elements meet steps by a key that both
    have (the rarest of a step's: an id or other attribute value, a class, an attribute, a tag), and the step's test is
    verified. Only elements with a key that some step asks for enter the index.

    Each form first meets the elements of one step, the one whose keys fewest elements have; its other steps are looked for on the
    pages found so and nowhere else. A common outer step (``ul > li.c17``) thus costs nothing on pages without the rare one. The
    matches of a page and a form then meet, at most the page's elements for each step, and steps are checked from the
    outermost inwards by positions and subtrees.
    """
    steps = forms.where("relations is not null").select(
        "form_id", F.posexplode(F.arrays_zip("keys", "ways")).alias("step", "test")
    )
    keyed = steps.select("form_id", "step", F.col("test.ways").alias("ways"), F.explode("test.keys").alias("k"))
    keyed = keyed.select("form_id", "step", "ways", _hashed(F.col("k.op"), F.col("k.name"), F.col("k.value")).alias("key")).distinct()
    keyed = _kept(keyed, "selector-keys")
    # places go by key, which are narrow; the elements are put to those that are left
    places = parsed.select("_row", F.posexplode("elements").alias("at", "e")).select("_row", "at", F.explode(element_keys(F.col("e"))).alias("key"))
    asked = places.join(keyed.select("key").distinct(), "key", "left_semi")
    element = F.try_element_at("elements", F.col("at") + 1)
    tested = F.struct(*(element[name].alias(name) for name in TESTED))
    index = _kept(asked.join(parsed, "_row").select("_row", "key", tested.alias("e")), "element-index")
    counts = index.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    sizes = keyed.join(counts, "key", "left").groupBy("form_id", "step").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    rarest = sizes.groupBy("form_id").agg(F.min(F.struct("n", "step")).alias("least")).where("least.n > 0")
    leading = keyed.join(rarest.select("form_id", F.col("least.step").alias("step")), ["form_id", "step"])
    fitting = fits_row(F.col("e"), F.col("ways"))
    found = index.join(leading, "key").where(fitting).select("_row", "form_id").distinct()
    met = found.join(keyed, "form_id").join(index, ["_row", "key"]).where(fitting)
    hit = F.struct(F.col("step").cast("int").alias("step"), "e.pos", "e.parent_pos", "e.last_pos")
    grouped = met.groupBy("_row", "form_id").agg(F.array_sort(F.collect_set(hit)).alias("hits"))
    whole = grouped.join(forms.select("form_id", "relations", "nth"), "form_id").where(F.size(F.array_distinct("hits.step")) == F.size("relations"))

    def narrow(state: Column, i: Column) -> Column:
        relation, after = F.try_element_at("relations", i + 1), F.try_element_at("relations", i + 2)

        def passes(m: Column) -> Column:
            placed = (
                F.when(relation == ROOT, m["parent_pos"].isNull())
                .when(state["marked"].isNull(), True)
                .when(relation == CHILD, is_marked(state["marked"], m["parent_pos"]))
                .otherwise(is_marked(state["marked"], m["pos"]))
            )
            return (m["step"] == i) & F.coalesce(placed, F.lit(False))

        def marked(hits: Column) -> Column:
            return F.struct(F.when(after == BELOW, marks(hits, True)).otherwise(marks(hits, False)).alias("marked"), hits.alias("hits"))

        return bind(F.filter("hits", passes), marked)

    start = F.struct(F.lit(None).cast("binary").alias("marked"), F.array().cast(HITS).alias("hits"))
    last = F.aggregate(F.sequence(F.lit(0), F.size("relations") - 1), start, narrow)["hits"]
    return whole.select("_row", "form_id", F.try_element_at(last, F.col("nth"))["pos"].alias("pos")).where("pos is not null")


def _resolved_by_index(pages: DataFrame, named: DataFrame, html: str, requests: DataFrame | None, key: str, hits_only: bool) -> DataFrame:
    """``resolve_selectors`` for catalogues of any size: parsed pages and forms are written, and meet by :func:`find_by_index`.

    Rows without a match are the requests themselves, or all pairs of a page and a selector if neither requests nor ``hits_only``
    say less: that is what is asked for then.
    """
    if requests is not None:
        asked = requests.select(key, "group", "name").distinct()
        pages = pages.join(asked.select(key).distinct(), key, "left_semi")
    parsed = _kept(parse_pages(pages, Wanted(text="span"), html).withColumn("_row", F.monotonically_increasing_id()), "parsed-pages")
    keep = [c for c in parsed.columns if c not in ("elements", "parse_error", "page_text", "_row")]
    forms = _kept(form_rows(named).withColumn("form_id", F.monotonically_increasing_id()), "selector-forms")
    best = find_by_index(parsed.select("_row", "elements"), forms).join(forms.select("form_id", "group", "name"), "form_id")
    first = best.groupBy("_row", "group", "name").agg(F.min("pos").alias("pos"))
    element = F.try_element_at("elements", F.col("pos") + 1)
    text = span_text(F.col("page_text"), element)
    match = F.struct("pos", element["tag"].alias("tag"), text.alias("text")).alias("match")
    if hits_only and requests is None:  # the matches are all there is
        return _result(first.join(parsed, "_row").select(*keep, "group", "name", F.lit(True).alias("supported"), match), keep)
    shown = first.join(parsed, "_row").select("_row", "group", "name", match)
    listed = forms.groupBy("group", "name").agg(F.bool_and(F.col("relations").isNotNull()).alias("supported"))
    plain = parsed.select("_row", *keep)
    pair = lambda a, b: F.col(f"{a}.group").eqNullSafe(F.col(f"{b}.group")) & F.col(f"{a}.name").eqNullSafe(F.col(f"{b}.name"))
    if requests is not None:
        rows = plain.join(asked, key).alias("a").join(listed.alias("b"), pair("a", "b")).select("a.*", "b.supported")
    else:
        rows = plain.crossJoin(listed)
    found = rows.alias("a").join(shown.alias("b"), (F.col("a._row") == F.col("b._row")) & pair("a", "b"), "inner" if hits_only else "left")
    return _result(found.select("a.*", "b.match"), keep)


def check_selectors(pages: DataFrame, elements: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Element records with ``selector_found``: does their page have a tag of that id, or else name?

    Null where a record gives neither. Pages come down to their ids and names before the join, and are merged, never broadcast.
    """
    parsed = parse_pages(pages.select(key, html), Wanted(attributes=("id", "name"), text="none"), html)
    named = parsed.select(
        key,
        F.transform("elements", lambda e: attr(e, "id")).alias("_ids"),
        F.transform("elements", lambda e: attr(e, "name")).alias("_names"),
    )
    id_, name = F.col("selectors")["id"], F.col("selectors")["name"]
    found = F.when(id_ != "", F.exists("_ids", lambda v: F.coalesce(v == id_, F.lit(False)))).when(
        name != "", F.exists("_names", lambda v: F.coalesce(v == name, F.lit(False)))
    )
    given = F.coalesce(id_ != "", F.lit(False)) | F.coalesce(name != "", F.lit(False))
    joined = elements.join(named.hint("merge"), key, "left")
    return joined.withColumn("selector_found", F.when(given, F.coalesce(found, F.lit(False)))).drop("_ids", "_names")
