"""Operation steps: what they ask for, and which element of a page they mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import ascii_digits, collapse_spaces, quoted_argument, strip_u
from feedloom.operators.arrays import attr, attr_contains, below, bind, first
from feedloom.operators.html import Wanted, parse_pages

# Words that name an operation, the particles behind its target, and the
# seconds waited when none are given.
CLICK, INPUT, SELECT, WAIT = "クリック", "入力", "選択", "待機"
CLICK_PARTICLE, INPUT_PARTICLE, SELECT_PARTICLE = "を", "に", "から"
WAIT_PATTERN = r"(\p{Nd}+)[\s\p{Z}]*秒"
DEFAULT_WAIT = 3


def classify_step(operation: Column) -> Column:
    """``click``, ``input``, ``select``, ``wait`` or ``unsupported``; the first word that occurs wins."""
    return (
        F.when(F.contains(operation, F.lit(CLICK)), "click")
        .when(F.contains(operation, F.lit(INPUT)), "input")
        .when(F.contains(operation, F.lit(SELECT)), "select")
        .when(F.contains(operation, F.lit(WAIT)), "wait")
        .otherwise("unsupported")
    )


def _target_and_value(operation: Column, particle: str) -> tuple[Column, Column, Column]:
    """Target before the particle, quoted value behind it, and the value when cut at the next particle."""
    rest = F.substr(operation, F.instr(operation, particle) + len(particle))
    whole = quoted_argument(rest)
    cut = quoted_argument(F.split_part(operation, F.lit(particle), F.lit(2)))
    target = F.when(F.contains(operation, F.lit(particle)) & whole.isNotNull(), strip_u(F.substring_index(operation, particle, 1)))
    return target, F.when(target.isNotNull(), whole), F.when(target.isNotNull(), cut)


def parse_step(operation: Column) -> Column:
    """A step as ``(kind, target, value, wait_seconds, malformed, readings_differ)``.

    The value is looked for in all that follows the first particle. ``readings_differ`` marks
    steps whose value would be cut if the text were split at a particle inside the value.
    """
    kind = classify_step(operation)
    click_text = F.replace(operation, F.lit(CLICK), F.lit(""))
    click = strip_u(F.substring_index(click_text, CLICK_PARTICLE, 1))
    in_target, in_value, in_cut = _target_and_value(operation, INPUT_PARTICLE)
    sel_target, sel_value, sel_cut = _target_and_value(operation, SELECT_PARTICLE)
    seconds = ascii_digits(F.nullif(F.regexp_extract(operation, WAIT_PATTERN, 1), F.lit(""))).try_cast("int")
    target = F.when(kind == "click", click).when(kind == "input", in_target).when(kind == "select", sel_target)
    value = F.when(kind == "input", in_value).when(kind == "select", sel_value)
    cut = F.when(kind == "input", in_cut).when(kind == "select", sel_cut)
    return F.struct(
        kind.alias("kind"),
        target.alias("target"),
        value.alias("value"),
        F.when(kind == "wait", F.coalesce(seconds, F.lit(DEFAULT_WAIT))).alias("wait_seconds"),
        (kind.isin("input", "select") & target.isNull()).alias("malformed"),
        (~F.equal_null(value, cut)).alias("readings_differ"),
    )


def parse_steps(steps: DataFrame, operation: str = "operation") -> DataFrame:
    return steps.withColumn("_step", parse_step(F.col(operation))).select(*steps.columns, "_step.*")


def section_steps(sections: DataFrame, *keys: str) -> DataFrame:
    """Operations of instruction sections as parsed rows: the keys, ``step``, ``operation`` and its parts."""
    rows = sections.select(*keys, F.posexplode("operations").alias("step", "operation"))
    return parse_steps(rows.withColumn("step", F.col("step") + 1))


def _enabled(e: Column) -> Column:
    return F.when(e.isNotNull() & attr(e, "disabled").isNull(), e)


def _first_node(e: Column) -> Column:
    return F.coalesce(first(e["text_nodes"]), F.lit(""))


def _labelled(e: Column, target: Column) -> Column:
    return (e["tag"] == "label") & (F.array_contains(e["text_nodes"], target) | F.contains(_first_node(e), target))


def _following(elements: Column, target: Column, *tags: str) -> Column:
    """First element of the tags that starts behind the first label of that text."""
    end = F.array_min(F.transform(F.filter(elements, lambda e: _labelled(e, target)), lambda e: e["last_pos"]))
    return bind(end, lambda at: first(F.filter(elements, lambda e: e["tag"].isin(*tags) & (e["pos"] > at))))


def _by_attr(elements: Column, name: str, target: Column) -> Column:
    return first(F.filter(elements, lambda e: F.coalesce(attr(e, name) == target, F.lit(False))))


def _found(rule: str, element: Column) -> Column:
    return bind(
        element,
        lambda e: F.when(
            e.isNotNull(),
            F.struct(F.lit(rule).alias("rule"), e["pos"].alias("pos"), e["tag"].alias("tag"), e["text"].alias("text")),
        ),
    )


def clickable(elements: Column, target: Column) -> Column:
    """Link text, part of a link text, text or label attributes: first rule with an enabled hit.

    When all first hits are disabled, the first hit of the last rule is taken all the same. A CSS
    search for the label attributes would come last, but finds nothing the rule before did not.
    """
    links = F.filter(elements, lambda e: e["tag"] == "a")
    exact = first(F.filter(links, lambda e: collapse_spaces(e["text"]) == target))
    part = first(F.filter(links, lambda e: F.contains(collapse_spaces(e["text"]), target)))
    loose = first(
        F.filter(
            elements,
            lambda e: (e["tag"].isin("a", "button") & F.contains(_first_node(e), target))
            | attr_contains(e, "title", target)
            | attr_contains(e, "aria-label", target)
            | attr_contains(e, "alt", target),
        )
    )
    return F.coalesce(
        _found("link_text", bind(exact, _enabled)),
        _found("partial_link_text", bind(part, _enabled)),
        _found("text_or_label", bind(loose, _enabled)),
        _found("forced", loose),
    )


def input_field(elements: Column, target: Column) -> Column:
    """Name, id, placeholder text, then the first field behind a label of that text."""
    hinted = first(
        F.filter(elements, lambda e: e["tag"].isin("input", "textarea") & attr_contains(e, "placeholder", target))
    )
    return F.coalesce(
        _found("name", _by_attr(elements, "name", target)),
        _found("id", _by_attr(elements, "id", target)),
        _found("placeholder", hinted),
        _found("label", _following(elements, target, "input", "textarea")),
    )


def option_of(elements: Column, target: Column, value: Column) -> Column:
    """The select of that name, id or label, and in it the option by text, value or 1-based place."""

    def only_select(e: Column) -> Column:
        return F.when(e["tag"] == "select", e)

    def labelled(rule: str, element: Column) -> Column:
        return bind(element, lambda e: F.when(e.isNotNull(), F.struct(F.lit(rule).alias("select_rule"), e.alias("field"))))

    field = F.coalesce(
        labelled("name", bind(_by_attr(elements, "name", target), only_select)),
        labelled("id", bind(_by_attr(elements, "id", target), only_select)),
        labelled("label", _following(elements, target, "select")),
    )

    def choose(found: Column) -> Column:
        options = F.filter(elements, lambda e: (e["tag"] == "option") & below(e, found["field"]))

        def pick(listed: Column) -> Column:
            shown = F.filter(listed, lambda o: collapse_spaces(o["text"]) == collapse_spaces(value))
            valued = F.filter(listed, lambda o: F.coalesce(attr(o, "value") == value, F.lit(False)))
            place = F.when(F.regexp_like(value, F.lit(r"^\p{Nd}+$")), ascii_digits(value).try_cast("int"))
            placed = F.when(place > 0, F.try_element_at(listed, place))
            return F.coalesce(
                _found("visible_text", bind(first(shown), _enabled)),
                _found("value", bind(first(valued), _enabled)),
                _found("index", bind(placed, _enabled)),
            )

        return F.when(
            found.isNotNull(),
            F.struct(
                found["select_rule"].alias("select_rule"),
                found["field"]["pos"].alias("select_pos"),
                bind(options, pick).alias("option"),
            ),
        )

    return bind(field, choose)


CLICK_TAGS = Wanted(tags=("a", "button"), attributes=("title", "aria-label", "alt"))
INPUT_TAGS = Wanted(tags=("input", "textarea", "label"), attributes=("name", "id"))
SELECT_TAGS = Wanted(tags=("select", "option", "label"), attributes=("name", "id"))


def _with_pages(pages: DataFrame, steps: DataFrame, wanted: Wanted, key: str, html: str) -> DataFrame:
    """Steps beside the elements of their page.

    Pages are parsed before the join, so what is shuffled is the few tags kept, not HTML. The
    join is on the page key; a page with very many steps is split by AQE's skew handling. A step
    whose page is not there stays, without a hit. Rows are merged, never broadcast: Spark judges the
    elements by the size of the pages' files, which tells little of theirs in memory.
    """
    parsed = parse_pages(pages.select(key, html), wanted, html).select(key, "elements")
    return steps.join(parsed.hint("merge"), key, "left")


def locate_clickable(pages: DataFrame, steps: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """For click steps ``(key, ..., target)``: ``rule``, ``pos``, ``tag``, ``text`` of the element meant."""
    both = _with_pages(pages, steps, CLICK_TAGS, key, html)
    found = both.select(*steps.columns, clickable(F.col("elements"), F.col("target")).alias("hit"))
    return found.select(*steps.columns, "hit.rule", "hit.pos", "hit.tag", "hit.text")


def locate_input(pages: DataFrame, steps: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """For input steps ``(key, ..., target)``: ``rule``, ``pos``, ``tag`` of the field meant."""
    both = _with_pages(pages, steps, INPUT_TAGS, key, html)
    found = both.select(*steps.columns, input_field(F.col("elements"), F.col("target")).alias("hit"))
    return found.select(*steps.columns, "hit.rule", "hit.pos", "hit.tag")


def locate_option(pages: DataFrame, steps: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """For select steps ``(key, ..., target, value)``: the select and the option meant."""
    both = _with_pages(pages, steps, SELECT_TAGS, key, html)
    hit = option_of(F.col("elements"), F.col("target"), F.col("value"))
    found = both.select(*steps.columns, hit.alias("hit"))
    return found.select(
        *steps.columns,
        "hit.select_rule",
        "hit.select_pos",
        F.col("hit.option.rule").alias("option_rule"),
        F.col("hit.option.pos").alias("option_pos"),
        F.col("hit.option.text").alias("option_text"),
    )
