"""Selector texts as tests on elements.

Supported CSS: tags, ``*``, ``#id``, ``.class``, ``[attr]``, ``[attr=v]``, ``[attr*=v]``, put together
with blank, ``>`` and comma. Supported XPath: ``/`` and ``//`` steps with a tag or ``*`` and conditions on
attributes and ``text()`` (equality, presence, ``contains``, joined by all ``or`` or all ``and``), ``|``
between paths, and ``(path)[n]``. Any other form is not supported and gives nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.operators.arrays import attr, first

ROOT, CHILD, BELOW = "root", "child", "below"
# What one element must have: an operation, an attribute's name and a value, empty where the operation takes none.
Term = tuple[str, str, str]
# A test holds in one of its ways if all terms of the way hold; a way without terms always holds.
Ways = tuple[tuple[Term, ...], ...]
Step = tuple[str, Ways]
ANY: Ways = ((),)


@dataclass(frozen=True)
class Form:
    """Steps from the outermost element inwards; of the last step's elements the n-th is meant."""

    steps: tuple[Step, ...]
    nth: int = 1


def has_class(e: Column, name: Column | str) -> Column:
    classes = F.concat(F.lit(" "), F.regexp_replace(attr(e, "class"), r"\s", " "), F.lit(" "))
    return F.contains(classes, F.concat(F.lit(" "), F.lit(name), F.lit(" ")))


# Null counts as false: an absent attribute gives null. XPath takes the first text piece in ``in_text``, and an empty
# text where there is none.
OPERATIONS = {
    "tag": lambda e, name, value: e["tag"] == value,
    "equals": lambda e, name, value: e["attrs"][name] == value,
    "contains": lambda e, name, value: F.contains(e["attrs"][name], value),
    "has": lambda e, name, value: e["attrs"][name].isNotNull(),
    "class": lambda e, name, value: has_class(e, value),
    "text": lambda e, name, value: F.array_contains(e["text_nodes"], value),
    "in_text": lambda e, name, value: F.contains(F.coalesce(first(e["text_nodes"]), F.lit("")), value),
    "never": lambda e, name, value: F.lit(False),
}


def fits(e: Column, ways: Ways) -> Column:
    """A known test on an element, as an expression."""

    def all_of(way: tuple[Term, ...]) -> Column:
        return reduce(and_, [OPERATIONS[op](e, F.lit(name), F.lit(value)) for op, name, value in way]) if way else F.lit(True)

    return reduce(or_, map(all_of, ways))


def fits_row(e: Column, ways: Column) -> Column:
    """A test that stands in a column, ``array<array<struct<op,name,value>>>``, on an element."""

    def holds(term: Column) -> Column:
        found = F.lit(False)
        for op, test in OPERATIONS.items():
            found = F.when(term["op"] == op, test(e, term["name"], term["value"])).otherwise(found)
        return F.coalesce(found, F.lit(False))

    return F.exists(ways, lambda way: F.forall(way, holds))


def key_of(way: tuple[Term, ...]) -> Term:
    """The term of a way that fewest elements are likely to fulfil, among those that an index of elements can hold."""
    rank = {"equals": 1, "class": 2, "contains": 3, "has": 3, "tag": 4}
    found = min((t for t in way if t[0] in rank), key=lambda t: (rank[t[0]], t[:2] != ("equals", "id")), default=("any", "", ""))
    return ("has", found[1], "") if found[0] == "contains" else found


def _tag(tag: str) -> tuple[Term, ...]:
    return () if tag == "*" else (("tag", "", tag.lower()),)


def _quiet(text: str) -> str:
    """The text with quoted parts blotted out, so separators are found outside them only."""
    return re.sub(r"\"[^\"]*\"|'[^']*'", lambda m: "_" * len(m.group()), text)


def _cut(text: str, separator: str) -> list[str]:
    """The text cut at separators outside quotes."""
    bounds = [0, *[p for cut in re.finditer(separator, _quiet(text)) for p in cut.span()], len(text)]
    return [text[bounds[i] : bounds[i + 1]] for i in range(0, len(bounds), 2)]


_CSS_PART = re.compile(
    r"""(?P<tag>^(?:\*|[A-Za-z][\w-]*))|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)"""
    r"""|\[(?P<attr>[\w-]+)(?:(?P<op>\*?=)(?P<q>["']?)(?P<val>[^\]"']*)(?P=q))?\]"""
)


def _css_compound(text: str) -> Ways | None:
    terms: list[Term] = []
    at = 0
    while at < len(text):
        part = _CSS_PART.match(text, at) if at == 0 or text[at] in "#.[" else None
        if part is None:
            return None
        at = part.end()
        if part["tag"]:
            terms += _tag(part["tag"])
        elif part["id"]:
            terms.append(("equals", "id", part["id"]))
        elif part["cls"]:
            terms.append(("class", "", part["cls"]))
        elif part["op"] is None:
            terms.append(("has", part["attr"].lower(), ""))
        elif part["op"] == "=":
            terms.append(("equals", part["attr"].lower(), part["val"]))
        elif part["val"]:
            terms.append(("contains", part["attr"].lower(), part["val"]))
        else:
            terms.append(("never", "", ""))
    return (tuple(terms),) if terms or text == "*" else None


def _css_form(text: str) -> Form | None:
    steps: list[Step] = []
    relation = BELOW
    for word in re.findall(r"(?:\[[^\]]*\]|[^\s>\[])+|>", text.strip()):
        if word == ">":
            if not steps or relation == CHILD:
                return None
            relation = CHILD
            continue
        ways = _css_compound(word)
        if ways is None:
            return None
        steps.append((relation, ways))
        relation = BELOW
    return Form(tuple(steps)) if steps and relation == BELOW else None


_XPATH_STEP = re.compile(r"(?P<axis>//?)(?P<tag>\*|[A-Za-z][\w-]*)(?:\[(?P<cond>(?:[^\]\"']|\"[^\"]*\"|'[^']*')*)\])?")
_XPATH_TERM = re.compile(
    r"""@(?P<attr>[\w-]+)\s*=\s*(?P<q>["'])(?P<value>.*?)(?P=q)$"""
    r"""|contains\(\s*@(?P<in_attr>[\w-]+)\s*,\s*(?P<q2>["'])(?P<part>.*?)(?P=q2)\s*\)$"""
    r"""|text\(\)\s*=\s*(?P<q3>["'])(?P<text>.*?)(?P=q3)$"""
    r"""|contains\(\s*text\(\)\s*,\s*(?P<q4>["'])(?P<in_text>.*?)(?P=q4)\s*\)$"""
    r"""|@(?P<present>[\w-]+)$"""
)


def _xpath_term(text: str) -> Term | None:
    term = _XPATH_TERM.match(text.strip())
    if term is None:
        return None
    if term["attr"]:
        return "equals", term["attr"], term["value"]
    if term["in_attr"]:
        return "contains", term["in_attr"], term["part"]
    if term["text"] is not None:
        return "text", "", term["text"]
    if term["in_text"] is not None:
        return "in_text", "", term["in_text"]
    return "has", term["present"], ""


def _xpath_condition(text: str) -> Ways | None:
    ways = [_cut(part, r"\s+and\s+") for part in _cut(text, r"\s+or\s+")]
    if len(ways) > 1 and any(len(way) > 1 for way in ways):
        return None
    terms = [[_xpath_term(t) for t in way] for way in ways]
    if any(t is None for way in terms for t in way):
        return None
    return tuple(map(tuple, terms))


def _xpath_form(text: str) -> Form | None:
    text = text.strip()
    numbered = re.match(r"^\((.*)\)\[([1-9]\d*)\]$", text)
    path, nth = (numbered[1].strip(), int(numbered[2])) if numbered else (text, 1)
    steps: list[Step] = []
    at = 0
    while at < len(path):
        found = _XPATH_STEP.match(path, at)
        condition = _xpath_condition(found["cond"]) if found and found["cond"] is not None else None
        if found is None or (found["cond"] is not None and condition is None):
            return None
        at = found.end()
        relation = BELOW if found["axis"] == "//" else CHILD if steps else ROOT
        steps.append((relation, tuple((*_tag(found["tag"]), *way) for way in condition or ANY)))
    return Form(tuple(steps), nth) if steps else None


def selector_forms(kind: str | None, value: str | None) -> list[Form] | None:
    """The forms of a catalogue selector, one unless it lists several; null when it is not supported."""
    if not kind or not value:
        return None
    kind = kind.lower()
    if kind == "css":
        forms = [_css_form(part) for part in _cut(value, ",")]
    elif kind == "xpath":
        forms = [_xpath_form(part) for part in _cut(value, r"\|")]
    elif kind in ("id", "name"):
        forms = [Form(((BELOW, ((("equals", kind, value),),)),))]
    elif kind == "class":
        forms = [Form(((BELOW, ((("class", "", value),),)),))]
    else:
        return None
    return forms if all(forms) else None
