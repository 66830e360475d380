"""Helpers on arrays of elements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use the result many times, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def first(values: Column) -> Column:
    """First entry, null when there is none."""
    return F.try_element_at(values, F.lit(1))


def append_missing(items: Column, more: Column) -> Column:
    """``items`` followed by those of ``more`` not in it yet, each once, order kept."""
    return F.concat(items, F.array_except(more, items))


def below(element: Column, ancestor: Column) -> Column:
    """True when the element lies in the subtree of the other one."""
    return (element["pos"] > ancestor["pos"]) & (element["pos"] <= ancestor["last_pos"])


_START = "named_struct('text', '', 'upto', 0)"
_OWN = """(s, e) -> if(e.pos >= s.upto,
    named_struct('text', concat(s.text, repeat('0', e.pos - s.upto), '1'), 'upto', e.pos + 1), s)"""
_INSIDE = """(s, e) -> if(e.pos + 1 >= s.upto,
    named_struct('text', concat(s.text, repeat('0', e.pos + 1 - s.upto), repeat('1', e.last_pos - e.pos)),
    'upto', e.last_pos + 1), s)"""


def marks(elements: Column, inside: bool) -> Column:
    """A byte per page position up to the last one marked: ``1`` where an element of the array stands.

    With ``inside`` the positions below the elements are marked, not their own. Subtrees nest or
    lie apart, so elements inside an earlier one add nothing then. One pass over the array; a
    position is tested with :func:`is_marked` at once, however many elements there are.
    """
    add = F.expr(_INSIDE if inside else _OWN)
    return F.call_function("aggregate", elements, F.expr(_START), add, F.expr("s -> s.text")).cast("binary")


def is_marked(bytes_: Column, pos: Column) -> Column:
    return F.substring(bytes_, pos + 1, F.lit(1)) == F.lit(b"1")


def attr(element: Column, name: str) -> Column:
    return element["attrs"][name]


def attr_contains(element: Column, name: str, text: Column) -> Column:
    return F.coalesce(F.contains(element["attrs"][name], text), F.lit(False))


def class_has(element: Column, *words: str) -> Column:
    """True when the class text holds one of the words in any case."""
    classes = F.lower(F.coalesce(attr(element, "class"), F.lit("")))
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(classes, F.lit(word))
    return hit
