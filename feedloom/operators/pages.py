"""Page reports over parsed pages. None of them shuffles: a page's tags lie in its own row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.arrays import append_missing, attr, bind, class_has, first, is_marked, marks
from feedloom.operators.html import Wanted, parse_pages, span_text

# Words in class names that mark errors and menus, and the element types,
# attributes and selector kinds of the inventory.
ERROR_WORDS = ("error", "alert")
MENU_WORDS = ("menu", "nav")
INVENTORY_TAGS = ("a", "button", "input", "select", "textarea")
INVENTORY_ATTRIBUTES = ("type", "placeholder", "value", "href", "title", "aria-label", "alt")

PROFILE = Wanted(tags=("title", "h1", "a", "button", "nav"), class_words=ERROR_WORDS, text="span")

TextOf = Callable[[Column], Column]


def own_text(e: Column) -> Column:
    return e["text"]


def first_of(elements: Column, tag: str, text: TextOf = own_text) -> Column:
    """Text of the first element of a tag in document order, null without one."""
    return bind(first(F.filter(elements, lambda e: e["tag"] == tag)), lambda e: F.when(e.isNotNull(), text(e)))


def texts_of(elements: Column, text: TextOf = own_text) -> Column:
    """Non-empty texts of elements, in document order."""
    return F.filter(F.transform(elements, text), lambda t: t != "")


def error_texts(elements: Column, text: TextOf = own_text) -> Column:
    return texts_of(F.filter(elements, lambda e: class_has(e, *ERROR_WORDS)), text)


def menu_texts(elements: Column, text: TextOf = own_text) -> Column:
    """Links and buttons of a menu class, then links inside ``nav`` that are not listed yet."""
    marked = F.filter(elements, lambda e: e["tag"].isin("a", "button") & class_has(e, *MENU_WORDS))
    linked = bind(
        marks(F.filter(elements, lambda e: e["tag"] == "nav"), inside=True),
        lambda navs: F.filter(elements, lambda e: (e["tag"] == "a") & is_marked(navs, e["pos"])),
    )
    return append_missing(texts_of(marked, text), texts_of(linked, text))


def page_profile(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title, first heading, error texts and menu texts of each page.

    The page's text comes once from the parser, and only reported elements' parts are cut out, so
    links that were never closed, and so hold one another, cost nothing unless they are reported.
    """
    parsed = parse_pages(pages, PROFILE, html)
    keep = [c for c in parsed.columns if c not in ("elements", "parse_error", "page_text")]
    elements = F.col("elements")

    def text(e: Column) -> Column:
        return span_text(F.col("page_text"), e)

    return parsed.select(
        *keep,
        F.coalesce(first_of(elements, "title", text), F.lit("")).alias("page_title"),
        F.coalesce(first_of(elements, "h1", text), F.lit("")).alias("main_heading"),
        error_texts(elements, text).alias("error_messages"),
        menu_texts(elements, text).alias("menu_items"),
    )


def elements_per_page(pages: DataFrame, html: str = "html") -> DataFrame:
    """Number of tags on each page."""
    parsed = parse_pages(pages, Wanted(text="none", attrs=False), html)
    keep = [c for c in parsed.columns if c not in ("elements", "parse_error")]
    return parsed.select(*keep, F.size("elements").cast("bigint").alias("element_count"))


def find_elements(pages: DataFrame, tag: str, text_filter: str | None = None, html: str = "html") -> DataFrame:
    """Elements of a tag, only those whose text holds ``text_filter`` when one is given.

    The text is that of the HTML: what a style hides counts as well.
    """
    parsed = parse_pages(pages, Wanted(tags=(tag,)), html)
    keep = [c for c in parsed.columns if c not in ("elements", "parse_error")]

    def fits(e: Column) -> Column:
        hit = e["tag"] == tag
        return hit & F.contains(e["text"], F.lit(text_filter)) if text_filter else hit

    found = parsed.select(*keep, F.filter("elements", fits).alias("elements"))
    return found.select(*keep, F.inline("elements")).select(*keep, "pos", "tag", "attrs", "text")


def _xpath(e: Column) -> Column:
    id_, name = attr(e, "id"), attr(e, "name")
    return (
        F.when(F.length(id_) > 0, F.concat(F.lit("//"), e["tag"], F.lit("[@id='"), id_, F.lit("']")))
        .when(F.length(name) > 0, F.concat(F.lit("//"), e["tag"], F.lit("[@name='"), name, F.lit("']")))
        .otherwise(F.concat(F.lit("(//*)["), (e["pos"] + 1).cast("string"), F.lit("]")))
    )


def _css(e: Column) -> Column:
    id_, classes = attr(e, "id"), F.trim(F.regexp_replace(attr(e, "class"), r"\s+", " "))
    return (
        F.when(F.length(id_) > 0, F.concat(F.lit("#"), id_))
        .when(F.length(classes) > 0, F.concat(e["tag"], F.lit("."), F.replace(classes, F.lit(" "), F.lit("."))))
        .otherwise(F.lit(""))
    )


def element_record(e: Column) -> Column:
    """An element as inventory record: name, type, selectors, main attributes and visible text."""
    id_ = F.coalesce(attr(e, "id"), F.lit(""))
    name = F.coalesce(attr(e, "name"), F.lit(""))
    label = F.coalesce(
        F.nullif(e["text"], F.lit("")),
        F.nullif(attr(e, "aria-label"), F.lit("")),
        F.nullif(attr(e, "placeholder"), F.lit("")),
        F.nullif(name, F.lit("")),
        F.nullif(id_, F.lit("")),
        F.concat(e["tag"], F.lit("_"), e["pos"].cast("string")),
    )
    selectors = F.create_map(
        F.lit("id"), id_, F.lit("name"), name, F.lit("css"), _css(e), F.lit("xpath"), _xpath(e)
    )
    best = F.coalesce(
        F.nullif(id_, F.lit("")), F.nullif(name, F.lit("")), F.nullif(_css(e), F.lit("")), _xpath(e)
    )
    return F.struct(
        e["pos"].alias("pos"),
        label.alias("element_name"),
        F.when(e["tag"] == "a", F.lit("link")).otherwise(e["tag"]).alias("element_type"),
        selectors.alias("selectors"),
        best.alias("best_selector"),
        F.map_filter(e["attrs"], lambda k, v: k.isin(*INVENTORY_ATTRIBUTES)).alias("attributes"),
        e["text"].alias("visible_text"),
    )


def page_inventories(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with their inventory records as an array ``records``."""
    parsed = parse_pages(pages, Wanted(tags=INVENTORY_TAGS), html)
    keep = [c for c in parsed.columns if c not in ("elements", "parse_error")]
    return parsed.select(*keep, F.transform("elements", element_record).alias("records"))


def element_inventory(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per link, button, input, select and text area of each page.

    The best selector is the id, else the name, else CSS, else XPath.
    """
    listed = page_inventories(pages, html)
    keep = [c for c in listed.columns if c != "records"]
    return listed.select(*keep, F.inline("records"))
