"""Operators on element records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.sources.pages import ELEMENT_LIST

# Elements left out of a section, full-width blanks included.
EXCLUDED_NAMES = {
    "detail_analytics": (
        "アカウントID　入力フィールド",
        "ログインID　入力フィールド",
        "パスワード　入力フィールド",
        "ログイン　クリックボタン",
    )
}


def is_excluded(section: Column, name: Column, exclusions: Mapping[str, Sequence[str]] = EXCLUDED_NAMES) -> Column:
    """True for a name on its section's list; an element without a name is on none."""
    unwanted = F.lit(False)
    for title, names in exclusions.items():
        unwanted = unwanted | ((section == title) & name.isin(*names))
    return F.coalesce(unwanted, F.lit(False))


def exclude_named(
    elements: DataFrame,
    exclusions: Mapping[str, Sequence[str]] = EXCLUDED_NAMES,
    section: str = "section",
    name: str = "element_name",
) -> DataFrame:
    """Drop the named elements of the named sections."""
    return elements.where(~is_excluded(F.col(section), F.col(name), exclusions))


def drop_blank_entries(entries: Column) -> Column:
    """Keep map entries with a value."""
    return F.map_filter(entries, lambda k, v: v.isNotNull() & (v != ""))


def elements_long(elements: DataFrame, *keys: str) -> DataFrame:
    """One row per selector and attribute: the keys, ``kind``, ``key``, ``value``.

    Blank values are left out of selectors only. Both maps are unfolded in one pass.
    """

    def entries(kind: str, column: Column) -> Column:
        return F.transform(
            F.map_entries(column),
            lambda e: F.struct(F.lit(kind).alias("kind"), e["key"].alias("key"), e["value"].alias("value")),
        )

    none = F.array().cast("array<struct<kind:string,key:string,value:string>>")
    both = F.concat(
        F.coalesce(entries("selector", drop_blank_entries(F.col("selectors"))), none),
        F.coalesce(entries("attribute", F.col("attributes")), none),
    )
    return elements.select(*keys, F.inline(both))


def parse_elements_json(text: Column) -> Column:
    """Reply text to its element array; text that is not one whole JSON object gives an empty array.

    The text is read as the only entry of an array, so anything behind the object makes it malformed.
    """
    replies = F.from_json(
        F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(ELEMENT_LIST), {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
    )
    elements = F.when(F.size(replies) == 1, F.element_at(replies, 1)["elements"])
    return F.coalesce(elements, F.array().cast(ELEMENT_LIST["elements"].dataType))


def elements_per_section(elements: DataFrame) -> DataFrame:
    return elements.groupBy("section").agg(F.count("*").alias("element_count"))
