"""Text and number cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FULL_WIDTH = "０１２３４５６７８９"
ASCII = "0123456789"
QUOTES = "\"'"
# Every character that Unicode counts as white space or a separator, and the four separators among the control characters.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip_u(c: Column) -> Column:
    """Remove any Unicode white space at both ends (Spark's ``trim`` knows U+0020 only)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip_u(c) == "")


def collapse_spaces(c: Column) -> Column:
    """White space runs become one blank, ends are trimmed: text as a page shows it."""
    return F.trim(F.regexp_replace(c, r"[ \t\r\n\f]+", " "))


def ascii_digits(c: Column) -> Column:
    return F.translate(c, FULL_WIDTH, ASCII)


def unquote(c: Column) -> Column:
    """Strip surrounding single and double quotes."""
    return F.btrim(c, F.lit(QUOTES))


def mask(c: Column, keep: int = 30) -> Column:
    """The first ``keep`` characters and ``...`` when there are more."""
    return F.when(F.length(c) > keep, F.concat(F.left(c, F.lit(keep)), F.lit("..."))).otherwise(c)


def truncate_text(c: Column, limit: int, marker: str = "") -> Column:
    """Cut to ``limit`` characters; ``marker`` is added only when something was cut."""
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit)), F.lit(marker))).otherwise(c)


def quoted_argument(c: Column) -> Column:
    """Text between 「 and 」 or double quotes; null when there is none."""
    pattern = '[「"](.*?)[」"]'
    return F.when(F.regexp_like(c, F.lit(pattern)), F.regexp_extract(c, pattern, 1))


def clean_currency(c: Column) -> Column:
    """Keep digits of any script and dots; a value without any stays as it is."""
    kept = F.regexp_replace(c, r"[^\p{Nd}.]", "")
    return F.when(kept == "", c).otherwise(kept)


def to_number(c: Column) -> Column:
    """Text to double. Anything that is not a plain decimal number becomes null.

    The pattern keeps out Java's ``1d`` / ``1f`` spellings and ``nan``.
    """
    text = F.btrim(c.cast("string"), F.lit(" \t\r\n\f\x0b"))
    numeric = F.regexp_like(
        text, F.lit(r"(?i)^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?$|^[+-]?inf(inity)?$")
    )
    return F.when(numeric, text.try_cast("double"))


def whole_number_text(c: Column) -> Column:
    """Number to text without decimals, ties to even, null and NaN to an empty text."""
    number = c.cast("double")
    whole = F.rint(number)
    zero = F.when(F.startswith(number.cast("string"), F.lit("-")), F.lit("-0")).otherwise(F.lit("0"))
    return (
        F.when(c.isNull() | F.isnan(whole), F.lit(""))
        .when(whole == 0, zero)
        # Longs print fast and exactly; the formatter covers the rest.
        .when(F.abs(whole) < F.lit(9.0e18), whole.try_cast("bigint").cast("string"))
        .otherwise(F.format_string("%.0f", whole))
    )


def coerce_scalar(c: Column) -> Column:
    """Setting text to a typed value: digits, digits with one dot, true/false, else text.

    Signs are not numbers here: ``-5`` is text, ``.5`` and ``1.`` are doubles.
    """
    digits = F.regexp_like(c, F.lit(r"^\p{Nd}+$"))
    dotted = F.regexp_like(c, F.lit(r"^(\p{Nd}+\.\p{Nd}*|\.\p{Nd}+)$"))
    truth = F.lower(c).isin("true", "false")
    kind = (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(digits, "int")
        .when(dotted, "double")
        .when(truth, "bool")
        .otherwise("text")
    )
    number = ascii_digits(c)
    return F.struct(
        kind.alias("kind"),
        F.when(digits, number.try_cast("decimal(38,0)")).alias("int_value"),
        F.when(dotted, number.try_cast("double")).alias("double_value"),
        F.when(~digits & ~dotted & truth, F.lower(c) == "true").alias("bool_value"),
        c.alias("text"),
    )
