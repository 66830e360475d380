"""Column functions against plain Python models written from their description."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.functions import dates as D
from feedloom.functions import text as X
from feedloom.functions import urls as U
from feedloom.sources.feeds import header_width, normalise_header, unique_names

# NUL is left out: no CSV or HTML value holds it.
LETTERS = st.text(
    st.sampled_from("ab0１２９.,-+ \t\n　 ￥円「」\"'/:?#;éñ～①") | st.characters(min_codepoint=33, max_codepoint=0x2FFF, blacklist_categories=["Cs"]),
    max_size=12,
)
MANY = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_currency_edges(values):
    got = values(X.clean_currency, ["￥1,200円", "-100", "なし", "３００.５円12", "1.2.3", "", None, "..."])
    assert got == ["1200", "100", "なし", "３００.５12", "1.2.3", "", None, "..."]


@MANY
@given(st.lists(LETTERS, min_size=40, max_size=80))
def test_currency_model(values, items):
    model = [re.sub(r"[^\d.]", "", v) or v for v in items]
    assert values(X.clean_currency, items) == model


@MANY
@given(st.lists(LETTERS, min_size=40, max_size=80))
def test_strip_model(values, items):
    assert values(X.strip_u, items) == [v.strip() for v in items]


def test_strip_wide_blanks(values):
    items = ["　期間　", "\n a \x1c", "\x85x ", " "]
    assert values(X.strip_u, items) == ["期間", "a", "x", ""]


def test_number_edges(values):
    items = ["1,200", " 12 ", "1d", "1f", "nan", "0x10", "1e3", "", "True", "inf", "-Infinity", "３", "-.5", "5.", ".", None, "1_0"]
    got = values(X.to_number, items)
    assert got == [None, 12.0, None, None, None, None, 1000.0, None, None, math.inf, -math.inf, None, -0.5, 5.0, None, None, None]


def test_whole_number_edges(values):
    items = [2.5, 3.5, -2.5, 0.5, -0.4, 1e18, 1234567.5, float("nan"), None]
    got = values(X.whole_number_text, items, "double")
    assert got == ["2", "4", "-2", "0", "-0", "1000000000000000000", "1234568", "", ""]


@MANY
@given(st.lists(st.floats(-1e15, 1e15), min_size=40, max_size=80))
def test_whole_number_model(values, items):
    assert values(X.whole_number_text, items, "double") == ["%.0f" % v for v in items]


def scalar_model(text):
    if re.fullmatch(r"\d+", text):
        return "int", int(text)
    if re.fullmatch(r"\d+", text.replace(".", "", 1)):
        return "double", float(text)
    if text.lower() in ("true", "false"):
        return "bool", text.lower() == "true"
    return "text", text


def scalar_value(row):
    key = {"int": "int_value", "double": "double_value", "bool": "bool_value", "text": "text"}[row["kind"]]
    return row["kind"], int(row[key]) if row["kind"] == "int" else row[key]


def test_scalar_edges(values):
    items = ["12", "-5", ".5", "1.", "1.2.3", "TRUE", "false", "", ".", "１２", "１.５", "yes"]
    assert [scalar_value(r) for r in values(X.coerce_scalar, items)] == [scalar_model(v) for v in items]


@MANY
@given(st.lists(st.text("019.tTrRuUeE-１", max_size=6), min_size=40, max_size=80))
def test_scalar_model(values, items):
    assert [scalar_value(r) for r in values(X.coerce_scalar, items)] == [scalar_model(v) for v in items]


@MANY
@given(st.lists(LETTERS, min_size=40, max_size=80))
def test_text_models(values, items):
    assert values(X.unquote, items) == [v.strip("\"'") for v in items]
    assert values(lambda c: X.mask(c, 5), items) == [v[:5] + "..." if len(v) > 5 else v for v in items]
    assert values(lambda c: X.truncate_text(c, 4, "!"), items) == [v[:4] + ("!" if len(v) > 4 else "") for v in items]
    quoted = [re.search('[「"](.*?)[」"]', v) for v in items]
    assert values(X.quoted_argument, items) == [m and m.group(1) for m in quoted]


def test_truncate_limits(values):
    items = ["x" * 1000, "x" * 1001, None]
    assert values(lambda c: X.truncate_text(c, 1000, "~"), items) == ["x" * 1000, "x" * 1000 + "~", None]


def slug_model(url):
    from urllib.parse import urlparse

    parts = urlparse(url)
    path = parts.path.replace("/", "_").replace(".", "_") or "index"
    return parts.netloc.replace(".", "_") + path


def test_slug(values):
    items = [
        "https://id.example.com/",
        "https://id.example.com",
        "http://a.b:8080/x/y.html?q=1#f",
        "https://a.b/c;p=1",
        "https://a.b?x=/1",
        "a.b/c",
        "",
    ]
    assert values(U.page_slug, items) == [slug_model(u) for u in items]


@MANY
@given(st.lists(st.text("ab.:/?#;-1", max_size=10), min_size=40, max_size=80))
def test_slug_model(values, tails):
    items = ["https://h.test/" + t for t in tails]
    assert values(U.page_slug, items) == [slug_model(u) for u in items]


def test_host_and_fix(values):
    items = ["https://a.b/c", "http://x.y", "a.b/c", "", None, "HTTP://A.b/c"]
    assert values(U.host_of, items) == ["a.b", "x.y", "a.b", "", None, "HTTP:"]
    assert values(U.fix_url, items) == ["https://a.b/c", "http://x.y", "https://a.b/c", None, None, "https://HTTP://A.b/c"]


def test_dates(spark):
    row = spark.range(1).select(
        D.date_text(D.days_before("2024-03-01", 1)).alias("row"),
        D.feed_path("2024-03-01", 1, "_SS.csv", "/in/").alias("path"),
        D.parse_row_date(F.lit("2024/02/29")).cast("string").alias("day"),
        D.parse_row_date(F.lit("2024/02/30")).alias("none"),
    ).first()
    assert tuple(row) == ("2024/02/29", "/in/20240229_SS.csv", "2024-02-29", None)


def test_header_names():
    assert normalise_header([" a ", "b", "", "a", "　", "a_1", "a"]) == ["a", "b", "a_1", "a_1_1", "a_2"]
    assert header_width([" a ", "b", "", "　"]) == 2
    assert unique_names([]) == []


def names_model(names):
    seen, out = set(), []
    for name in names:
        candidates = [name] + [f"{name}_{i}" for i in range(1, len(names) + 2)]
        free = next(c for c in candidates if c not in seen)
        seen.add(free)
        out.append(free)
    return out


@given(st.lists(st.sampled_from(["a", "b", "a_1", "a_2", "a_1_1"]), max_size=10))
def test_names_model(names):
    got = unique_names(names)
    assert got == names_model(names) and len(set(got)) == len(names)


