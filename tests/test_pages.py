"""Page parsing, profiles, inventories, selectors, steps, state."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.operators import elements as E
from feedloom.operators import pages as P
from feedloom.operators import selectors as L
from feedloom.operators import state as Z
from feedloom.operators import steps as S
from feedloom.operators.html import Wanted, html_elements, parse_pages
from feedloom.plans.daily import extract_pages
from feedloom.sinks.pages import save_snapshots
from feedloom.sinks.elements import element_documents, page_documents, write_elements
from feedloom.sources.catalogues import DEFAULT_SELECTORS, find_section, scan_instructions, scan_selectors
from feedloom.sources.pages import scan_elements, scan_pages


def pages(spark, *htmls):
    return spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


FORM = """<html><body><form id=f>
<label for=a>ユーザー名</label> <input name="user" id="a" placeholder="名前を入れる">
<label>備考 <b>x</b></label><div><textarea id="note"></textarea></div>
<label>都道府県</label><select id="pref" name="region"><option value="13">東京  都</option><option value="27">大阪府</option>
<option disabled value="1">北海道</option></select>
<button type="submit" disabled>送信</button><a href="/s" title="送信する">こちら</a>
<a class="nav-link" href="/m">設定 メニュー</a><img alt="設定の絵"></form></body></html>"""


def test_html_elements(spark):
    html = (
        "<title>a &amp; b</title><p id=x class='k  m' data-q>one<b>two<br>three</p>four<script>var t='</p>';</script>"
        "<!-- <i> --><div/>five</i><style>p{}</style>"
    )
    got = html_elements(pages(spark, html)).orderBy("pos").collect()
    assert [(r["tag"], r["parent_pos"], r["last_pos"], r["text"]) for r in got] == [
        ("title", None, 0, "a & b"),
        ("p", None, 3, "onetwothree"),
        ("b", 1, 3, "twothree"),
        ("br", 2, 3, ""),
        ("script", None, 4, ""),
        ("div", None, 5, ""),
        ("style", None, 6, ""),
    ]
    assert got[1]["id"] == "x" and got[1]["classes"] == ["k", "m"] and got[1]["attrs"]["data-q"] == ""
    assert got[2]["text_nodes"] == ["two", "three"]


def test_workers_need_no_package(tmp_path):
    """A job whose workers cannot import this package still parses pages."""
    script = tmp_path / "job.py"
    script.write_text(
        f"""import sys
sys.path.insert(0, {str(Path(__file__).parent.parent)!r})
from feedloom.operators.pages import elements_per_page
from feedloom.session import build_session
spark = build_session("away", "local[1]")
print("tags", elements_per_page(spark.createDataFrame([(1, "<p><b>")], "page_id long, html string")).first())
"""
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "tags Row(page_id=1, element_count=2)" in done.stdout, done.stderr[-2000:]


def test_portions():
    import pyarrow as pa

    from feedloom.operators import html

    big = "x" * html.BYTES_PER_BATCH
    assert list(html._portions(pa.array([], pa.string()))) == []
    assert list(html._portions(pa.array(["a", None, "b"]))) == [(0, 3)]
    assert list(html._portions(pa.array(["a", big, "b", "c", big]))) == [(0, 1), (1, 1), (2, 2), (4, 1)]


def test_unclosed_links(spark):
    """Links that hold one another: text grows with their square, the profile must not."""
    html = "<title>t</title><nav><a>one</a></nav>" + "<a>x" * 30000
    assert rows(P.page_profile(pages(spark, html))) == [(0, "t", "", [], ["one"])]


def test_wanted_and_spans(spark):
    html = "<div class='Alert'>é<p>～① x</p></div><nav><a title=t>y</a></nav>"
    kept = parse_pages(pages(spark, html), Wanted(tags=("a",), class_words=("alert",))).first()["elements"]
    assert [(e["tag"], e["text"]) for e in kept] == [("div", "é～① x"), ("a", "y")]
    assert [e["tag"] for e in parse_pages(pages(spark, html), Wanted(attributes=("title",))).first()["elements"]] == ["a"]
    from feedloom.operators.html import span_text

    spans = parse_pages(pages(spark, html), Wanted(text="span"))
    texts = spans.select(F.transform("elements", lambda e: span_text(F.col("page_text"), e)).alias("t")).first()["t"]
    assert texts == ["é～① x", "～① x", "y", "y"]


def test_empty_and_null_pages(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "plain")], "page_id long, html string")
    assert [len(r["elements"]) for r in parse_pages(df).collect()] == [0, 0, 0]
    assert rows(P.page_profile(df))[0] == (1, "", "", [], [])


def test_page_profile(spark):
    html = (
        "<title> T </title><h1>first</h1><h1>second</h1><div class='error-box'> bad <p class='x ALERT'>worse</p></div>"
        "<p class=error> </p><a class='menu'>M</a><button class='Nav-item'>N</button><a class=menu>M</a>"
        "<nav><ul><li><a>A</a><a>M</a><a> A </a></li></ul><nav><a>B</a></nav></nav><a>out</a>"
    )
    got = P.page_profile(pages(spark, html, "<p>none</p>")).orderBy("page_id").collect()
    assert got[0]["page_title"] == "T" and got[0]["main_heading"] == "first"
    assert got[0]["error_messages"] == ["bad worse", "worse"]
    assert got[0]["menu_items"] == ["M", "N", "M", "A", "B"]
    assert tuple(got[1])[1:] == ("", "", [], [])


def test_tag_search_and_count(spark):
    df = pages(spark, "<p>for information</p><p>other</p>")
    assert P.find_elements(df, "p").count() == 2
    assert P.find_elements(df, "p", "information").count() == 1
    assert P.find_elements(df, "p", "nothing like it").count() == 0
    assert rows(P.elements_per_page(df)) == [(0, 2)]


def test_inventory(spark):
    html = "<input id=i name=n type=text placeholder='p'><select name=s></select><a class='k m' href='/'>go</a><button></button>"
    got = P.element_inventory(pages(spark, html)).orderBy("pos").collect()
    assert [(r["element_name"], r["element_type"], r["best_selector"]) for r in got] == [
        ("p", "input", "i"),
        ("s", "select", "s"),
        ("go", "link", "a.k.m"),
        ("button_3", "button", "(//*)[4]"),
    ]
    assert got[0]["selectors"] == {"id": "i", "name": "n", "css": "#i", "xpath": "//input[@id='i']"}
    assert got[0]["attributes"] == {"type": "text", "placeholder": "p"}
    long = rows(E.elements_long(P.element_inventory(pages(spark, html)), "pos").where("pos = 1"))
    assert long == [(1, "selector", "name", "s"), (1, "selector", "xpath", "//select[@name='s']")]


def test_blank_values_stay_in_attributes(spark):
    df = spark.createDataFrame([(1, {"id": "", "css": "x"}, {"value": ""})], "k int, selectors map<string,string>, attributes map<string,string>")
    assert rows(E.elements_long(df, "k")) == [(1, "attribute", "value", ""), (1, "selector", "css", "x")]


def test_documents_round_trip(spark, tmp_path):
    df = pages(spark, "<a>x</a><a>y</a>", "<a>ログイン　クリックボタン</a><p>no</p><a>z</a>")
    extract_pages(df, "detail_analytics", str(tmp_path / "d"), str(tmp_path / "log"))
    got = scan_elements(spark, str(tmp_path / "d"), multi_line=False)
    assert rows(got.select("section", "pos", "element_name")) == [
        ("detail_analytics", 0, "x"),
        ("detail_analytics", 0, "z"),
        ("detail_analytics", 1, "y"),
    ]
    log = spark.read.parquet(str(tmp_path / "log")).first()
    assert (log["stage"], log["rows"]) == ("elements detail_analytics", 3)
    flat = E.exclude_named(P.element_inventory(df).withColumn("section", F.lit("detail_analytics")))
    whole = page_documents(P.page_inventories(df).withColumn("section", F.lit("detail_analytics")))
    assert rows(element_documents(flat)) == rows(whole)
    write_elements(whole, str(tmp_path / "again"))
    assert rows(scan_elements(spark, str(tmp_path / "again"), multi_line=False)) == rows(got)


def test_scan_elements_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"section": "s", "elements": {"elements": [\n{"element_name": "名", "selectors": {"id": "i"}, "attributes": {"x": 1}}]}}'
    )
    (tmp_path / "b.json").write_text('{"section": "t", "timestamp": "20250101_000000", "elements": {"elements": []}}')
    got = scan_elements(spark, str(tmp_path)).collect()
    assert [(r["section"], r["timestamp"], r["element_name"], r["selectors"], r["attributes"]) for r in got] == [
        ("s", None, "名", {"id": "i"}, {"x": "1"})
    ]


@pytest.mark.parametrize(
    "text, found",
    [
        ('{"elements": [{"element_name": "a"}]}', 1),
        (' {"elements": [{"element_name": "a"}, {"element_name": "b", "selectors": {"id": 5}}]}\n', 2),
        ('{"elements": []}', 0),
        ('{"elements": null}', 0),
        ('{"other": 1}', 0),
        ("broken", 0),
        ("", 0),
        (None, 0),
        ('{"elements": [{"element_na', 0),
        ('{"elements": [{"element_name": "a"}]} and more', 0),
        ('{"elements": [{"element_name": "a"}]}}', 0),
        ('{"elements": [{"element_name": "a"}]},{"elements": []}', 0),
        ('{"elements": [{"element_name": "a"}], "x": tru}', 0),
        ('[{"elements": [{"element_name": "a"}]}]', 0),
        ("{'elements': [{'element_name': 'a'}]}", 0),
    ],
)
def test_parse_elements_json(values, text, found):
    assert len(values(E.parse_elements_json, [text])[0]) == found


def test_exclude_named(spark):
    df = spark.createDataFrame(
        [("detail_analytics", "ログインID　入力フィールド"), ("login", "ログインID　入力フィールド"), ("detail_analytics", None), (None, "x")],
        "section string, element_name string",
    )
    assert E.exclude_named(df).count() == 3


def test_scan_pages(spark, tmp_path):
    for name in ("id_a_b__20250320_192711.html", "a_bindex_20250320_192711.html", "bad.html", "x_20251399_000000.html"):
        (tmp_path / name).write_text("<p>é\n</p>\n", encoding="utf-8")
    got = scan_pages(spark, str(tmp_path)).select("file_name", "page_slug", F.col("captured_at").cast("string"), "html")
    assert rows(got) == [
        ("a_bindex_20250320_192711.html", "a_bindex", "2025-03-20 19:27:11", "<p>é\n</p>\n"),
        ("bad.html", None, None, "<p>é\n</p>\n"),
        ("id_a_b__20250320_192711.html", "id_a_b_", "2025-03-20 19:27:11", "<p>é\n</p>\n"),
        ("x_20251399_000000.html", None, None, "<p>é\n</p>\n"),
    ]


def test_snapshots_of_one_name_are_not_written(spark, tmp_path):
    df = spark.createDataFrame(
        [("https://h/x.y", "<a>1</a>", "2024-01-31 01:02:03"), ("https://h/x/y", "<a>2</a>", "2024-01-31 01:02:03"), ("https://h/z", "<a>3</a>", "2024-01-31 01:02:03")],
        "url string, html string, at string",
    )
    folder = tmp_path / "same"
    saved = save_snapshots(df, str(folder), F.col("url"), F.to_timestamp("at")).collect()
    names = [r["file_name"] for r in saved]
    problems = {r["file_name"]: r["problem"] for r in saved}
    if len(set(names)) < 3:
        assert sorted(problems.values()) == ["", "2 pages have this name"] and len(list(folder.glob("*.html"))) == 1
    else:
        assert set(problems.values()) == {""}


def test_save_snapshots(spark, tmp_path):
    df = spark.createDataFrame(
        [("https://a.b/c.html?x", "2025-03-20 19:27:11", "<p>é"), ("https://a.b", "2025-03-20 19:27:12", None)],
        "url string, at string, html string",
    )
    folder = str(tmp_path / "pages")
    saved = save_snapshots(df, folder, F.col("url"), F.to_timestamp("at"))
    assert rows(saved) == [("a_b_c_html_20250320_192711.html", 5, ""), ("a_bindex_20250320_192712.html", 0, "")]
    got = scan_pages(spark, folder).select("page_slug", F.col("captured_at").cast("string"), "html").where("html <> ''")
    assert rows(got) == [("a_b_c_html", "2025-03-20 19:27:11", "<p>é")]
    blocked = spark.createDataFrame([("http://x", "2025-03-20 19:27:11", "y")], df.schema)
    (tmp_path / "pages" / "xindex_20250320_192711.html").mkdir()
    assert save_snapshots(blocked, folder, F.col("url"), F.to_timestamp("at")).first()["problem"] != ""


CATALOGUE = """group,name,selector_type,selector_value
login,username,css,"input[name=""u,v""]"
x,y,id,old
x,y,name,new
x,z,,
"""


def test_scan_selectors(spark, tmp_path):
    (tmp_path / "c.csv").write_text(CATALOGUE)
    got = {(r["group"], r["name"]): (r["selector_type"], r["selector_value"]) for r in scan_selectors(spark, str(tmp_path / "c.csv")).collect()}
    assert got[("x", "y")] == ("name", "new") and got[("login", "username")] == ("css", 'input[name="u,v"]')
    assert got[("login", "password")][0] == "xpath" and got[("x", "z")] == (None, None) and len(got) == 5
    (tmp_path / "d.csv").write_text("group,name\na,b\n")
    assert rows(scan_selectors(spark, str(tmp_path / "d.csv"))) == sorted(DEFAULT_SELECTORS, key=repr)
    assert rows(L.selectors_per_group(scan_selectors(spark, str(tmp_path / "c.csv")))) == [("login", 3), ("x", 2)]


def test_lookup(spark, tmp_path):
    (tmp_path / "c.csv").write_text(CATALOGUE)
    asked = spark.createDataFrame([("x", "y"), ("x", "none")], "`group` string, name string")
    found = L.lookup_selector(asked, scan_selectors(spark, str(tmp_path / "c.csv")))
    assert rows(found) == [("x", "none", None, None), ("x", "y", "name", "new")]


@pytest.mark.parametrize(
    "kind, value, supported, text",
    [
        ("css", "h1", True, "T"),
        ("CSS", "#a", True, "A"),
        ("css", "p.x.y", True, "both"),
        ("css", "div > p", True, "child"),
        ("css", "section p", True, "deep"),
        ("css", "section > p", True, None),
        ("css", "div [data-k]", True, "child"),
        ("css", "[data-k='v w']", True, "child"),
        ("css", "[data-k*=w]", True, "child"),
        ("css", "*", True, "whole"),
        ("css", "p:first-child", False, None),
        ("css", "div p, h1", True, "T"),
        ("css", "i, [t=' or ']", True, "N"),
        ("css", "h1, p:hover", False, None),
        ("css", "[data-k=',']", True, None),
        ("css", "> p", False, None),
        ("xpath", "//p[@class='x y']", True, "both"),
        ("xpath", '//p[@id="a" or contains(@class, "y")]', True, "A"),
        ("xpath", "//*[@data-k and @data-m]", True, "child"),
        ("xpath", "//section//p", True, "deep"),
        ("xpath", "//p[@t=' or ']", True, "odd"),
        ("xpath", "//p[text()='both']", True, "both"),
        ("xpath", "//p[contains(text(), 'ee')]", True, "deep"),
        ("xpath", "//p[text()='bot']", True, None),
        ("xpath", "(//p)[2]", True, "both"),
        ("xpath", "(//p)[9]", True, None),
        ("xpath", "//section/b/p", True, "deep"),
        ("xpath", "//section/p", True, None),
        ("xpath", "/html/h1", True, "T"),
        ("xpath", "/h1", True, None),
        ("xpath", "//i | //section//p", True, "deep"),
        ("xpath", "//p[2]", False, None),
        ("xpath", "//p[last()]", False, None),
        ("xpath", "//p | ", False, None),
        ("xpath", "//p[@a or @b and @c]", False, None),
        ("xpath", "/html/body", True, None),
        ("id", "a", True, "A"),
        ("name", "n", True, "N"),
        ("class", "y", True, "both"),
        ("class", "none", True, None),
        ("link", "x", False, None),
        (None, None, False, None),
    ],
)
def test_resolve_selector(spark, kind, value, supported, text):
    html = (
        "<html><h1>T</h1><p id=a>A</p><p class='x y'>both</p><div><p data-k='v w' data-m>child</p></div>"
        "<section><b><p>deep</p></b></section><i name=n>N</i><p t=' or '>odd</p></html>"
    )
    catalogue = spark.createDataFrame([("g", "n", kind, value)], "`group` string, name string, selector_type string, selector_value string")
    got = L.resolve_selectors(pages(spark, html), catalogue).first()
    assert got["supported"] is supported and got["found"] is (text is not None)
    assert got["text"] == ("TAbothchilddeepNodd" if text == "whole" else text)


def _selector_cases():
    marks = [m for m in test_resolve_selector.pytestmark if m.name == "parametrize"]
    return [(f"n{i}", kind, value) for i, (kind, value, _, _) in enumerate(marks[0].args[1])]


SHAPE = "`group` string, name string, selector_type string, selector_value string"
PAGES = (
    "<html><h1>T</h1><p id=a>A</p><p class='x y'>both</p><div><p data-k='v w' data-m>child</p></div>"
    "<section><b><p>deep</p></b></section><i name=n>N</i><p t=' or '>odd</p></html>",
    "<p>one<p>two<div class=y><section><p id=a>in</section></div><i t=' or '>x</i>",
    "",
    "<section><p><b><p id=a class='y  x'>z</p></b></section><section><div><p>q</div></section>" * 3,
)


def test_index_gives_what_expressions_give(spark):
    """Every selector form on several pages, evaluated in place and by the index of elements."""
    catalogue = spark.createDataFrame([("g" if i % 2 else None, *row) for i, row in enumerate(_selector_cases())], SHAPE)
    data = pages(spark, *PAGES).withColumn("row", F.col("page_id") * 2)
    for hits_only in (False, True):
        whole = rows(L.resolve_selectors(data, catalogue, hits_only=hits_only))
        assert rows(L.resolve_selectors(data, catalogue, hits_only=hits_only, in_place=0)) == whole and whole
    asked = spark.createDataFrame([(0, "g", "n1"), (0, "g", "n1"), (3, "g", "n3"), (1, "g", "none"), (9, "g", "n1"), (2, "g", "n5")], "page_id long, `group` string, name string")
    for hits_only in (False, True):
        some = rows(L.resolve_selectors(data, catalogue, requests=asked, hits_only=hits_only))
        assert rows(L.resolve_selectors(data, catalogue, requests=asked, hits_only=hits_only, in_place=0)) == some and some


def test_large_catalogue(spark):
    """20,000 selectors on a few pages; requests cut the catalogue down before it is evaluated."""
    catalogue = spark.range(20_000).select(F.lit("g").alias("group"), F.concat(F.lit("n"), "id").alias("name"), F.lit("css").alias("selector_type"), F.concat(F.lit("ul > #p"), "id").alias("selector_value"))
    data = pages(spark, *("<ul>" + "".join(f"<li id=p{i}>t{i}</li>" for i in range(first, 20_000, 4000)) + "</ul>" for first in (0, 7, 3999)))
    found = L.resolve_selectors(data, catalogue, hits_only=True)
    want = {(page, f"n{i}", f"t{i}") for page, first in enumerate((0, 7, 3999)) for i in range(first, 20_000, 4000)}
    assert {(r.page_id, r.name, r.text) for r in found.collect()} == want
    asked = spark.createDataFrame([(1, "g", "n7"), (1, "g", "n8")], "page_id long, `group` string, name string")
    assert rows(L.resolve_selectors(data, catalogue, requests=asked).select("page_id", "name", "text")) == [(1, "n7", "t7"), (1, "n8", None)]


def test_common_steps_are_not_tested_on_other_pages(spark, monkeypatch):
    """A list on a page without the rare item is not held against the selectors that begin with a list."""
    tested = L.fits_row
    lonely = lambda e: F.coalesce(e["attrs"]["id"] == "lonely", F.lit(False))
    monkeypatch.setattr(L, "fits_row", lambda e, ways: F.when(lonely(e), F.raise_error(F.lit("tested"))).otherwise(tested(e, ways)).cast("boolean"))
    catalogue = spark.createDataFrame([("g", f"n{i}", "css", f"ul > li.c{i}") for i in range(20)], SHAPE)
    data = pages(spark, "<ul><li class=c7>t</li></ul>", "<ul id=lonely><li class=d>u</li></ul>")
    found = L.resolve_selectors(data, catalogue, hits_only=True, in_place=0)
    assert [(r.page_id, r.name, r.text) for r in found.collect()] == [(0, "n7", "t")]


TREES = st.recursive(st.just(""), lambda inner: st.lists(st.tuples(st.sampled_from("biu"), inner), max_size=4), max_leaves=25)


def markup(tree):
    return "".join(f"<{tag}>{markup(inner)}</{tag}>" for tag, inner in tree or [])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TREES, min_size=5, max_size=12))
def test_nested_selectors_model(spark, trees):
    """Descendant and child steps against a walk up the parents."""
    df = pages(spark, *[markup(t) for t in trees])
    paths = {}
    for r in html_elements(df, Wanted(text="none")).orderBy("page_id", "pos").collect():
        above = paths[(r["page_id"], r["parent_pos"])] if r["parent_pos"] is not None else []
        paths[(r["page_id"], r["pos"])] = [*above, r["tag"]]
    models = {
        "b i": lambda p: p[-1] == "i" and "b" in p[:-1],
        "b > i": lambda p: p[-2:] == ["b", "i"],
        "b > i u": lambda p: p[-1] == "u" and any(p[k : k + 2] == ["b", "i"] for k in range(len(p) - 2)),
        "u b > b": lambda p: p[-2:] == ["b", "b"] and "u" in p[:-2],
    }
    shape = "`group` string, name string, selector_type string, selector_value string"
    catalogue = spark.createDataFrame([("g", css, "css", css) for css in models], shape)
    got = {(r["page_id"], r["name"]): r["pos"] for r in L.resolve_selectors(df, catalogue).collect()}
    for css, fits in models.items():
        for page in range(len(trees)):
            hits = [pos for (p, pos), path in paths.items() if p == page and fits(path)]
            assert got[(page, css)] == (min(hits) if hits else None)


def test_default_selectors_resolve(spark):
    shape = "`group` string, name string, selector_type string, selector_value string"
    html = "<input id=username><input type=password name=q><button class='btn-login'>go</button>"
    got = L.resolve_selectors(pages(spark, html), spark.createDataFrame(DEFAULT_SELECTORS, shape))
    assert rows(got.select("name", "found", "pos")) == [("password", True, 1), ("submit", True, 2), ("username", True, 0)]


def test_check_selectors(spark):
    """An inventory may name ids its page does not have."""
    records = [(0, {"id": "username"}), (0, {"id": "login_id", "name": "n"}), (0, {"id": "", "name": "n"}), (0, {"css": "p"}), (9, {"id": "x"})]
    elements = spark.createDataFrame(records, "page_id long, selectors map<string,string>")
    got = L.check_selectors(pages(spark, "<input id=username><b name=n>"), elements)
    assert rows(got.select(F.col("selectors")["id"], "selector_found")) == [
        ("", True),
        ("login_id", False),
        ("username", True),
        ("x", False),
        (None, None),
    ]


TEXT = """前書き
## 1. login
--概要
ログインの説明
--url
https://login.example.com/
--ログインコード
login.py
--取得要素
ID　入力欄

　送信　ボタン

## 2. detail
--概要
表
--url
https://app.example.com/a
--前提操作
ログイン login.py x
単独
--操作手順
1. 表をクリック
番号なし
10.  5秒待機
--取得要素
表　ボタン

## login_more
@https://more.example.com/
--取得要素
欄
"""


def test_instructions(spark, tmp_path):
    (tmp_path / "direction.md").write_text(TEXT, encoding="utf-8")
    sections = scan_instructions(spark, str(tmp_path / "direction.md"))
    got = {r["section"]: r for r in sections.collect()}
    assert list(sorted(got)) == ["detail", "login", "login_more"]
    assert got["login"]["title"] == "## 1. login" and got["login"]["url"] == "https://login.example.com/"
    assert got["login"]["elements"] == ["ID　入力欄", "送信　ボタン"] and got["login"]["login_code"] == "login.py"
    # A later section has its own address and elements only.
    assert got["detail"]["url"] == "https://app.example.com/a" and got["detail"]["elements"] == ["表　ボタン"]
    assert got["detail"]["operations"] == ["表をクリック", "5秒待機"]
    assert [tuple(p) for p in got["detail"]["prerequisites"]] == [("ログイン", "login.py x")]
    assert got["login_more"]["url"] == "https://more.example.com/" and got["login_more"]["login_code"] == ""
    assert find_section(sections, "detail").count() == 1 and find_section(sections, "none").count() == 0
    steps = S.section_steps(sections, "section").orderBy("step").collect()
    assert [(r["step"], r["kind"], r["target"], r["wait_seconds"]) for r in steps] == [(1, "click", "表", None), (2, "wait", None, 5)]


@pytest.mark.parametrize(
    "text, want",
    [
        ("設定メニューをクリック", ("click", "設定メニュー", None, None, False, False)),
        ("設定クリック", ("click", "設定", None, None, False, False)),
        ("　ユーザー名 に「test」を入力", ("input", "ユーザー名", "test", None, False, False)),
        ('欄に"a b"を入力', ("input", "欄", "a b", None, False, False)),
        ("一覧から「選択肢1」を選択", ("select", "一覧", "選択肢1", None, False, False)),
        ("欄に「東に行く」を入力", ("input", "欄", "東に行く", None, False, True)),
        ("一覧から「ここから」を選択", ("select", "一覧", "ここから", None, False, True)),
        ("欄に値を入力", ("input", None, None, None, True, False)),
        ("「x」を入力", ("input", None, None, None, True, False)),
        ("5秒待機", ("wait", None, None, 5, False, False)),
        ("１０ 秒待機", ("wait", None, None, 10, False, False)),
        ("待機", ("wait", None, None, 3, False, False)),
        ("確認する", ("unsupported", None, None, None, False, False)),
        ("入力欄をクリック", ("click", "入力欄", None, None, False, False)),
    ],
)
def test_parse_step(values, text, want):
    assert tuple(values(S.parse_step, [text])[0]) == want


def step_table(spark, *targets):
    return spark.createDataFrame([(0, t) for t in targets], "page_id long, target string")


def test_locate_clickable(spark):
    steps = step_table(spark, "設定 メニュー", "設定", "送信", "こちら", "設定の絵", "none")
    got = {r["target"]: (r["rule"], r["tag"]) for r in S.locate_clickable(pages(spark, FORM), steps).collect()}
    assert got == {
        "設定 メニュー": ("link_text", "a"),
        "設定": ("partial_link_text", "a"),
        # The first hit is a disabled button, so it is only taken by force.
        "送信": ("forced", "button"),
        "こちら": ("link_text", "a"),
        "設定の絵": ("text_or_label", "img"),
        "none": (None, None),
    }


def test_locate_input(spark):
    steps = step_table(spark, "user", "note", "名前", "備考", "ユーザー名", "none")
    got = {r["target"]: (r["rule"], r["tag"]) for r in S.locate_input(pages(spark, FORM), steps).collect()}
    assert got == {
        "user": ("name", "input"),
        "note": ("id", "textarea"),
        "名前": ("placeholder", "input"),
        "備考": ("label", "textarea"),
        "ユーザー名": ("label", "input"),
        "none": (None, None),
    }


@pytest.mark.parametrize("kind", ["input", "option", "check"])
def test_elements_are_not_broadcast(spark, tmp_path, kind):
    """A small file of pages can hold more elements than a driver: they are merged with the steps."""
    pages(spark, *[FORM] * 50).write.parquet(str(tmp_path / "pages"))
    stored = spark.read.parquet(str(tmp_path / "pages"))
    steps = spark.range(50).select(F.col("id").alias("page_id"), F.lit("region").alias("target"), F.lit("東京 都").alias("value"))
    records = steps.select("page_id", F.create_map(F.lit("id"), F.lit(""), F.lit("name"), F.col("target")).alias("selectors"))
    run = {"input": lambda: S.locate_input(stored, steps), "option": lambda: S.locate_option(stored, steps), "check": lambda: L.check_selectors(stored, records)}
    found = run[kind]()
    assert found.count() == 50 and "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_label_field_must_follow(spark):
    html = "<label>住所<input id=inside></label><input id=next>"
    got = S.locate_input(pages(spark, html), step_table(spark, "住所")).first()
    assert (got["rule"], got["pos"]) == ("label", 2)


@pytest.mark.parametrize(
    "target, value, want",
    [
        ("region", "東京 都", ("name", "visible_text", "東京  都")),
        ("pref", "27", ("id", "value", "大阪府")),
        ("都道府県", "2", ("label", "index", "大阪府")),
        ("region", "北海道", ("name", None, None)),
        ("region", "3", ("name", None, None)),
        ("region", "9", ("name", None, None)),
        ("user", "13", (None, None, None)),
    ],
)
def test_locate_option(spark, target, value, want):
    steps = spark.createDataFrame([(0, target, value)], "page_id long, target string, value string")
    got = S.locate_option(pages(spark, FORM), steps).first()
    assert (got["select_rule"], got["option_rule"], got["option_text"]) == want


HOSTS = ("https://id.test/login", "https://app.test/start", "id.test", "app.test")


@pytest.mark.parametrize(
    "url, html, want",
    [
        ("https://id.test/login?x", "ログアウト", (False, "login_url")),
        ("https://app.test/x", "<p>ダッシュボード ログアウト パスワード", (True, "dashboard_marker")),
        ("https://app.test/x", "パスワード", (False, "login_marker")),
        ("https://other.test/", "ダッシュボード loginForm", (False, "login_marker")),
        ("https://id.test/x", "", (False, "login_host")),
        ("https://app.test/x", "", (True, "dashboard_host")),
        ("https://other.test/", "", (True, "not_login_url")),
    ],
)
def test_page_state(spark, url, html, want):
    df = spark.createDataFrame([(url, html)], "url string, html string")
    assert tuple(df.select(Z.page_state(F.col("url"), F.col("html"), *HOSTS).alias("s")).first()["s"]) == want


@pytest.mark.parametrize(
    "url, html, want",
    [
        ("https://app.test/x", "<p class='alert-danger'>", (True, "success_host")),
        ("https://id.test/login", "<p class='x alert-danger'>e", (False, "failure_notice")),
        ("https://id.test/login", "<p class='alert-danger-x'>", (False, "still_at_login")),
        ("https://else.test/", "", (True, "left_login")),
    ],
)
def test_login_outcome(spark, url, html, want):
    df = spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")
    got = Z.login_outcome(df, "app.test", "https://id.test/login").first()
    assert (got["succeeded"], got["rule"]) == want


def test_related_hosts(spark):
    hosts = spark.createDataFrame([("a.b.c.test",)] * 3 + [("solo",), ("x.fam.test",)], "host string")
    known = spark.createDataFrame([(h,) for h in ("a.b.c.test", "b.c.test", "c.test", "test", "solo", "fam.test", "y.fam.test", "x.fam.test")], "host string")
    got = rows(Z.related_hosts(hosts, known, "fam.test", ["x.fam.test", "y.fam.test", "z.fam.test"]))
    assert got == [
        ("a.b.c.test", "a.b.c.test"),
        ("a.b.c.test", "b.c.test"),
        ("a.b.c.test", "c.test"),
        ("solo", "solo"),
        ("x.fam.test", "fam.test"),
        ("x.fam.test", "x.fam.test"),
        ("x.fam.test", "y.fam.test"),
    ]


@pytest.mark.parametrize(
    "domain, want",
    [
        (".c.test", "a.c.test"),
        (".a.c.test", "a.c.test"),
        (".else.test", ".else.test"),
        ("c.test", "c.test"),
        ("else.test", "a.c.test"),
        (None, None),
    ],
)
def test_retarget(spark, domain, want):
    record = {"name": "n", "value": "v", "expiry": "1", "secure": "x"} | ({"domain": domain} if domain else {})
    df = spark.createDataFrame([(record,)], "m map<string,string>")
    got = df.select(Z.retarget_record(F.col("m"), F.lit("a.c.test")).alias("m")).first()["m"]
    assert got == {"name": "n", "value": "v"} | ({"domain": want} if domain else {})


def test_skip_bad_records(spark):
    items = [("n", "v" * 4000), ("n", "v" * 4001), ("", "v"), ("n", ""), (None, "v"), ("n", None), ("n", "é" * 4000)]
    df = spark.createDataFrame(items, "name string, value string")
    assert Z.skip_bad_records(df).count() == 2
