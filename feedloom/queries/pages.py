"""Page queries: profile, inventory, selectors, steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import pages as P
from feedloom.operators import steps as S
from feedloom.operators.elements import elements_long as long_form
from feedloom.operators.elements import elements_per_section
from feedloom.operators.html import Wanted, html_elements, spread
from feedloom.operators.selectors import check_selectors, lookup_selector, resolve_selectors, selectors_per_group
from feedloom.plans.daily import section_log
from feedloom.queries.registry import query, table
from feedloom.session import work_path
from feedloom.sinks.elements import element_documents as gather
from feedloom.sinks.elements import page_documents, write_elements
from feedloom.sources.catalogues import instruction_sections, scan_instructions, scan_selectors
from feedloom.sources.pages import scan_elements


def _decoded(sql: str) -> str:
    """Entities of the page table as text; the ampersand goes last."""
    for entity, text in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"), ("&amp", "&")):
        sql = f"replace({sql}, '{entity}', '{text}')"
    return f"trim({sql})"


_NAV = "regexp_extract(html, '<nav>(.*?)</nav>', 1, 's')"
_LINKS = f"""list_transform(regexp_extract_all({_NAV}, '<a [^>]*>([^<]*)</a>', 1), lambda t: {_decoded('t')})"""
_QUIET = "regexp_replace(regexp_replace(html, '<script>.*?</script>', '<script>', 'gs'), '<!--.*?-->', '', 'gs')"


def pages_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages").select("page_id", "html"))


def pages_by_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the language part of their address as section."""
    section = F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z]+)", 1)
    return spread(table(spark, sf_dir, "pages").select("page_id", "html", section.alias("section")))


@query(
    f"""WITH p AS (SELECT page_id, html, list_filter({_LINKS}, lambda t: t <> '') AS links FROM pages)
    SELECT page_id, {_decoded("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")} AS page_title,
    {_decoded("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS main_heading, '' AS error_messages,
    array_to_string(list_filter(links, lambda t, i: list_position(links, t) = i), '|') AS menu_items FROM p"""
)
def page_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, first heading, error texts and menu texts."""
    profile = P.page_profile(pages_of(spark, sf_dir))
    return profile.select(
        "page_id",
        "page_title",
        "main_heading",
        F.array_join("error_messages", "|").alias("error_messages"),
        F.array_join("menu_items", "|").alias("menu_items"),
    )


@query(f"SELECT page_id, len(regexp_extract_all({_QUIET}, '<[a-zA-Z]')) AS element_count FROM pages")
def page_element_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.elements_per_page(pages_of(spark, sf_dir))


@query(
    f"""WITH p AS (SELECT page_id, unnest({_LINKS}) AS text FROM pages)
    SELECT page_id, text, count(*) AS times FROM p WHERE contains(text, 'th') GROUP BY page_id, text"""
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links whose text holds ``th``, counted per page."""
    links = P.find_elements(pages_of(spark, sf_dir), "a", "th")
    return links.groupBy("page_id", "text").agg(F.count("*").alias("times"))


@query(
    f"""SELECT lower(tag) AS tag, count(*) AS times FROM (SELECT unnest(regexp_extract_all({_QUIET}, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag
    FROM pages) GROUP BY 1"""
)
def page_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat element table, counted by tag."""
    return html_elements(pages_of(spark, sf_dir), Wanted(text="none", attrs=False)).groupBy("tag").agg(F.count("*").alias("times"))


_LINK_TAGS = f"""SELECT page_id, regexp_extract(link, 'href="([^"]*)"', 1) AS href,
    {_decoded("regexp_extract(link, '>([^<]*)</a>', 1)")} AS text
    FROM (SELECT page_id, unnest(regexp_extract_all({_QUIET}, '<a [^>]*>[^<]*</a>')) AS link FROM pages)"""


@query(
    f"""SELECT page_id, text AS element_name, 'link' AS element_type, {_decoded('href')} AS href, text AS visible_text,
    count(*) AS times FROM ({_LINK_TAGS}) GROUP BY ALL"""
)
def element_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, buttons and fields of every page; equal entries of a page counted."""
    inventory = P.element_inventory(pages_of(spark, sf_dir))
    entry = ["page_id", "element_name", "element_type", F.col("attributes")["href"].alias("href"), "visible_text"]
    return inventory.select(*entry).groupBy("page_id", "element_name", "element_type", "href", "visible_text").agg(
        F.count("*").alias("times")
    )


@query(
    f"""SELECT page_id, 'attribute' AS kind, 'href' AS "key", count(*) AS times FROM ({_LINK_TAGS}) GROUP BY page_id
    UNION ALL SELECT page_id, 'selector', 'xpath', count(*) FROM ({_LINK_TAGS}) GROUP BY page_id"""
)
def elements_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selectors and attributes of the inventory as rows, counted by kind and key."""
    rows = long_form(P.element_inventory(pages_of(spark, sf_dir)), "page_id")
    return rows.groupBy("page_id", "kind", "key").agg(F.count("*").alias("times"))


_SECTION = "regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)', 1)"


@query(f"SELECT {_SECTION} AS section, sum(len({_LINKS})) :: BIGINT AS element_count FROM pages GROUP BY 1")
def elements_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element documents written by section, read back and counted."""
    path = work_path(spark, "elements")
    write_elements(page_documents(P.page_inventories(pages_by_section(spark, sf_dir))), path)
    return elements_per_section(scan_elements(spark, path, multi_line=False))


@query(f"SELECT page_id, {_SECTION} AS section, array_to_string({_LINKS}, '|') AS names FROM pages WHERE len({_LINKS}) > 0")
def element_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flat element table gathered into one document per page, elements in order."""
    documents = gather(P.element_inventory(pages_by_section(spark, sf_dir)))
    names = F.transform("elements.elements", lambda e: e["visible_text"])
    return documents.select("page_id", "section", F.array_join(names, "|").alias("names"))


SELECTORS = [
    ("page", "heading", "css", "h1"),
    ("page", "notice", "class", "ad"),
    ("page", "first_link", "css", "nav li > a"),
    ("page", "link_by_path", "xpath", "//nav//a[@href and contains(@href, '/t')]"),
    ("page", "unknown", "magic", "h1"),
    ("page", "absent", "id", "no-such-id"),
]


@query(
    f"""WITH p AS (SELECT page_id, html, {_LINKS} AS links, regexp_extract_all({_NAV}, 'href="([^"]*)"', 1) AS hrefs FROM pages),
    r AS (SELECT page_id, 'heading' AS name, true AS supported, {_decoded("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS text FROM p
    UNION ALL SELECT page_id, 'notice', true, {_decoded("regexp_extract(html, '<div class=.ad.>([^<]*)</div>', 1)")} FROM p
    UNION ALL SELECT page_id, 'first_link', true, links[1] FROM p
    UNION ALL SELECT page_id, 'link_by_path', true,
    links[list_position(list_transform(hrefs, lambda h: contains(h, '/t')), true)] FROM p
    UNION ALL SELECT page_id, 'unknown', false, NULL FROM p
    UNION ALL SELECT page_id, 'absent', true, NULL FROM p)
    SELECT page_id, name, supported, text IS NOT NULL AS found, text FROM r"""
)
def selector_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue selectors evaluated on every page."""
    shape = "`group` string, name string, selector_type string, selector_value string"
    resolved = resolve_selectors(pages_of(spark, sf_dir), spark.createDataFrame(SELECTORS, shape))
    return resolved.select("page_id", "name", "supported", "found", "text")


@query(
    """SELECT p_partkey // 50 AS page_id, 'p' || CAST(p_partkey AS VARCHAR) AS name, 'li' AS tag, p_name AS text FROM part WHERE p_partkey % 4 <> 3"""
)
def selector_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue with a selector for every part, found on the pages that list the parts; a quarter names another list."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_partkey").cast("string").alias("key"))
    item = F.concat(F.lit("<li id='p"), "key", F.lit("' class='part c"), "key", F.lit("' data-key='"), "key", F.lit("'>"), "p_name", F.lit("</li>"))
    listed = parts.groupBy(F.floor(F.col("p_partkey") / 50).alias("page_id")).agg(F.sort_array(F.collect_list(F.struct("p_partkey", item.alias("item")))).alias("items"))
    pages = listed.select("page_id", F.concat(F.lit("<html><body><ul>"), F.array_join("items.item", ""), F.lit("</ul></body></html>")).alias("html"))
    kind = F.col("p_partkey") % 4
    value = (
        F.when(kind == 0, F.concat(F.lit("#p"), "key"))
        .when(kind == 1, F.concat(F.lit("ul > li.c"), "key"))
        .when(kind == 2, F.concat(F.lit('//body//li[@data-key="'), "key", F.lit('"]')))
        .otherwise(F.concat(F.lit("ol li.c"), "key"))
    )
    way = F.when(kind == 2, "xpath").otherwise("css")
    catalogue = parts.select(F.lit("parts").alias("group"), F.concat(F.lit("p"), "key").alias("name"), way.alias("selector_type"), value.alias("selector_value"))
    return resolve_selectors(pages, catalogue, hits_only=True).select("page_id", "name", "tag", "text")


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names by brand as a catalogue file, read back."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("group"),
        F.concat("p_name", F.lit("/"), "p_type").alias("name"),
        F.lit("css").alias("selector_type"),
        F.concat(F.lit("#"), F.translate("p_name", " ", "-")).alias("selector_value"),
    )
    path = work_path(spark, "catalogue")
    parts.write.option("header", True).option("escape", '"').csv(path)
    return scan_selectors(spark, path)


@query(
    """SELECT p_brand AS "group", count(DISTINCT p_name || '/' || p_type) AS selector_count FROM part GROUP BY p_brand
    UNION ALL SELECT 'login', 3"""
)
def selector_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names per group of a catalogue, with the built-in login group."""
    return selectors_per_group(_catalogue(spark, sf_dir))


@query(
    """SELECT p.p_partkey, c.v AS selector_value FROM part p LEFT JOIN
    (SELECT DISTINCT p_brand, p_name || '/' || p_type AS n, '#' || replace(p_name, ' ', '-') AS v FROM part) c
    ON c.p_brand = CASE WHEN p.p_size > 25 THEN p.p_brand ELSE 'Brand#0' END AND c.n = p.p_name || '/' || p.p_type"""
)
def selector_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests looked up by group and name; those not listed get null."""
    requests = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise("Brand#0").alias("group"),
        F.concat("p_name", F.lit("/"), "p_type").alias("name"),
    )
    return lookup_selector(requests, _catalogue(spark, sf_dir)).select("p_partkey", "selector_value")


@query(
    """SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'click' WHEN 1 THEN 'input' WHEN 2 THEN 'select' WHEN 3 THEN 'wait'
    WHEN 4 THEN 'wait' WHEN 5 THEN 'input' WHEN 6 THEN 'input' ELSE 'unsupported' END AS kind,
    CASE WHEN p_partkey % 8 IN (0, 1, 2, 6) THEN p_name END AS target,
    CASE p_partkey % 8 WHEN 1 THEN p_type WHEN 2 THEN p_brand WHEN 6 THEN '東に' || p_type END AS value,
    CASE p_partkey % 8 WHEN 3 THEN p_size WHEN 4 THEN 3 END AS wait_seconds,
    p_partkey % 8 = 5 AS malformed, p_partkey % 8 = 6 AS readings_differ FROM part"""
)
def step_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of every kind taken apart."""
    kind, name = F.col("p_partkey") % 8, F.col("p_name")
    operation = (
        F.when(kind == 0, F.concat(F.lit(" "), name, F.lit(" をクリック")))
        .when(kind == 1, F.concat(name, F.lit("に「"), "p_type", F.lit("」を入力")))
        .when(kind == 2, F.concat(name, F.lit('から"'), "p_brand", F.lit('"を選択')))
        .when(kind == 3, F.concat(F.col("p_size").cast("string"), F.lit(" 秒待機")))
        .when(kind == 4, F.lit("少し待機"))
        .when(kind == 5, F.concat(name, F.lit("に入力")))
        .when(kind == 6, F.concat(name, F.lit("に「東に"), "p_type", F.lit("」を入力")))
        .otherwise(F.concat(name, F.lit("を確認")))
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", operation.alias("operation"))
    return S.parse_steps(parts).drop("operation")


_SECTION_COLUMNS = """'## ' || CAST(p.section_pos AS VARCHAR) || '. ' || CASE p.section_pos WHEN 1 THEN 'login' ELSE c_name END AS title,
    CASE p.section_pos WHEN 1 THEN 'login' ELSE c_name END AS section,
    CASE p.section_pos WHEN 1 THEN 'https://login.example.com/' ELSE 'https://app.example.com/' || CAST(c_custkey AS VARCHAR) END AS url,
    CASE p.section_pos WHEN 1 THEN 'ID　欄|パスワード　欄' ELSE c_mktsegment || '　ボタン|期間' END AS elements,
    CASE p.section_pos WHEN 1 THEN '' ELSE c_name || 'をクリック|5秒待機' END AS operations,
    CASE p.section_pos WHEN 1 THEN 'login.py' ELSE '' END AS login_code,
    CASE p.section_pos WHEN 1 THEN '' ELSE 'ログイン=login.py x' END AS prerequisites"""


def _instructions() -> Column:
    """An instruction text of two sections for a customer."""
    return F.concat(
        F.lit("## 1. login\n--概要\n説明\n--url\nhttps://login.example.com/\n--ログインコード\nlogin.py\n--取得要素\nID　欄\n\nパスワード　欄\n\n## 2. "),
        "c_name",
        F.lit("\n@https://app.example.com/"),
        F.col("c_custkey").cast("string"),
        F.lit("\n--前提操作\nログイン login.py x\n--操作手順\n1. "),
        "c_name",
        F.lit("をクリック\n番号なし\n2. 5秒待機\n--取得要素\n"),
        "c_mktsegment",
        F.lit("　ボタン\n　期間"),
    )


def _shown_sections(sections: DataFrame, *keys: str) -> DataFrame:
    pairs = F.transform("prerequisites", lambda p: F.concat(p["type"], F.lit("="), p["value"]))
    return sections.select(
        *keys,
        "section_pos",
        "title",
        "section",
        "url",
        F.array_join("elements", "|").alias("elements"),
        F.array_join("operations", "|").alias("operations"),
        "login_code",
        F.array_join(pairs, "|").alias("prerequisites"),
    )


@query(f"SELECT c_custkey, p.section_pos, {_SECTION_COLUMNS} FROM customer CROSS JOIN (VALUES (1), (2)) p(section_pos)")
def instruction_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction texts, one per customer, as their sections."""
    content = F.concat(F.lit("前書き\n"), _instructions()).alias("content")
    customers = table(spark, sf_dir, "customer").select("c_custkey", content)
    return _shown_sections(instruction_sections(customers, "content", "c_custkey"), "c_custkey")


@query(
    f"""SELECT (2 * rank - 2 + p.section_pos)::INT AS section_pos, {_SECTION_COLUMNS}
    FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey // 4096 ORDER BY c_custkey) AS rank FROM customer) CROSS JOIN (VALUES (1), (2)) p(section_pos)"""
)
def instruction_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction files that hold the texts of many customers: sections numbered in their file."""
    path = work_path(spark, "instructions")
    customers = table(spark, sf_dir, "customer").withColumn("part", F.floor(F.col("c_custkey") / 4096))
    texts = customers.repartition("part").sortWithinPartitions("part", "c_custkey").select(_instructions().alias("value"), "part")
    texts.write.partitionBy("part").text(path)
    return _shown_sections(scan_instructions(spark, path))


@query(
    f"""WITH p AS (SELECT page_id, {_LINKS} AS links FROM pages), t AS (SELECT page_id, links, links[-1] AS target FROM p)
    SELECT page_id, target, 'link_text' AS rule, 'a' AS tag, target AS text FROM t WHERE len(links) > 0 AND target <> ''"""
)
def locate_clickable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step on every page that names the text of its last menu link."""
    menu = F.regexp_extract("html", "(?s)<nav>(.*?)</nav>", 1)
    last = F.try_element_at(F.regexp_extract_all(menu, F.lit("<a [^>]*>([^<]+)</a>"), F.lit(1)), F.lit(-1))
    pages = table(spark, sf_dir, "pages")
    steps = pages.select("page_id", F.concat(last, F.lit("をクリック")).alias("operation")).where(last.isNotNull())
    targets = S.parse_steps(steps).select("page_id", "target")
    return S.locate_clickable(pages, targets).select("page_id", "target", "rule", "tag", "text")


def form_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page with a form for every part: a field and a select whose names and labels tell the part."""
    name, kind = F.col("p_name"), F.col("p_type")
    html = F.concat(
        F.lit("<html><body><div class='error-box'>"),
        kind,
        F.lit("</div><a class='main-MENU'>"),
        name,
        F.lit("</a><form><label>"),
        kind,
        F.lit("</label><p><input id='f"),
        F.col("p_partkey").cast("string"),
        F.lit("' name='"),
        name,
        F.lit("' placeholder='size "),
        F.col("p_size").cast("string"),
        F.lit("'></p><label>pick</label><select name='sel'><option value='v1'>"),
        F.col("p_brand"),
        F.lit("</option><option value='"),
        F.col("p_brand"),
        F.lit("x'> second  one </option></select><button class='nav'>"),
        kind,
        F.lit("</button></form></body></html>"),
    )
    parts = table(spark, sf_dir, "part")
    return spread(parts.select(F.col("p_partkey").alias("page_id"), html.alias("html")))


@query(
    """SELECT p_partkey AS page_id, p_type AS error_messages, p_name || '|' || p_type AS menu_items FROM part"""
)
def page_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error texts and menu texts found by their classes."""
    profile = P.page_profile(form_pages(spark, sf_dir))
    joined = [F.array_join(c, "|").alias(c) for c in ("error_messages", "menu_items")]
    return profile.select("page_id", *joined)


@query(
    """SELECT p_partkey AS page_id, CASE p_partkey % 5 WHEN 0 THEN 'name' WHEN 1 THEN 'id' WHEN 2 THEN 'placeholder'
    WHEN 3 THEN 'label' END AS rule, CASE WHEN p_partkey % 5 < 4 THEN 'input' END AS tag FROM part"""
)
def locate_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input steps on every form page: by name, id, placeholder, label, and one without a field."""
    kind = F.col("p_partkey") % 5
    target = (
        F.when(kind == 0, F.col("p_name"))
        .when(kind == 1, F.concat(F.lit("f"), F.col("p_partkey").cast("string")))
        .when(kind == 2, F.concat(F.lit("size "), F.col("p_size").cast("string")))
        .when(kind == 3, F.col("p_type"))
        .otherwise("no such field")
    )
    steps = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), target.alias("target"))
    return S.locate_input(form_pages(spark, sf_dir), steps).select("page_id", "rule", "tag")


@query(
    """SELECT p_partkey AS page_id, CASE WHEN p_partkey % 2 = 0 THEN 'name' ELSE 'label' END AS select_rule,
    CASE p_partkey % 4 WHEN 0 THEN 'visible_text' WHEN 1 THEN 'value' WHEN 2 THEN 'index' END AS option_rule,
    CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN 'second  one' WHEN 2 THEN 'second  one' END AS option_text FROM part"""
)
def locate_option(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Select steps on every form page: option by text, value, place, and one that is not there."""
    kind = F.col("p_partkey") % 4
    value = (
        F.when(kind == 0, F.col("p_brand"))
        .when(kind == 1, F.concat("p_brand", F.lit("x")))
        .when(kind == 2, F.lit("2"))
        .otherwise("no such option")
    )
    target = F.when(F.col("p_partkey") % 2 == 0, "sel").otherwise("pick")
    steps = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("page_id"), target.alias("target"), value.alias("value")
    )
    found = S.locate_option(form_pages(spark, sf_dir), steps)
    return found.select("page_id", "select_rule", "option_rule", "option_text")


@query(
    """SELECT p_partkey AS page_id, p_partkey % 3 <> 1 AS selector_found FROM part WHERE p_partkey % 4 <> 3
    UNION ALL SELECT p_partkey, NULL FROM part WHERE p_partkey % 4 = 3"""
)
def selector_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose id or name their page has, records whose it has not, and records without either."""
    wrong, key = F.col("p_partkey") % 3 == 1, F.col("p_partkey")
    id_ = F.when(key % 4 == 0, F.concat(F.when(wrong, F.lit("x")).otherwise("f"), key.cast("string"))).otherwise("")
    name = F.when(key % 4 != 3, F.when(wrong, F.lit("absent")).otherwise(F.col("p_name"))).otherwise("")
    selectors = F.create_map(F.lit("id"), id_, F.lit("name"), name)
    records = table(spark, sf_dir, "part").select(key.alias("page_id"), selectors.alias("selectors"))
    return check_selectors(form_pages(spark, sf_dir), records).select("page_id", "selector_found")


@query(
    f"""SELECT 'r1' AS run_id, 'elements ' || {_SECTION} AS stage, 'done' AS status, sum(len({_LINKS})) :: BIGINT AS "rows",
    '' AS error, '' AS detail FROM pages GROUP BY ALL HAVING sum(len({_LINKS})) > 0"""
)
def section_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element counts per section as run-log rows."""
    return section_log(P.element_inventory(pages_by_section(spark, sf_dir)), "r1")
