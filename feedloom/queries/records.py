"""Queries on records: page state, hosts, site records, alerts, element lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.urls import host_of
from feedloom.operators import alerts as A
from feedloom.operators import elements as E
from feedloom.operators import state as S
from feedloom.operators.arrays import append_missing
from feedloom.operators.html import spread
from feedloom.queries.registry import query, table

LOGIN = "https://m."
MARKERS = ("ththe", "Ththe")
LOGIN_TEXTS = ("wherethe", "eaurela")


@query(
    """WITH r AS (SELECT page_id, CASE WHEN contains(url, 'https://m.') THEN 'login_url'
    WHEN contains(url, 'example.com') AND (contains(html, 'ththe') OR contains(html, 'Ththe')) THEN 'dashboard_marker'
    WHEN contains(html, 'wherethe') OR contains(html, 'eaurela') THEN 'login_marker'
    WHEN contains(url, 'blog.') THEN 'login_host' WHEN contains(url, 'www.') THEN 'dashboard_host'
    ELSE 'not_login_url' END AS rule FROM pages)
    SELECT page_id, rule IN ('dashboard_marker', 'dashboard_host', 'not_login_url') AS signed_in, rule FROM r"""
)
def page_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed in or not, and the rule that says so."""
    state = S.page_state(
        F.col("url"), F.col("html"), LOGIN, "https://example.com/start", "blog.", "www.", MARKERS, LOGIN_TEXTS
    )
    return table(spark, sf_dir, "pages").select("page_id", state.alias("s")).select("page_id", "s.*")


@query(
    """WITH r AS (SELECT page_id, CASE WHEN contains(url, 'example.com') THEN 'success_host'
    WHEN contains(url, '/fr/') AND contains(html, 'class="ad"') THEN 'failure_notice'
    WHEN contains(url, '://m.') THEN 'still_at_login' ELSE 'left_login' END AS rule FROM pages)
    SELECT page_id, rule IN ('success_host', 'left_login') AS succeeded, rule FROM r"""
)
def login_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of a login by address and failure notice; the ad box of French pages is made one."""
    noticed = F.replace(F.col("html"), F.lit('class="ad"'), F.lit('class="box alert-danger"'))
    html = F.when(F.contains("url", F.lit("/fr/")), noticed).otherwise(F.col("html"))
    pages = spread(table(spark, sf_dir, "pages").withColumn("html", html))
    return S.login_outcome(pages, "example.com", "://m.").select("page_id", "succeeded", "rule")


@query(
    """WITH h AS (SELECT DISTINCT split_part(replace(replace(url, 'https://', ''), 'http://', ''), '/', 1) AS host FROM pages),
    k AS (SELECT DISTINCT host AS related_host FROM h UNION SELECT DISTINCT regexp_replace(host, '^[^.]+[.]', '') FROM h),
    s AS (SELECT host, unnest(CASE WHEN contains(host, 'example.net') THEN ['blog.thther.example.net', 'gone.example.net'] ELSE [] :: VARCHAR[] END) AS related_host FROM h
    UNION SELECT host, array_to_string(list_slice(string_split(host, '.'), i, 99), '.')
    FROM h, range(1, 99) r(i) WHERE i = 1 OR i < len(string_split(host, '.')))
    SELECT host, related_host FROM s WHERE related_host IN (SELECT related_host FROM k)"""
)
def related_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every host's parents and siblings among the hosts and parent hosts of the pages."""
    hosts = table(spark, sf_dir, "pages").select(host_of(F.col("url")).alias("host"))
    known = hosts.union(hosts.select(F.regexp_replace("host", r"^[^.]+\.", "")))
    return S.related_hosts(hosts, known, "example.net", ["blog.thther.example.net", "gone.example.net"])


_DOMAIN = """CASE event_type WHEN 'click' THEN '.example.com' WHEN 'view' THEN 'other.test' WHEN 'error' THEN '.other.test'
    WHEN 'signup' THEN 'app.example.com' ELSE 'example.com' END"""


@query(
    f"""SELECT event_id, 'domain,name,path,value' AS kept, CASE event_type WHEN 'click' THEN 'app.example.com' WHEN 'view' THEN 'app.example.com'
    ELSE {_DOMAIN} END AS domain, CAST(user_id AS VARCHAR) AS value FROM events"""
)
def retarget_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record maps moved to another host."""
    domain = (
        F.when(F.col("event_type") == "click", ".example.com")
        .when(F.col("event_type") == "view", "other.test")
        .when(F.col("event_type") == "error", ".other.test")
        .when(F.col("event_type") == "signup", "app.example.com")
        .otherwise("example.com")
    )
    fields = {
        "name": F.lit("session"),
        "value": F.col("user_id").cast("string"),
        "domain": domain,
        "path": F.lit("/"),
        "expiry": F.lit("1"),
        "expires": F.lit("never"),
        "httpOnly": F.lit("true"),
        "sameSite": F.lit("Lax"),
        "secure": F.lit("true"),
    }
    record = F.create_map(*[c for k, v in fields.items() for c in (F.lit(k), v)])
    moved = S.retarget_record(record, F.lit("app.example.com"))
    return table(spark, sf_dir, "events").select("event_id", moved.alias("m")).select(
        "event_id",
        F.array_join(F.array_sort(F.map_keys("m")), ",").alias("kept"),
        F.col("m")["domain"].alias("domain"),
        F.col("m")["value"].alias("value"),
    )


@query("SELECT doc_id, source, text FROM documents WHERE source <> '' AND text <> '' AND length(text) <= 4000")
def skip_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a name and a value that is not too long."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return S.skip_bad_records(documents, "source", "text")


_CODES = ", ".join(f"({code}, '{text}')" for code, text in A.STATUS_MESSAGES.items())


@query(
    f"""SELECT event_id, coalesce(m.message, '{A.UNKNOWN_STATUS}') AS message FROM events LEFT JOIN (VALUES {_CODES}) m(code, message)
    ON m.code = coalesce(CASE WHEN event_type <> 'view' THEN 400 + event_id % 110 END, 500)"""
)
def status_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of status codes; events without one count as 500."""
    code = F.when(F.col("event_type") != "view", 400 + F.col("event_id") % 110)
    return table(spark, sf_dir, "events").select("event_id", A.status_message(code).alias("message"))


_TRACE = "repeat(props || chr(10), CAST(user_id AS BIGINT))"


@query(
    f"""SELECT event_id, 'エラー発生' AS title, '#ff0000' AS color, '*failed ' || CAST(event_id AS VARCHAR) || '*' || chr(10)
    || chr(10) || '```' || chr(10) || props || chr(10) || '```' || CASE WHEN {_TRACE} = '' THEN '' ELSE chr(10) || '*スタックトレース:*' || chr(10)
    || '```' || chr(10) || left({_TRACE}, 1000) || '```' || CASE WHEN length({_TRACE}) > 1000 THEN chr(10)
    || '(スタックトレースが長すぎるため省略されました)' ELSE '' END END AS text,
    '環境=test|ホスト=h|発生時刻=' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '|user=' || CAST(user_id AS VARCHAR) AS fields
    FROM events WHERE event_type = 'error'"""
)
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events as alert records."""
    failures = table(spark, sf_dir, "events").where("event_type = 'error'").select(
        "event_id",
        "ts",
        F.concat(F.lit("failed "), F.col("event_id").cast("string")).alias("message"),
        F.col("props").alias("exception"),
        F.struct(F.concat("props", F.lit("\n")).alias("frame"), F.col("user_id").cast("int").alias("times")).alias("stack_trace"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("context"),
    )
    built = A.build_alerts(failures, F.lit("test"), F.lit("h"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    shown = F.transform("fields", lambda f: F.concat(f["title"], F.lit("="), f["value"]))
    return built.select("event_id", "title", "color", "text", F.array_join(shown, "|").alias("fields"))


@query(
    """SELECT event_id, coalesce(nullif(CASE WHEN event_type = 'click' THEN '' ELSE event_type END, ''), '通知') AS title,
    '#36a64f' AS color, props AS text FROM events"""
)
def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain notices; without a title they get the standard one."""
    rows = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("message"), "event_type")
    title = F.when(F.col("event_type") != "click", F.col("event_type"))
    return A.build_notices(rows, title).select("event_id", "title", "color", "text")


_NAME = """CASE event_type WHEN 'click' THEN 'パスワード　入力フィールド' WHEN 'view' THEN 'ログイン　クリックボタン'
    WHEN 'error' THEN NULL ELSE event_type END"""


@query(
    f"""SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'detail_analytics' ELSE 'login' END AS section, {_NAME} AS element_name
    FROM events WHERE NOT (user_id % 2 = 0 AND event_type IN ('click', 'view'))"""
)
def exclude_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Login elements left out of one section only."""
    name = (
        F.when(F.col("event_type") == "click", "パスワード　入力フィールド")
        .when(F.col("event_type") == "view", "ログイン　クリックボタン")
        .when(F.col("event_type") != "error", F.col("event_type"))
    )
    section = F.when(F.col("user_id") % 2 == 0, "detail_analytics").otherwise("login")
    rows = table(spark, sf_dir, "events").select("event_id", section.alias("section"), name.alias("element_name"))
    return E.exclude_named(rows)


@query(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 0 WHEN event_type = 'view' THEN 1 ELSE 2 END :: BIGINT AS found,
    CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS first_name,
    CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE CAST(user_id AS VARCHAR) END AS second_id FROM events"""
)
def elements_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reply texts as element lists; replies that break off give none."""
    first = F.concat(F.lit('{"elements": [{"element_name": "'), "event_type", F.lit('"}'))
    second = F.concat(
        first, F.lit(', {"element_name": "b", "selectors": {"id": "'), F.col("user_id").cast("string"), F.lit('"}}]}')
    )
    reply = (
        F.when(F.col("event_type") == "error", first)
        .when(F.col("event_type") == "view", F.concat(first, F.lit("]}")))
        .otherwise(second)
    )
    parsed = table(spark, sf_dir, "events").select("event_id", E.parse_elements_json(reply).alias("e"))
    return parsed.select(
        "event_id",
        F.size("e").cast("bigint").alias("found"),
        F.try_element_at("e", F.lit(1))["element_name"].alias("first_name"),
        F.try_element_at("e", F.lit(2))["selectors"]["id"].alias("second_id"),
    )


@query(
    """SELECT doc_id, array_to_string(list_filter(string_split(text, ' ')[1:3] || string_split(text, ' '),
    lambda t, i: i <= least(3, len(string_split(text, ' '))) OR
    list_position(string_split(text, ' ')[1:3] || string_split(text, ' '), t) = i), ' ') AS words FROM documents"""
)
def append_missing_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three words of a text, then each further word that is not among them, once."""
    words = F.split("text", " ", -1)
    joined = append_missing(F.slice(words, 1, 3), words)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(joined, " ").alias("words"))


@query(
    """SELECT user_id, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 2 END) :: BIGINT AS kept FROM events GROUP BY user_id"""
)
def drop_blank_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map entries that have a value, counted per user."""
    entries = F.create_map(
        F.lit("id"), F.col("props"), F.lit("css"), F.when(F.col("event_type") != "view", F.col("event_type")), F.lit("xpath"), F.lit("")
    )
    sizes = table(spark, sf_dir, "events").select("user_id", F.size(E.drop_blank_entries(entries)).alias("n"))
    return sizes.groupBy("user_id").agg(F.sum("n").alias("kept"))
