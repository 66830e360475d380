"""Queries on whole jobs and on odd input: several files, long fields, shared histories, requests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import alerts as A
from feedloom.operators.elements import elements_per_section
from feedloom.operators.pages import page_inventories, page_profile
from feedloom.operators.quality import profile_csv, ragged_rows
from feedloom.operators.selectors import resolve_selectors
from feedloom.plans.daily import convert_counts, convert_feeds, extract_pages, integrate_feeds
from feedloom.queries.pages import _LINKS, pages_by_section
from feedloom.queries.registry import query, table, write_lines
from feedloom.session import work_path
from feedloom.sinks.batches import export_batches
from feedloom.sinks.elements import page_documents, write_elements
from feedloom.sinks.feeds import DAY, FILE, append_feed, remove_old_days, with_day, write_feed_csv
from feedloom.sinks.versions import drop_days, keep_newest_days, read_history, replace_days, sweep
from feedloom.sources.catalogues import scan_selectors
from feedloom.sources.pages import scan_elements
from feedloom.sources.feeds import scan_feed, scan_mixed_feed
from feedloom.streaming.feeds import append_stream, stream_feed

_SECTION = "regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)', 1)"
RUN_DATE = dt.date(2024, 2, 1)


@query(f"SELECT {_SECTION} AS section, sum(len({_LINKS})) :: BIGINT AS element_count FROM pages GROUP BY 1")
def sections_written_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections written in two calls, one of them twice: each call replaces its own sections alone."""
    path = work_path(spark, "sections")
    documents = page_documents(page_inventories(pages_by_section(spark, sf_dir)))
    early = F.col("section") < "n"
    write_elements(documents.where(early), path)
    write_elements(documents.where(~early | F.col("section").isNull()), path)
    write_elements(documents.where(early), path)
    return elements_per_section(scan_elements(spark, path, multi_line=False))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def feed_headers_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one feed whose columns differ in order, matched by name."""
    orders = table(spark, sf_dir, "orders")
    key, status, priority = F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority")
    odd = F.col("o_orderkey") % 2 == 1
    paths = [
        write_lines(orders.where(odd), F.concat_ws(",", key, status, priority), "o_orderkey,o_orderstatus,o_orderpriority", "plain"),
        write_lines(orders.where(~odd), F.concat_ws(",", priority, key, status), "o_orderpriority,o_orderkey,o_orderstatus", "turned"),
    ]
    return scan_mixed_feed(spark, paths, ["o_orderkey", "o_orderstatus", "o_orderpriority"])


def _long_fields(spark: SparkSession, sf_dir: str, header: str | None) -> str:
    """A document per record, its text one quoted field; every third record has a field too many."""
    text = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    extra = F.when(F.col("doc_id") % 3 == 0, F.lit(",more")).otherwise(F.lit(""))
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return write_lines(docs, F.concat(F.col("doc_id").cast("string"), F.lit(","), text, extra), header, "long_fields", "UTF-8")


@query("SELECT 'long_row' AS issue, 3 AS field_count, count(*) AS times FROM documents WHERE text IS NOT NULL AND doc_id % 3 = 0")
def ragged_long_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on wrong-width records of whole texts as quoted fields."""
    scanned = scan_feed(spark, _long_fields(spark, sf_dir, "doc_id,text"), encoding="UTF-8", with_source=True)
    return ragged_rows(scanned, "documents", 2).groupBy("issue", "field_count").agg(F.count("*").alias("times"))


@query("SELECT count(*) AS row_count, 3 AS max_fields FROM documents WHERE text IS NOT NULL")
def csv_profile_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and widest row of the same records, which hold line ends inside quotes."""
    return profile_csv(spark, _long_fields(spark, sf_dir, None))


_BLANKS = 3000


@query(f"SELECT page_id, url || repeat(' ', {_BLANKS}) || url AS title FROM pages")
def page_blank_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of pages padded with long runs of blanks, inside and at both ends."""
    pad = F.repeat(F.lit(" "), F.lit(_BLANKS))
    html = F.concat(F.lit("<html><head><title>"), pad, "url", pad, "url", pad, F.lit("　</title></head><body></body></html>"))
    return page_profile(table(spark, sf_dir, "pages").select("page_id", html.alias("html"))).select("page_id", F.col("page_title").alias("title"))


@query(
    """SELECT strftime(ts, '%Y/%m/%d') AS "日付", CAST(event_id AS VARCHAR) AS event_id, event_type,
    CASE WHEN event_id % 2 = 0 THEN 'stream' ELSE 'batch' END AS way FROM events"""
)
def feed_shared_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of files and a batch that is run twice, in one history."""
    drop, history = work_path(spark, "shared_drop"), work_path(spark, "shared_history")
    events = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy/MM/dd").alias("日付"), F.col("event_id").cast("string").alias("event_id"), "event_type"
    )
    even = F.col("event_id").cast("long") % 2 == 0
    write_feed_csv(events.where(even).repartitionByRange("日付"), drop)
    append_stream(stream_feed(spark, drop, events.columns), history, work_path(spark, "shared_state")).awaitTermination()
    for _ in range(2):
        append_feed(with_day(events.where(~even)), history, rebalance=True, source="batch")
    way = F.when(F.col(FILE) == "batch", "batch").otherwise("stream").alias("way")
    return spark.read.parquet(history).select(*events.columns, way)


@query(
    """SELECT strftime(ts, '%Y/%m/%d') AS "日付", CAST(event_id AS VARCHAR) AS event_id, CASE WHEN day(ts) % 2 = 0 THEN 'second' ELSE 'first' END AS version
    FROM events WHERE CAST(ts AS DATE) IN (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events ORDER BY d DESC LIMIT 9) AND day(ts) <> 5"""
)
def history_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history by pointer: even days replaced, the newest nine days kept, the fifth of the month taken out."""
    history = work_path(spark, "versions")
    events = table(spark, sf_dir, "events")
    feed = with_day(events.select(F.date_format("ts", "yyyy/MM/dd").alias("日付"), F.col("event_id").cast("string").alias("event_id"), F.lit("first").alias("version")))
    replace_days(feed, history, rebalance=True)
    replace_days(feed.where(F.dayofmonth(DAY) % 2 == 0).withColumn("version", F.lit("second")), history, rebalance=True)
    keep_newest_days(spark, history, 9)
    drop_days(spark, history, lambda day: not day.endswith("-05"))
    sweep(spark, history)
    return read_history(spark, history).drop(DAY)


def _delivered(df: DataFrame, drop: str, hours: int) -> None:
    """One more delivery in the drop folder, its files modified so many hours after a fixed time."""
    spark, path = df.sparkSession, work_path(df.sparkSession, "delivery")
    write_feed_csv(df, path)
    home, target = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (path, drop))
    system = home.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target)
    for file in system.listStatus(home):
        if file.getPath().getName().endswith(".csv"):
            system.setTimes(file.getPath(), 1_700_000_000_000 + hours * 3_600_000, -1)
            system.rename(file.getPath(), spark._jvm.org.apache.hadoop.fs.Path(target, file.getPath().getName()))


@query(
    """SELECT strftime(ts, '%Y/%m/%d') AS "日付", CAST(event_id AS VARCHAR) AS event_id,
    CASE WHEN day(ts) % 2 = 0 THEN 'corrected' ELSE 'first' END AS version FROM events"""
)
def feed_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries of the same days: a first one, a correction of even days, an older one that comes late, and all of them again."""
    drop, history = work_path(spark, "corrected_drop"), work_path(spark, "corrected_history")
    events = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy/MM/dd").alias("日付"), F.col("event_id").cast("string").alias("event_id"), F.dayofmonth("ts").alias("day")
    )
    by_day = events.repartitionByRange("日付")  # a day lies in one file of a delivery

    def version(name: str) -> DataFrame:
        return by_day.select("日付", "event_id", F.lit(name).alias("version"))

    def take_in(state: str) -> None:
        rows = stream_feed(spark, drop, ["日付", "event_id", "version"])
        append_stream(rows, history, state, newest_wins=True).awaitTermination()

    state = work_path(spark, "corrected_state")
    _delivered(version("first"), drop, 1)
    take_in(state)
    _delivered(by_day.where("day % 2 = 0").select("日付", "event_id", F.lit("corrected").alias("version")), drop, 2)
    take_in(state)
    _delivered(version("stale").where("event_id % 3 = 0"), drop, 0)
    take_in(state)
    take_in(work_path(spark, "corrected_again"))
    return spark.read.parquet(history).select("日付", "event_id", "version")


@query(
    """SELECT strftime(ts, '%Y/%m/%d') AS "日付", CAST(event_id AS VARCHAR) AS event_id FROM events
    WHERE CAST(ts AS DATE) IN (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events ORDER BY d DESC LIMIT 5)"""
)
def history_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history from which all days but the newest five are deleted."""
    history = work_path(spark, "kept_history")
    events = table(spark, sf_dir, "events")
    feed = events.select(F.date_format("ts", "yyyy/MM/dd").alias("日付"), F.col("event_id").cast("string").alias("event_id"))
    append_feed(with_day(feed), history, rebalance=True)
    remove_old_days(spark, history, 5)
    return spark.read.parquet(history).drop(DAY)


@query(
    """SELECT CAST(p_partkey AS VARCHAR) AS key, CASE WHEN p_partkey % 5 = 0 THEN 'a\rb' ELSE 'plain' END AS note,
    p_brand AS brand FROM part"""
)
def feed_lone_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted fields with a lone carriage return, in a file that may not be read in parts."""
    note = F.when(F.col("p_partkey") % 5 == 0, F.lit("a\rb")).otherwise(F.lit("plain"))
    path = work_path(spark, "returns")
    write_feed_csv(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("key"), note.alias("note"), F.col("p_brand").alias("brand")), path)
    return scan_feed(spark, path, multi_line=None)


@query(
    """SELECT p_brand AS "group", 'n' || CAST(p_size AS VARCHAR) AS name, 'css' AS selector_type,
    'late' || CAST(max(p_partkey) AS VARCHAR) AS selector_value FROM part GROUP BY ALL"""
)
def catalogue_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two catalogue files of unlike size: the later file's last entry of a name wins."""
    # the names of part files keep the order of the ranges
    parts = table(spark, sf_dir, "part").repartitionByRange(8, "p_partkey").sortWithinPartitions("p_partkey")
    folder = work_path(spark, "catalogue")
    cells = [F.col("p_brand").alias("group"), F.concat(F.lit("n"), F.col("p_size").cast("string")).alias("name"), F.lit("css").alias("selector_type")]
    padded = F.concat(F.lit("early "), F.repeat(F.lit("x"), F.lit(50)))
    for name, value in (("a", padded), ("b", F.concat(F.lit("late"), F.col("p_partkey").cast("string")))):
        parts.select(*cells, value.alias("selector_value")).write.option("header", True).csv(f"{folder}/{name}")
    return scan_selectors(spark, [f"{folder}/a", f"{folder}/b"], defaults=False)


@query(
    """SELECT key, row_number() OVER (ORDER BY part, key) - 1 AS row_index FROM (
    SELECT 0 AS part, c_custkey AS key FROM customer UNION ALL SELECT 1, s_suppkey FROM supplier)"""
)
def export_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows numbered in the order of their files, the larger file first or not."""
    folder = work_path(spark, "ordered")
    for name, source, key in (("a", "customer", "c_custkey"), ("b", "supplier", "s_suppkey")):
        rows = table(spark, sf_dir, source).select(F.col(key).alias("key")).repartitionByRange(8, "key").sortWithinPartitions("key")
        rows.write.parquet(f"{folder}/{name}")
    return export_batches(spark.read.parquet(f"{folder}/a", f"{folder}/b")).select("key", "row_index")


def _at(row: Column) -> list[Column]:
    return [F.lit("test"), F.lit("h"), row]


@query(
    """SELECT event_id, '通知' AS title, '環境=test|ホスト=h|発生時刻=' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS fields FROM events"""
)
def notices_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain notices with the three fields that every message carries."""
    rows = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("message"), "ts")
    built = A.build_notices(rows, None, *_at(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    shown = F.transform("fields", lambda f: F.concat(f["title"], F.lit("="), f["value"]))
    return built.select("event_id", "title", F.array_join(shown, "|").alias("fields"))


@query(
    """SELECT event_id, '<@u1>' || CASE event_id % 4 WHEN 0 THEN '認証に失敗しました。詳細はログファイルをご覧ください。'
    WHEN 1 THEN 'リクエストされたリソースが見つかりません。詳細はログファイルをご覧ください。'
    WHEN 2 THEN 'サーバーエラーが発生しました。詳細はログファイルをご覧ください。'
    ELSE '予期せぬエラーが発生しました。詳細はログファイルをご覧ください。' END AS text, 'bot' AS username FROM events"""
)
def status_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed requests as short messages: known codes, an unknown one, none."""
    kind = F.col("event_id") % 4
    code = F.when(kind == 0, 401).when(kind == 1, 404).when(kind == 3, 418)
    failures = table(spark, sf_dir, "events").select("event_id", code.alias("status_code"))
    return A.status_alerts(failures, "u1", "bot").select("event_id", "text", "username")


@query(f"SELECT page_id, 'first_link' AS name, {_LINKS}[1] AS text FROM pages WHERE page_id % 3 = 0 UNION ALL SELECT page_id, 'absent', NULL FROM pages WHERE page_id % 3 = 1")
def selector_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the selectors that a page is asked for."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    rows = [("page", "first_link", "css", "nav li > a"), ("page", "absent", "id", "no-such-id"), ("page", "heading", "css", "h1")]
    catalogue = spark.createDataFrame(rows, "`group` string, name string, selector_type string, selector_value string")
    kind = F.col("page_id") % 3
    wanted = pages.where(kind < 2).select("page_id", F.lit("page").alias("group"), F.when(kind == 0, "first_link").otherwise("absent").alias("name"))
    return resolve_selectors(pages, catalogue, requests=wanted).select("page_id", "name", "text")


@query(f"SELECT section, sum(n)::BIGINT AS element_count FROM (SELECT {_SECTION} AS s, len({_LINKS}) AS n FROM pages), (VALUES ('one'), ('two')) v(section) WHERE (section = 'one') = (s < 'n') GROUP BY section HAVING sum(n) > 0")
def pages_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page job for two sections, one after the other, into one folder."""
    target = work_path(spark, "extracted")
    pages = pages_by_section(spark, sf_dir)
    for name, part in (("one", F.col("section") < "n"), ("two", ~(F.col("section") < "n"))):
        extract_pages(pages.where(part).drop("section"), name, target)
    return elements_per_section(scan_elements(spark, target, multi_line=False))


def _day_files(spark: SparkSession, sf_dir: str) -> str:
    """The day's three feed files as one folder: a name between day and end, a plain name, and none."""
    folder = work_path(spark, "day_files")
    orders = table(spark, sf_dir, "orders").select(F.lit("2024/01/31").alias("日付"), F.col("o_orderkey").cast("string").alias("広告名"), F.col("o_orderstatus").alias("値"))
    write_feed_csv(orders, f"{folder}/20240131_report_CVrepo.csv")
    write_feed_csv(orders.where("o_orderstatus = 'O'"), f"{folder}/20240131_CV.csv")
    return folder


@query(
    """SELECT 'cv_attr' AS feed, count(*) AS rows FROM orders UNION ALL SELECT 'cv', count(*) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'missing ss', NULL"""
)
def feeds_integrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day's feed files into their histories; the file that is not there is reported."""
    history = work_path(spark, "integrated")
    issues = integrate_feeds(spark, _day_files(spark, sf_dir), history, RUN_DATE)
    counts = [spark.read.parquet(f"{history}/{f}").agg(F.lit(f).alias("feed"), F.count("*").alias("rows")) for f in ("cv_attr", "cv")]
    missing = issues.select(F.concat(F.lit("missing "), "feed").alias("feed"), F.lit(None).cast("long").alias("rows"))
    return counts[0].unionByName(counts[1]).unionByName(missing)


@query("""SELECT '2024/01/31' AS "日付", CAST(o_orderkey AS VARCHAR) AS "広告名", o_orderstatus AS "値" FROM orders""")
def feeds_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole feed file to Parquet."""
    target = work_path(spark, "converted")
    convert_feeds(spark, _day_files(spark, sf_dir), {"cv_attr": "20240131_CVrepo.csv"}, target)
    return spark.read.parquet(f"{target}/cv_attr")


@query("""SELECT c_name AS "教室", CAST(c_custkey AS DOUBLE) AS "教室グループID", nullif(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END, '') AS "区分" FROM customer""")
def counts_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classroom job: numeric columns by name, blank text as null."""
    source, target = work_path(spark, "counts"), work_path(spark, "counts_out")
    segment = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("")
    rows = table(spark, sf_dir, "customer").select(F.col("c_name").alias("教室"), F.col("c_custkey").cast("string").alias("教室グループID"), segment.alias("区分"))
    write_feed_csv(rows, source)
    convert_counts(spark, source, target)
    return spark.read.parquet(target)
