"""Feed queries: reading, repairing, splitting, history, batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.dates import date_text, feed_path
from feedloom.operators import columns as C
from feedloom.operators.quality import lost_signs, missing_feeds, profile_csv, ragged_rows
from feedloom.plans.daily import run_daily_feeds
from feedloom.queries.registry import query, table, write_lines
from feedloom.session import work_path
from feedloom.sinks.batches import append_run_log, batch_report, deliver_batches, export_batches
from feedloom.sinks.feeds import (
    DAY,
    append_feed,
    append_rows,
    clear_table,
    keep_last_days,
    with_day,
    write_feed_csv,
    write_parquet,
)
from feedloom.sources.feeds import (
    REPORT_COLUMNS,
    feed_file_names,
    header_width,
    latest_file,
    read_header,
    scan_any_encoding,
    scan_feed,
    scan_feeds,
)
from feedloom.streaming.feeds import FILE, append_stream, stream_feed

RUN_DATE = dt.date(2024, 2, 1)


def _orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a name column full of quotes, commas, a newline and Windows-only characters."""
    name = F.concat(
        F.lit('～①「a,b"c"'), F.col("o_orderpriority"), F.lit("」\n"), F.col("o_orderkey").cast("string")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", name.alias("広告名"), "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("string").alias("o_orderdate")
    )


_ORDERS_NAME = """'～①「a,b"c"' || o_orderpriority || '」' || chr(10) || CAST(o_orderkey AS VARCHAR)"""


@query(
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, {_ORDERS_NAME} AS "広告名", o_orderstatus,
    CAST(CAST(round_even(o_totalprice, 0) AS BIGINT) AS VARCHAR) AS o_totalprice,
    CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders"""
)
def feed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """windows-31j CSV written and read back: money without decimals, all columns text."""
    path = work_path(spark, "orders_feed")
    write_feed_csv(_orders_feed(spark, sf_dir), path)
    return C.as_text(scan_feed(spark, path))


@query(
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, {_ORDERS_NAME} AS "広告名" FROM orders"""
)
def feed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two named columns of a wider feed."""
    path = work_path(spark, "orders_feed")
    write_feed_csv(_orders_feed(spark, sf_dir), path)
    return scan_feed(spark, path, columns=["o_orderkey", "広告名"])


@query(
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, {_ORDERS_NAME} AS "広告名", o_orderstatus FROM orders"""
)
def feed_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with line ends inside quotes, cut into records in parts of its files."""
    path = work_path(spark, "orders_feed")
    write_feed_csv(_orders_feed(spark, sf_dir), path)
    return scan_feed(spark, path, columns=["o_orderkey", "広告名", "o_orderstatus"], multi_line=None)


def wide_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a wide report: a row per user with clicks, signups and columns to leave out.

    The counts only make input. A user without clicks or signups has a blank there.
    """
    events = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("event_type") == "signup").alias("signups"),
        F.count("*").alias("all_events"),
    )
    return events.select(
        F.concat(F.lit("広告～①_"), F.col("user_id").cast("string")).alias(REPORT_COLUMNS[0]),
        F.lit("媒体").alias("媒体名"),
        F.nullif("clicks", F.lit(0)).cast("double").alias(REPORT_COLUMNS[1]),
        F.nullif("signups", F.lit(0)).cast("double").alias(REPORT_COLUMNS[2]),
        F.col("all_events").alias("表示回数"),
    )


def write_report(spark: SparkSession, sf_dir: str) -> str:
    """The wide report and the attribute report in a fresh drop folder."""
    drop = work_path(spark, "drop")
    write_feed_csv(wide_report(spark, sf_dir), f"{drop}/detail_analyze_{RUN_DATE:%Y%m%d}.csv")
    price = F.concat(F.lit("￥"), F.format_number("o_totalprice", 2), F.lit("円"))
    attributes = table(spark, sf_dir, "orders").select("o_orderkey", price.alias("売上金額"), "o_orderstatus")
    write_feed_csv(attributes, f"{drop}/cv_attr_{RUN_DATE:%Y%m%d}.csv")
    return drop


def report_feed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """Report written, found, scanned, stamped, split and stored; one feed read back."""
    drop = write_report(spark, sf_dir)
    newest = latest_file(spark, drop).where("token = 'detail_analyze'").first()["path"]
    stamped = C.stamp_date(scan_feed(spark, newest, columns=REPORT_COLUMNS), RUN_DATE, 1)
    history = work_path(spark, feed)
    write_parquet(with_day(C.as_text(C.split_feed(stamped)[feed])), history)
    return spark.read.parquet(history).drop(DAY)


def _feed_sql(metric: str, event: str) -> str:
    return f"""SELECT '2024/01/31' AS "日付", '広告～①_' || CAST(user_id AS VARCHAR) AS "広告名",
    coalesce(CAST(nullif(count(*) FILTER (event_type = '{event}'), 0) AS VARCHAR), '') AS "{metric}"
    FROM events GROUP BY user_id"""


@query(_feed_sql("クリック数", "click"))
def feed_split_ss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_feed(spark, sf_dir, "ss")


@query(_feed_sql("応募完了（CV）", "signup"))
def feed_split_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_feed(spark, sf_dir, "cv")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, replace(format('{:.2f}', o_totalprice), ',', '') AS \"売上金額\", o_orderstatus FROM orders")
def daily_run_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole daily job on a drop folder; the attribute feed's history with cleaned money."""
    history = work_path(spark, "history")
    run_daily_feeds(spark, write_report(spark, sf_dir), history, RUN_DATE)
    return spark.read.parquet(f"{history}/cv_attr").drop(DAY)


@query(
    """SELECT v.stage, v.status, CASE WHEN v.status <> 'done' THEN NULL WHEN v.stage = 'find_files' THEN 2
    WHEN v.stage = 'cv_attr' THEN (SELECT count(*) FROM orders)
    ELSE (SELECT count(DISTINCT user_id) FROM events) END AS "rows"
    FROM (VALUES ('find_files', 'start'), ('find_files', 'done'), ('ss', 'start'), ('ss', 'done'), ('cv', 'start'),
    ('cv', 'done'), ('cv_attr', 'start'), ('cv_attr', 'done')) v(stage, status)"""
)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows of a daily run, saved to the run log and read from it."""
    log = work_path(spark, "run_log")
    run_daily_feeds(spark, write_report(spark, sf_dir), work_path(spark, "history"), RUN_DATE, log_path=log)
    return spark.read.parquet(log).select("stage", "status", "rows")


def _events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(date_text(F.col("ts")).alias("日付"), "event_id", "event_type", "value")


_EVENTS_BY_DAY = """SELECT strftime(ts, '%Y/%m/%d') AS "日付", event_id, event_type, value FROM events"""


@query(_EVENTS_BY_DAY)
def feed_append_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stored by day, then all stored again: the history holds each once."""
    history = work_path(spark, "events_history")
    for _ in range(2):
        append_feed(with_day(_events_by_day(spark, sf_dir)), history, rebalance=True)
    return spark.read.parquet(history).drop(DAY)


@query(
    """SELECT c_custkey, c_name, '2024-01-31' AS feed_date FROM customer
    UNION ALL SELECT s_suppkey, s_name, '2024-02-01' FROM supplier
    UNION ALL SELECT s_suppkey, s_name, '2024-02-01' FROM supplier"""
)
def feed_append_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, then suppliers twice, by position and without replacing."""
    history = work_path(spark, "raw_history")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    append_feed(with_day(customers, "2024-01-31"), history, mode="raw")
    for _ in range(2):
        append_feed(with_day(suppliers, "2024-02-01"), history, mode="raw")
    return spark.read.parquet(history).withColumn(DAY, F.col(DAY).cast("string"))


@query("SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def feed_append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables joined end to end by position."""
    return append_rows(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name"),
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
    )


@query(
    f"""SELECT * FROM ({_EVENTS_BY_DAY}) WHERE "日付" IN
    (SELECT DISTINCT strftime(ts, '%Y/%m/%d') AS d FROM events ORDER BY d DESC LIMIT 7)"""
)
def feed_rotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest seven days of a day-partitioned history."""
    history = work_path(spark, "events_history")
    append_feed(with_day(_events_by_day(spark, sf_dir)), history, rebalance=True)
    return keep_last_days(spark.read.parquet(history), 7).drop(DAY)


@query(
    """SELECT strftime(ts, '%Y/%m/%d') AS "日付", CAST(event_id AS VARCHAR) AS event_id, event_type,
    CAST(CAST(round_even(value, 0) AS BIGINT) AS VARCHAR) AS value FROM events"""
)
def feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily CSV files taken in as a file stream, two files at a time, into the history."""
    drop, history = work_path(spark, "stream_drop"), work_path(spark, "stream_history")
    daily = _events_by_day(spark, sf_dir).repartitionByRange("日付")
    write_feed_csv(daily, drop)
    rows = stream_feed(spark, drop, daily.columns, max_files=2)
    append_stream(rows, history, work_path(spark, "stream_state")).awaitTermination()
    return spark.read.parquet(history).drop(DAY, FILE)


def _money() -> Column:
    yen = F.format_number("o_totalprice", 2)
    return (
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("￥"), yen, F.lit("円")))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("-"), yen))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("なし"))
        .otherwise(F.concat(F.lit("1.２."), F.col("o_orderkey").cast("string")))
    )


_MONEY = """CASE WHEN o_orderstatus = 'O' THEN '￥' || format('{:,.2f}', o_totalprice) || '円'
    WHEN o_orderstatus = 'F' THEN '-' || format('{:,.2f}', o_totalprice)
    WHEN o_orderpriority = '5-LOW' THEN 'なし' ELSE '1.２.' || CAST(o_orderkey AS VARCHAR) END"""


def _money_feed(spark: SparkSession, sf_dir: str) -> str:
    path = work_path(spark, "money_feed")
    write_feed_csv(table(spark, sf_dir, "orders").select("o_orderkey", _money().alias("売上金額")), path)
    return path


@query(
    rf"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
    coalesce(nullif(regexp_replace({_MONEY}, '[^\p{{Nd}}.]', '', 'g'), ''), {_MONEY}) AS "売上金額" FROM orders"""
)
def currency_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The money column of a feed, cleaned while it is read."""
    return scan_feed(spark, _money_feed(spark, sf_dir))


@query(
    f"""SELECT 'orders' AS feed, 'lost_sign' AS issue, {_MONEY} AS detail FROM orders WHERE o_orderstatus = 'F'"""
)
def currency_lost_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negative amounts whose sign the cleaning removes."""
    raw = scan_feed(spark, _money_feed(spark, sf_dir), currency_column=None)
    return lost_signs(raw, "orders").select("feed", "issue", "detail")


def _ragged_line() -> Column:
    """A third of the customer lines is cut short, a third has two fields too many."""
    kind = F.col("c_custkey") % 3
    short = F.concat(F.col("c_custkey").cast("string"), F.lit(',"'), "c_name", F.lit(',x"'))
    full = F.concat_ws(",", short, "c_mktsegment")
    return F.when(kind == 1, short).when(kind == 2, F.concat(full, F.lit(",extra,extra"))).otherwise(full)


_RAGGED = """CAST(c_custkey AS VARCHAR) || ',"' || c_name || ',x"' || CASE c_custkey % 3 WHEN 1 THEN ''
    WHEN 2 THEN ',' || c_mktsegment || ',extra,extra' ELSE ',' || c_mktsegment END"""


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ',x' AS c_name,
    CASE c_custkey % 3 WHEN 1 THEN '' ELSE c_mktsegment END AS c_mktsegment FROM customer"""
)
def ragged_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short lines padded with empty text, long lines cut."""
    customers = table(spark, sf_dir, "customer")
    return scan_feed(spark, write_lines(customers, _ragged_line(), "c_custkey,c_name,c_mktsegment", "ragged"))


@query(
    f"""SELECT 'customer' AS feed, CASE c_custkey % 3 WHEN 1 THEN 'short_row' ELSE 'long_row' END AS issue,
    {_RAGGED} AS detail, CASE c_custkey % 3 WHEN 1 THEN 2 ELSE 5 END AS field_count, record_number
    FROM (SELECT *, 1 + row_number() OVER (PARTITION BY c_custkey // 4096 ORDER BY c_custkey) AS record_number FROM customer) WHERE c_custkey % 3 <> 0"""
)
def ragged_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that were repaired, with their raw text, number of fields and number in their file."""
    customers = table(spark, sf_dir, "customer").withColumn("part", F.floor(F.col("c_custkey") / 4096))
    path = work_path(spark, "ragged")
    lines = customers.repartition("part").sortWithinPartitions("part", "c_custkey").select(_ragged_line().alias("c_custkey,c_name,c_mktsegment"), "part")
    lines.write.options(header=True, sep="\x01", quote="").partitionBy("part").csv(path)
    width = header_width(read_header(spark, path))
    return ragged_rows(scan_feed(spark, path, with_source=True), "customer", width).drop("file_name")


@query("SELECT count(*) AS row_count, max(CASE c_custkey % 3 WHEN 1 THEN 2 WHEN 2 THEN 5 ELSE 3 END) AS max_fields FROM customer")
def csv_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and widest row of CSV text."""
    return profile_csv(spark, write_lines(table(spark, sf_dir, "customer"), _ragged_line(), None, "profile"))


_ODD_HEADER = " c_custkey ,c_name,,c_name,c_mktsegment, "


def _odd_lines(spark: SparkSession, sf_dir: str) -> str:
    customers = table(spark, sf_dir, "customer")
    line = F.concat_ws(
        ",",
        F.col("c_custkey").cast("string"),
        "c_name",
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")),
        "c_mktsegment",
        F.lit("last"),
        F.lit("blank"),
    )
    return write_lines(customers, line, _ODD_HEADER, "odd_header")


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, 'n' || CAST(c_nationkey AS VARCHAR) AS c_name_1,
    c_mktsegment FROM customer"""
)
def header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank header cells dropped, repeats numbered, values cut from the right."""
    return scan_feed(spark, _odd_lines(spark, sf_dir))


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment AS c_name_1, 'last' AS c_mktsegment
    FROM customer"""
)
def header_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same header with the columns of blank cells dropped."""
    return scan_feed(spark, _odd_lines(spark, sf_dir), blank_header="align")


def _mixed_number() -> Column:
    size = F.col("p_size").cast("string")
    kind = F.col("p_partkey") % 8
    return (
        F.when(kind == 0, size)
        .when(kind == 1, F.concat(size, F.lit("d")))
        .when(kind == 2, F.concat(F.lit("1,"), size))
        .when(kind == 3, F.concat(F.lit(" "), size, F.lit(".5 ")))
        .when(kind == 4, F.lit("nan"))
        .when(kind == 5, F.concat(size, F.lit("e2")))
        .when(kind == 6, F.concat(F.lit("-."), size))
        .otherwise(F.col("p_name"))
    )


_MIXED = """CASE p_partkey % 8 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN CAST(p_size AS VARCHAR) || 'd'
    WHEN 2 THEN '1,' || CAST(p_size AS VARCHAR) WHEN 3 THEN ' ' || CAST(p_size AS VARCHAR) || '.5 '
    WHEN 4 THEN 'nan' WHEN 5 THEN CAST(p_size AS VARCHAR) || 'e2' WHEN 6 THEN '-.' || CAST(p_size AS VARCHAR) ELSE p_name END"""


@query(
    rf"""SELECT CAST(p_partkey AS DOUBLE) AS "教室グループID",
    CASE WHEN regexp_matches(trim({_MIXED}), '^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$')
    THEN TRY_CAST(trim({_MIXED}) AS DOUBLE) END AS "企業ID", CAST(p_retailprice AS VARCHAR) AS p_retailprice, p_type FROM part"""
)
def numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed columns to double, null where the text is no number; the rest to text."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("教室グループID"), _mixed_number().alias("企業ID"), "p_retailprice", "p_type"
    )
    return C.coerce_numeric(parts)


@query(
    """SELECT l_orderkey, l_linenumber, CAST(CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS VARCHAR) AS half,
    CAST(CAST(round_even(l_extendedprice, 0) AS BIGINT) AS VARCHAR) AS price FROM lineitem"""
)
def whole_number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as text without decimals, halves to the even neighbour."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") / 2).alias("half"), F.col("l_extendedprice").alias("price")
    )
    return C.whole_numbers(lines).select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"), F.col("l_linenumber").cast("int").alias("l_linenumber"), "half", "price"
    )


@query(
    """SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, d.source, coalesce(CAST(l.quality AS VARCHAR), '') AS "セッション数"
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def fill_blank_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values as empty text, one column renamed."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("クリック数"))
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return C.rename_columns(C.fill_blank(documents.join(labels, "doc_id", "left")))


@query("SELECT c_name, CAST(NULL AS VARCHAR) AS absent, c_custkey FROM customer")
def reindex_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in a given order; one that is missing is null."""
    return C.reindex_columns(table(spark, sf_dir, "customer"), ["c_name", "absent", "c_custkey"])


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d') AS row_date, strftime(o_orderdate, '%Y%m%d') AS file_date,
    strftime(o_orderdate, '%Y%m%d_%H%M%S') AS snapshot_time,
    '/feeds/' || strftime(o_orderdate - INTERVAL 3 DAY, '%Y%m%d') || '_SS.csv' AS feed_path,
    '2024/01/30' AS "日付" FROM orders"""
)
def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date spellings, the path of a day's feed and the stamped date."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        date_text(F.col("o_orderdate")).alias("row_date"),
        date_text(F.col("o_orderdate"), "yyyyMMdd").alias("file_date"),
        date_text(F.col("o_orderdate"), "yyyyMMdd_HHmmss").alias("snapshot_time"),
        feed_path(F.col("o_orderdate"), 3, "_SS.csv", "/feeds").alias("feed_path"),
    )
    return C.stamp_date(orders, RUN_DATE, 2)


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer")
def newest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reports of a kind in the drop folder: the newer one is read."""
    drop = work_path(spark, "drop")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    write_feed_csv(customers.withColumn("c_name", F.lit("old")), f"{drop}/z_detail_analyze.csv")
    write_feed_csv(customers, f"{drop}/a_detail_analyze.csv")
    newest = latest_file(spark, drop, ["detail_analyze"]).first()["path"]
    return scan_feed(spark, newest)


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, '名前～' || c_name AS c_name FROM customer")
def encoding_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed whose files are UTF-8 in part and windows-31j in part."""
    named = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("名前～"), "c_name").alias("c_name"), "c_nationkey"
    )
    paths = []
    for encoding, rows in (("UTF-8", named.where("c_nationkey < 12")), ("windows-31j", named.where("c_nationkey >= 12"))):
        paths.append(work_path(spark, "mixed"))
        write_feed_csv(rows.drop("c_nationkey"), paths[-1], encoding=encoding)
    return scan_any_encoding(spark, paths)


@query(
    """WITH n AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS row_index,
    count(*) OVER () AS total FROM orders)
    SELECT o_orderkey, o_totalprice, row_index, row_index // 1000 + 1 AS batch_num, (total + 999) // 1000 AS total_batches,
    'A' || CAST(2 + row_index // 1000 * 1000 AS VARCHAR) || ':ZZ'
    || CAST(1 + least(total, row_index // 1000 * 1000 + 1000) AS VARCHAR) AS range_text FROM n"""
)
def export_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by price cut into numbered batches of 1,000 rows with their target range."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("sort_key"))
    return export_batches(orders, ["sort_key", "o_orderkey"]).drop("sort_key")


@query(
    """WITH n AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS i,
    count(*) OVER () AS total FROM lineitem)
    SELECT i // 1000 + 1 AS batch_num, (total + 999) // 1000 AS total_batches, 'A' || CAST(2 + i // 1000 * 1000 AS VARCHAR)
    || ':ZZ' || CAST(1 + least(total, i // 1000 * 1000 + 1000) AS VARCHAR) AS range_text, count(*) AS row_count
    FROM n GROUP BY ALL"""
)
def export_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per batch of the line items."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return batch_report(export_batches(table(spark, sf_dir, "lineitem").select(*keys), keys))


@query("SELECT 'r' || CAST(o_orderkey AS VARCHAR) AS run_id, 'orders' AS stage, o_orderstatus AS status, o_custkey AS \"rows\", '' AS error, '' AS detail FROM orders")
def run_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows appended in two parts and read back."""
    log = work_path(spark, "run_log")
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.lit("orders").alias("stage"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").alias("rows"),
        F.lit("").alias("error"),
        F.lit("").alias("detail"),
    )
    append_run_log(rows.where("status = 'F'"), log)
    append_run_log(rows.where("status <> 'F'"), log)
    return spark.read.parquet(log)


@query(
    """SELECT 'ss' AS feed, CAST(user_id AS VARCHAR) AS "key", '' AS problem FROM (SELECT DISTINCT user_id FROM events)
    UNION ALL SELECT 'cv', CAST(c_custkey AS VARCHAR), '' FROM customer
    UNION ALL SELECT 'cv_attr', NULL, 'not found or empty: 20240131_CVrepo.csv'"""
)
def feeds_scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three feeds of a day, one of which is not there and becomes a quality row."""
    folder, names = work_path(spark, "day"), feed_file_names(RUN_DATE, 1)
    users = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key")).distinct()
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"))
    write_feed_csv(users, f"{folder}/{names['ss']}")
    write_feed_csv(customers, f"{folder}/{names['cv']}")
    found = scan_feeds(spark, folder, names)
    result = missing_feeds(spark, found.missing).select(
        "feed", F.lit(None).cast("string").alias("key"), F.col("detail").alias("problem")
    )
    for feed, rows in found.items():
        result = result.union(rows.select(F.lit(feed), "key", F.lit("")))
    return result


@query("SELECT 0 :: BIGINT AS rows_left, 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns_left")
def table_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table emptied: no rows, all columns."""
    path = work_path(spark, "cleared")
    orders = table(spark, sf_dir, "orders")
    write_parquet(orders, path, partition_by=())
    clear_table(orders, path)
    cleared = spark.read.parquet(path)
    return cleared.agg(F.count("*").alias("rows_left")).withColumn("columns_left", F.lit(",".join(cleared.columns)))


@query(
    """WITH n AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS b FROM orders)
    SELECT b + 1 AS batch_num, count(*) AS row_count, CASE WHEN sum(o_orderkey % 7) % 2 = 1 THEN 'failed' ELSE 'ok' END AS status
    FROM n GROUP BY b"""
)
def export_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches handed to a target that refuses some of them; all are reported."""

    def send(range_text, rows):
        if (rows["o_orderkey"] % 7).sum() % 2:
            raise RuntimeError(f"{range_text} refused")

    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    report = deliver_batches(export_batches(orders, ["o_orderkey"]), send)
    return report.select("batch_num", "row_count", "status")
