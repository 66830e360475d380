"""Text, URL and setting queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import text as X
from feedloom.functions import urls as U
from feedloom.queries.registry import query, table
from feedloom.session import work_path
from feedloom.sinks.batches import append_run_log
from feedloom.sinks.pages import save_snapshots
from feedloom.sources.pages import parse_snapshot_name, scan_pages, snapshot_name


@query(
    r"""SELECT page_id, replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '.', '_') ||
    CASE WHEN regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) = '' THEN 'index'
    ELSE replace(replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/', '_'), '.', '_') END AS slug FROM pages"""
)
def url_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", U.page_slug(F.col("url")).alias("slug"))


@query("SELECT page_id, split_part(replace(replace(url, 'https://', ''), 'http://', ''), '/', 1) AS host FROM pages")
def url_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", U.host_of(F.col("url")).alias("host"))


@query(
    """SELECT page_id, CASE WHEN url LIKE 'http://%.org/%' THEN NULL ELSE 'https://' || replace(replace(url, 'https://', ''),
    'http://', '') END AS fixed FROM pages"""
)
def url_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses without scheme get one; empty ones become null."""
    bare = F.when(F.col("url").like("http://%.org/%"), F.lit("")).otherwise(F.regexp_replace("url", "^http://", ""))
    return table(spark, sf_dir, "pages").select("page_id", U.fix_url(bare).alias("fixed"))


@query(
    """SELECT doc_id, CASE WHEN length(text) > 30 THEN left(text, 30) || '...' ELSE text END AS masked,
    CASE WHEN length(text) > 1000 THEN left(text, 1000) || '(cut)' ELSE text END AS shortened, source AS unquoted FROM documents"""
)
def text_mask_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    quoted = F.concat(F.lit("\"'"), "source", F.lit("'\""))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        X.mask(text).alias("masked"),
        X.truncate_text(text, 1000, "(cut)").alias("shortened"),
        X.unquote(quoted).alias("unquoted"),
    )


@query("SELECT page_id, left(html, 50000) AS html FROM pages")
def page_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages cut to the length passed on for extraction."""
    return table(spark, sf_dir, "pages").select("page_id", X.truncate_text(F.col("html"), 50000).alias("html"))


@query(
    """SELECT event_id, CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR) || 'を' ELSE event_type END AS argument
    FROM events WHERE event_type <> 'error' UNION ALL SELECT event_id, NULL FROM events WHERE event_type = 'error'"""
)
def quoted_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text in Japanese or double quotes; null for events without any."""
    told = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("欄に「"), F.col("user_id").cast("string"), F.lit("を」と「次」")))
        .when(F.col("event_type") == "error", F.lit("なし"))
        .otherwise(F.concat(F.lit('値 "'), "event_type", F.lit('" です')))
    )
    return table(spark, sf_dir, "events").select("event_id", X.quoted_argument(told).alias("argument"))


_SETTING = """CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR) WHEN 'view' THEN CAST(value AS VARCHAR)
    WHEN 'error' THEN CASE WHEN user_id % 2 = 0 THEN 'TRUE' ELSE 'False' END WHEN 'signup' THEN '-' || CAST(user_id AS VARCHAR)
    ELSE props END"""


@query(
    f"""SELECT event_id, CASE event_type WHEN 'click' THEN 'int' WHEN 'view' THEN 'double' WHEN 'error' THEN 'bool' ELSE 'text' END AS kind,
    CASE WHEN event_type = 'click' THEN user_id END AS int_value, CASE WHEN event_type = 'view' THEN value END AS double_value,
    CASE WHEN event_type = 'error' THEN user_id % 2 = 0 END AS bool_value, {_SETTING} AS text FROM events"""
)
def scalar_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Setting texts as typed values."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    setting = (
        F.when(kind == "click", user)
        .when(kind == "view", F.col("value").cast("string"))
        .when(kind == "error", F.when(F.col("user_id") % 2 == 0, "TRUE").otherwise("False"))
        .when(kind == "signup", F.concat(F.lit("-"), user))
        .otherwise(F.col("props"))
    )
    typed = table(spark, sf_dir, "events").select("event_id", X.coerce_scalar(setting).alias("s"))
    return typed.select("event_id", "s.*").withColumn("int_value", F.col("int_value").cast("bigint"))


@query(
    r"""WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
    regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)
    SELECT page_id, replace(host, '.', '_') || CASE WHEN path = '' THEN 'index' ELSE replace(replace(path, '/', '_'), '.', '_') END
    || '_20250320_101500.html' AS file_name,
    replace(host, '.', '_') || CASE WHEN path = '' THEN 'index' ELSE replace(replace(path, '/', '_'), '.', '_') END AS page_slug,
    '2025-03-20 10:15:00' AS captured_at FROM p"""
)
def snapshot_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot file names made from addresses and taken apart again."""
    at = F.to_timestamp(F.lit("2025-03-20 10:15:00"))
    named = table(spark, sf_dir, "pages").select("page_id", snapshot_name(F.col("url"), at).alias("file_name"))
    return named.select("page_id", "file_name", parse_snapshot_name(F.col("file_name")).alias("p")).select(
        "page_id", "file_name", "p.page_slug", F.col("p.captured_at").cast("string").alias("captured_at")
    )


@query(
    r"""WITH p AS (SELECT page_id, html, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
    regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)
    SELECT replace(host, '.', '_') || CASE WHEN path = '' THEN 'index' ELSE replace(replace(path, '/', '_'), '.', '_') END AS page_slug,
    strftime(TIMESTAMP '2025-03-20 00:00:00' + to_seconds(page_id), '%Y-%m-%d %H:%M:%S') AS captured_at, html FROM p"""
)
def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages saved as snapshot files, a second apart, and read back from them."""
    folder = work_path(spark, "snapshots")
    at = F.to_timestamp_ntz(F.lit("2025-03-20 00:00:00")) + F.make_dt_interval(secs=F.col("page_id"))
    saved = save_snapshots(table(spark, sf_dir, "pages"), folder, F.col("url"), at)
    append_run_log(saved, work_path(spark, "saved"))
    return scan_pages(spark, folder).select("page_slug", F.col("captured_at").cast("string").alias("captured_at"), "html")
