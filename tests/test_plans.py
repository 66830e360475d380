"""What the plans must look like: no needless shuffle, pruned scans."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from feedloom.operators import pages as P
from feedloom.operators import steps as S
from feedloom.operators.alerts import status_message
from feedloom.operators.selectors import resolve_selectors
from feedloom.sinks import feeds as K
from feedloom.sinks.elements import page_documents
from feedloom.sources import feeds as Q
from feedloom.sources.catalogues import instruction_sections


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.fixture
def stored_pages(spark, tmp_path):
    path = str(tmp_path / "pages")
    rows = [(i, f"https://a.b/{i}", "<title>t</title><nav><a>x</a></nav>") for i in range(20)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(
    "report",
    [
        P.page_profile,
        P.elements_per_page,
        P.element_inventory,
        lambda d: P.find_elements(d, "a", "x"),
        lambda d: page_documents(P.page_inventories(d.withColumn("section", F.lit("s")))),
    ],
)
def test_pages_are_not_shuffled(stored_pages, report):
    shown = plan(report(stored_pages.select("page_id", "html")))
    assert "Exchange" not in shown and "ReadSchema: struct<page_id:bigint,html:string>" in shown


def test_selectors_do_not_shuffle_or_repeat(spark, stored_pages):
    shape = "`group` string, name string, selector_type string, selector_value string"
    catalogue = spark.createDataFrame([("g", str(i), "css", f"nav a.c{i}") for i in range(100)], shape)
    shown = plan(resolve_selectors(stored_pages.select("page_id", "html"), catalogue))
    assert "Exchange" not in shown and shown.count("MapInArrow") == 1


def test_pages_are_parsed_before_they_are_joined(spark, stored_pages):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        steps = spark.createDataFrame([(1, "x")], "page_id long, target string")
        shown = plan(S.locate_clickable(stored_pages, steps))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in shown and shown.count("Exchange") == 2
    joined, parsed = shown.index("SortMergeJoin"), shown.index("MapInArrow")
    assert joined < parsed and "url" not in shown


def test_rotation_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "h")
    days = spark.range(10).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("feed_date"), "id")
    K.append_feed(days, path)
    kept = K.keep_last_days(spark.read.parquet(path), 3)
    assert re.search(r"PartitionFilters: \[isnotnull\(feed_date#\d+\), \(feed_date#\d+ >= 2024-01-08\)\]", plan(kept))
    assert kept.count() == 3


def test_feed_scan_is_pruned(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes("a,売上金額,c\n1,2,3\n".encode("cp932"))
    shown = plan(Q.scan_feed(spark, str(tmp_path / "f.csv"), columns=["c"]))
    assert "ReadSchema: struct<c:string>" in shown and "Exchange" not in shown


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "cv_attr.csv").write_text("")
    found = Q.latest_file(spark, str(tmp_path))
    assert [r["path"].rsplit("/", 1)[-1] for r in found.collect()] == ["cv_attr.csv"]
    assert "FileScan" not in plan(found)


def test_row_work_stays_in_generated_code(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("t"), F.col("id").cast("int").alias("code"))
    parsed = df.select(S.parse_step(F.col("t")).alias("s"), status_message(F.col("code")).alias("m"))
    shown = plan(parsed)
    assert "Join" not in shown and "Python" not in shown and "*(1) Project" in shown
    assert "Exchange" not in plan(instruction_sections(df, "t", "code"))
