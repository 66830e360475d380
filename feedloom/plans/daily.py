"""The daily jobs: report to feed history, classroom counts, pages to element documents."""

from __future__ import annotations

import datetime as dt
import traceback
from collections.abc import Callable, Mapping, Sequence
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.columns import coerce_numeric, fill_blank, quoted, split_feed, stamp_date
from feedloom.operators.elements import elements_per_section
from feedloom.operators.pages import page_inventories
from feedloom.operators.quality import header_issues, missing_feeds
from feedloom.session import work_path
from feedloom.sinks.batches import append_run_log, log_rows
from feedloom.sinks.elements import page_documents, write_elements
from feedloom.sinks.feeds import append_feed, remove_day, with_day, write_parquet
from feedloom.sources.feeds import (
    FEED_SUFFIXES,
    REPORT_COLUMNS,
    REPORT_TOKENS,
    feed_file_names,
    latest_file,
    read_header,
    scan_feed,
    scan_feeds,
)
from feedloom.sources.pages import scan_elements


class RunReport:
    """Status rows of a run: each stage's start, and its end or its trace."""

    def __init__(self, spark: SparkSession, run_id: str) -> None:
        self.spark, self.run_id = spark, run_id
        self.rows: list[tuple] = []

    def note(self, stage: str, status: str, rows: int | None = None, error: str = "", detail: str = "") -> None:
        self.rows.append((self.run_id, stage, status, rows, error, detail))

    def run(self, stage: str, work: Callable[[], int | None]) -> bool:
        """Do a stage; a failure is noted with its trace and not raised."""
        self.note(stage, "start")
        try:
            rows = work()
        except Exception as problem:
            self.note(stage, "failed", None, str(problem), traceback.format_exc())
            return False
        self.note(stage, "done", rows)
        return True

    def frame(self) -> DataFrame:
        return log_rows(self.spark, self.rows)

    def failures(self) -> DataFrame:
        """Failed stages in the shape the alert operators take."""
        failed = self.frame().where("status = 'failed'")
        return failed.select(
            "stage",
            F.concat(F.lit("stage failed: "), F.col("stage")).alias("message"),
            F.col("error").alias("exception"),
            F.col("detail").alias("stack_trace"),
            F.create_map(F.lit("run_id"), F.col("run_id"), F.lit("stage"), F.col("stage")).alias("context"),
        )

    def save(self, path: str) -> str | None:
        return append_run_log(self.frame(), path)


def run_daily_feeds(
    spark: SparkSession,
    drop_folder: str,
    history: str,
    run_date: dt.date,
    days_ago: int = 1,
    log_path: str | None = None,
    mode: str = "day",
    tokens: Sequence[str] = REPORT_TOKENS,
    multi_line: bool | None = None,
) -> DataFrame:
    """Newest reports of the drop folder into the histories ``<history>/ss``, ``cv``, ``cv_attr``.

    The wide report gives the SS and the CV feed, the attribute report is kept whole. Returns one
    status row per stage step; a failed feed does not stop the others. In ``mode='day'`` the day's old rows go even where
    the new report has none. ``multi_line`` is that of ``scan_feed``: unless told, files that may be read in parts are.
    """
    day = run_date - dt.timedelta(days=days_ago)
    report = RunReport(spark, f"{run_date:%Y%m%d}")
    found: dict[str, str] = {}

    def find() -> int:
        # One row per token: the listing is reduced before it gets here.
        found.update({r.token: r.path for r in latest_file(spark, drop_folder, tokens).collect()})
        return len(found)

    def newest(token: str) -> str:
        if token not in found:
            raise FileNotFoundError(f"no file named *{token}* in {drop_folder}")
        return found[token]

    def store(feed: str, frame: DataFrame) -> int:
        # Rows are counted while they are written.
        written = Observation()
        target = f"{history.rstrip('/')}/{feed}"
        counted = with_day(frame, day).observe(written, F.count(F.lit(1)).alias("rows"))
        append_feed(counted, target, mode)
        if mode == "day" and not written.get["rows"]:
            remove_day(spark, target, day)
        return written.get["rows"]

    @cache
    def split() -> dict[str, DataFrame]:
        # The report is parsed once: both feeds read the three columns that are written here.
        scanned = scan_feed(spark, newest(tokens[0]), columns=REPORT_COLUMNS, multi_line=multi_line)
        path = work_path(spark, "report")
        scanned.write.parquet(path)
        report_rows = spark.read.schema(scanned.schema).parquet(path)
        return split_feed(stamp_date(report_rows, run_date, days_ago))

    def attributes() -> int:
        return store("cv_attr", fill_blank(scan_feed(spark, newest(tokens[1]), multi_line=multi_line)))

    report.run("find_files", find)
    report.run("ss", lambda: store("ss", split()["ss"]))
    report.run("cv", lambda: store("cv", split()["cv"]))
    report.run("cv_attr", attributes)
    if log_path:
        problem = report.save(log_path)
        if problem:
            report.note("run_log", "failed", None, problem)
    return report.frame()


def integrate_feeds(
    spark: SparkSession,
    folder: str,
    history: str,
    run_date: dt.date,
    days_ago: int = 1,
    suffixes: Mapping[str, str] = FEED_SUFFIXES,
    mode: str = "day",
) -> DataFrame:
    """The feed files of one day into their histories; gives quality rows of those not found."""
    day = run_date - dt.timedelta(days=days_ago)
    found = scan_feeds(spark, folder, feed_file_names(run_date, days_ago, suffixes))
    for feed, rows in found.items():
        append_feed(with_day(rows, day), f"{history.rstrip('/')}/{feed}", mode)
    return missing_feeds(spark, found.missing)


def convert_feeds(spark: SparkSession, folder: str, files: Mapping[str, str], target: str) -> DataFrame:
    """Whole feed CSV files, cleaned, to ``<target>/<feed>`` as Parquet; gives quality rows.

    Reported are files not found and odd header cells. Wrong-width rows are repaired; see
    :func:`feedloom.operators.quality.ragged_rows` for their report.
    """
    found = scan_feeds(spark, folder, files)
    issues = missing_feeds(spark, found.missing)
    for feed, rows in found.items():
        write_parquet(rows, f"{target.rstrip('/')}/{feed}", partition_by=())
        issues = issues.unionByName(header_issues(spark, feed, read_header(spark, found.paths[feed])))
    return issues


def convert_counts(spark: SparkSession, source: str, target: str) -> None:
    """Classroom counts: CSV to Parquet, listed columns numeric, blank text as null."""
    counts = coerce_numeric(scan_feed(spark, source, currency_column=None))
    text = [f.name for f in counts.schema.fields if f.dataType == T.StringType()]
    blanks = {name: F.nullif(quoted(name), F.lit("")) for name in text}
    write_parquet(counts.withColumns(blanks), target, partition_by=())


def extract_pages(pages: DataFrame, section: str, target: str, log_path: str | None = None) -> None:
    """Pages to element documents of a section, without the section's excluded elements."""
    documents = page_documents(page_inventories(pages).withColumn("section", F.lit(section)))
    write_elements(documents, target, rebalance=False)
    if log_path:
        append_run_log(section_log(scan_elements(pages.sparkSession, target, multi_line=False), section), log_path)


def section_log(elements: DataFrame, run_id: str) -> DataFrame:
    """Element counts per section in the shape of the run log."""
    return elements_per_section(elements).select(
        F.lit(run_id).alias("run_id"),
        F.concat(F.lit("elements "), F.col("section")).alias("stage"),
        F.lit("done").alias("status"),
        F.col("element_count").alias("rows"),
        F.lit("").alias("error"),
        F.lit("").alias("detail"),
    )
