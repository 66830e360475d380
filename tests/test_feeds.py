"""Feed readers, repairs, writers, history, stream."""

import csv
import datetime as dt
import io
import os
import re
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.operators import columns as C
from feedloom.operators import quality as Q
from feedloom.plans.daily import RunReport, convert_counts, convert_feeds, integrate_feeds, run_daily_feeds
from feedloom.sinks import batches as B
from feedloom.sinks import feeds as K
from feedloom.sources import feeds as S
from feedloom.streaming.feeds import FILE, append_stream, stream_feed


def put(path, text, encoding="cp932"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding) if isinstance(text, str) else text)
    return str(path)


def rows(df, *order):
    return sorted(tuple(r) for r in df.collect())


ATTRIBUTES = (
    'CV日,売上金額, 広告名 ,,広告名,\r\n'
    '2024/01/31,"￥1,200円",～①,x,"a\r\nb",y\r\n'
    '2024/01/31,-100\r\n'
    '\r\n'
    '2024/01/31,なし,"q""r",x,007,y,z,z\r\n'
)


def test_scan_feed_edges(spark, tmp_path):
    path = put(tmp_path / "a.csv", ATTRIBUTES)
    feed = S.scan_feed(spark, path)
    assert feed.columns == ["CV日", "売上金額", "広告名", "広告名_1"]
    assert {f.dataType.simpleString() for f in feed.schema.fields} == {"string"}
    # The blank line is gone, short rows are padded, values behind the blank header move left.
    assert rows(feed) == [
        ("2024/01/31", "100", "", ""),
        ("2024/01/31", "1200", "～①", "x"),
        ("2024/01/31", "なし", 'q"r', "x"),
    ]


def test_scan_feed_align(spark, tmp_path):
    path = put(tmp_path / "a.csv", ATTRIBUTES)
    assert ("2024/01/31", "なし", 'q"r', "007") in rows(S.scan_feed(spark, path, blank_header="align"))
    assert ("2024/01/31", "1200", "～①", "a\nb") in rows(S.scan_feed(spark, path, blank_header="align"))


def test_scan_feed_columns_and_errors(spark, tmp_path):
    path = put(tmp_path / "a.csv", ATTRIBUTES)
    assert S.scan_feed(spark, path, columns=["広告名"]).columns == ["広告名"]
    with pytest.raises(ValueError, match="not in the header"):
        S.scan_feed(spark, path, columns=["none"])
    with pytest.raises(ValueError, match="no header"):
        S.scan_feed(spark, put(tmp_path / "empty.csv", ""))
    with pytest.raises(ValueError, match="blank_header"):
        S.scan_feed(spark, path, blank_header="other")
    assert S.header_width(S.read_header(spark, path)) == 4


def test_large_files_are_split(spark, tmp_path):
    """Without quoted newlines a file may be read in parts; the rows are the same."""
    plain = "a,売上金額,b\r\n" + "".join(f'{i},￥{i:,},"～①""{i}"\r\n' if i % 5 else f"{i}\r\n" for i in range(1000))
    path = put(tmp_path / "plain.csv", plain)
    assert S.may_be_split(spark, path)
    assert not S.may_be_split(spark, put(tmp_path / "a.csv", ATTRIBUTES))
    # In other encodings these bytes would take the quote for a part of a character.
    assert not S.may_be_split(spark, put(tmp_path / "b.csv", b'a\n"x\xe3\x5c\ny\xe3\x5c"\n'))
    assert not S.may_be_split(spark, put(tmp_path / "c.csv", b'a,b\n"\xe3\x5c",\x83\x5c"\n'))
    assert not S.may_be_split(spark, put(tmp_path / "d.csv", "a\n \n"))
    assert S.may_be_split(spark, put(tmp_path / "e.csv", "a\n\n　\n"))
    assert S.may_be_split(spark, put(tmp_path / "f.csv", ""))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        split = S.scan_feed(spark, path, multi_line=None)
        assert split.rdd.getNumPartitions() > 2
        assert rows(split) == rows(S.scan_feed(spark, path)) and split.count() == 1000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ragged_report(spark, tmp_path):
    path = put(tmp_path / "r.csv", 'a,b,c\n1,2,3\n1\n"x,y",2,"z\nz",4\n')
    scanned = S.scan_feed(spark, path, with_source=True)
    assert rows(scanned.select("a", "b", "c")) == [("1", "", ""), ("1", "2", "3"), ("x,y", "2", "z\nz")]
    assert rows(Q.ragged_rows(scanned, "feed", 3)) == [
        ("feed", "r.csv", "long_row", '"x,y",2,"z\nz",4', 4, 4),
        ("feed", "r.csv", "short_row", "1", 1, 3),
    ]


def test_header_issues_and_signs(spark, tmp_path):
    issues = rows(Q.header_issues(spark, "f", ["a", " ", "a"]).select("issue", "detail"))
    assert issues == [("blank_header", "column 2"), ("repeated_header", "a")]
    path = put(tmp_path / "m.csv", "売上金額\n-100\n▲5\n7\nなし\n")
    assert rows(Q.lost_signs(S.scan_feed(spark, path, currency_column=None), "f").select("detail")) == [("-100",), ("▲5",)]


def test_profile(spark, tmp_path):
    path = put(tmp_path / "p.csv", 'a,b\n"x,1",2,3\n\nz\n')
    assert tuple(Q.profile_csv(spark, path).first()) == (4, 3)
    assert tuple(Q.profile_csv(spark, path, multi_line=None).first()) == (4, 3)
    long = put(tmp_path / "long.csv", 'a,"' + "x, " * 20_000 + '\n\n"\n\n')
    assert tuple(Q.profile_csv(spark, long).first()) == (2, 2)
    assert tuple(Q.profile_csv(spark, put(tmp_path / "one.csv", "a\nb\n")).first()) == (2, 1)
    assert tuple(Q.profile_csv(spark, put(tmp_path / "none.csv", "")).first()) == (0, 0)


def test_japanese_bytes_are_those_of_the_codec(spark):
    """Every byte, every pair of bytes, and longer lines, against the codec's own verdict."""
    from feedloom.sources.feeds import is_japanese

    def readable(raw):
        try:
            raw.decode("cp932")
        except UnicodeDecodeError:
            return False
        return True

    lines = [bytes([a]) for a in range(256)] + [bytes([a, b]) for a in range(256) for b in range(256)]
    lines += [b"", "～①漢字ｶﾅ".encode("cp932") * 20_000, "～①".encode("cp932") * 20_000 + b"\x81", b"a\x82\xa0\xff\xfd\x80", b"\x85\x40z", b"\x00" * 50_000 + b"\xfc\xfc"]
    rows_ = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line binary").repartition(4)
    got = {r.i: r.ok for r in rows_.select("i", is_japanese(F.col("line")).alias("ok")).collect()}
    assert [i for i, line in enumerate(lines) if got[i] is not readable(line)] == []


def test_encodings_need_no_python(spark, tmp_path):
    path = put(tmp_path / "a.csv", "名\n～\n")
    plan = S.file_encodings(spark, path)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_any_encoding(spark, tmp_path):
    folder = tmp_path / "mixed"
    put(folder / "bom.csv", "﻿名,値\né～,1\n", "utf-8")
    put(folder / "plain.csv", '名,値\n"ñ\nñ",2\n', "utf-8")
    put(folder / "sjis.csv", "名,値\n～①,3\n")
    feed = S.scan_any_encoding(spark, str(folder))
    assert feed.columns == ["名", "値"]
    assert rows(feed) == [("é～", "1"), ("ñ\nñ", "2"), ("～①", "3")]
    assert rows(S.file_encodings(spark, str(folder)).select("file_name", "encoding")) == [
        ("bom.csv", "UTF-8"),
        ("plain.csv", "UTF-8"),
        ("sjis.csv", "windows-31j"),
    ]
    # 0x8160 is the wave dash of Windows here, U+FF5E.
    assert S.scan_any_encoding(spark, put(tmp_path / "w.csv", b"a\n\x81\x60\n")).first()[0] == "～"


def test_any_encoding_fails(spark, tmp_path):
    put(tmp_path / "bad" / "x.csv", b"a\n\x85\x40\xff\x81\n")
    with pytest.raises(ValueError, match="x.csv"):
        S.scan_any_encoding(spark, str(tmp_path / "bad"))


def test_latest_file(spark, tmp_path):
    for name, at in (("a_detail_analyze.csv", 50), ("b_detail_analyze.csv", 90), ("c_detail_analyze.csv", 90), ("cv_attr.csv", 10), ("other", 99)):
        os.utime(put(tmp_path / name, "x\n"), (at, at))
    put(tmp_path / "d_detail_analyze" / "part-0.csv", "x\n")
    os.utime(tmp_path / "d_detail_analyze" / "part-0.csv", (20, 20))
    found = {r["token"]: r["path"].rsplit("/", 1)[-1] for r in S.latest_file(spark, str(tmp_path)).collect()}
    assert found == {"detail_analyze": "c_detail_analyze.csv", "cv_attr": "cv_attr.csv"}


def test_scan_feeds_notes_missing(spark, tmp_path):
    names = S.feed_file_names(dt.date(2024, 2, 1), 1)
    assert names == {"cv_attr": "20240131_CVrepo.csv", "cv": "20240131_CV.csv", "ss": "20240131_SS.csv"}
    put(tmp_path / names["ss"], "日付,広告名\n2024/01/31,x\n")
    put(tmp_path / names["cv"], "")
    found = S.scan_feeds(spark, str(tmp_path), names)
    assert list(found) == ["ss"] and set(found.missing) == {"cv", "cv_attr"}
    assert rows(Q.missing_feeds(spark, found.missing).select("feed", "issue")) == [("cv", "missing_feed"), ("cv_attr", "missing_feed")]


def test_columns(spark):
    df = spark.createDataFrame([("a", 1.5, None), (None, None, 2)], "x string, y double, `z.z` int")
    assert rows(C.as_text(df).na.fill("-")) == [("-", "-", "2"), ("a", "1.5", "-")]
    assert rows(C.fill_blank(df)) == [("", "", "2"), ("a", "1.5", "")]
    assert rows(C.whole_numbers(df)) == [("", "", "2"), ("a", "2", "")]
    assert C.reindex_columns(df, ["z.z", "n"]).columns == ["z.z", "n"]
    with pytest.raises(ValueError, match="n"):
        C.reindex_columns(df, ["z.z", "n"], strict=True)
    assert C.rename_columns(df.withColumnRenamed("x", "クリック数")).columns[0] == "セッション数"
    assert C.stamp_date(df, dt.date(2024, 3, 1), 1).select("日付").first()[0] == "2024/02/29"


def test_split_feed(spark):
    report = spark.createDataFrame(
        [("～①", "3", "2.5", "2024/01/31"), ("b", "", "007", "2024/01/31"), ("c", "1,200", "x", "2024/01/31")],
        "`広告名` string, `クリック数` string, `応募完了（CV）` string, `日付` string",
    )
    feeds = C.split_feed(report)
    assert rows(feeds["ss"]) == [("2024/01/31", "b", ""), ("2024/01/31", "c", "1,200"), ("2024/01/31", "～①", "3")]
    assert rows(feeds["cv"]) == [("2024/01/31", "b", "7"), ("2024/01/31", "c", "x"), ("2024/01/31", "～①", "2")]


def test_write_feed_csv(spark, tmp_path):
    df = spark.createDataFrame([(" a,\"b\"\n", 2.5, None), ("～", 3.5, "x")], "`広告名` string, n double, t string")
    K.write_feed_csv(df, str(tmp_path / "out"))
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("*.csv"))).decode("cp932")
    assert '" a,""b""\n",2,' in text and "～,4,x" in text and text.startswith("広告名,n,t")
    assert rows(S.scan_feed(spark, str(tmp_path / "out"))) == [(' a,"b"\n', "2", ""), ("～", "4", "x")]


def day_frame(spark, *items):
    return K.with_day(spark.createDataFrame(list(items), "`日付` string, x string"))


def test_append_by_day(spark, tmp_path):
    path = str(tmp_path / "h")
    for _ in range(2):
        K.append_feed(day_frame(spark, ("2024/01/30", "a"), ("2024/01/31", "b")), path)
    K.append_feed(day_frame(spark, ("2024/01/31", "c")), path)
    history = spark.read.parquet(path)
    assert rows(history.select("日付", "x")) == [("2024/01/30", "a"), ("2024/01/31", "c")]
    assert rows(K.keep_last_days(history, 1).select("x")) == [("c",)]
    assert rows(K.keep_last_days(history, 5).select("x")) == [("a",), ("c",)]


def test_append_raw_by_position(spark, tmp_path):
    path = str(tmp_path / "h")
    K.append_feed(day_frame(spark, ("2024/01/30", "a")), path, mode="raw")
    other = day_frame(spark, ("2024/01/30", "a")).withColumnRenamed("x", "other")
    K.append_feed(other, path, mode="raw")
    assert rows(spark.read.parquet(path).select("日付", "x")) == [("2024/01/30", "a")] * 2
    with pytest.raises(ValueError):
        K.append_feed(other, path, mode="both")


def test_clear_table(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    K.clear_table(df, str(tmp_path / "t"))
    cleared = spark.read.parquet(str(tmp_path / "t"))
    assert cleared.columns == ["x", "y"] and cleared.count() == 0


@pytest.mark.parametrize("max_files", [None, 1])
def test_stream_equals_batch(spark, tmp_path, max_files):
    drop, names = tmp_path / "drop", ["日付", "売上金額"]
    put(drop / "20240130_a.csv", "日付,売上金額\n2024/01/30,￥1\n")
    put(drop / "20240131_a.csv", "日付,売上金額\n2024/01/31,￥2\n")
    put(drop / "20240131_b.csv", '日付,売上金額\n2024/01/31,"￥3,0"\n')
    history, state = str(tmp_path / "h"), str(tmp_path / "state")

    def run():
        append_stream(stream_feed(spark, str(drop), names, max_files=max_files), history, state).awaitTermination()

    run()
    batch = K.with_day(S.scan_feed(spark, str(drop)))
    assert rows(spark.read.parquet(history).drop(FILE)) == rows(batch)
    run()
    assert spark.read.parquet(history).count() == 3
    put(drop / "20240201_a.csv", "日付,売上金額\n2024/02/01,4\n")
    run()
    assert rows(spark.read.parquet(history).select("売上金額")) == [("1",), ("2",), ("30",), ("4",)]


@pytest.mark.parametrize("max_files", [None, 1])
def test_newest_delivery_wins(spark, tmp_path, max_files):
    """A correction replaces, a late older file does not, and any number of further runs changes nothing."""
    drop, history = tmp_path / "drop", str(tmp_path / "h")

    def deliver(name, hour, *lines):
        put(drop / name, "日付,v\n" + "".join(f"{line}\n" for line in lines))
        os.utime(drop / name, (1_700_000_000 + hour * 3600,) * 2)

    def run(state="state"):
        rows_ = stream_feed(spark, str(drop), ["日付", "v"], max_files=max_files)
        append_stream(rows_, history, str(tmp_path / state), newest_wins=True).awaitTermination()
        return rows(spark.read.parquet(history).select("日付", "v"))

    deliver("a b=1%.csv", 1, "2024/01/30,first", "2024/01/31,first", "never,kept")
    assert run() == [("2024/01/30", "first"), ("2024/01/31", "first"), ("never", "kept")]
    deliver("b.csv", 3, "2024/01/31,corrected")
    want = [("2024/01/30", "first"), ("2024/01/31", "corrected"), ("never", "kept")]
    assert run() == want
    deliver("late.csv", 2, "2024/01/31,stale")
    deliver("early.csv", 0, "2024/01/30,stale")
    assert run() == want
    deliver("c.csv", 3, "2024/01/31,tie")  # the later name of two of one time
    want = [("2024/01/30", "first"), ("2024/01/31", "tie"), ("never", "kept")]
    assert run() == want and run("other state") == want
    K.append_feed(K.with_day(spark.createDataFrame([("2024/01/31", "batch")], "`日付` string, v string")), history, source="batch")
    assert run("third state") == sorted([*want, ("2024/01/31", "batch")])


def test_delivery_that_failed_half_way(spark, tmp_path, monkeypatch):
    """Whatever step a run failed at, the next one gives the newest file's rows."""
    from feedloom.sinks import feeds as sinks

    def feed(file, hour, value):
        rows_ = [("2024-01-31", file, dt.datetime(2024, 2, 1, hour), value)]
        return spark.createDataFrame(rows_, f"d string, {FILE} string, {K.MODIFIED} timestamp, v string").withColumn(K.DAY, F.to_date("d"))

    def broken(*args, **options):
        raise OSError("lost")

    for step in ("write_parquet", "remove_file"):
        history = str(tmp_path / step)
        K.append_newest(feed("a.csv", 1, "old"), history)
        with monkeypatch.context() as patch:
            patch.setattr(sinks, step, broken)
            with pytest.raises(OSError, match="lost"):
                K.append_newest(feed("b.csv", 2, "new"), history)
        assert "old" in {r.v for r in spark.read.parquet(history).collect()}
        K.append_newest(feed("b.csv", 2, "new"), history)
        assert rows(spark.read.parquet(history).select("v")) == [("new",)]
        assert len([x for x in os.listdir(f"{history}/{K.DELIVERIES}") if not x.startswith(".")]) == 1


def test_export_batches(spark):
    df = spark.range(2500).select((2499 - F.col("id")).alias("k")).repartition(7)
    got = B.export_batches(df, ["k"]).orderBy("row_index").collect()
    assert [r["k"] for r in got] == list(range(2500)) == [r["row_index"] for r in got]
    ranges = {r["batch_num"]: r["range_text"] for r in got}
    assert ranges == {1: "A2:ZZ1001", 2: "A1002:ZZ2001", 3: "A2002:ZZ2501"}
    assert {r["total_batches"] for r in got} == {3}
    plain = B.export_batches(df, ["k"], batch_rows=1000, has_header=False)
    assert rows(B.batch_report(plain).select("batch_num", "range_text", "row_count"))[0] == (1, "A1:ZZ1000", 1000)


def test_hot_key_is_spread(spark, tmp_path):
    """A key that fills a third of the rows: whole numbering, ties in file order, more than one task."""
    path = str(tmp_path / "hot")
    hot = F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id") % 1000)
    spark.range(0, 30000, 1, 1).select("id", hot.alias("k")).write.parquet(path)
    numbered = B.number_rows(spark.read.parquet(path), ["k"]).collect()
    numbered.sort(key=lambda r: r["row_index"])
    assert [r["row_index"] for r in numbered] == list(range(30000))
    assert [(r["k"], r["id"]) for r in numbered] == sorted((r["k"], r["id"]) for r in numbered)


def test_export_keeps_file_order(spark, tmp_path):
    path = put(tmp_path / "o.csv", "v\n" + "\n".join(f"x{i}" for i in (5, 3, 9)) + "\n")
    got = B.export_batches(S.scan_feed(spark, path), batch_rows=2).orderBy("row_index").collect()
    assert [(r["v"], r["batch_num"]) for r in got] == [("x5", 1), ("x3", 1), ("x9", 2)]


def test_no_rows(spark):
    none = spark.range(0).withColumnRenamed("id", "k")
    assert B.export_batches(none, ["k"]).count() == 0 and B.export_batches(none).count() == 0
    assert K.keep_last_days(none.withColumn("feed_date", F.lit(None).cast("date")), 3).count() == 0


def test_deliver_batches_goes_on(spark, tmp_path):
    out = tmp_path / "sent"
    out.mkdir()

    def send(range_text, rows):
        if range_text.startswith("A12"):
            raise RuntimeError("refused")
        (out / range_text.replace(":", "-")).write_text(",".join(str(v) for v in rows["k"]))

    batches = B.export_batches(spark.range(25).withColumnRenamed("id", "k"), ["k"], batch_rows=10)
    got = rows(B.deliver_batches(batches, send).select("batch_num", "row_count", "status", "detail"))
    assert got == [(1, 10, "ok", ""), (2, 10, "failed", "RuntimeError: refused"), (3, 5, "ok", "")]
    assert (out / "A22-ZZ26").read_text() == "20,21,22,23,24"


REPORT = '広告名,媒体,クリック数,応募完了（CV）\n"～①,x",m,3,\nb,m,,1\n'


def test_daily_run(spark, tmp_path):
    drop, history, log = tmp_path / "drop", str(tmp_path / "h"), str(tmp_path / "log")
    put(drop / "detail_analyze_1.csv", REPORT)
    put(drop / "cv_attr_1.csv", ATTRIBUTES)
    for _ in range(2):
        status = run_daily_feeds(spark, str(drop), history, dt.date(2024, 2, 1), log_path=log)
    done = rows(status.where("status = 'done'").select("stage", "rows"))
    assert done == [("cv", 2), ("cv_attr", 3), ("find_files", 2), ("ss", 2)]
    assert rows(spark.read.parquet(f"{history}/ss").drop("feed_date")) == [("2024/01/31", "b", ""), ("2024/01/31", "～①,x", "3")]
    assert rows(spark.read.parquet(f"{history}/cv").drop("feed_date")) == [("2024/01/31", "b", "1"), ("2024/01/31", "～①,x", "")]
    assert spark.read.parquet(f"{history}/cv_attr").count() == 3
    assert spark.read.parquet(log).count() == 16


def test_daily_run_goes_on_after_failure(spark, tmp_path):
    put(tmp_path / "drop" / "detail_analyze_1.csv", REPORT)
    status = run_daily_feeds(spark, str(tmp_path / "drop"), str(tmp_path / "h"), dt.date(2024, 2, 1))
    failed = status.where("status = 'failed'").collect()
    assert [r["stage"] for r in failed] == ["cv_attr"] and "cv_attr" in failed[0]["detail"]


def test_daily_run_of_empty_report(spark, tmp_path):
    put(tmp_path / "drop" / "detail_analyze_1.csv", REPORT.split("\n")[0] + "\n")
    status = run_daily_feeds(spark, str(tmp_path / "drop"), str(tmp_path / "h"), dt.date(2024, 2, 1))
    assert rows(status.where("status = 'done'").select("stage", "rows")) == [("cv", 0), ("find_files", 1), ("ss", 0)]


def test_run_report(spark, tmp_path):
    report = RunReport(spark, "r1")
    assert report.run("good", lambda: 3)
    assert not report.run("bad", lambda: 1 / 0)
    got = [(r["stage"], r["status"], r["rows"]) for r in report.frame().collect()]
    assert got == [("good", "start", None), ("good", "done", 3), ("bad", "start", None), ("bad", "failed", None)]
    failure = report.failures().first()
    assert failure["exception"] == "division by zero"
    (tmp_path / "file").write_text("x")
    assert "rror" in report.save(str(tmp_path / "file" / "log"))


def test_classroom_counts(spark, tmp_path):
    text = "教室グループID,企業ID,名称,掲載設定数\n1,1d,あ,\n 2 ,1e3,007,nan\n3,,,4\n"
    convert_counts(spark, put(tmp_path / "count.csv", text), str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["double", "double", "string", "double"]
    assert sorted(map(tuple, out.collect())) == [(1.0, None, "あ", None), (2.0, 1000.0, "007", None), (3.0, None, None, 4.0)]


def test_integrate_and_convert(spark, tmp_path):
    put(tmp_path / "in" / "20240131_SS.csv", "日付,広告名,クリック数\n2024/01/31,x,007\n")
    put(tmp_path / "in" / "20240131_CVrepo.csv", ATTRIBUTES)
    for _ in range(2):
        missing = integrate_feeds(spark, str(tmp_path / "in"), str(tmp_path / "h"), dt.date(2024, 2, 1))
    assert rows(missing.select("feed", "issue")) == [("cv", "missing_feed")]
    assert rows(spark.read.parquet(str(tmp_path / "h" / "ss")).drop("feed_date")) == [("2024/01/31", "x", "007")]
    files = {"ss": "20240131_SS.csv", "cv_attr": "20240131_CVrepo.csv", "cv": "none.csv"}
    issues = convert_feeds(spark, str(tmp_path / "in"), files, str(tmp_path / "out"))
    assert rows(issues.select("feed", "issue")) == [
        ("cv", "missing_feed"),
        ("cv_attr", "blank_header"),
        ("cv_attr", "blank_header"),
        ("cv_attr", "repeated_header"),
    ]
    assert spark.read.parquet(str(tmp_path / "out" / "cv_attr")).columns == ["CV日", "売上金額", "広告名", "広告名_1"]


def test_rows_without_day(spark, tmp_path):
    odd = spark.createDataFrame([("someday", "x")], "`日付` string, x string")
    with pytest.raises(Exception, match="holds no date: someday"):
        K.append_feed(K.with_day(odd), str(tmp_path / "h"))
    assert K.with_day(odd, strict=False).first()["feed_date"] is None
    assert str(K.with_day(odd, "2024-01-31").first()["feed_date"]) == "2024-01-31"


CELLS = st.text(st.sampled_from("ab1２.,\"' \n\t　～①￥-#\\;|"), max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.sampled_from(["a", " b", "売上金額", "", "　", "a", '"q,']), min_size=1, max_size=5),
    st.lists(st.lists(CELLS, min_size=1, max_size=7), min_size=1, max_size=25),
)
def test_scan_feed_model(spark, tmp_path, header, lines):
    """Any CSV text against Python's reader: header rules, padding, cutting, currency."""
    if not any(h.strip() for h in header):
        header = ["a", *header]
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows([header, *lines])
    path = put(tmp_path / f"{uuid.uuid4().hex}.csv", text.getvalue())

    read = list(csv.reader(io.StringIO(text.getvalue())))
    names = [h.strip() for h in read[0] if h.strip()]
    money = names.index("売上金額") if "売上金額" in names else -1
    want = []
    for line in read[1:]:
        if not line:
            continue
        line = (line + [""] * len(names))[: len(names)]
        want.append(tuple((re.sub(r"[^\d.]", "", v) or v) if i == money else v for i, v in enumerate(line)))
    got = S.scan_feed(spark, path)
    assert got.columns == S.unique_names(names)
    assert rows(got) == sorted(want)
    assert rows(S.scan_feed(spark, path, multi_line=None)) == sorted(want)
    counts = [r["field_count"] for r in S.scan_feed(spark, path, with_source=True).collect()]
    assert sorted(n for n in counts if n != len(names)) == sorted(
        len(r) for r in read[1:] if r and len(r) != len(names)
    )


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(CELLS, CELLS), min_size=1, max_size=30))
def test_written_feed_reads_everywhere(spark, tmp_path, lines):
    """What is written reads back the same, by this reader and by Python's."""
    folder = tmp_path / uuid.uuid4().hex
    K.write_feed_csv(spark.createDataFrame(lines, "`名` string, v string").coalesce(1), str(folder))
    assert rows(S.scan_feed(spark, str(folder))) == sorted(lines)
    text = "".join(p.read_bytes().decode("cp932") for p in folder.glob("*.csv"))
    assert sorted(tuple(r) for r in csv.reader(io.StringIO(text, newline=""))) == sorted([("名", "v"), *lines])


def test_headers_of_several_files(spark, tmp_path):
    folder = tmp_path / "turned"
    put(folder / "a.csv", "a,b\n1,2\n")
    put(folder / "b.csv", "b,a\n2,1\n")
    assert rows(S.scan_mixed_feed(spark, str(folder), ["a", "b"])) == [("1", "2"), ("1", "2")]
    with pytest.raises(Exception, match="b.csv"):
        S.scan_feed(spark, [str(folder / "a.csv"), str(folder / "b.csv")]).collect()
    put(folder / "c.csv", "x,y\n3,4\n")
    with pytest.raises(ValueError, match="c.csv"):
        S.scan_mixed_feed(spark, str(folder), ["a", "b"])
    odd = tmp_path / "odd"
    put(odd / "a.csv", "a,,b\n1,2,3\n")
    put(odd / "b.csv", "a,b,\n1,2,3\n")
    with pytest.raises(ValueError, match="headers differ"):
        S.scan_feed(spark, str(odd))


def test_field_count_of_long_fields(spark):
    record = '"' + 'x""y,' * 50_000 + '",b,"c'
    assert spark.range(1).select(S.field_count(F.lit(record))).first()[0] == 3


def test_lone_returns_are_not_split(spark, tmp_path):
    assert S.may_be_split(spark, put(tmp_path / "plain.csv", "a,b\r\n1,2\r\n"))
    assert not S.may_be_split(spark, put(tmp_path / "lone.csv", 'a,b\n"1\r1",2\n'))
    path = str(tmp_path / "lone.csv")
    assert rows(S.scan_feed(spark, path, multi_line=None)) == [("1\r1", "2")]


def test_newest_report_may_be_empty(spark, tmp_path):
    put(tmp_path / "detail_analyze_1.csv", "a\n1\n")
    put(tmp_path / "detail_analyze_2.csv", "")
    os.utime(tmp_path / "detail_analyze_1.csv", (1, 1))
    newest = S.latest_file(spark, str(tmp_path), ["detail_analyze"]).first()["path"]
    assert newest.endswith("detail_analyze_2.csv")
    with pytest.raises(ValueError):
        S.scan_feed(spark, newest)


def test_feed_files_by_day_and_end(spark, tmp_path):
    put(tmp_path / "20240131_own_CVrepo.csv", "a\n1\n")
    put(tmp_path / "20240130_own_CVrepo.csv", "a\n2\n")
    found = S.scan_feeds(spark, str(tmp_path), S.feed_file_names(dt.date(2024, 2, 1), 1))
    assert rows(found["cv_attr"]) == [("1",)] and set(found.missing) == {"ss", "cv"}


def test_old_days_are_deleted(spark, tmp_path):
    history = str(tmp_path / "history")
    for day in ("2024-01-01", "2024-01-02", "2024-01-05"):
        K.append_feed(K.with_day(spark.createDataFrame([(day,)], "v string"), day), history)
    assert K.remove_old_days(spark, history, 2) == ["feed_date=2024-01-01"]
    assert rows(spark.read.parquet(history).select("v")) == [("2024-01-02",), ("2024-01-05",)]
    K.remove_day(spark, history, dt.date(2024, 1, 5))
    assert rows(spark.read.parquet(history).select("v")) == [("2024-01-02",)]
