"""Alerts and status messages."""

import pytest
from pyspark.sql import functions as F

from feedloom.operators import alerts as A


@pytest.mark.parametrize("code, start", [(400, "不正なリクエスト"), (504, "ゲートウェイ"), (418, "予期せぬ"), (None, "サーバー")])
def test_status(values, code, start):
    assert values(A.status_message, [code], "int")[0].startswith(start)


def build(spark, exception, trace, context):
    df = spark.createDataFrame(
        [("m", exception, trace, context)], "message string, exception string, stack_trace string, context map<string,string>"
    )
    return A.build_alerts(df, F.lit("dev"), F.lit("h"), F.lit("now")).first()


def test_alert_texts(spark):
    assert build(spark, None, "trace", None)["text"] == "*m*\n"
    assert build(spark, "e", None, None)["text"] == "*m*\n\n```\ne\n```"
    assert build(spark, "e", A.NO_TRACE, None)["text"] == "*m*\n\n```\ne\n```"
    assert build(spark, "e", "t" * 1000, None)["text"].endswith("```\n" + "t" * 1000 + "```")
    long = build(spark, "e", "t" * 1001, None)["text"]
    assert "t" * 1000 + "```\n(" in long and "t" * 1001 not in long


def test_repeated_frames(spark):
    """A frame and its times give the text that the written-out trace gives, also where that has gigabytes."""
    frames = ["f\n", "", None, A.NO_TRACE, "t" * 500, "t" * 1001, "字\n"]
    cases = [(frame, times) for frame in frames for times in (-1, 0, 1, 2, 3, 500, 501, None)]
    shape = "message string, exception string, stack_trace struct<frame:string,times:int>, context map<string,string>"

    def texts(traces, kind):
        df = spark.createDataFrame([("m", "e", trace, None) for trace in traces], shape if kind == "struct" else shape.replace("struct<frame:string,times:int>", "string"))
        return [r["text"] for r in A.build_alerts(df, F.lit("dev"), F.lit("h"), F.lit("now")).collect()]

    plain = [None if frame is None or times is None else frame * max(times, 0) for frame, times in cases]
    assert texts(cases, "struct") == texts(plain, "string")
    huge = texts([("frame\n", 2**31 - 1)], "struct")[0]
    assert huge.endswith("```\n" + A.TRACE_CUT) and len(huge) < 1100


def test_alert_fields(spark):
    row = build(spark, None, None, {"環境": "again", "k": "v"})
    assert [tuple(f) for f in row["fields"]] == [("環境", "dev"), ("ホスト", "h"), ("発生時刻", "now"), ("環境", "again"), ("k", "v")]
    assert (row["title"], row["color"]) == ("エラー発生", "#ff0000")


def test_notices(spark):
    df = spark.createDataFrame([("m", "")], "message string, t string")
    row = A.build_notices(df, F.col("t")).first()
    assert (row["title"], row["color"], row["text"]) == ("通知", "#36a64f", "m")


def test_status_alerts(spark):
    row = A.status_alerts(spark.createDataFrame([(404,)], "status_code int"), "U1", "bot").first()
    assert row["text"].startswith("<@U1>リクエストされた") and (row["username"], row["icon_emoji"]) == ("bot", ":exclamation:")
