"""Alert records and status texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import truncate_text

# Messages, colours, titles and texts of alerts.
STATUS_MESSAGES = {
    400: "不正なリクエストです。詳細はログファイルをご覧ください。",
    401: "認証に失敗しました。詳細はログファイルをご覧ください。",
    403: "アクセス権限がありません。詳細はログファイルをご覧ください。",
    404: "リクエストされたリソースが見つかりません。詳細はログファイルをご覧ください。",
    408: "リクエストタイムアウトが発生しました。詳細はログファイルをご覧ください。",
    500: "サーバーエラーが発生しました。詳細はログファイルをご覧ください。",
    502: "不正なゲートウェイです。詳細はログファイルをご覧ください。",
    503: "サービス利用不可。詳細はログファイルをご覧ください。",
    504: "ゲートウェイタイムアウトが発生しました。詳細はログファイルをご覧ください。",
}
UNKNOWN_STATUS = "予期せぬエラーが発生しました。詳細はログファイルをご覧ください。"
STATUS_WITHOUT_RESPONSE = 500
RED, GREEN = "#ff0000", "#36a64f"
ERROR_TITLE, NOTICE_TITLE = "エラー発生", "通知"
TRACE_TITLE = "スタックトレース:"
TRACE_LIMIT = 1000
TRACE_CUT = "(スタックトレースが長すぎるため省略されました)"
NO_TRACE = "NoneType: None\n"
ENVIRONMENT, HOST, TIME = "環境", "ホスト", "発生時刻"
ICON = ":exclamation:"


def status_message(code: Column) -> Column:
    """Message of an HTTP status; a missing status counts as 500. A literal map, so no join."""
    entries = [F.lit(x) for pair in STATUS_MESSAGES.items() for x in pair]
    status = F.coalesce(code.cast("int"), F.lit(STATUS_WITHOUT_RESPONSE))
    return F.coalesce(F.try_element_at(F.create_map(*entries), status), F.lit(UNKNOWN_STATUS))


def repeated_trace(frame: Column, times: Column, trace_limit: int = TRACE_LIMIT) -> Column:
    """A frame so many times, written out no further than it takes to show the limit and to tell that there is more."""
    # a trace that is cut here is longer than the limit, and than the text that counts as none
    enough = F.floor(F.lit(max(trace_limit, len(NO_TRACE))) / F.nullif(F.length(frame), F.lit(0))) + 1
    return F.when(times.isNotNull(), F.repeat(frame, F.least(times, enough).cast("int")))


def error_text(message: Column, exception: Column, trace: Column, trace_limit: int = TRACE_LIMIT) -> Column:
    """Bold message, fenced exception, and the trace, cut at so many characters."""
    has_trace = F.coalesce((trace != "") & (trace != NO_TRACE), F.lit(False))
    cut = F.when(F.length(trace) > trace_limit, F.lit("\n" + TRACE_CUT)).otherwise(F.lit(""))
    trace_part = F.when(
        has_trace,
        F.concat(F.lit(f"\n*{TRACE_TITLE}*\n```\n"), truncate_text(trace, trace_limit), F.lit("```"), cut),
    ).otherwise(F.lit(""))
    exception_part = F.when(
        exception.isNotNull(), F.concat(F.lit("\n```\n"), exception, F.lit("\n```"), trace_part)
    ).otherwise(F.lit(""))
    return F.concat(F.lit("*"), message, F.lit("*\n"), exception_part)


def default_fields(environment: Column, host: Column, at: Column) -> Column:
    """The three fields that every message carries."""
    entries = ((ENVIRONMENT, environment), (HOST, host), (TIME, at))
    return F.array(*(F.struct(F.lit(name).alias("title"), value.cast("string").alias("value")) for name, value in entries))


def build_alerts(
    failures: DataFrame, environment: Column, host: Column, at: Column, title: Column | None = None, context: str = "context"
) -> DataFrame:
    """Failure rows ``(message, exception, stack_trace, context map)`` as alert rows.

    Adds ``title``, ``color``, ``text`` and ``fields``: three default fields, then the context. The trace is a text, or
    ``(frame, times)`` where one frame repeats: then the text's size does not grow with the times.
    """

    extra = F.transform(
        F.map_entries(F.col(context)), lambda e: F.struct(e["key"].alias("title"), e["value"].cast("string").alias("value"))
    )
    none = F.array().cast("array<struct<title:string,value:string>>")
    heading = title if title is not None else F.lit(ERROR_TITLE)
    defaults = default_fields(environment, host, at)
    trace = F.col("stack_trace")
    if isinstance(failures.schema["stack_trace"].dataType, T.StructType):
        trace = repeated_trace(trace["frame"], trace["times"])
    return failures.select(
        "*",
        F.coalesce(F.nullif(heading, F.lit("")), F.lit(NOTICE_TITLE)).alias("title"),
        F.lit(RED).alias("color"),
        error_text(F.col("message"), F.col("exception"), trace).alias("text"),
        F.concat(defaults, F.coalesce(extra, none)).alias("fields"),
    )


def build_notices(
    notices: DataFrame,
    title: Column | None = None,
    environment: Column | None = None,
    host: Column | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Plain messages as alert rows in the default colour; without a title the standard one is used.

    With environment, host and time the rows also get ``fields``, the three that alerts have.
    """
    given = environment is not None and host is not None and at is not None
    fields = [default_fields(environment, host, at).alias("fields")] if given else []
    heading = title if title is not None else F.lit(None).cast("string")
    return notices.select(
        "*",
        F.coalesce(F.nullif(heading, F.lit("")), F.lit(NOTICE_TITLE)).alias("title"),
        F.lit(GREEN).alias("color"),
        F.col("message").alias("text"),
        *fields,
    )


def status_alerts(failures: DataFrame, user: str, sender: str, icon: str = ICON, code: str = "status_code") -> DataFrame:
    """Failed requests as short messages: the user addressed, then the status's message."""
    return failures.select(
        "*",
        F.concat(F.lit(f"<@{user}>"), status_message(F.col(code))).alias("text"),
        F.lit(sender).alias("username"),
        F.lit(icon).alias("icon_emoji"),
    )
