"""Page state rules and site records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.urls import host_of
from feedloom.operators.html import Wanted, parse_pages
from feedloom.operators.selector_forms import has_class

# Texts that only a signed-in or only a login page shows, the class of a
# failed login's notice, record fields dropped when a record moves to another host, and the
# longest value kept. Markers of one site, such as its header's class, are passed as arguments.
SIGNED_IN_MARKERS = ("ダッシュボード", "ログアウト", "マイアカウント", "account-menu")
LOGIN_MARKERS = ("loginForm", "ログインする", "ログインページ", "ユーザー名", "パスワード", "アカウントキー")
FAILURE_CLASS = "alert-danger"
DROPPED_FIELDS = ("expiry", "expires", "httpOnly", "sameSite", "secure")
LONGEST_VALUE = 4000


def _has_any(text: Column, markers: Sequence[str]) -> Column:
    hit = F.lit(False)
    for marker in markers:
        hit = hit | F.contains(text, F.lit(marker))
    return hit


def page_state(
    url: Column,
    html: Column,
    login_url: str,
    dashboard_url: str,
    login_host: str,
    dashboard_host: str,
    signed_in_markers: Sequence[str] = SIGNED_IN_MARKERS,
    login_markers: Sequence[str] = LOGIN_MARKERS,
) -> Column:
    """``(signed_in, rule)``; the first rule that holds decides."""
    bare_dashboard = host_of(F.lit(dashboard_url))
    at_login = F.contains(url, F.lit(login_url))
    rule = (
        F.when(at_login, "login_url")
        .when(F.contains(url, bare_dashboard) & _has_any(html, signed_in_markers), "dashboard_marker")
        .when(_has_any(html, login_markers), "login_marker")
        .when(F.contains(url, F.lit(login_host)), "login_host")
        .when(F.contains(url, F.lit(dashboard_host)), "dashboard_host")
        .otherwise("not_login_url")
    )
    return F.struct(rule.isin("dashboard_marker", "dashboard_host", "not_login_url").alias("signed_in"), rule.alias("rule"))


def login_outcome(pages: DataFrame, success_host: str, login_url: str, url: str = "url", html: str = "html") -> DataFrame:
    """Pages with ``succeeded`` and the ``rule`` that decided it."""
    parsed = parse_pages(pages, Wanted(class_words=(FAILURE_CLASS,), text="none"), html)
    keep = [c for c in parsed.columns if c not in ("elements", "parse_error")]
    failed = F.exists("elements", lambda e: has_class(e, FAILURE_CLASS))
    still_there = F.contains(F.col(url), F.lit(login_url)) if login_url else F.lit(False)
    rule = (
        F.when(F.contains(F.col(url), F.lit(success_host)), "success_host")
        .when(failed, "failure_notice")
        .when(still_there, "still_at_login")
        .otherwise("left_login")
    )
    return parsed.select(*keep, rule.isin("success_host", "left_login").alias("succeeded"), rule.alias("rule"))


def related_host_names(host: Column, family: str | None = None, siblings: Sequence[str] = ()) -> Column:
    """The host, its last two labels and every suffix between; siblings when it holds ``family``."""
    labels = F.split(host, r"\.", -1)
    count = F.size(labels)
    suffixes = F.when(
        count >= 2,
        F.transform(
            F.sequence(F.lit(1), F.greatest(count - 1, F.lit(1))),
            lambda i: F.array_join(F.slice(labels, i, count), "."),
        ),
    ).otherwise(F.array(host))
    own = F.array_distinct(suffixes)
    if not family or not siblings:
        return own
    others = F.array(*[F.lit(s) for s in siblings])
    return F.when(F.contains(host, F.lit(family)), F.array_union(own, others)).otherwise(own)


def related_hosts(
    hosts: DataFrame, known: DataFrame, family: str | None = None, siblings: Sequence[str] = (), column: str = "host"
) -> DataFrame:
    """``(host, related_host)`` for every host and each related name that ``known`` lists.

    Both sides are made distinct first, so a host that fills a third of the rows is one row here.
    """
    pairs = hosts.select(column).distinct().select(
        column, F.explode(related_host_names(F.col(column), family, siblings)).alias("related_host")
    )
    listed = known.select(F.col(column).alias("related_host")).distinct()
    return pairs.join(listed, "related_host", "left_semi").select(column, "related_host")


def retarget_record(record: Column, target: Column) -> Column:
    """A record map for another host: five fields dropped, ``domain`` rewritten by containment.

    A domain with a leading dot is replaced when its bare form and the target contain one
    another; any other domain is replaced when they do not.
    """
    domain = record["domain"]
    bare = F.substr(domain, F.lit(2))
    dotted = F.startswith(domain, F.lit("."))
    related = F.contains(target, domain) | F.contains(domain, target)
    bare_related = F.contains(target, bare) | F.contains(bare, target)
    moved = F.when(dotted, F.when(bare_related, target).otherwise(domain)).otherwise(
        F.when(related, domain).otherwise(target)
    )
    kept = F.map_filter(record, lambda k, v: ~k.isin(*DROPPED_FIELDS))
    return F.transform_values(kept, lambda k, v: F.when((k == "domain") & v.isNotNull(), moved).otherwise(v))


def skip_bad_records(records: DataFrame, name: str = "name", value: str = "value", longest: int = LONGEST_VALUE) -> DataFrame:
    """Keep records that have a name and a value of at most ``longest`` characters."""
    size = F.length(F.col(value))
    return records.where((F.coalesce(F.length(F.col(name)), F.lit(0)) > 0) & (size > 0) & (size <= longest))
