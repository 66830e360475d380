"""URL text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """Drop the scheme wherever it occurs, cut at the first slash."""
    bare = F.replace(F.replace(url, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    return F.split_part(bare, F.lit("/"), F.lit(1))


def fix_url(url: Column) -> Column:
    """Null for an empty address; ``https://`` is put in front when there is no scheme."""
    schemed = F.startswith(url, F.lit("http://")) | F.startswith(url, F.lit("https://"))
    return F.when(F.length(url) == 0, F.lit(None).cast("string")).when(schemed, url).otherwise(
        F.concat(F.lit("https://"), url)
    )


def page_slug(url: Column) -> Column:
    """File-name form of an address: dots of the host and dots and slashes of the path become ``_``.

    Taken apart by pattern, so odd addresses give a slug as well and no query fails on them.
    An address without a path gets ``index``.
    """
    parts = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?([^?#]*)"
    host = F.translate(F.regexp_extract(url, parts, 1), ".", "_")
    path = F.regexp_replace(F.regexp_extract(url, parts, 2), ";[^/]*$", "")
    path = F.translate(path, "/.", "__")
    return F.concat(host, F.when(path == "", F.lit("index")).otherwise(path))
