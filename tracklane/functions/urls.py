"""URL column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# scheme : // authority path, up to the first "?" or "#"
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"


def url_path(url: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(url, _PARTS, 3), ";[^/]*$", "")


def object_name(url: Column) -> Column:
    """Last path segment of a URL, ignoring the query; null where there is none."""
    trimmed = F.regexp_replace(url_path(url), "/+$", "")
    return F.nullif(F.substring_index(trimmed, "/", -1), F.lit(""))


def safe_url(url: Column) -> Column:
    """``scheme://host/path``: no credentials, port, query or fragment, so it can be logged."""
    host = F.regexp_replace(F.regexp_extract(url, _PARTS, 2), "^.*@", "")
    host = F.when(
        host.startswith("["), F.regexp_extract(host, r"^\[([^\]]*)", 1)
    ).otherwise(F.substring_index(host, ":", 1))
    return F.concat(F.lower(F.regexp_extract(url, _PARTS, 1)), F.lit("://"), F.lower(host), url_path(url))
