"""URL parts, with the leniency of a browser-like URL reader."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _clean(url: Column) -> Column:
    """Leading blanks and control characters go, tabs and line breaks go anywhere."""
    return F.regexp_replace(F.regexp_replace(url, r"[\t\r\n]", ""), r"^[\x00-\x20]+", "")


def request_key(url: Column) -> Column:
    """What requests and landed responses are matched by: the URL without blanks around it."""
    return F.rtrim(_clean(url))


def url_scheme(url: Column) -> Column:
    """Lower-case scheme, ``''`` if there is none."""
    return F.lower(F.regexp_extract(_clean(url), r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def file_path(url: Column) -> Column:
    """Path a ``file:`` URL stands for; NULL for other schemes.

    Without a host, or with host ``.``, the path is relative. Any other host is a first folder,
    unless the path is absolute, which then wins.
    """
    rest = F.regexp_replace(_clean(url), r"^[A-Za-z]+:", "")
    host = F.regexp_extract(rest, r"^//([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^(?://[^/?#]*)?([^?#]*)", 1)
    relative = F.regexp_replace(F.regexp_replace(path, r"^/+", ""), r"^\\+", "")
    joined = (
        F.when(host.isin("", "."), relative).when(path == "", host).when(
            path.startswith("/"), path
        ).otherwise(F.concat_ws("/", host, path))
    )
    return F.when(url_scheme(url) == "file", plain_path(joined))


def plain_path(path: Column) -> Column:
    """Path without doubled slashes, ``.`` steps and a closing slash."""
    path = F.regexp_replace(path, r"/{2,}", "/")
    path = F.regexp_replace(path, r"(?<=/)(?:\./)+|^(?:\./)+", "")
    return F.regexp_replace(path, r"(?<=.)(?:/\.)?/?$", "")
