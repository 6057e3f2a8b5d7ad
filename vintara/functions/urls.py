"""URL handling, Column -> Column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vintara.functions.text import col, strip

#: scheme, authority with its slashes, path, query with ?, fragment with #
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def _part(c: Column, group: int) -> Column:
    return F.regexp_extract(c, _PARTS, group)


def url_path(c: Column | str) -> Column:
    return _part(col(c), 3)


def normalise_url(c: Column | str) -> Column:
    """Trim, lower-case scheme and host, cut trailing slashes of the path."""
    url = strip(c)
    scheme = F.lower(_part(url, 1))
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.lower(_part(url, 2)),
        F.regexp_replace(_part(url, 3), "/+$", ""),
        _part(url, 4),
        _part(url, 5),
    )


def _tidy(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(part == ".", done)
        .otherwise(F.concat(done, F.array(part))),
    )
    kept = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    tidy = F.array_join(kept, "/")
    return F.when(tidy.startswith("/"), tidy).otherwise(F.concat(F.lit("/"), tidy))


def resolve_url(base: Column | str, ref: Column | str) -> Column:
    """Absolute URL of a link found on the page ``base``."""
    base, ref = col(base), col(ref)
    scheme, own = F.lower(F.substring_index(base, ":", 1)), F.lower(F.substring_index(ref, ":", 1))
    absolute = ref.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:")
    root = F.regexp_extract(base, r"^([^:/?#]+:(?://[^/?#]*)?)", 1)
    page = F.regexp_extract(base, r"^[^:/?#]+:(?://[^/?#]*)?([^#]*)", 1)
    page_path = F.substring_index(page, "?", 1)
    folder = F.regexp_replace(page_path, "[^/]*$", "")
    path = F.regexp_extract(ref, "^[^?#]*", 0)
    rest = F.regexp_extract(ref, r"[?#](?s:.*)\z", 0)
    # empty inner segments of a merged relative path are dropped
    merged = F.regexp_replace(F.concat(F.lit("/"), folder, path), "/{2,}", "/")
    target = F.when(ref.startswith("/"), path).otherwise(merged)
    return (
        F.when(ref == "", base)
        .when(absolute & (own == scheme), F.concat(scheme, F.substring(ref, F.length(own) + 1, F.length(ref))))
        .when(absolute, ref)
        .when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
        .when(ref.startswith("?"), F.concat(root, page_path, ref))
        .when(ref.startswith("#"), F.concat(root, page, ref))
        .when(target.rlike(r"(?:^|/)\.{1,2}(?:/|\z)"), F.concat(root, _tidy(target), rest))
        .otherwise(F.concat(root, target, rest))
    )


def has_extension(c: Column | str, extensions: Sequence[str]) -> Column:
    return col(c).rlike(r"(?i)\.(" + "|".join(extensions) + r")\z")


def last_segment(c: Column | str) -> Column:
    return F.substring_index(col(c), "/", -1)


def file_name(url: Column | str, period: Column | str) -> Column:
    """Name to store a download under."""
    path = F.regexp_replace(F.substring_index(col(url), "?", 1), "/+$", "")
    name = last_segment(path)
    return F.when(name != "", name).otherwise(F.concat(col(period), F.lit(".bin")))


def hub_file_name(url: Column | str) -> Column:
    """Last path segment, or a name made from the URL's digest."""
    name = last_segment(F.regexp_replace(url_path(url), "/+$", ""))
    digest = F.substring(F.md5(col(url).cast("binary")), 1, 8)
    return F.when(name != "", name).otherwise(F.concat(F.lit("file_"), digest, F.lit(".csv")))


def yearbook_file_name(href: Column | str) -> Column:
    """Last segment of the link's path, in lower case."""
    return last_segment(F.regexp_replace(F.lower(url_path(strip(href))), "/+$", ""))


def versioned_name(name: Column | str, version: Column) -> Column:
    """``base.vN.ext``, split at the first dot."""
    name = col(name)
    base = F.substring_index(name, ".", 1)
    tag = F.concat(base, F.lit(".v"), version.cast("string"))
    return F.when(name.contains("."), F.concat(tag, F.substring(name, F.length(base) + 1, F.length(name))))\
        .otherwise(tag)
