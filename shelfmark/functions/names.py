"""Keys, urls and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.spec import CatalogSpec


def after(text: Column, prefix: str) -> Column:
    """The part of ``text`` behind the first ``len(prefix)`` characters."""
    return F.substr(text, F.lit(len(prefix) + 1))


def file_name(path: Column) -> Column:
    """What follows the last slash or backslash; '' for a folder marker."""
    return F.substring_index(F.translate(path, "\\", "/"), "/", -1)


def public_url(key: Column, spec: CatalogSpec) -> Column:
    return F.concat(F.lit(spec.base_url), after(key, spec.key_prefix))


def key_of_url(url: Column, spec: CatalogSpec) -> Column:
    return F.concat(F.lit(spec.key_prefix), after(url, spec.base_url))


def model_id(key: Column, spec: CatalogSpec) -> Column:
    """The id folder of a 3D model's file, '' when the key has none."""
    return F.regexp_extract(key, spec.model_pattern, 1)


def linked_name(url: Column) -> Column:
    """The raw value of a url's first ``id=`` parameter, '' when it has none."""
    return F.regexp_extract(url, "[?&]id=([^&]+)", 1)


def source_path(path: Column | None = None) -> Column:
    """The path of the file a row was read from (``_metadata.file_path``), as the reader was given it.

    Spark percent-encodes the path and may drop slashes of a local one. ``url_decode`` would turn a
    plus sign into a space, so plus signs are escaped first.
    """
    path = F.col("_metadata.file_path") if path is None else path
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:///")


def naive_utc(instant: Column) -> Column:
    """An instant as UTC wall-clock time, whatever the session's time zone."""
    return F.timestamp_add(
        "MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    )


def bare_etag(etag: Column) -> Column:
    return F.btrim(etag, F.lit('"'))
