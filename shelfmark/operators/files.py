"""The files catalog and pattern selection over a listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.names import file_name, naive_utc, public_url
from shelfmark.spec import CatalogSpec


def select_keys(listing: DataFrame, pattern: str) -> DataFrame:
    """Keys that match a pattern, in order."""
    return listing.select("key").where(F.rlike("key", F.lit(pattern))).orderBy("key")


def is_file() -> Column:
    """Not a folder marker."""
    return file_name(F.col("key")) != ""


def build_files(listing: DataFrame, spec: CatalogSpec) -> DataFrame:
    """One row per media or 3D object: url, size, last_modified in naive UTC.

    Both prefix tests reach the Parquet scan as string-prefix filters.
    """
    modified = F.col("last_modified")
    if isinstance(listing.schema["last_modified"].dataType, T.TimestampType):
        modified = naive_utc(modified)
    under = F.col("key").startswith(spec.media_prefix) | F.col("key").startswith(spec.models_prefix)
    return listing.where(under & is_file()).select(
        public_url(F.col("key"), spec).alias("url"),
        F.col("size").cast("long").alias("size"),
        modified.alias("last_modified"),
    )
