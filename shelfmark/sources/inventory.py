"""Object inventories: who is stored, how large, since when."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.names import after, bare_etag, source_path
from shelfmark.spec import CatalogSpec


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """A stored inventory table with key, size, last_modified and etag.

    Unsigned sizes, which Spark reads as decimals, become bigint.
    """
    return as_listing(spark.read.parquet(path))


def as_listing(inventory: DataFrame) -> DataFrame:
    return inventory.select(
        "key", F.col("size").cast("long").alias("size"), "last_modified", bare_etag(F.col("etag")).alias("etag")
    )


def scan_tree(spark: SparkSession, spec: CatalogSpec) -> DataFrame:
    """The inventory of a live tree, listed by Spark's file source without reading any content.

    The driver holds the file statuses while it plans, so for very many objects prefer a stored
    inventory. Such a tree has no etags and shows no folder markers.
    """
    root = spec.object_url(spec.key_prefix)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return found.select(
        after(source_path(), spec.store_url).alias("key"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
        F.lit(None).cast("string").alias("etag"),
    )
