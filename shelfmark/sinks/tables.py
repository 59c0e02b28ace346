"""Sorted tables, segment shards and publishing."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfmark.errors import ListingError, PublishError
from shelfmark.operators.gates import enforce, gate_report
from shelfmark.operators.listing import check_coverage, check_not_shrunken, check_repeats, check_unique
from shelfmark.operators.order_audit import order_audit
from shelfmark.operators.ranges import KeyRanges
from shelfmark.schemas import OUTPUTS, PUBLISH_ORDER, Output
from shelfmark.sinks.ordered_copy import content_metrics, contents, copy_loose, observed_contents, settle
from shelfmark.sources.tables import drop_path, path_exists
from shelfmark.spec import CatalogSpec

logger = logging.getLogger(__name__)

# Parquet compresses pages of about 1 MB one by one. Levels far above this one gain nothing on pages
# of that size, but set up hundreds of megabytes for each.
PUBLISHED_ZSTD_LEVEL = 9


def write_sorted(
    df: DataFrame, path: str, keys: tuple[str, ...], level: int | None = None, mode: str = "overwrite"
) -> None:
    """Write zstd Parquet in global order, nulls last, as many part files.

    The range sort cuts on all sort columns, so rows that share the first one still spread out.
    """
    writer = df.orderBy(*[F.asc_nulls_last(k) for k in keys]).write.mode(mode)
    writer = writer.option("compression", "zstd")
    if level is not None:
        writer = writer.option("parquet.compression.codec.zstd.level", str(level))
    writer.parquet(path)


def write_segments(listing: DataFrame, path: str) -> DataFrame:
    """Write each segment to its own folder, sorted; returns ``(segment, n)``.

    ``listing`` has a segment column. A large segment is cut by key into several files, so it is
    not one task's work.
    """
    order = ["segment", "key"]
    shards = listing.repartitionByRange(*order).sortWithinPartitions(*order)
    shards.write.mode("overwrite").option("compression", "zstd").partitionBy("segment").parquet(path)
    return listing.sparkSession.read.parquet(path).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


def merge_listing(
    shards: DataFrame, ranges: KeyRanges, spec: CatalogSpec, path: str, previous_rows: int | None = None
) -> int:
    """Audit a segmented listing and write it as one table sorted by key; returns its rows.

    ``shards`` is read straight from what ``write_segments`` stored. Its files are sorted and cut by key, so they
    are put one after the other: no row is sorted or shuffled again, and a key that is there twice is next to itself.
    Only files that overlap, because a segment was written in several goes, are sorted.
    """
    spark = shards.sparkSession
    keys = check_coverage(shards, ranges, spec, unique=False)["keys"]
    if previous_rows is not None:
        check_not_shrunken(keys, previous_rows, spec)
    rows = shards.select("key", "size", "last_modified", "etag")
    copy = copy_loose(rows, path, ("key",), {"compression": "zstd"})
    if copy.falls:
        drop_path(spark, copy.loose)
        check_unique(rows)
        write_sorted(rows, path, ("key",))
        return keys
    try:
        check_repeats(copy.repeats)
        if copy.source != copy.stored:
            raise ListingError(f"{path} does not hold the listed rows: {copy.stored} and {copy.source}")
        settle(spark, copy, path)
    finally:
        drop_path(spark, copy.loose)
    return keys


def table_path(root: str, output: Output) -> str:
    return f"{root.rstrip('/')}/{output.file}"


def read_catalog(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {o.name: spark.read.parquet(table_path(root, o)) for o in OUTPUTS}


def write_catalog(tables: Mapping[str, DataFrame], root: str, level: int | None = None) -> dict[str, int]:
    """Write the three tables in their contract order of columns and rows; returns row counts."""
    counts = {}
    for output in OUTPUTS:
        path = table_path(root, output)
        write_sorted(tables[output.name].select(output.columns), path, output.sort, level)
        # answered from the file footers
        counts[output.file] = tables[output.name].sparkSession.read.parquet(path).count()
        logger.info("%s: %d rows", path, counts[output.file])
    return counts


def publish(
    spark: SparkSession,
    staged: str,
    target: str,
    spec: CatalogSpec,
    previous: Mapping[str, DataFrame | None] | None = None,
    level: int = PUBLISHED_ZSTD_LEVEL,
) -> dict[str, int]:
    """Validate the staged catalog again, then store its tables under ``target`` in publish order.

    ``target`` is a new folder for each release, so readers of an earlier release are not disturbed.
    The staged tables are sorted, so their part files are compressed anew one by one, without a sort. Each
    stored table is compared with the staged one before the next is written: rows, order, schema
    and a hash sum of all values, which the write and one scan of the result observe. A table that is there
    already, because an earlier run broke off later, is compared likewise and kept; one that differs is an error
    and never overwritten. Only a table whose write was not completed is written anew. Strong compression is paid for
    here only, once, after all gates passed.
    """
    tables = read_catalog(spark, staged)
    enforce(gate_report(tables, spec, previous))
    options = {"compression": "zstd", "parquet.compression.codec.zstd.level": str(level)}
    counts = {}
    for output in PUBLISH_ORDER:
        path, table = table_path(target, output), tables[output.name]
        if path_exists(spark, f"{path}/_SUCCESS"):
            stored = spark.read.parquet(path)
            observed = Observation()
            rows, fallen = order_audit(stored, output.sort, (observed, content_metrics(stored))).first()
            held = observed_contents(observed) if rows else contents(stored)  # without rows nothing may be observed
            same = stored.schema == table.schema and not fallen and held == contents(table)
        else:
            copy = copy_loose(table, path, output.sort, options)
            rows, fallen, same = copy.rows, copy.falls, copy.faithful
            if same:
                settle(spark, copy, path)
        if not same:
            raise PublishError(f"{path} does not hold the staged table: {rows} rows, {fallen} falls in order")
        counts[output.file] = rows
        logger.info("published %s: %d rows", path, rows)
    return counts
