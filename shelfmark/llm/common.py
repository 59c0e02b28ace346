"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.sources.tables import drop_table, scratch_path
from shelfmark.sources.tables import stage as stage_at

# A key that holds more than 1/HOT of all rows is hot; there are at most HOT such keys, which bounds
# what is broadcast for them.
HOT = 1_000

# Values that a memo in a Python worker keeps before it starts afresh: a bound on memory, not on work.
MEMO = 200_000


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within it, a job's shuffle files are deleted when it ends, and not some time after the driver has forgotten it."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, computed once and stored in the shared folder; what was shuffled for them is deleted at once."""
    with shuffles_deleted(df.sparkSession):
        return stage_at(df, scratch_path(df.sparkSession, name))


def worker_cached(key: tuple, make: Callable):
    """An object that a Python worker makes once and keeps for later tasks, until another takes its place."""
    kept = sys.__dict__.setdefault("_shelfmark_kept", {})
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]


def return_memory() -> None:
    """Give what this Python worker has freed back to the system.

    Workers live as long as their executor, and an allocator that keeps the largest need of every stage for itself
    would leave too little to the next.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; others return memory by themselves
    if trim is not None:
        trim(0)


def release_kept() -> None:
    """Drop what ``worker_cached`` keeps in this Python worker, which other stages of a job have no use for."""
    kept = sys.__dict__.get("_shelfmark_kept", {})
    if kept:
        kept.clear()
        gc.collect()
    return_memory()


class Memo(dict):
    """A dict that makes missing values, and forgets all of them beyond ``MEMO`` keys."""

    def __init__(self, make: Callable):
        self.make = make

    def __missing__(self, key):
        if len(self) >= MEMO:
            self.clear()
        value = self[key] = self.make(key)
        return value


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def join_counted(rows: DataFrame, groups: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """``rows.join(groups, key, "left")`` where ``weight`` tells how many of ``total`` rows a group has.

    ``groups`` has one row a key, the key not null. Groups with more than 1/HOT of all rows are
    looked up by broadcast (at most HOT rows); their rows then take a salted key through the shuffle
    for the other groups, where they match nothing, so that no task gets them all.
    """
    columns = [c for c in groups.columns if c != key]
    hot = F.col(weight) * HOT >= F.lit(total)
    values = F.struct(*columns)
    few = groups.where(hot).select(key, values.alias("__hot"))
    many = groups.where(~hot).select(key, values.alias("__cold"), F.lit(0).alias("__salt"))
    salt = F.when(F.col("__hot").isNull(), 0).otherwise(F.pmod(F.xxhash64(*rows.columns), F.lit(4096)).cast("int"))
    joined = rows.join(F.broadcast(few), key, "left").withColumn("__salt", salt).join(many, [key, "__salt"], "left")
    found = F.coalesce("__hot", "__cold")
    return joined.select(*rows.columns, *(found[c].alias(c) for c in columns))


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected ``links (a, b)``: ``(node, root)``, the root the smallest node.

    Every node of a link is listed. Alternates two steps that hang the neighbours of a node on its
    smallest neighbour: first the larger ones, then the smaller ones. Each round stores its links, of
    which there are never more than before; the number of rounds grows with the logarithm of the
    longest chain.
    """
    edges = staged(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staged(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        spent, edges = (edges, large), staged(small.where("a <> b").distinct(), "links")
        for table in spent:  # a round needs the one before it only
            drop_table(table)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b").distinct().toDF("node", "root")
    )


SKETCH_WORDS = 1 << 16  # of 64 bits: half a MB, whatever the number of values


def sketch(values: DataFrame, column: str) -> DataFrame:
    """A set of bigint values (ids or hashes) as bits ``(__word, __bits)``: at most ``SKETCH_WORDS`` rows.

    It only tells which values cannot be in the set; with more values it lets more others pass.
    """
    bit = F.col(column).bitwiseAND(F.lit(SKETCH_WORDS * 64 - 1))
    mask = F.expr("shiftleft(1L, int(__bit & 63))").alias("__mask")
    marked = values.select(bit.alias("__bit")).select(F.shiftrightunsigned("__bit", 6).alias("__word"), mask)
    return marked.groupBy("__word").agg(F.bit_or("__mask").alias("__bits"))


def maybe_in(rows: DataFrame, values: DataFrame, column: str, keep: bool = True) -> DataFrame:
    """Rows whose ``column`` may be among ``values`` (a sketch): all that are, and few others.

    With ``keep`` false, the other rows: their value is surely not among them, or null.
    """
    bit = F.col(column).bitwiseAND(F.lit(SKETCH_WORDS * 64 - 1))
    placed = rows.withColumn("__bit", bit).withColumn("__word", F.shiftrightunsigned("__bit", 6))
    found = placed.join(F.broadcast(values), "__word", "left")
    hit = F.expr("coalesce((shiftrightunsigned(__bits, int(__bit & 63)) & 1) = 1, false)")
    return found.where(hit if keep else ~hit).select(*rows.columns)


def sketch_array(values: DataFrame) -> np.ndarray:
    """The words of a sketch as one array, for use in Python workers."""
    words = np.zeros(SKETCH_WORDS, np.uint64)
    rows = values.toArrow()
    words[rows["__word"].to_numpy()] = rows["__bits"].to_numpy().view(np.uint64)
    return words


def maybe_in_array(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of some unsigned 64-bit values may be in a sketch."""
    bit = values & np.uint64(SKETCH_WORDS * 64 - 1)
    return (words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
