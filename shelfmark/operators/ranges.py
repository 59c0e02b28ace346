"""Key ranges: exact quantile boundaries, contiguous segments, membership."""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.errors import RangeError
from shelfmark.functions.names import key_of_url
from shelfmark.functions.search import count_below
from shelfmark.spec import CatalogSpec

# Quantile search tells keys apart by so many characters at a time.
CHARACTERS = 2


class KeyRanges:
    """Contiguous ranges of keys, given by the strictly rising keys at which they end.

    Range n holds the keys above ``ends[n - 1]`` up to and including ``ends[n]``; the first has no
    lower and the last no upper bound.
    """

    def __init__(self, ends: Iterable[str] = ()):
        self.ends = tuple(ends)
        falls = [n for n in range(1, len(self.ends)) if self.ends[n - 1] >= self.ends[n]]
        if falls:
            raise RangeError(f"{len(falls)} ends of key ranges do not rise, the first at place {falls[0]}")

    def __len__(self) -> int:
        return len(self.ends) + 1

    def bounds(self, n: int) -> tuple[str | None, str | None]:
        """The end of the range before and that of the range itself; None is an open side."""
        return (self.ends[n - 1] if n else None), (self.ends[n] if n < len(self.ends) else None)

    def holds(self, key: Column, n: int) -> Column:
        """Whether a key lies in range n; both bounds reach a Parquet scan as filters."""
        low, high = self.bounds(n)
        inside = key.isNotNull()
        if low is not None:
            inside = inside & (key > low)
        if high is not None:
            inside = inside & (key <= high)
        return inside

    def place(self, key: Column) -> Column:
        """The one range a key lies in."""
        return count_below(key, self.ends)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(n, *self.bounds(n)) for n in range(len(self))], schemas.SEGMENTS)


def scan_segments(shards: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of the ranges that ``wanted`` names by ``index``, in one scan however many they are.

    ``shards`` is a listing with a segment column, at best stored by it: then the scan opens only the files of
    wanted ranges, also where these are known at run time only. A range is named once.
    """
    ranges = wanted.select(F.col("index").cast("int").alias("segment")).distinct()
    # one integer a range, and the ranges came from the driver
    return shards.join(F.broadcast(ranges), "segment", "left_semi")


def assign_segments(listing: DataFrame, ranges: KeyRanges) -> DataFrame:
    """Every row with the one range its key falls into. No join, no shuffle."""
    return listing.withColumn("segment", ranges.place(F.col("key")))


def exact_quantiles(df: DataFrame, column: str, parts: int) -> list[str]:
    """The discrete i/parts quantiles of a string column, i = 1 .. parts - 1, as sorted distinct values.

    A quantile is the value at rank ceil(n * i / parts), counted from 1 over all non-null rows.

    Sorting everything to read a few ranks would shuffle every key. Instead keys are counted by how they
    begin, first all of them, then those that begin like the key at a wanted rank, ``CHARACTERS`` further at
    a time and past whatever the keys of a group have in common. A group whose smallest and largest key are
    the same ends the search for its ranks. Each pass counts in tasks before it shuffles; the driver gets a row
    for each beginning that is found below the at most ``parts`` - 1 beginnings that hold a wanted rank.
    """
    keys = df.select(F.col(column).alias("key")).where("key IS NOT NULL")
    rows, low, high = keys.agg(F.count(F.lit(1)), F.min("key"), F.max("key")).first()
    if parts < 2 or rows == 0:
        return []
    # integer arithmetic: rank = ceil(rows * i / parts)
    ranks = [(rows * i + parts - 1) // parts for i in range(1, parts)]
    found: set[str] = set()
    todo: dict[str, list[int]] = {}
    _look_up(ranks, [(rows, low, high)], found, todo)
    while todo:
        prefixes = sorted(todo)
        groups: dict[int, list] = {}
        for r in _beginnings(keys, prefixes).collect():
            groups.setdefault(r["prefix"], []).append(r)
        wanted, todo = todo, {}
        for n, prefix in enumerate(prefixes):
            # strings compare as their bytes in UTF-8; a group that begins another is one key, which comes first
            found_below = sorted(groups[n], key=lambda r: r["beginning"])
            _look_up(wanted[prefix], [(r["n"], r["low"], r["high"]) for r in found_below], found, todo)
    return sorted(found)


def _beginnings(keys: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Keys below some prefixes, counted by prefix and the characters after it, with the smallest and largest of each."""
    key = F.col("key")
    below = [key.startswith(p) for p in prefixes]
    prefix = F.coalesce(*(F.when(there, F.lit(n)) for n, there in enumerate(below)))
    beginning = F.coalesce(*(F.when(there, F.substring(key, 1, len(p) + CHARACTERS)) for p, there in zip(prefixes, below, strict=True)))
    placed = keys.where(reduce(Column.__or__, below)).select("key", prefix.alias("prefix"), beginning.alias("beginning"))
    return placed.groupBy("prefix", "beginning").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))


def _look_up(ranks: Sequence[int], groups: Iterable[tuple[int, str, str]], found: set[str], todo: dict[str, list[int]]) -> None:
    """Find the group of each rank among groups in order: its key if it has one only, else where to look on."""
    waiting, before = sorted(ranks, reverse=True), 0
    for n, low, high in groups:
        while waiting and waiting[-1] <= before + n:
            rank = waiting.pop() - before
            if low == high:
                found.add(low)
            else:
                todo.setdefault(os.path.commonprefix([low, high]), []).append(rank)
        before += n


def key_boundaries(previous_files: DataFrame, spec: CatalogSpec, parts: int | None = None) -> list[str]:
    """Boundaries that cut the keys of an earlier files catalog into equal segments."""
    parts = spec.segments if parts is None else parts
    if parts < 2:
        return []
    foreign = previous_files.where(~F.col("url").startswith(spec.base_url)).count()
    if foreign:
        raise RangeError(f"{foreign} urls of the earlier catalog lie outside the archive")
    keys = previous_files.select(key_of_url(F.col("url"), spec).alias("key"))
    return exact_quantiles(keys, "key", parts)
