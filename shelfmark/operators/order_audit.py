"""Whether stored rows lie in sorted order, across all part files."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Python workers get these functions by value, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _compared(left: list[pa.Array], right: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """For each row pair: whether left sorts after right (nulls last, text by bytes), and whether they are equal."""
    size = len(left[0])
    falls, tied = np.zeros(size, bool), np.ones(size, bool)
    for a, b in zip(left, right, strict=True):
        a_null, b_null = (x.is_null().to_numpy(zero_copy_only=False) for x in (a, b))
        greater = pc.fill_null(pc.greater(a, b), False).to_numpy(zero_copy_only=False)
        equal = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False)
        falls |= tied & (greater | (a_null & ~b_null))
        tied &= equal | (a_null & b_null)
    return falls, tied


class RunTracker:
    """Summarises each stretch of consecutive rows of one file: its ends, the falls and the repeats inside it.

    Stretches are recognised by row position, so nothing is assumed about the order of a scan. Rows need
    the ``keys``, ``file`` and ``at``.
    """

    def __init__(self, keys: Sequence[str]):
        self.keys, self.run, self.tail = keys, None, None

    def add(self, batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        """Take further rows; returns the stretches that ended."""
        rows, closed = pa.Table.from_batches([batch]), []
        if not rows.num_rows:
            return closed
        if self.tail is not None:
            rows = pa.concat_tables([self.tail, rows])
        columns = {name: rows[name].combine_chunks() for name in rows.column_names}
        self.run = self.run or self._open(columns, 0)
        before = {name: column[:-1] for name, column in columns.items()}
        after = {name: column[1:] for name, column in columns.items()}
        found = _compared([before[k] for k in self.keys], [after[k] for k in self.keys])
        same_file = pc.equal(before["file"], after["file"]).to_numpy(zero_copy_only=False)
        follows = same_file & (np.diff(columns["at"].to_numpy()) == 1)
        start = 0
        for gap in np.flatnonzero(~follows).tolist():
            self._count(found, start, gap)
            closed.append(self._close(columns, gap))
            self.run, start = self._open(columns, gap + 1), gap + 1
        self._count(found, start, None)
        self.tail = rows.slice(rows.num_rows - 1)
        return closed

    def finish(self) -> list[pa.RecordBatch]:
        """The last stretch."""
        if self.run is None:
            return []
        return [self._close({name: self.tail[name].combine_chunks() for name in self.tail.column_names}, 0)]

    def _open(self, columns: dict[str, pa.Array], at: int) -> dict:
        return {"first": {name: column[at : at + 1] for name, column in columns.items()}, "falls": 0, "repeats": 0}

    def _count(self, found: tuple[np.ndarray, np.ndarray], start: int, end: int | None) -> None:
        for name, rows in zip(("falls", "repeats"), found, strict=True):
            self.run[name] += int(rows[start:end].sum())

    def _close(self, columns: dict[str, pa.Array], at: int) -> pa.RecordBatch:
        first, last = self.run["first"], {name: column[at : at + 1] for name, column in columns.items()}
        values = [first["file"], first["at"], last["at"], *(pa.array([self.run[n]], pa.int64()) for n in ("falls", "repeats"))]
        values += [first[k] for k in self.keys] + [last[k] for k in self.keys]
        names = ["file", "from", "to", "falls", "repeats"]
        names += [f"{end}_{i}" for end in ("first", "last") for i in range(len(self.keys))]
        return pa.RecordBatch.from_arrays(values, names)


def _runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.RecordBatch]:
    tracker = RunTracker(keys)
    for batch in batches:
        yield from tracker.add(batch)
    yield from tracker.finish()


def _rank(keys: Sequence[str]) -> Column:
    """Keys as one comparable value, nulls last."""
    return F.struct(*[F.struct(F.col(k).isNull(), F.col(k)) for k in keys])


PART = "coalesce(try_cast(regexp_extract(name, '^part-([0-9]+)', 1) AS long), -1)"


def file_summaries(stored: DataFrame, keys: Sequence[str], observed: tuple | None = None) -> DataFrame:
    """A row a stored file that holds rows: ``(place, rows, falls, repeats, first, last)``.

    ``stored`` is a frame straight from ``read.parquet``. The rows are scanned once and not shuffled: a task
    reduces what it reads to one row per stretch of a file. ``place`` orders files by their part number
    and name, ``first`` and ``last`` are their end rows as comparable values, falls and repeats neighbours that
    sort the wrong way or are equal. ``observed`` is an observation and its metrics, taken in the same scan.
    """
    fields = {f.name: f for f in stored.schema.fields}
    types = [fields[k].dataType.simpleString() for k in keys]
    ends = [f"`first_{i}` {t}" for i, t in enumerate(types)] + [f"`last_{i}` {t}" for i, t in enumerate(types)]
    placed = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
    if observed is None:
        scan = stored.select(*keys, *placed)
    else:
        observation, metrics = observed
        scan = stored.select("*", *placed).observe(observation, *metrics).select(*keys, "file", "at")
    runs = scan.mapInArrow(
        lambda batches: _runs(batches, keys),
        "file string, `from` long, `to` long, falls long, repeats long, " + ", ".join(ends),
    )
    first, last = (_rank([f"{end}_{i}" for i in range(len(keys))]) for end in ("first", "last"))
    run = F.struct("from", "to", "falls", "repeats", first.alias("first"), last.alias("last"))
    files = runs.groupBy("file").agg(F.sort_array(F.collect_list(run)).alias("runs"))
    files = files.withColumn("name", F.substring_index("file", "/", -1))

    def total(own: str, between: str) -> Column:
        met = f"size(filter(sequence(1, size(runs)), n -> n < size(runs) AND runs[n - 1].last {between} runs[n].first))"
        return F.expr(f"aggregate(runs, 0L, (n, r) -> n + r.{own}) + {met}")

    return files.select(
        F.struct(F.expr(PART).alias("part"), "name").alias("place"),
        F.expr("aggregate(runs, 0L, (n, r) -> n + r.to - r.from + 1)").alias("rows"),
        total("falls", ">").alias("falls"),
        total("repeats", "=").alias("repeats"),
        F.expr("runs[0].first").alias("first"),
        F.expr("element_at(runs, -1).last").alias("last"),
    )


def order_audit(stored: DataFrame, keys: Sequence[str], observed: tuple | None = None) -> DataFrame:
    """One row ``(rows, out_of_order)``: stored rows, and neighbours of which the first sorts later.

    Part files follow each other by their part number, rows by their position in the file. Files are
    summarised each, in ranges of their names to one row a range, and only the ranges, as many as there
    are shuffle partitions, meet in one task.
    """
    files = file_summaries(stored, keys, observed)
    ranged = files.repartitionByRange("place").withColumn("range", F.spark_partition_id())
    whole = _joined(_joined(ranged, ["range"]), [])
    return whole.select(F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("falls", F.lit(0)).alias("out_of_order"))


def _joined(parts: DataFrame, group: list[str]) -> DataFrame:
    """Parts ``(place, rows, falls, first, last)`` of each group as one, counting falls between neighbours."""
    before = F.lag("last").over(Window.partitionBy(*group).orderBy("place"))
    paired = parts.withColumn("falls", F.col("falls") + F.coalesce((before > F.col("first")).cast("long"), F.lit(0)))
    return paired.groupBy(*group).agg(
        F.min("place").alias("place"), F.sum("rows").alias("rows"), F.sum("falls").alias("falls"),
        F.min_by("first", "place").alias("first"), F.max_by("last", "place").alias("last"),
    )
