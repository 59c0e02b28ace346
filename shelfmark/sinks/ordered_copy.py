"""Copies of sorted tables that keep the order without sorting: one task a part file, names in the order of the rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.order_audit import file_summaries
from shelfmark.sources.tables import drop_path

# Larger than any part file; as the cost of opening one it keeps two from sharing a task.
_WHOLE_FILE = str(1 << 40)


def content_metrics(df: DataFrame) -> list[Column]:
    """Number of rows and a sum of their hashes, as aggregates."""
    hashes = F.xxhash64(*df.columns).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(hashes), F.lit(0)).alias("hashes")]


def contents(df: DataFrame) -> tuple:
    """Number of rows and a sum of their hashes."""
    return tuple(df.agg(*content_metrics(df)).first())


def observed_contents(observation: Observation) -> tuple:
    """What an observation of ``content_metrics`` found."""
    return observation.get["rows"], observation.get["hashes"]


@contextmanager
def one_task_a_file(spark: SparkSession) -> Iterator[None]:
    """Within it, a scan reads each file in one task, and no two in the same."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name in names:
            spark.conf.set(name, _WHOLE_FILE)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@dataclass(frozen=True)
class OrderedCopy:
    """A table as it was copied: rows, neighbours that sort the wrong way or are equal, contents before and after."""

    rows: int
    falls: int
    repeats: int
    source: tuple
    stored: tuple
    loose: str
    names: tuple[str, ...]

    @property
    def faithful(self) -> bool:
        return self.source == self.stored and not self.falls


def copy_loose(stored: DataFrame, path: str, keys: Sequence[str], options: dict[str, str]) -> OrderedCopy:
    """Write the rows of sorted part files again beside ``path``, a file a task, and find the files' order.

    ``stored`` is read straight from part files, of which each is sorted by ``keys`` and which do not overlap. A
    scan deals files by size, so the copy's names do not follow the rows; ``settle`` gives them names that do. The
    contents are observed in the write, and once more in the scan that tells each file's ends. The driver gets a row
    a file, as many as the write's own commit handles.
    """
    spark = stored.sparkSession
    folder, _, name = path.rstrip("/").rpartition("/")
    loose = f"{folder}/_loose-{name}"
    before, after = Observation(), Observation()
    with one_task_a_file(spark):
        stored.observe(before, *content_metrics(stored)).write.mode("overwrite").options(**options).parquet(loose)
    written = spark.read.schema(stored.schema).parquet(loose)
    files = file_summaries(written, keys, (after, content_metrics(written))).collect()
    files.sort(key=lambda f: (f["first"], f["last"]))
    met = list(zip(files, files[1:], strict=False))
    return OrderedCopy(
        rows=sum(f["rows"] for f in files),
        falls=sum(f["falls"] for f in files) + sum(a["last"] > b["first"] for a, b in met),
        repeats=sum(f["repeats"] for f in files) + sum(a["last"] == b["first"] for a, b in met),
        source=observed_contents(before),
        # of a scan without rows nothing may be left to observe
        stored=observed_contents(after) if files else contents(written),
        loose=loose,
        names=tuple(f["place"]["name"] for f in files),
    )


def settle(spark: SparkSession, copy: OrderedCopy, path: str) -> None:
    """Move a loose copy to ``path`` under names in the order of its rows, and mark it complete last.

    What an unfinished earlier move left at ``path`` is replaced.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    target, loose = hadoop(path), hadoop(copy.loose)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    drop_path(spark, path)
    files.mkdirs(target)
    names = list(copy.names) or [f.getPath().getName() for f in files.listStatus(loose) if f.getPath().getName().startswith("part-")][:1]
    for n, name in enumerate(names):
        rest = name.split("-", 2)[2]
        if not files.rename(hadoop(loose, name), hadoop(target, f"part-{n:05d}-{rest}")):
            raise OSError(f"could not move {copy.loose}/{name} to {path}")
    files.create(hadoop(target, "_SUCCESS")).close()
    drop_path(spark, copy.loose)
