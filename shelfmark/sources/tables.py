"""Stored tables and scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from shelfmark.errors import ArchiveError

# The lookup of paths is all waiting for the store, so there are more of its tasks than cores.
LOOKUP_TASKS_PER_CORE = 16
_LOOKUP_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# Paths of scratch tables that this process made and has not deleted.
_scratch: list[str] = []


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored table, or None where there is none yet; a folder without data is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def register(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Make tables known to SQL under their names, replacing views of an earlier run."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def literal_paths(paths: Sequence[str]) -> list[str]:
    """Paths as the file reader takes them literally: it reads some characters as patterns."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in paths]


def read_text(spark: SparkSession, paths: Sequence[str], wholetext: bool = False) -> DataFrame:
    """Text files by their literal paths.

    Spark looks up very many paths in a job of its own, by default in a task a path: each task then takes far longer
    to start than to look. Here a task looks up several.
    """
    before = spark.conf.get(_LOOKUP_TASKS)
    spark.conf.set(_LOOKUP_TASKS, str(min(int(before), LOOKUP_TASKS_PER_CORE * spark.sparkContext.defaultParallelism)))
    try:
        return spark.read.text(literal_paths(paths), wholetext=wholetext)
    finally:
        spark.conf.set(_LOOKUP_TASKS, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data on whatever store holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_table(staged: DataFrame) -> None:
    """Delete the folder of a staged table that no plan reads any more."""
    for folder in {file.rpartition("/")[0] for file in staged.inputFiles()}:
        drop_path(staged.sparkSession, folder)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of this process."""
    while _scratch:
        drop_path(spark, _scratch.pop())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table, in the folder ``spark.checkpoint.dir`` names.

    All executors must see that folder. Without the setting only a local session gets a folder of
    its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ArchiveError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="shelfmark-")
    path = f"{root.rstrip('/')}/shelfmark/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table and read it back: computed once, and safe from lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
