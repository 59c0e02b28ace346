"""A store of text files for queries that read an archive from disk."""

from __future__ import annotations

import os
import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.sources.tables import scratch_path

# Python workers get these functions by value, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _write_in_task(batches):
    """Write the lines of sorted ``(path, line)`` rows to their files; a file shows up once it is whole."""
    def finish(file, path):
        if file:
            file.close()
            os.replace(file.name, path)

    path, file = None, None
    for batch in batches:
        for name, line in zip(batch.column("path").to_pylist(), batch.column("line").to_pylist(), strict=True):
            if name is None:
                raise ValueError(f"a line of no file: {line}")
            if name != path:
                finish(file, path)
                folder, _, last = name.rpartition("/")
                os.makedirs(folder, exist_ok=True)
                path, file = name, open(f"{folder}/.{last}.{os.getpid()}", "wb")  # noqa: SIM115
            file.write((line or "").encode() + b"\n")
    finish(file, path)
    yield pa.RecordBatch.from_pydict({"files": pa.array([], pa.int64())})


def write_files(lines: DataFrame, root: str) -> str:
    """Text files named by ``key`` below ``root``, made of the lines ``(key, line)``; the root as readers name it.

    Tasks write the files themselves where the root is a folder that they see as such. Any other store gets them
    from Spark's writer, and their names on the driver, as an upload would.
    """
    spark = lines.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    whole = store.makeQualified(path(root))
    if whole.toUri().getScheme() == "file":
        # a number given is kept, where adaptive execution would let one task write very many small files
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        placed = lines.select(F.concat(F.lit(f"{whole.toUri().getPath()}/"), "key").alias("path"), "line")
        written = placed.repartition(parts, "path").sortWithinPartitions("path").mapInArrow(_write_in_task, "files bigint")
        written.count()
        return re.sub("^file:/+", "file:///", whole.toString())
    loose = scratch_path(spark, "loose-files")
    named = lines.select(F.md5("key").alias("name"), F.col("line").alias("value"))
    named.repartition("name").write.partitionBy("name").text(loose)
    for row in lines.select("key", F.md5("key").alias("name")).distinct().collect():
        target = path(f"{root}/{row['key']}")
        store.mkdirs(target.getParent())
        [part] = [f.getPath() for f in store.listStatus(path(f"{loose}/name={row['name']}"))]
        store.rename(part, target)
    return whole.toString()
