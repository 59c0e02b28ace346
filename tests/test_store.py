"""Text files of a store that queries write."""

import os

import pytest
from pyspark.sql import functions as F

from catalog_queries.store import write_files


def contents(root):
    folder = root.removeprefix("file://")
    paths = [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names]
    return {os.path.relpath(p, folder): sorted(open(p, encoding="utf-8").read().splitlines()) for p in paths}


def test_files_hold_the_lines_of_their_key(spark, tmp_path):
    rows = [("a/b/x.txt", "one"), ("a/b/x.txt", "two"), ("a/y.txt", "ö"), ("z", None), ("a/b/x.txt", "one")]
    root = write_files(spark.createDataFrame(rows, "key string, line string"), f"{tmp_path}/s")
    assert root == f"file://{tmp_path}/s"
    assert contents(root) == {"a/b/x.txt": ["one", "one", "two"], "a/y.txt": ["ö"], "z": [""]}


def test_many_small_files_are_written_by_many_tasks_and_need_no_row_of_each_on_the_driver(spark, tmp_path):
    lines = spark.range(2_000).select(F.concat(F.lit("m"), "id", F.lit("/s.json")).alias("key"), F.lit("{}").alias("line"))
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("store", "files of a store")
    try:
        root = write_files(lines, f"{tmp_path}/s")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("store") for s in status.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = contents(root)
    assert len(found) == 2_000 and set(map(tuple, found.values())) == {("{}",)}


def test_a_line_without_a_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="a line of no file"):
        write_files(spark.createDataFrame([(None, "x")], "key string, line string"), f"{tmp_path}/s")
