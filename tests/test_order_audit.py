import os
import subprocess
import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfmark.operators.order_audit import order_audit
from shelfmark.sinks.tables import write_sorted

ROOT = Path(__file__).parent.parent


def audit(spark, path, *keys):
    return tuple(order_audit(spark.read.parquet(str(path)), keys).first())


def numbers(spark, count):
    return spark.range(count).select(F.format_string("k%06d", "id").alias("k"), (F.col("id") % 7).alias("n"))


def test_a_sorted_table_of_many_files_is_in_order(spark, tmp_path):
    path = f"{tmp_path}/t"
    frame = numbers(spark, 30_000).repartition(6)
    frame.repartitionByRange(6, "k").sortWithinPartitions("k").write.parquet(path)
    assert audit(spark, path, "k") == (30_000, 0)


def test_swapped_part_files_are_noticed_at_their_edges(spark, tmp_path):
    for part, (low, high) in enumerate([(0, 10), (20, 30), (10, 20)]):
        frame = pd.DataFrame({"k": [f"k{i:02d}" for i in range(low, high)]})
        (tmp_path / "t").mkdir(exist_ok=True)
        frame.to_parquet(tmp_path / "t" / f"part-0000{part}-x.parquet")
    assert audit(spark, tmp_path / "t", "k") == (30, 1)


def test_part_numbers_count_as_numbers(spark, tmp_path):
    (tmp_path / "t").mkdir()
    for part, key in ((99_999, "a"), (100_000, "b")):
        pd.DataFrame({"k": [key]}).to_parquet(tmp_path / "t" / f"part-{part:05d}-x.parquet")
    assert audit(spark, tmp_path / "t", "k") == (2, 0)


@pytest.mark.parametrize(
    ("rows", "fallen"),
    [
        ([("a", "x"), ("a", "y"), ("b", "a"), (None, "a"), (None, None)], 0),
        ([(None, "a"), ("a", "x")], 1),
        ([("a", None), ("a", "x")], 1),
        ([("b", "x"), ("a", "y"), ("a", "x")], 2),
        ([("a", "x"), ("a", "x")], 0),
        ([("z", "x"), ("ä", "x"), ("\U0001f600", "x")], 0),
        ([], 0),
    ],
)
def test_neighbours(spark, tmp_path, rows, fallen):
    frame = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    frame.write.parquet(f"{tmp_path}/t")
    assert audit(spark, f"{tmp_path}/t", "a", "b") == (len(rows), fallen)


def test_a_long_file_is_read_in_batches_and_splits(spark, tmp_path):
    rows = 45_000
    order = [f"k{i:06d}" for i in range(rows)]
    order[25_000], order[25_001] = order[25_001], order[25_000]
    (tmp_path / "t").mkdir()
    pd.DataFrame({"k": order}).to_parquet(tmp_path / "t" / "part-00000.parquet", row_group_size=5_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    try:
        stored = spark.read.parquet(f"{tmp_path}/t")
        assert stored.rdd.getNumPartitions() > 1
        assert tuple(order_audit(stored, ["k"]).first()) == (rows, 1)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_write_sorted_puts_nulls_last_and_passes(spark, tmp_path):
    frame = numbers(spark, 5_000).withColumn("k", F.when(F.col("n") != 3, F.col("k"))).repartition(5)
    write_sorted(frame, f"{tmp_path}/t", ("k", "n"), level=5)
    assert audit(spark, f"{tmp_path}/t", "k", "n") == (5_000, 0)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 5_000


def test_executors_need_no_copy_of_the_package(tmp_path):
    """A driver in another folder, whose Python workers cannot import the package."""
    script = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from shelfmark.operators.order_audit import order_audit
spark.range(10).repartition(3).write.parquet({str(tmp_path / "t")!r})
print("found", order_audit(spark.read.parquet({str(tmp_path / "t")!r}), ["id"]).first()["rows"])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "found 10" in done.stdout, done.stderr[-2000:]
