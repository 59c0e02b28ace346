"""Copies that keep the order of sorted part files without a sort."""

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.order_audit import order_audit
from shelfmark.sinks import ordered_copy
from shelfmark.sinks.tables import write_sorted


def sorted_table(spark, path, values, files):
    """Part files of very uneven sizes, in order."""
    rng = random.Random(files)
    values = sorted(values, key=lambda v: (v is None, (v or "").encode()))
    cuts = sorted(rng.sample(range(1, len(values)), files - 1))
    for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(values)], strict=True)):
        frame = spark.createDataFrame([(v, k, "x" * rng.randrange(200)) for k, v in enumerate(values[a:b])], "k string, n int, pad string")
        frame.coalesce(1).write.mode("append").parquet(f"{path}-{n}")
    return values, [f"{path}-{n}" for n in range(files)]


@pytest.mark.parametrize("files", [1, 2, 9])
def test_the_order_is_kept(spark, tmp_path, files):
    rng = random.Random(files)
    values = [f"é{rng.randrange(500)}" for _ in range(300)] + [f"\U0001f600{n}" for n in range(20)] + [None] * 3
    ordered, folders = sorted_table(spark, f"{tmp_path}/in", values, files)
    stored = spark.read.parquet(*folders)
    copy = ordered_copy.copy_loose(stored, f"{tmp_path}/out", ("k",), {"compression": "zstd"})
    assert copy.faithful and copy.rows == len(values)
    assert copy.repeats == len(values) - len(set(values))
    assert len(copy.names) == files  # a file each
    ordered_copy.settle(spark, copy, f"{tmp_path}/out")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert tuple(order_audit(out, ("k",)).first()) == (len(values), 0)
    names = out.select("k", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i")).collect()
    assert [r["k"] for r in sorted(names, key=lambda r: (r["f"], r["i"]))] == ordered
    assert ordered_copy.contents(out) == ordered_copy.contents(stored)
    assert not (tmp_path / "_loose-out").exists()


def test_files_that_overlap_are_noticed(spark, tmp_path):
    for n in range(3):
        spark.createDataFrame([(f"k{i}",) for i in range(n, 9, 3)], "k string").coalesce(1).write.parquet(f"{tmp_path}/in-{n}")
    stored = spark.read.parquet(*(f"{tmp_path}/in-{n}" for n in range(3)))
    copy = ordered_copy.copy_loose(stored, f"{tmp_path}/out", ("k",), {})
    assert copy.falls and not copy.faithful and copy.source == copy.stored


def test_an_empty_table_keeps_its_schema(spark, tmp_path):
    write_sorted(spark.createDataFrame([], "k string, n int"), f"{tmp_path}/in", ("k",))
    copy = ordered_copy.copy_loose(spark.read.parquet(f"{tmp_path}/in"), f"{tmp_path}/out", ("k",), {})
    assert copy.faithful
    ordered_copy.settle(spark, copy, f"{tmp_path}/out")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == 0 and out.columns == ["k", "n"]


def test_settings_are_given_back(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with pytest.raises(ValueError), ordered_copy.one_task_a_file(spark):
        raise ValueError
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
