import bisect
import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import json_text, names
from shelfmark.functions.search import count_below


def values(spark, column, *inputs):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in frame.orderBy("i").select(column).collect()]


def test_file_name_cuts_at_either_slash(spark):
    v = F.col("v")
    assert values(spark, names.file_name(v), "a/b.jpg", "a/", "a\\b/c\\d.tif", "plain", None) == [
        "b.jpg", "", "d.tif", "plain", None,
    ]


def test_urls_and_keys_are_inverse(spark, spec):
    v = F.col("v")
    [url] = values(spark, names.public_url(v, spec), "arc/pub/media/x/ü.jpg")
    assert url == "https://files.example/arc/pub/media/x/ü.jpg"
    assert values(spark, names.key_of_url(v, spec), url) == ["arc/pub/media/x/ü.jpg"]


def test_linked_name_is_the_first_raw_id_value(spark):
    found = values(
        spark,
        names.linked_name(F.col("v")),
        "https://x/dl?id=A%20b.jpg",
        "https://x/dl?a=1&id=B.tif&id=C",
        "https://x/dl?pid=D",
        "none",
        None,
    )
    assert found == ["A%20b.jpg", "B.tif", "", "", None]


def test_source_path_undoes_percent_encoding_only(spark):
    found = values(spark, names.source_path(F.col("v")), "file:/t/a%20b+c%25.txt", "s3a://b/k+1.txt")
    assert found == ["file:///t/a b+c%.txt", "s3a://b/k+1.txt"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_naive_utc_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.sql("SELECT timestamp_micros(1767225600000001) AS t")
        assert frame.select(names.naive_utc(F.col("t"))).first()[0] == dt.datetime(2026, 1, 1, 0, 0, 0, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, 8, 63, 64, 100])
def test_count_below_is_a_lower_bound(spark, size):
    ordered = [f"k{i:03d}" for i in range(1, 2 * size, 2)]
    probes = [f"k{i:03d}" for i in range(2 * size + 2)] + ["", "z"]
    found = values(spark, count_below(F.col("v"), ordered), *probes, None)
    assert found == [bisect.bisect_left(ordered, p) for p in probes] + [None]


def test_json_parts(spark):
    v = F.col("v")
    assert values(spark, json_text.parts_of_list(v), '[1, "a", {"b": 2}, null]', '{"a": 1}', "[", None) == [
        ["1", "a", '{"b":2}', None], None, None, None,
    ]
    field = json_text.parts_of_field(v, "r")
    assert values(spark, field, '{"r": [1, "x"]}', '{"r": {"u": 1}}', '{"r": 3}', "7", "{}", None) == [
        ["1", "x"], [], [], [], [], [],
    ]
    assert values(spark, json_text.has_field(v, "c"), '{"c": null}', '{"d": 1}', "[1]") == [True, False, None]
    assert values(spark, json_text.not_json(v), '{"c": 1}', "{oops", "7", None) == [False, True, False, False]


def test_patterns(spark, spec):
    model = "m" * spec.model_id_length

    def matching(pattern, *keys):
        return values(spark, F.rlike("v", F.lit(pattern)), *keys)

    prefix = spec.key_prefix
    assert matching(
        spec.record_file_pattern,
        prefix + "metadata/edan/u 7/c9.txt",
        prefix + "metadata/edan/u 7/c9.txt.gz",
        prefix + "metadata/edan/u 7/C9.txt",
        prefix + "metadata/edan/u/7/c9.txt",
        prefix + "metadata/edan/u 7/c9.txt\n",
        "x" + prefix + "metadata/edan/u 7/c9.txt",
        prefix.replace("/", "-") + "metadata/edan/u 7/c9.txt",
    ) == [True, False, False, False, False, False, False]
    assert matching(
        spec.scene_key_pattern,
        prefix + f"3d/{model}/scene.svx.json",
        prefix + f"3d/{model}m/scene.svx.json",
        prefix + f"3d/{model}/scene-svx-json",
        prefix + f"3d/{model}/old/scene.svx.json",
    ) == [True, False, False, False]
    assert values(spark, names.model_id(F.col("v"), spec), prefix + f"3d/{model}/a/b.glb", prefix + "3d/x/y") == [model, ""]
