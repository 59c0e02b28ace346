import json
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import records

SOURCE = "metadata/edan/npg/00.txt"


def metadata(spark, spec, *contents, unit="U"):
    rows = [(i, unit, c if isinstance(c, str) or c is None else json.dumps(c)) for i, c in enumerate(contents)]
    frame = spark.createDataFrame(rows, "i int, unitCode string, content string")
    return frame.withColumn("filename", F.lit(spec.object_url(spec.key_prefix + SOURCE)))


def extracted(spark, spec, content, unit="U"):
    return records.extract_records(metadata(spark, spec, content, unit=unit), spec).first()


def with_media(media, **fields):
    return {"record_id": "r", "descriptiveNonRepeating": {"online_media": {"media": media}}, **fields}


def resource(name):
    return {"url": f"https://ids.example/dl?id={name}"}


def test_fields_come_from_the_top_or_from_below(spark, spec):
    nested = {"record_ID": "n", "unit_code": "NU", "guid": "ng", "title": {"content": "nt"}}
    top = {"record_id": "t", "title": "tt", "guid": "tg", "descriptiveNonRepeating": nested}
    row = extracted(spark, spec, top)
    assert tuple(row)[:5] == ("t", "U", "tt", "tg", spec.base_url + SOURCE)
    row = extracted(spark, spec, {"descriptiveNonRepeating": nested}, unit=None)
    assert tuple(row)[:4] == ("n", "NU", "nt", "ng")
    row = extracted(spark, spec, {"title": None})
    assert tuple(row)[:4] == (None, "U", None, None)
    assert row["media_names"] is None


@pytest.mark.parametrize(
    ("media", "names"),
    [
        ([{"resources": [resource("a.jpg"), resource("b.TIFF")]}, {"resources": [resource("c.pdf")]}], ["a.jpg", "b.TIFF", "c.pdf"]),
        ([{"resources": [resource("a.jpg"), resource("a.jpg")]}], ["a.jpg"]),
        ([{"resources": [resource("a.png"), resource("xjpg"), resource("a.jpg.txt"), resource("a.jpeg")]}], ["xjpg", "a.jpeg"]),
        ([{"resources": [{"label": "no url"}, {"url": None}, None, resource("a.jpg")]}, None, {"x": 1}], ["a.jpg"]),
        ([7, "s", {"resources": [resource("a.jpg")]}], ["a.jpg"]),
        ([{"resources": [5, resource("a.jpg")]}, {"resources": [resource("b.jpg")]}], ["a.jpg", "b.jpg"]),
        ([{"resources": resource("a.jpg")}, {"resources": [resource("b.jpg")]}], ["b.jpg"]),
        ({"resources": [resource("a.jpg")]}, []),
        ("text", []),
        (None, []),
        ([], []),
        ([{"resources": [{"url": "https://ids.example/dl?id=a.jpg\n"}]}], []),
        ([{"resources": [{"url": 5}]}], []),
    ],
)
def test_media_of_any_shape(spark, spec, media, names):
    row = extracted(spark, spec, with_media(media, title="T"))
    assert row["media_names"] == names
    alone = records.extract_records(metadata(spark, spec, with_media(media)), spec).select("media_names")
    assert alone.first()[0] == names
    assert (row["record_id"], row["title"], row["malformed"]) == ("r", "T", False)


def test_odd_shapes_beside_media_do_not_hide_them(spark, spec):
    content = with_media([{"resources": [resource("a.jpg")]}])
    content["descriptiveNonRepeating"]["title"] = "not an object"
    row = extracted(spark, spec, content)
    assert row["media_names"] == ["a.jpg"]
    assert row["title"] is None


@pytest.mark.parametrize(
    ("content", "malformed"),
    [('{"record_id": "a", "ti', True), ("{oops", True), ("", True), ("  ", True), ("[1]", False), ("7", False), (None, False)],
)
def test_texts_that_are_not_json_are_marked(spark, spec, content, malformed):
    row = extracted(spark, spec, content)
    assert (row["record_id"], row["malformed"]) == (None, malformed)


def test_content_is_parsed_once(spark, spec, tmp_path):
    """Sound texts: the other parses stand behind the verdict of the first."""
    metadata(spark, spec, with_media([])).write.parquet(f"{tmp_path}/m")
    found = records.extract_records(spark.read.parquet(f"{tmp_path}/m"), spec)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("parse_?json", plan, re.IGNORECASE)) == 1
    assert "CASE WHEN NOT whole" in plan and plan.count("from_json(StructField(record_id") == 1


def test_repeated_names_take_the_last(spark, spec):
    text = '{"record_id":"a","title":"one","title":"two","descriptiveNonRepeating":{"online_media":{"media":[7,{"resources":[{"url":"x?id=a.jpg"}]}]}}}'
    row = extracted(spark, spec, text)
    assert (row["record_id"], row["title"], row["media_names"], row["malformed"]) == ("a", "two", ["a.jpg"], False)


def test_keep_one_takes_the_first_with_nulls_last(spark):
    rows = [("k", None, 1), ("k", "b", 2), ("k", "a", 3), ("l", None, 4), (None, "z", 5), (None, "y", 6)]
    frame = spark.createDataFrame(rows, "key string, o string, v int")
    assert sorted(r["v"] for r in records.keep_one(frame, ["key"], ["o"]).collect()) == [3, 4, 6]


def test_keep_one_drops_copies_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("key"), "id")
    plan = records.keep_one(frame, ["key"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def tables(spark):
    found = [
        ("a_1", "A", "first", None, "u2"),
        ("a_1", "A", "second", "g", "u1"),
        ("a_1", "A", "third", "g", None),
        ("b_1", None, None, None, None),
        ("c_1", "C", "unlinked", "g", "u3"),
        (None, "N", "no id", "g", "u4"),
    ]
    found = spark.createDataFrame(found, "record_id string, unit_code string, title string, guid string, metadata_url string")
    links = [("x", "a_1"), ("y", "a_1"), ("z", "b_1"), ("z", "m_1"), ("w", "ghost_1"), ("n", None)]
    links = spark.createDataFrame(links, "url string, record_id string")
    models = [("1", "a_1", "model of a"), ("2", "m_1", None), ("3", "m_1", "beta"), ("4", "m_1", "alpha"), ("5", "c_1", "of c"), ("6", "NoUnderscore", None)]
    models = spark.createDataFrame(models, "model_id string, record_id string, title string")
    return found, links, models


EXPECTED_LINKED = [("A", "a_1", "second", "g", "u1"), (None, "b_1", None, None, None)]
# c_1 is in the dump but no link names it, so its model gets a synthetic row as well
EXPECTED_SYNTHETIC = [
    ("C", "c_1", "of c", None, None),
    ("M", "m_1", "alpha", None, None),
    ("NOUNDERSCORE", "NoUnderscore", None, None, None),
]


def ordered(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_linked_records_are_unique_and_linked(spark):
    found, links, _ = tables(spark)
    assert ordered(records.linked_records(found, links)) == sorted(EXPECTED_LINKED, key=repr)


def test_models_without_a_linked_record_get_a_row(spark):
    found, links, models = tables(spark)
    linked = records.linked_records(found, links)
    assert ordered(records.synthetic_records(models, linked)) == sorted(EXPECTED_SYNTHETIC, key=repr)


def test_the_catalog_has_both(spark):
    catalog = records.catalog_metadata(*tables(spark))
    assert catalog.columns == ["unit_code", "record_id", "title", "guid", "metadata_url"]
    assert ordered(catalog) == sorted(EXPECTED_LINKED + EXPECTED_SYNTHETIC, key=repr)


def test_the_catalog_does_not_depend_on_the_order_of_rows(spark):
    found, links, models = tables(spark)
    rows = found.collect()
    random.Random(5).shuffle(rows)
    shuffled = spark.createDataFrame(rows, found.schema).repartition(5)
    assert ordered(records.catalog_metadata(shuffled, links, models)) == ordered(
        records.catalog_metadata(found, links, models)
    )
