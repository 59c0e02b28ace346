"""One parse that proves a text to be one value, against the two that judge any text."""

import json
import random

from pyspark.sql import functions as F

from shelfmark.functions import json_text
from shelfmark.functions.json_text import as_variant, field_of, is_one_value, is_whole, not_json, parse_whole, whole_value

FIELDS = "record_id STRING, n STRUCT<a: STRING>"
MARK = json_text._MARK
ESCAPED = json_text._MARK_ESCAPE
PIECES = [
    "{", "}", "[", "]", ",", ":", '"', '"a":1', '"record_id":"r"', '{"record_id":"r"}', '{"n":{"a":"x"}}', "null", "7", " ", "\n", "junk",
    f'"{MARK}":0', f'{{"{MARK}":0}}', f'],"{MARK}":[', f'{{"{ESCAPED}":0}}', f'],"{ESCAPED}":[', "]}", '}],"x":[{', '},"x":{"y":1', "//", "\\",
]
SMUGGLED = [
    f'{{"record_id":"a"}},"{MARK}"],[1', f'{{"record_id":"a"}},"{ESCAPED}"]',
    f'{{"record_id":"a"}}],"{MARK}":[{{"record_id":"b"}}',
    f'{{"record_id":"a"}}],"{ESCAPED}":[{{"record_id":"b"}}',
    f'{{"record_id":"a"}},{{"{MARK}":0}}]}}',
    f'{{"record_id":"a"}},{{"{ESCAPED}":0}}]}}',
    '{"record_id":"a"},{"record_id":"b"}',
    '{"record_id":"a"},"x":1',
    '{"record_id":"a"}],"x":[{"record_id":"b"}',
    '{"record_id":"a"}]}', '{"record_id":"a"}]', '{"record_id":"a"}}', '{"record_id":"a"} junk', '{"record_id":"a"', "", "  ", None,
]
SOUND = ['{"record_id":"a"}', ' {"record_id":"a","record_id":"b"}\n', '{"n":{"a":5,"b":[{"c":1}]}}', "{}", "null"]
ODD = ["7", '"text"', "[1]", '{"n":3}', f'{{"record_id":"{MARK}"}}']


def judged(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    once = rows.select("*", parse_whole(F.col("text"), FIELDS).alias("once"))
    once = once.withColumn("variant", as_variant(F.col("text")))
    # both ways to parse once must agree wherever they claim something
    one, whole = is_one_value(F.col("variant"), F.col("text")), is_whole(F.col("once"), F.col("text"))
    for r in once.select("text", one.alias("one"), whole.alias("whole"), not_json(F.col("text")).alias("bad"),
                         field_of(F.col("variant"), "record_id").alias("a"), whole_value(F.col("once"))["record_id"].alias("b")).collect():
        assert not (r.one and r.bad), r.text
        assert not (r.one and r.whole) or r.a == r.b, r.text
        if r.one:
            json.loads(r.text)
    found = once.select("i", is_whole(F.col("once"), F.col("text")).alias("whole"), not_json(F.col("text")).alias("bad"),
                        whole_value(F.col("once"))["record_id"].alias("record_id"))
    return [(texts[r.i], r.whole, r.bad, r.record_id) for r in found.orderBy("i").collect()]


def test_nothing_is_smuggled_past_the_mark(spark):
    for text, whole, bad, _ in judged(spark, SMUGGLED):
        assert not whole, text
        assert bad == (text is not None)


def test_sound_texts_take_one_parse(spark):
    for text, whole, bad, record_id in judged(spark, SOUND):
        assert whole and not bad
        assert record_id == (json.loads(text) or {}).get("record_id")


def test_other_shapes_are_left_to_the_second_parse(spark):
    assert all(not whole and not bad for _, whole, bad, _ in judged(spark, ODD))


def test_random_texts(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    texts += [rng.choice(SOUND).strip() + "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 6))) for _ in range(3000)]
    for text, whole, bad, _ in judged(spark, texts):
        if whole:
            assert not bad, text
            json.loads(text)
