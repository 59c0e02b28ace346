"""Further columns with the names that operators use inside change nothing."""

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import licenses, packing, warc
from tests.llm.odd import documents, odd_rows, sentence

NAMES = [
    "key", "hash", "n", "part", "at", "file", "offset", "length", "payload", "payload_digest", "shard", "block", "data", "words", "pos", "grams",
    "template", "label", "labels", "diagonal", "score", "ids", "start", "class", "bucket", "sequence_id", "weight", "row", "__salt", "__hot",
]


def clashing(df):
    return df.select("*", *(F.lit(k if k % 2 else "x").alias(name) for k, name in enumerate(NAMES) if name not in df.columns))


@pytest.mark.parametrize("name", ["op4", "op5", "op8"])
def test_results_are_the_same(spark, name):
    rng = random.Random(4)
    if name == "op4":
        rows = [(n, f"http://h{n % 3}.example/{n}", None if n % 7 == 0 else sentence(rng, 3 + n % 5)) for n in range(60)]
        frame, query = spark.createDataFrame(rows, "page_id bigint, url string, html string"), warc.op4
    else:
        rows = odd_rows(rng) + [(100 + n, sentence(rng, 30) + " licensed under the MIT License") for n in range(20)]
        frame, query = documents(spark, rows), {"op5": packing.op5, "op8": licenses.op8}[name]
    plain, found = query(frame), query(clashing(frame))
    assert found.columns == plain.columns
    # where a piece lies may differ, since rows are numbered by their hash; what it is may not
    same = [c for c in plain.columns if name != "op5" or c in ("doc_id", "doc_tokens")]
    assert sorted(map(repr, found.select(same).distinct().collect())) == sorted(map(repr, plain.select(same).distinct().collect()))
