import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.llm import toxicity
from tests.llm.odd import documents, odd_rows, sentence


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 300), st.integers(1, 8), st.integers(1, 20), st.integers(0, 10**6))
def test_the_index_finds_exactly_the_nearest(n, n_terms, k, seed):
    rng = np.random.default_rng(seed)
    terms, weights = [], []
    for _ in range(n):
        t = np.flatnonzero(rng.random(n_terms) < 0.4)
        w = rng.integers(1, 4, len(t)).astype(float)
        terms.append(t)
        weights.append(w / np.linalg.norm(w) if len(t) else w)
    ids = rng.permutation(n)
    index = toxicity.BlockMaxIndex(n_terms, terms, weights, ids)
    query = np.zeros(n_terms)
    query[rng.integers(0, n_terms, 2)] = rng.random()
    at = np.flatnonzero(query)
    q = query[at] / np.linalg.norm(query[at])
    dense = np.zeros((n, n_terms))
    for i, (t, w) in enumerate(zip(terms, weights, strict=True)):
        dense[i, t] = w
    sims = np.round(np.minimum(dense[:, at] @ q, 1.0), 9)
    best = [i for i in np.lexsort((ids, -sims))[:k] if sims[i] > 0]
    found, scores = index.nearest(at, q, k)
    assert index.ids[found].tolist() == ids[best].tolist()
    assert scores.tolist() == pytest.approx(sims[best].tolist())


def labelled(rng, n):
    bad = ["grub", "wretchling", "nitwit"]
    rows, labels = [], []
    for doc_id in range(n):
        words = sentence(rng, rng.randrange(5, 80)).split()
        toxic = int(rng.random() < 0.2)
        for _ in range(toxic * rng.randrange(1, 4)):
            words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", ".", "s"]))
        rows.append((doc_id, " ".join(words)))
        labels.append((doc_id, toxic))
    return rows, labels


def test_held_out_documents_are_told_apart(spark):
    rows, labels = labelled(random.Random(2), 600)
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = toxicity.op3(documents(spark, rows), marks).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    truth = dict(labels)
    assert all(r.predicted == truth[r.doc_id] for r in found if r.held_out)
    assert all(r.held_out == (r.doc_id in {h.doc_id for h in found if h.held_out}) for r in found)


def test_held_out_labels_change_nothing(spark):
    rows, labels = labelled(random.Random(3), 300)
    docs = documents(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    other = marks.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [{r.doc_id: r.score for r in toxicity.op3(docs, m).collect()} for m in (marks, other)]
    assert scores[0] == scores[1]


def test_odd_rows_labels_and_columns(spark):
    rng = random.Random(4)
    rows, labels = labelled(rng, 200)
    rows = [(*r, "x") for r in [(i + 100, t) for i, t in rows] + odd_rows(rng)]
    labels = [(i + 100, y) for i, y in labels] + [(None, 1), (1, None), (2, 7), (4, 0), (4, 1), (99999, 1)]
    docs = documents(spark, rows, ", toxicity string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    kept = toxicity.without_toxic(docs, marks)
    assert kept.columns == docs.columns
    assert kept.where("doc_id < 100 OR doc_id IS NULL").count() >= len(odd_rows(rng)) - 3
    found = toxicity.op3(docs, marks).collect()
    assert len(found) == len(rows) and all(r.score is not None and not math.isnan(r.score) for r in found)


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1)]])
def test_without_both_classes_all_scores_are_zero(spark, labels):
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = toxicity.op3(documents(spark, [(1, "a b c"), (2, None)]), marks).collect()
    assert [(r.score, r.predicted) for r in found] == [(0.0, 0)] * 2


def test_empty_table(spark):
    marks = spark.createDataFrame([(1, 0), (2, 1)], "doc_id bigint, toxic int")
    assert toxicity.op3(documents(spark, []), marks).collect() == []


def test_a_task_hands_on_its_counted_terms_before_they_fill_its_memory():
    import pyarrow as pa

    # 60,000 different words in documents of both classes
    texts = [" ".join(f"{chr(97 + d % 26)}{chr(97 + d // 26 % 26)}{chr(97 + w % 26)}{chr(97 + w // 26)}" for w in range(100)) for d in range(600)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "toxic": [d % 2 for d in range(600)]})
    handed_on = list(toxicity._term_counts([batch]))
    assert max(b.num_rows for b in handed_on) <= 2 * (toxicity.COUNTED + 100)
    assert len(handed_on) > 1
    assert sum(sum(b.column(c).to_pylist()) for b in handed_on for c in ("n_toxic", "n_clean")) == 60_000


def test_workers_keep_nothing_of_other_stages_while_they_score(spark):
    import sys

    from shelfmark.llm.common import worker_cached

    kept = worker_cached(("of", "another stage"), object)
    assert kept in sys._shelfmark_kept.values()
    list(toxicity._term_counts([]))
    assert not sys._shelfmark_kept
