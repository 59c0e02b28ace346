import random

import numpy as np

from shelfmark.llm import quality
from tests.llm.odd import documents, odd_rows, sentence


def test_em_recovers_the_labellers_accuracies():
    rng = np.random.default_rng(1)
    rates = np.zeros((2, quality.LABELLERS, 3))
    for k in range(quality.LABELLERS):
        right, silent = rng.uniform(0.65, 0.95), rng.uniform(0, 0.3)
        rates[1, k] = silent, (1 - silent) * (1 - right), (1 - silent) * right
        rates[0, k] = silent, (1 - silent) * right, (1 - silent) * (1 - right)
    truth = rng.random(40_000) < 0.8
    number = np.zeros(len(truth), int)
    for k in range(quality.LABELLERS):
        u, r = rng.random(len(truth)), rates[truth.astype(int), k]
        number = 3 * number + (u > r[:, 0]).astype(int) + (u > r[:, 0] + r[:, 1])
    posterior, found, share = quality.estimate(np.bincount(number, minlength=quality.PATTERNS).astype(float))
    assert abs(share - 0.8) < 0.02 and np.abs(found - rates).max() < 0.05
    assert ((posterior[number] >= 0.5) == truth).mean() > 0.95


def junk(rng):
    words = sentence(rng, rng.randrange(20, 90)).split()
    kind = rng.randrange(3)
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in words)
    if kind == 1:
        return " ".join(w + rng.choice(["***", "###", "$$$"]) for w in words)
    return " ".join(w for w in words for _ in range(8))


def prose(rng):
    lines = [" ".join(f"{rng.choice(['the', 'of', 'and', 'to'])} {w}" for w in sentence(rng, rng.randrange(6, 20)).split()).capitalize() + "." for _ in range(rng.randrange(2, 9))]
    return "\n".join(lines)


def test_scores_tell_prose_from_junk(spark):
    rng = random.Random(2)
    rows = [(n, junk(rng) if n % 6 == 0 else prose(rng)) for n in range(600)]
    found = quality.op1(documents(spark, rows)).collect()
    assert all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in found)
    assert sum(r.keep != (r.doc_id % 6 == 0) for r in found) >= 590


def test_odd_rows_and_clashing_columns(spark):
    rng = random.Random(3)
    rows = [(*r, 1.0) for r in odd_rows(rng) + [(100 + n, prose(rng)) for n in range(50)]]
    found = quality.op1(documents(spark, rows, ", score double")).collect()
    assert len(found) == len(rows) and all(r.score is not None for r in found)
    assert {r.score for r in found if r.doc_id in (1, 2, 3)} == {next(r.score for r in found if r.doc_id == 1)}


def test_empty_table(spark):
    assert quality.op1(documents(spark, [])).collect() == []
