"""Whitening against integers of Python and a plain covariance."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from shelfmark.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, n bigint, x string, d int, whitened double"


def rows_of(vectors, first=0):
    return [(first + i, v, 1, 7, "extra", 3, 0.5) for i, v in enumerate(vectors)]


def expected(vectors, components=8):
    """Brute force with fractions: (deviations, covariance)."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(row[i] for row in x) for i in range(d)]
    y = [[n * row[i] - s[i] for i in range(d)] for row in x]
    cov = [[float(Fraction(sum(row[i] * row[j] for row in y), n**3)) for j in range(d)] for i in range(d)]
    return [sum(c * c for c in row) for row in y], np.array(cov), np.array(y, float) / n


@pytest.mark.parametrize("dims, n", [(3, 40), (12, 300)])
def test_agrees_with_brute_force(spark, dims, n):
    rng = np.random.default_rng(dims)
    vectors = (rng.standard_normal((n, dims)) @ rng.standard_normal((dims, dims))).astype(np.float32).tolist()
    df = spark.createDataFrame(rows_of(vectors), SCHEMA).repartition(5)
    found = whitening.op13(df).collect()
    deviations, cov, centred = expected(vectors)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(8, dims)
    assert len(found) == n * k and {r.n for r in found} == {n}
    white = np.zeros((n, k))
    for r in found:
        assert r.deviation == deviations[r.vec_id]
        assert r.explained == pytest.approx(values[r.component - 1] / cov.trace(), rel=1e-9)
        assert r.identity_error < 1e-9
        white[r.vec_id, r.component - 1] = r.whitened
    want = centred @ axes[:, :k] / np.sqrt(values[:k])
    for c in range(k):
        sign = np.sign(want[:, c] @ white[:, c])
        assert np.allclose(sign * white[:, c], want[:, c], atol=1e-7)


def test_polarisation_is_exact_in_all_widths():
    rng = random.Random(5)
    for bits in (10, 29, 33, 58, 80):
        y = [[rng.randrange(-(1 << bits), 1 << bits) for _ in range(4)] for _ in range(50)]
        total = whitening._Sums((4, 4))
        matrix = np.array(y, object) if bits > 60 else np.array(y, np.int64)
        whitening.add_squares(total, matrix[:30])
        whitening.add_squares(total, matrix[30:])
        for i in range(4):
            for j in range(i, 4):
                found = sum(int(limb[i, j]) << (31 * k) for k, limb in enumerate(total.limbs))
                want = sum(row[i] ** 2 if i == j else (row[i] + row[j]) ** 2 for row in y)
                assert found == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(1)
    fine = rng.standard_normal((30, 3)).astype(np.float32).tolist()
    odd = [None, [nan, 0.0, 1.0], [inf, 1.0, 1.0], [None, 1.0, 2.0], []]
    rows = rows_of(fine) + rows_of(odd, 100) + [(None, [1.0, 2.0, 3.0], None, None, None, None, None)] * 2 + rows_of([[1.0, 5.0], [2.0, 1.0]], 200)
    found = whitening.op13(spark.createDataFrame(rows, SCHEMA)).collect()
    three = [r for r in found if r.n == 32]
    assert len(three) == 32 * 3 and sum(r.vec_id is None for r in three) == 6
    two = [r for r in found if r.n == 2]
    assert {r.vec_id for r in two} == {200, 201} and len(two) == 4
    assert all((r.whitened is None) == (r.component == 2) for r in two)  # two points have one direction
    assert len(found) == len(three) + len(two)


def test_without_variance_and_empty(spark):
    same = spark.createDataFrame(rows_of([[1.0, 2.0]] * 5), SCHEMA)
    found = whitening.op13(same).collect()
    assert len(found) == 10
    assert all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in found)
    assert whitening.op13(same.limit(0)).collect() == []


def test_values_that_pass_64_bits(spark):
    vectors = [[3e38, 1.0], [-3e38, 2.0], [0.0, 3.0]]
    found = whitening.op13(spark.createDataFrame(rows_of(vectors), SCHEMA)).collect()
    assert len(found) == 6 and all(r.deviation is None for r in found if r.vec_id < 2)
    assert all(r.identity_error < 1e-4 for r in found)
