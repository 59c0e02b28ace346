import numpy as np
import pytest

from shelfmark.llm import neighbours


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def brute(vectors, ids, query, own, k):
    scores = vectors @ query
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != own]
    return [(int(ids[i]), float(scores[i])) for i in order[:k]]


@pytest.mark.parametrize("uneven", [False, True])
def test_recall_scores_and_order(spark, uneven):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((6000, 32)).astype(np.float32) + 2 * rng.standard_normal((10, 32)).astype(np.float32)[rng.integers(0, 10, 6000)]
    if not uneven:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = neighbours.op6(table(spark, [(i, v.tolist()) for i, v in enumerate(x)])).collect()
    exact, hits = x.astype(np.float64), 0
    ids = np.arange(len(x))
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(by_query) == set(range(0, 6000, 20))
    for q, rows in by_query.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21))
        assert all(r[2] == pytest.approx(float(exact[r[1]] @ exact[q]), abs=1e-12) for r in rows)
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        hits += len({r[1] for r in rows} & {i for i, _ in brute(exact, ids, exact[q], q, 20)})
    assert hits / (20 * len(by_query)) >= 0.9


@pytest.mark.parametrize(("dims", "uneven"), [(32, False), (64, True), (256, False)])
def test_recall_by_dimensions(dims, uneven):
    """Of vectors without any structure, the hardest case, one block."""
    rng = np.random.default_rng(dims)
    x = rng.standard_normal((3000, dims))
    if uneven:
        x *= rng.lognormal(0, 0.5, (3000, 1))
    ids = np.arange(len(x))
    index, hits = neighbours.CollisionIndex(x, 21), 0
    for q in range(0, 3000, 75):
        found, scores = index.nearest(x[q], 20, ids, q)
        hits += len(set(found.tolist()) & {i for i, _ in brute(x, ids, x[q], q, 20)})
    assert hits / (20 * 40) >= 0.9


def test_partitions_and_blocks_of_queries_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(9)
    lines = table(spark, [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((2000, 16)))])
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 500)
    monkeypatch.setattr(neighbours, "FEWEST_QUERIES", 5)
    before, results = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for partitions in ("3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            results.append(sorted(tuple(r) for r in neighbours.op6(lines.withColumn("block", lines.vec_id)).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] and len(results[0]) == 2000


def test_copies_give_the_smallest_ids(spark):
    rows = [(i, [1.0, 0.5]) for i in range(200)] + [(500, [0.5, 0.5]), (1000, [1.0, 0.5])]
    found = neighbours.op6(table(spark, rows)).collect()
    answers = {}
    for r in found:
        answers.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q, got in answers.items():
        assert [v for _, v in sorted(got)] == [i for i in range(22) if i != q][:20]


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [1.0, None]), (7, []), (None, [1.0, 1.0]), (20, [2.0, 0.0]), (40, [1.0, 1.0, 1.0]), (60, [1.0, 1.0, 2.0])]
    found = [tuple(r) for r in neighbours.op6(table(spark, rows)).orderBy("query_id", "rank").collect()]
    assert found == [
        (0, 1, 20, 2.0), (0, 2, 1, 0.5), (20, 1, 0, 2.0), (20, 2, 1, 1.0), (40, 1, 60, 4.0), (60, 1, 40, 4.0),
    ]


def test_empty_table(spark):
    assert neighbours.op6(table(spark, [])).collect() == []
