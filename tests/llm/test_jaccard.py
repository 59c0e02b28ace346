import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.llm import common, jaccard
from tests.llm.odd import documents, odd_rows, sentence


def sets_of(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    n = min(n, len(words))
    return frozenset((n, *words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, percent=90):
    """(n_shingles, component) of each row by comparing all pairs."""
    sets = [sets_of(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None and sets[i]:
            names[find(i)] = min(doc_id, names.get(find(i), doc_id))
    return [(rows[i][0], len(s), names.get(find(i)) if s else rows[i][0]) for i, s in enumerate(sets)]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at : at + rng.randrange(2)] = [sentence(rng, 1)]
    return words


def near_rows(rng, groups, copies, length):
    rows, doc_id = [], 0
    for _ in range(groups):
        base = sentence(rng, rng.randrange(3, length)).split()
        for _ in range(rng.randrange(1, copies)):
            rows.append((doc_id, " ".join(edited(rng, base, rng.choice([0, 0, 1, 1, 2, 4])))))
            doc_id += 1
    rng.shuffle(rows)
    return rows


def found(spark, rows, **options):
    result = jaccard.jaccard_components(documents(spark, rows), **options)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in result.collect()), key=repr)


@pytest.mark.parametrize(("seed", "cell"), [(1, jaccard.CELL), (2, 400), (3, 60)])
def test_components_equal_those_of_all_pairs(spark, seed, cell):
    rng = random.Random(seed)
    rows = near_rows(rng, 30, 14, 120) + odd_rows(rng)
    assert found(spark, rows, cell=cell) == sorted(brute(rows), key=repr)


def test_a_star_of_many_near_copies_in_small_cells(spark):
    rng = random.Random(5)
    base = sentence(rng, 100).split()
    rows = [(i, " ".join(edited(rng, base, rng.choice([1, 1, 2])))) for i in range(150)]
    assert found(spark, rows, cell=2_000) == sorted(brute(rows), key=repr)


def test_sets_meet_only_chunks_where_they_share_a_run_with_another_component(spark):
    # cluster 1 in three chunks, main component 10; runs 7 and 8 join sets of components, 9 lies within one
    rest = [(1, 1, 0, 10, False), (1, 2, 1, 10, False), (1, 3, 1, 30, True), (1, 4, 2, 40, True), (1, 5, 2, 10, False)]
    rest = spark.createDataFrame(rest, "root bigint, set_id bigint, chunk bigint, label bigint, left boolean")
    kept = [(1, 7), (3, 7), (3, 8), (4, 8), (1, 9), (2, 9), (5, 9)]
    kept = spark.createDataFrame(kept, "set_id bigint, key bigint")
    visits = {(v.set_id, v.root, v.chunk) for v in jaccard._visits(kept, rest).collect()}
    assert visits == {(3, 1, 0), (3, 1, 2)}  # the main component's set 1 is visited; of 3 and 4 the lower chunk's visits


def test_keys_taken_in_slices_give_the_same_components(spark, monkeypatch):
    rng = random.Random(8)
    rows = near_rows(rng, 30, 14, 120) + odd_rows(rng)
    monkeypatch.setattr(jaccard, "KEY_SLICE", sum(len(text or "") for _, text in rows) // 5)
    docs = documents(spark, rows)
    slices = jaccard.key_slices(docs)
    assert len(slices) == 6
    sets = jaccard.shingle_sets(docs, 3, 90, slices).collect()
    held = [{k for r in sets for k in r[name]} for name in slices]
    assert all(held) and sum(map(len, held)) == len(set.union(*held))
    assert set.union(*held) == {k for _, t in rows for k in jaccard.run_keys(jaccard.shingles(t, 3, jaccard.word_hashes()), 90)[0].tolist()}
    assert found(spark, rows) == sorted(brute(rows), key=repr)


def test_a_stored_table_leaves_no_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(n).getName() for n in range(files.size())} - before

    before = set()
    before = {name for name in shuffled() if name.startswith("shuffle_")}
    setting = spark.conf.get(common._SHUFFLE_CLEANUP)
    stored = common.staged(spark.range(100_000).groupBy(F.xxhash64("id").alias("h")).count(), "counted")
    for _ in range(50):  # deleted in the background
        left = [name for name in shuffled() if name.startswith("shuffle_")]
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert stored.count() == 100_000
    assert spark.conf.get(common._SHUFFLE_CLEANUP) == setting


def test_empty_table(spark):
    assert found(spark, []) == []


def test_keep_first_keeps_one_of_each_group_and_all_columns(spark):
    rng = random.Random(6)
    near = [(n + 100, text) for n, text in near_rows(rng, 10, 6, 60)]
    rows = [(*row, "t", 1) for row in near + odd_rows(rng)]
    docs = documents(spark, rows, ", text_hash string, first int")
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect() if r.doc_id is not None and sets_of(r.text)))
    expected = {c for d, n, c in brute([r[:2] for r in rows]) if n and c is not None}
    assert set(ids) >= expected
    assert len([r for r in kept.collect() if r.doc_id == 6]) == 0  # equals document 5


def keys_kept(s, percent, order):
    """Keys of a set without its last ones in an order of all keys, as many as it may leave out."""
    keys, spare = jaccard.run_keys(s, percent)
    kept = set()
    for bit in (0, 1):
        own = sorted((k for k in keys.tolist() if k & 1 == bit), key=order)
        kept |= set(own[: max(len(own) - spare[bit], 0)])
    return kept


@pytest.mark.parametrize("size", [130, 200, 260, 400, 500])
def test_sets_leave_out_what_their_own_size_allows(size):
    # a partner of at most 125 % differs in a ninth of both, whatever the largest set of the size class
    s = np.unique(jaccard.mixed(np.arange(size, dtype=np.uint64)))
    keys, spare = jaccard.run_keys(s, 80)
    own = size.bit_length() & 1
    top = (1 << size.bit_length()) - 1
    differ = (size + min(size * 100 // 80, top)) // 9
    assert spare[own] == sum(k & 1 == own for k in keys.tolist()) - differ - 1


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.integers(0, 60), min_size=1, max_size=60, unique=True), st.integers(0, 12), st.integers(0, 10**6), st.sampled_from([80, 90])
)
def test_similar_sets_keep_a_common_run(values, changes, seed, percent):
    rng = random.Random(seed)
    other = set(values)
    for _ in range(changes):
        other ^= {rng.randrange(80)}
    both = len(set(values) & other)
    if not other or set(values) == other or 100 * both < percent * (len(values) + len(other) - both):
        return
    a, b = (np.unique(jaccard.mixed(np.array(sorted(x), np.uint64))) for x in (values, other))
    for salt in range(8):
        def order(key, salt=salt):
            return hash((key, salt, seed))

        assert keys_kept(a, percent, order) & keys_kept(b, percent, order)
