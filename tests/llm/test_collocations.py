"""Collocations against plain counting, and the guarantee of the summaries."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from shelfmark.llm import collocations
from shelfmark.llm.oracles import COLLOCATIONS
from shelfmark.llm.queries import op11_collocations
from tests.llm.odd import odd_rows
from tests.oracle import connect, differences

SCHEMA = "doc_id bigint, text string, lang string, phrase string, f int, n bigint, hash string"


def table(spark, rows):
    return spark.createDataFrame([(d, t, g, "x", 1, 2, "y") for d, t, g in rows], SCHEMA)


def plain(rows, threshold, top):
    """The result as stated, one step after the other."""
    counts, words = Counter(), Counter()
    for _, text, lang in rows:
        lang, text = lang or "und", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            counts.update((lang, tuple(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= threshold}
    out = {}
    for (lang, w), a in found.items():
        longer = [f for (g, v), f in found.items() if g == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if any(100 * f >= 80 * a for f in longer):
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = counts[lang, w[:k]], counts[lang, w[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, words[lang], -score)
        for lang, phrases in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(phrases)[:top], 1)
    )


def made(rng, n, langs=("en", "de", None)):
    words = [f"w{k}" for k in range(30)] + ["É", "\x00", "a\xa0b", "😀"]
    fixed = ["New York City", "as well as", "w1 w2 W3 w4", "w1 w2 w3"]
    rows = []
    for doc_id in range(n):
        parts = []
        for _ in range(rng.randrange(40)):
            parts.append(rng.choice(fixed) if rng.random() < 0.2 else rng.choice(words[: rng.randrange(1, len(words) + 1)]))
            parts.append(rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\r\n", "\v"]))
        rows.append((doc_id, "".join(parts), rng.choice(langs)))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_agrees_with_plain_counting(spark, monkeypatch, small):
    rng = random.Random(11)
    rows = made(rng, 150) + [(d, t, "fr") for d, t in odd_rows(rng)]
    if small:  # many partitions, stretches, handed-on tables and ranking rounds
        for name, value in (("PARTITION_BYTES", 1500), ("STRETCH", 200), ("SUMMARY", 300), ("KNOWN", 50), ("WINDOW_ROWS", 40)):
            monkeypatch.setattr(collocations, name, value)
    for top in (2000, 7):
        found = collocations.collocations(table(spark, rows).repartition(6), threshold=12, top=top).collect()
        assert sorted(tuple(r) for r in found) == plain(rows, 12, top)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_agrees_with_its_sql(spark, sf_dir):
    with connect(sf_dir) as connection:
        assert differences(spark, connection, sf_dir, op11_collocations, COLLOCATIONS) is None
        assert connection.execute(f"SELECT count(*) FROM ({COLLOCATIONS})").fetchall()[0][0] > 0


def test_summaries_keep_every_frequent_item():
    rng = np.random.default_rng(5)
    for threshold in (5, 30):
        stream = np.concatenate([rng.zipf(1.3, 20_000) % 5_000, np.repeat(np.arange(6_000, 6_050), threshold), np.full(9_000, 7)]).astype(np.uint64)
        rng.shuffle(stream)
        exact = Counter(stream.tolist())
        frequent = {h for h, n in exact.items() if n >= threshold}
        capacity = len(stream) // threshold + 1
        merged = collocations.Summary(capacity)
        for part in np.array_split(stream, 37):
            other = collocations.Summary(capacity)
            other.merge(*collocations.counted(part))
            merged.merge(other.hashes, other.counts)
            assert len(merged.hashes) <= capacity
        assert merged.taken * (capacity + 1) <= len(stream) and merged.taken < threshold
        assert frequent <= set(merged.survivors(threshold).tolist())
        for h, n in zip(merged.hashes.tolist(), merged.counts.tolist(), strict=True):
            assert exact[h] - merged.taken <= n <= exact[h]


def test_products_that_pass_64_bits(spark):
    big = 4_000_000_000_000_000_000
    counts = [("en", "a", big), ("en", "b", big - 1), ("en", "a b", big - 7), ("en", "c", big), ("en", "b c", 30), ("en", "a b c", 30)]
    found = collocations.scored(spark.createDataFrame(counts, "lang string, phrase string, f bigint"))
    rows = {r.phrase: (r.l, r.r, r.score) for r in found.collect()}
    assert rows["a b"] == (big, big - 1, 2_000_000 * (big - 7) // (2 * big - 1))
    assert rows["a b c"] == (big, 30, 2_000_000 * 30 // (big + 30))  # ties of cuts go to the first


def test_long_texts_are_cut_between_pieces():
    text = "a b c. " * 40 + "d " * 500 + ".e"
    old = collocations.STRETCH
    collocations.STRETCH = 50
    try:
        parts = list(collocations.stretches(iter([("en", text), ("en", None), ("de", "x y")])))
    finally:
        collocations.STRETCH = old
    pieces = [p for _, data in parts for p in collocations.words_of(data + b".")]
    assert pieces.count(b"d") == 500 and max(len(run.split()) for _, data in parts for run in data.split(b".")) == 500


def test_empty_table(spark):
    assert collocations.op11(table(spark, [])).collect() == []
    assert collocations.op11(table(spark, [(1, None, None), (2, "", "en"), (3, " . ", "en")])).collect() == []
