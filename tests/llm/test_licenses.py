import random

from shelfmark.llm import licenses
from tests.llm.odd import documents, odd_rows, sentence
from tests.oracle import _sorted


def brute(text):
    """Words, places and labels of the base phrases by looking at every word."""
    words, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if ord(c) >= 0x80 or "0" <= c <= "9" or "a" <= c <= "z":
            word += c
        elif word:
            words.append(word)
            word = ""
    starts, labels = [], set()
    for label, phrase in licenses.BASE:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def rows_with_phrases(rng):
    phrases = [p for _, p in (*licenses.BASE, *licenses.MORE)] + ["Under THE mit-license", "CC BY-NC", "cc by nc cc by nc", "under the mit"]
    rows = []
    for n in range(200):
        parts = [sentence(rng, rng.randrange(0, 12)) for _ in range(3)]
        parts[rng.randrange(3):1] = rng.sample(phrases, rng.randrange(0, 3))
        rows.append((n + 100, rng.choice([" ", "\n", "... "]).join(parts)))
    return rows


def test_base_places_equal_a_plain_search(spark):
    rng = random.Random(1)
    rows = rows_with_phrases(rng) + odd_rows(rng) + [(70, "é́under the mit license ü"), (71, "ſunder the mit license")]
    found = licenses.op8(documents(spark, rows)).collect()
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found]
    assert _sorted(got, "abcdef") == _sorted([(i, *brute(t)) for i, t in rows], "abcdef")
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in found)
    assert all(r.score == 1 for r in found if r.n_base)


def test_changed_wordings_are_found_by_neighbouring_diagonals(spark):
    words = licenses.MORE[0][1].split()
    left_out = " ".join(words[:8] + words[9:])
    put_in = " ".join(words[:8] + ["also"] + words[8:])
    half = " ".join(words[: len(words) // 2])
    found = licenses.op8(documents(spark, [(1, f"x {left_out} y"), (2, f"z {put_in}"), (3, half)])).collect()
    assert {r.doc_id: r.labels for r in found} == {1: "mit", 2: "mit", 3: ""}
    assert all(r.n_base == 0 and r.base_labels == "" for r in found)
    assert all(0.7 <= r.score < 1 for r in found if r.doc_id < 3)


def test_no_python_on_the_way(spark):
    plan = licenses.op8(documents(spark, [(1, "a b c")]).repartition(2))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert licenses.op8(documents(spark, [])).collect() == []
