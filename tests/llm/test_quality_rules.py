"""Line labelling against enumeration, statistics against plain loops, verdicts on held-out documents."""

import itertools
import random
import re

import numpy as np
import pytest

from shelfmark.llm import quality_rules as rules
from tests.llm.odd import documents, odd_rows, sentence

SYMBOLS = set("#*$%&|<>")


def plain_statistics(text):
    """The statistics as stated, word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines, copies = [], 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in lines
            lines.append(line)
    return len(words), sum(map(len, words)), sum(c in SYMBOLS for c in text), copies, len(covered)


def test_statistics():
    rng = random.Random(2)
    texts = [None, "", " \n\t", "x", "a\x85b c\x1cd\x0be", "ä|b #1\n\nä|b #1\nä|b #1 \n"]
    texts += [" ".join(rng.choice("ab") for _ in range(n)) for n in range(14)]
    texts += ["\n".join(" ".join(rng.choice("abcdef") for _ in range(rng.randrange(5))) for _ in range(9)) for _ in range(60)]
    for text in texts:
        assert rules.read_lines(text)[0] == plain_statistics(text)


def test_repeats_of_many_words():
    """More different words than five of them fit into 64 bits."""
    words = [str(n).encode() for n in range(9000)]
    assert rules.repeated_words(words + words[50:56]) == 12
    assert rules.repeated_words(words) == 0


def some_field(rng):
    return rules.LineField(rng.normal(size=rules.WEIGHTS), rng.normal(size=2), rng.normal(size=(2, 2)))


def weight(field, scores, labels):
    value = field.start[labels[0]] + sum(s for s, label in zip(scores, labels, strict=True) if label)
    return value + sum(field.step[a, b] for a, b in itertools.pairwise(labels))


def test_viterbi_is_the_best_sequence():
    rng = np.random.default_rng(3)
    for n in range(1, 9):
        field, scores = some_field(rng), rng.normal(size=n).tolist()
        best = max(itertools.product((0, 1), repeat=n), key=lambda labels: weight(field, scores, labels))
        assert tuple(field.decode(scores)) == best
    assert rules.LineField.blank().decode([0.0] * 5) == [0] * 5
    assert rules.LineField.blank().decode([]) == []


def test_forward_backward_is_the_sum_over_sequences():
    rng = np.random.default_rng(4)
    field = some_field(rng)
    chunks = [rng.integers(0, 3, (n, len(rules.BINS))) + rules.OFFSETS[:-1] for n in (2, 5, 1, 3, 5)]
    places, of, counts = rules.by_place(chunks)
    boiler, pairs, total = field.expect(field.scores(places), counts)
    want_pairs = np.zeros((2, 2))
    for k, chunk in enumerate(chunks):
        scores = field.scores(chunk)
        every = list(itertools.product((0, 1), repeat=len(chunk)))
        mass = np.exp([weight(field, scores, labels) for labels in every])
        share = mass / mass.sum()
        assert np.allclose(boiler[of == k], share @ np.array(every))
        for p, labels in zip(share, every, strict=True):
            for a, b in itertools.pairwise(labels):
                want_pairs[a, b] += p
    assert np.allclose(pairs, want_pairs)
    assert np.allclose(np.sort(total)[-1], max(
        np.log(sum(np.exp(weight(field, field.scores(c), labels)) for labels in itertools.product((0, 1), repeat=len(c)))) for c in chunks
    ))


def test_slope_is_that_of_the_likelihood():
    rng = np.random.default_rng(6)
    field = some_field(rng)
    chunks = [rng.integers(0, 3, (n, len(rules.BINS))) + rules.OFFSETS[:-1] for n in (4, 2, 3)]
    places, of, counts = rules.by_place(chunks)
    labels = rng.integers(0, 2, len(of))

    def likelihood(f):
        value = 0.0
        for k, chunk in enumerate(chunks):
            scores = f.scores(chunk)
            every = itertools.product((0, 1), repeat=len(chunk))
            value += weight(f, scores, labels[of == k]) - np.log(sum(np.exp(weight(f, scores, e)) for e in every))
        return value

    _, by_start, by_step = field.slope(field.scores(places), counts, labels)
    for index in ((0,), (1,)):
        moved = rules.LineField(field.weights, field.start.copy(), field.step)
        moved.start[index] += 1e-6
        assert (likelihood(moved) - likelihood(field)) / 1e-6 == pytest.approx(by_start[index], abs=1e-4)
    for index in itertools.product((0, 1), repeat=2):
        moved = rules.LineField(field.weights, field.start, field.step.copy())
        moved.step[index] += 1e-6
        assert (likelihood(moved) - likelihood(field)) / 1e-6 == pytest.approx(by_step[index], abs=1e-4)


def made(rng, n):
    """Documents and their quality: sentences, or menus and lines of marks with some sentences between."""
    rows, labels = [], []
    for doc_id in range(n):
        good = rng.random() < 0.7
        lines = [sentence(rng, rng.randrange(8, 25)).capitalize() + "." for _ in range(rng.randrange(4, 9))]
        if not good:
            junk = [" | ".join(sentence(rng, 1).capitalize() for _ in range(9)) + " |" for _ in range(8)]
            junk += [" ".join(sentence(rng, 1) + "###" for _ in range(12)) for _ in range(6)]
            lines = lines[:2] + rng.sample(junk, 10) + lines[2:3]
        rows.append((doc_id, "\n".join(lines)))
        labels.append((doc_id, int(good)))
    return rows, labels


def test_held_out_documents(spark):
    rows, labels = made(random.Random(8), 300)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(labels[:150], "doc_id bigint, quality int")
    kept = {r.doc_id: r.kept for r in rules.op12(docs, known).collect()}
    truth = dict(labels)
    assert np.mean([kept[d] == bool(truth[d]) for d in range(150, 300)]) > 0.97


def test_odd_rows(spark):
    rows, labels = made(random.Random(9), 60)
    odd = odd_rows(random.Random(1))
    extra = ", labels string, quality double, n_words int, lines string"
    docs = documents(spark, [(*r, "x", 0.5, 3, "y") for r in odd + rows], extra)
    known = spark.createDataFrame([*labels, (None, 1), (1, None), (2, 7), (3, 1), (3, 0)], "doc_id bigint, quality int")
    found = rules.op12(docs, known).collect()
    assert len(found) == len(odd) + len(rows)
    by_row = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found)
    assert by_row == sorted((d is None, d or 0, *plain_fast(t)) for d, t in odd + rows)
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    for text in (docs, docs.limit(0)):
        untaught = rules.op12(text, known.limit(0))
        assert untaught.where("kept = base_failed").isEmpty()
    assert rules.op12(docs.limit(0), known).collect() == []


def plain_fast(text):
    """Like ``plain_statistics``, for long texts too."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, covered = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(i + k for i in places for k in range(5))
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), sum(c in SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered)
