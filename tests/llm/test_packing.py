import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from shelfmark.llm import packing
from tests.llm.odd import documents, odd_rows, sentence


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


@pytest.fixture(scope="module")
def encoder():
    with open(packing.default_tokenizer(), encoding="utf-8") as file:
        return packing.Encoder(file.read())


@given(st.integers(1, 20_000), st.sampled_from([16, 100, 2048]))
def test_cuts_cover_a_document_and_fit_their_places(n, capacity):
    pieces = packing.cuts(n, capacity)
    at = 0
    for start, length, k in pieces:
        assert start == at and 0 < length * k <= capacity
        at += length
    assert at == n
    assert len(pieces) <= n // capacity + 6


@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_never_overlaps(lengths):
    bins, offsets = packing.best_fit(lengths, 64)
    used = defaultdict(list)
    for b, o, n in zip(bins, offsets, lengths, strict=True):
        used[b].append((o, n))
    for places in used.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 64


@given(st.text(max_size=80))
def test_encoding_by_words_equals_that_of_the_text(tokenizer, encoder, text):
    whole = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert encoder.encode(text) == whole
    assert encoder.encode(text) == whole


@given(st.text(alphabet="aBcÉé\u0301ΑΣςİıKÅ.,!?;:'’-*#$%<|>endoftx 12\n\t²ⅷß", max_size=60))
def test_encoding_of_marks_and_letters(tokenizer, encoder, text):
    assert encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_special_tokens_and_odd_spaces_in_a_text(tokenizer, encoder):
    for text in ("a<|endoftext|>b <|startoftext|> c", "a\x1cb\x85c d e", "x" * 300 + " " + "É́" * 50, "﻿ a ​ b"):
        assert encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def check(rows, found, tokenizer, capacity):
    """Every id of every row in exactly one piece, sequences gapless and within capacity."""
    ids = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END], "<u4") for _, t in rows]
    wanted = defaultdict(int)
    for (doc_id, _), a in zip(rows, ids, strict=True):
        for start, length, _ in packing.cuts(len(a), capacity):
            wanted[doc_id, start, length, len(a), zlib.crc32(a[start : start + length].tobytes())] += 1
    got = defaultdict(int)
    used = defaultdict(list)
    for r in found:
        got[r.doc_id, r.start, r.length, r.doc_tokens, r.ids_crc32] += 1
        used[r.sequence_id].append((r.offset, r.length))
    assert got == wanted
    fills = []
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
        fills.append(at)
    return fills


@pytest.mark.parametrize("capacity", [64, 2048])
def test_every_id_has_one_place(spark, tokenizer, capacity):
    rng = random.Random(1)
    rows = odd_rows(rng) + [(100 + n, sentence(rng, rng.randrange(1, 400))) for n in range(200)]
    found = packing.pack(documents(spark, rows), capacity=capacity).collect()
    fills = check(rows, found, tokenizer, capacity)
    assert sum(fills) >= 0.97 * capacity * (len(fills) - 1)
    for r in found:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_buckets_change_nothing_that_counts(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 20)
    rng = random.Random(2)
    rows = [(n, sentence(rng, rng.randrange(1, 60))) for n in range(300)]
    check(rows, packing.op5(documents(spark, rows)).collect(), tokenizer, 2048)


def test_empty_table(spark):
    assert packing.op5(documents(spark, [])).collect() == []
