"""Harmonic packing: documents cut and dealt into sequences of a fixed number of tokens.

A document's tokens are cut into full sequences and a rest. A rest of r tokens belongs to class
k = capacity // r, whose bins take exactly k pieces, whatever these are. Where a rest leaves much of
its place empty, the largest length that fills a place of class k + 1 exactly is cut off first, so a
rest becomes four pieces at most. A piece's bin follows from its number within the class alone:
pieces are numbered in buckets side by side, and only the buckets' counts meet. The last pieces of a
class, too few for a bin, are packed together with those of the other classes by best fit; there are
fewer than k of class k, so at most ``capacity`` squared tokens, however many documents there are.

Defined cases: a null or empty text has the end token only; every row is a document of its own, also
repeated ones and those without doc_id, whose pieces have a null one. An id of a document lies in exactly one
piece. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import MEMO, return_memory, staged, worker_cached

CAPACITY = 2048
END = 1  # the id that ends each document
TOLERANCE = 1 / 32  # of a place that may stay empty
BUCKET_ROWS = 100_000  # pieces that are numbered together
LONG_PIECE = 100  # characters; longer ones are not remembered
PORTION = 4_000_000  # characters of texts that are encoded together
PIECES = 3 * MEMO  # whose ids are remembered
WORDS = 200  # that are encoded as one text
MARKS = ".,;:!?"
MARKED = re.compile(r"[^\w\s][.,;:!?]|_[.,;:!?]")  # a mark that may be one token with what precedes it
CLASS_SHIFT = 40  # sequence_id: class * 2**40 + number of the bin
ODD_SPACE = re.compile("[\x1c-\x1f]")  # white space for str.split, but not for tokenizers


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cuts(n: int, capacity: int) -> list[tuple[int, int, int]]:
    """``(start, length, class)`` of the pieces of a document with ``n`` tokens."""
    pieces = [(at, capacity, 1) for at in range(0, n - capacity + 1, capacity)]
    at = len(pieces) * capacity
    while at < n:
        rest = n - at
        k = capacity // rest
        place = capacity // k
        if place - rest > place * TOLERANCE and k * k < capacity:
            rest, k = capacity // (k + 1), k + 1
        pieces.append((at, rest, k))
        at += rest
    return pieces


class Encoder:
    """Little-endian 32-bit ids of texts.

    The tokenizer never joins characters across white space, nor letters or digits with a mark after
    them, and lowers letters one by one. So a text is cut there, in small letters, and each piece is
    encoded once as long as it is remembered. Texts in which this would change something are cut at
    white space only, or not at all.
    """

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(model)
        self.known: dict[str, bytes] = {}
        self.long: list[str] = []  # forgotten at the next call
        suffix = json.loads(model)["model"].get("end_of_word_suffix")
        self.ends = None  # which ids end a word, if the vocabulary tells
        if suffix:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[n for token, n in vocabulary.items() if token.endswith(suffix)]] = True

    @staticmethod
    def cut(text: str) -> list[str] | None:
        if ODD_SPACE.search(text):
            return None
        if not ("<|" in text or "\u0130" in text or "\u03a3" in text or MARKED.search(text)):
            text = text.lower()
            for mark in MARKS:
                text = text.replace(mark, " " + mark)
        return text.split()

    def learn(self, pieces: set[str]) -> None:
        """Remember the ids of some pieces without spaces."""
        known = self.known
        for piece in self.long:
            known.pop(piece, None)
        new = [p for p in pieces if p not in known]
        if len(known) + len(new) > PIECES:
            known.clear()
            new = list(pieces)
        self.long = [p for p in new if len(p) > LONG_PIECE]
        self._encode_words([p for p in new if p.isalpha()])
        self._encode_each([p for p in new if not p.isalpha()])

    def _encode_each(self, pieces: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        self.known.update((p, array("I", e.ids).tobytes()) for p, e in zip(pieces, found, strict=True))

    def _encode_words(self, words: list[str]) -> None:
        """Encode words of letters, many in one text where the ids tell which of them end a word."""
        if self.ends is None:
            return self._encode_each(words)
        for at in range(0, len(words), WORDS):
            some = words[at : at + WORDS]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):
                self._encode_each(some)
                continue
            data, start = ids.tobytes(), 0
            for word, end in zip(some, (4 * ends).tolist(), strict=True):
                self.known[word] = data[start:end]
                start = end

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        split = [self.cut(text) for text in texts]
        self.learn(set().union(*filter(None, split)))
        for text, pieces in zip(texts, split, strict=True):
            if pieces is None:
                yield array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            else:
                yield b"".join(map(self.known.__getitem__, pieces))


def _portions(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a column, some millions of characters at a time."""
    some, size = [], 0
    for text in column:
        some.append(text.as_py() or "")
        size += len(some[-1])
        if size > PORTION:
            yield some
            some, size = [], 0
    yield some


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """``(doc_id, start, length, class, ids_crc32, doc_tokens[, ids])`` of every piece of every row."""
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    path = tokenizer or "default"
    names = ["doc_id", "start", "length", "class", "ids_crc32", "doc_tokens"]
    end = END.to_bytes(4, "little")

    def read(batches):
        return_memory()
        encoder = worker_cached(("tokenizer", path), lambda: Encoder(model.value))
        gc.disable()  # what is remembered holds no cycles, but would be walked again and again
        encoder.known.clear()  # the worker serves other stages too, so only the tokenizer stays
        for batch in batches:
            rows, ids = [], []
            texts = (data for some in _portions(batch.column("text")) for data in encoder.encode_all(some))
            for doc_id, encoded in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                data = memoryview(encoded + end)
                n = len(data) // 4
                for start, length, k in cuts(n, capacity):
                    part = data[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, length, k, zlib.crc32(part), n))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 3 + [pa.int32()] + [pa.int64()] * 2, strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), names + ["ids"] * with_ids)
        encoder.known.clear()
        gc.enable()
        return_memory()

    schema = "doc_id bigint, start bigint, length bigint, class int, ids_crc32 bigint, doc_tokens bigint"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(read, schema + ", ids array<int>" * with_ids)


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each of some lengths, the longest placed first, each where least room is left."""
    bins, offsets, room, n_bins = [0] * len(lengths), [0] * len(lengths), [], 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect_left(room, (lengths[i], -1))
        if at < len(room):
            left, number = room.pop(at)
        else:
            left, number, n_bins = capacity, n_bins, n_bins + 1
        bins[i], offsets[i] = number, capacity - left
        if left > lengths[i]:
            insort(room, (left - lengths[i], number))
    return bins, offsets


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Every piece with its ``sequence_id`` and its ``offset`` there.

    Offsets are gapless; a sequence has at most ``capacity`` tokens.
    """
    cut = staged(pieces(docs, tokenizer, capacity, with_ids), "pieces")
    buckets = max(1, -(-cut.count() // BUCKET_ROWS))
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    numbered = cut.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    numbered = numbered.withColumn("rank", F.row_number().over(Window.partitionBy("class", "bucket").orderBy(*order)) - 1)
    numbered = staged(numbered, "numbered-pieces")
    counts = numbered.groupBy("class", "bucket").agg(F.count("*").alias("n"))
    by_class = Window.partitionBy("class")
    counts = counts.select(
        "class", "bucket",
        F.coalesce(F.sum("n").over(by_class.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(by_class).alias("total"),
    )
    placed = numbered.join(counts, ["class", "bucket"]).withColumn("rank", F.col("rank") + F.col("before"))
    placed = placed.withColumn("bin", F.floor(F.col("rank") / F.col("class")))
    complete = (F.col("bin") + 1) * F.col("class") <= F.col("total")
    columns = [*cut.columns, "sequence_id", "offset"]
    columns.remove("class")
    earlier = Window.partitionBy("sequence_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = (
        placed.where(complete)
        .withColumn("sequence_id", (F.shiftleft(F.col("class").cast("bigint"), CLASS_SHIFT) + F.col("bin")).cast("bigint"))
        .withColumn("offset", F.when(F.col("class") == 1, F.lit(0)).otherwise(F.coalesce(F.sum("length").over(earlier), F.lit(0))))
    )

    def fill(rest: pd.DataFrame) -> pd.DataFrame:
        rest = rest.sort_values(["length", "class", "rank"], ascending=[False, True, True], ignore_index=True)
        rest["sequence_id"], rest["offset"] = best_fit(rest["length"].tolist(), capacity)
        return rest[names]

    # fewer than k pieces of class k: bounded by the capacity, not by the documents
    last = placed.where(~complete).drop("bucket", "before", "total", "bin")
    names = [*cut.columns, "sequence_id", "offset"]
    schema = ", ".join(f"`{n}` {t}" for n, t in cut.dtypes) + ", sequence_id bigint, offset bigint"
    last = last.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fill, schema)
    return whole.select(*columns).unionByName(last.select(*columns))


def op5(docs: DataFrame) -> DataFrame:
    """Every piece of every document and its place, ids as a checksum."""
    return pack(docs.select("doc_id", "text"), with_ids=False)
