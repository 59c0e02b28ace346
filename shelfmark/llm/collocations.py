"""Phrase collocation mining with mergeable Misra-Gries summaries, and an exact second count.

Word n-grams are counted for each language apart. First, which of them can be frequent: n-grams are dealt by
their hash to partitions, as many as the texts' size asks for. Tasks reduce what they read to counted hashes for
each partition; a partition merges what it gets into a Misra-Gries summary, whose capacity exceeds the number of
its n-grams divided by the threshold. What such a summary takes off a counter in total is then below the threshold,
so every frequent n-gram survives, whatever the order of merging. Words and pairs go first; of longer n-grams
only those are summarised whose pairs survived, since no n-gram is more frequent than a part of it. Second,
the survivors are counted exactly; a task tells them apart by 64-bit hashes, and tasks' counts are added by the
words themselves, in places by their hash. Survivors reach the tasks as a bit sieve of fixed size, which lets all
survivors through and more others the more it holds; a sieve that is full costs time, not results.

Scores take the cut of a phrase that binds it least; phrases that mostly occur within a longer one are dropped.

Defined cases: a null text has no words, a null language is ``und``; repeated rows count each, as do rows without
doc_id. Very long texts are worked on in stretches that end at a piece's end. Ties of score and count go to the
smaller phrase in byte order. A language without candidates has no rows, an empty table none at all; further
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import Memo, join_counted, staged
from shelfmark.llm.jaccard import MIX, mixed, word_hashes

LONGEST = 4
THRESHOLD = 30
COVER_PERCENT = 80
TOP = 2_000
SCALE = 2_000_000
SLACK = 4  # how many times the least capacity a summary has: the more, the fewer infrequent n-grams survive
PARTITION_BYTES = 1 << 24  # of text, for each hash partition
STRETCH = 1 << 22  # bytes of text that are read in one go, about
SUMMARY = 1 << 22  # n-grams that a task counts before it hands them on
COUNT_PLACES = 4  # places of the second count for each hash partition
KNOWN = 1 << 19  # different n-grams that a task holds in the second count before it hands them on
SIEVE_BITS = 25  # 4 MB, whatever it holds
WINDOW_ROWS = 50_000  # candidates of a language that are ranked in one task

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_TABLE = bytes.maketrans(_UPPER + _SEPARATORS, _LOWER + b"." * len(_SEPARATORS))
_END = re.compile(b"[" + re.escape(_SEPARATORS) + b"]")


def stretches(rows: Iterator[tuple[str, str | None]]) -> Iterator[tuple[str, bytes]]:
    """Texts of one language together, in stretches of about ``STRETCH`` bytes that end where pieces end."""
    waiting: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for lang, text in rows:
        data = (text or "").encode("utf-8", "surrogatepass")
        at = 0
        while len(data) - at > STRETCH:
            end = _END.search(data, at + STRETCH)
            if end is None:
                break
            yield lang, data[at : end.end()]
            at = end.end()
        waiting.setdefault(lang, []).append(data[at:])
        sizes[lang] = sizes.get(lang, 0) + len(data) - at
        if sum(sizes.values()) > STRETCH:
            largest = max(sizes, key=sizes.get)
            yield largest, b"\n".join(waiting.pop(largest))
            del sizes[largest]
    for lang, texts in waiting.items():
        yield lang, b"\n".join(texts)


def words_of(data: bytes) -> list[bytes]:
    """Words in small letters; a full stop where a piece ends."""
    return data.translate(_TABLE).replace(b".", b" . ").split()


class Grams:
    """The n-grams of a stretch: for n from 1 on, their hashes by place, and which places hold one."""

    def __init__(self, lang: str, words: list[bytes], known: Memo):
        ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        whole = ids != np.uint64(known[b"."])
        start = np.uint64(known[lang.encode("utf-8", "surrogatepass")])
        self.n_words = int(np.count_nonzero(whole))
        self.hashes, self.whole = [mixed(ids * MIX + start)], [whole]
        for n in range(2, LONGEST + 1):
            last = max(len(ids) - n + 1, 0)
            self.hashes.append(mixed(self.hashes[-1][:last] * MIX + ids[n - 1 :]))
            self.whole.append(self.whole[-1][:last] & whole[n - 1 :])

    def passing(self, sieve: np.ndarray, n: int) -> np.ndarray:
        """Places of n-grams all of whose parts down to words or pairs may be survivors, and that may be one."""
        found = self.whole[n - 1]
        for part in range(min(n, 2), n):
            hit = in_sieve(sieve, self.hashes[part - 1])
            for shift in range(n - part + 1):
                found = found & hit[shift : shift + len(found)]
        at = np.flatnonzero(found)
        return at[in_sieve(sieve, self.hashes[n - 1][at])]


def in_sieve(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & np.uint64((1 << SIEVE_BITS) - 1)
    return (sieve[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def counted(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes in order, and how often each occurs (or the sums of ``counts``)."""
    if counts is None:
        hashes = np.sort(hashes)
        first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
        return hashes[first], np.diff(np.r_[first, len(hashes)])
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters, each short by at most ``taken``."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        """Add counters; beyond the capacity take the largest that must go off all."""
        self.hashes, self.counts = counted(np.concatenate([self.hashes, hashes]), np.concatenate([self.counts, counts]))
        if len(self.hashes) > self.capacity:
            place = len(self.counts) - self.capacity - 1
            off = int(np.partition(self.counts, place)[place])
            self.taken += off
            kept = self.counts > off
            self.hashes, self.counts = self.hashes[kept], self.counts[kept] - off

    def survivors(self, threshold: int) -> np.ndarray:
        """Hashes that may occur ``threshold`` times: all that do, as long as ``taken`` is below it."""
        return self.hashes[self.counts + self.taken >= threshold]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None]]:
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            yield lang.as_py(), text.as_py()


def survivors(docs: DataFrame, sizes: tuple[int, ...], partitions: int, threshold: int, sieve=None) -> DataFrame:
    """``(hash)`` of n-grams of these sizes, among them every one that occurs ``threshold`` times.

    With a ``sieve`` (a broadcast one), only n-grams whose pairs pass it are looked at.
    """

    def summarise(batches):
        known, held, size = word_hashes(), [], 0
        for lang, data in stretches(_rows(batches)):
            grams = Grams(lang, words_of(data), known)
            for n in sizes:
                if sieve is None:
                    held.append(grams.hashes[n - 1][grams.whole[n - 1]])
                    size += len(held[-1])
                    continue
                found = grams.whole[n - 1]
                hit = in_sieve(sieve.value, grams.hashes[1])
                for shift in range(n - 1):
                    found = found & hit[shift : shift + len(found)]
                held.append(grams.hashes[n - 1][found])
                size += len(held[-1])
            if size >= SUMMARY:
                yield from dealt(held)
                held, size = [], 0
        if size:
            yield from dealt(held)

    def dealt(held):
        hashes, counts = counted(np.concatenate(held))
        place = ((hashes >> np.uint64(32)) * np.uint64(partitions)) >> np.uint64(32)
        cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        ends = np.r_[cuts[1:], len(hashes)]
        yield pa.RecordBatch.from_pydict({
            "place": pa.array(place[cuts].astype(np.int32)), "mass": pa.array(np.add.reduceat(counts, cuts), pa.int64()),
            "hashes": pa.array([hashes[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
            "counts": pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
        })

    def merged(table: pa.Table) -> pa.Table:
        mass = sum(table["mass"].to_pylist())
        summary = Summary(SLACK * mass // threshold + 1)
        waiting, size = [], 0
        for hashes, counts in zip(table["hashes"], table["counts"], strict=True):
            waiting.append((np.frombuffer(hashes.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), np.uint32).astype(np.int64)))
            size += len(waiting[-1][0])
            if size > summary.capacity:
                summary.merge(*map(np.concatenate, zip(*waiting, strict=True)))
                waiting, size = [], 0
        if waiting:
            summary.merge(*map(np.concatenate, zip(*waiting, strict=True)))
        return pa.table({"hash": pa.array(summary.survivors(threshold).view(np.int64), pa.int64())})

    summaries = docs.mapInArrow(summarise, "place int, mass bigint, hashes binary, counts binary")
    return summaries.groupBy("place").applyInArrow(merged, "hash bigint")


def sieve_of(hashes: DataFrame) -> np.ndarray:
    """A set of hashes as 2**SIEVE_BITS bits."""
    bit = F.col("hash").bitwiseAND(F.lit((1 << SIEVE_BITS) - 1))
    marked = hashes.select(bit.alias("bit")).select(F.shiftrightunsigned("bit", 6).alias("word"), F.expr("shiftleft(1L, int(bit & 63))").alias("mask"))
    found = marked.groupBy("word").agg(F.bit_or("mask").alias("bits")).toArrow()  # at most 2**(SIEVE_BITS - 6) rows
    out = np.zeros(1 << (SIEVE_BITS - 6), np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def phrase_counts(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``(lang, phrase, f)``: exact counts of all n-grams of up to ``LONGEST`` words with f >= ``threshold``.

    The row of a language with a null phrase counts its words.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    partitions = -(-size // PARTITION_BYTES) or 1
    short = sieve_of(staged(survivors(docs, (1, 2), partitions, threshold), "survivors"))
    shared = spark.sparkContext.broadcast(short)
    long = sieve_of(staged(survivors(docs, tuple(range(3, LONGEST + 1)), partitions, threshold, shared), "survivors"))
    sieve = spark.sparkContext.broadcast(short | long)

    places = COUNT_PLACES * partitions

    def count(batches):
        known, words = word_hashes(), {}
        held: dict[str, list] = {}  # by language: hashes in order, their counts, numbers of their phrases
        phrases: list[bytes] = []
        for lang, data in stretches(_rows(batches)):
            tokens = words_of(data)
            grams = Grams(lang, tokens, known)
            words[lang] = words.get(lang, 0) + grams.n_words
            hashes, counts, numbers = held.get(lang, (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)))
            for n in range(1, LONGEST + 1):
                at = grams.passing(sieve.value, n)
                own, first, often = np.unique(grams.hashes[n - 1][at], return_index=True, return_counts=True)
                place = np.searchsorted(hashes, own)
                old = place < len(hashes)
                old[old] = hashes[place[old]] == own[old]
                counts[place[old]] += often[old]
                fresh = at[first[~old]].tolist()
                merged = np.concatenate([hashes, own[~old]])
                order = np.argsort(merged, kind="stable")
                hashes = merged[order]
                counts = np.concatenate([counts, often[~old]])[order]
                numbers = np.concatenate([numbers, np.arange(len(phrases), len(phrases) + len(fresh))])[order]
                phrases += [b" ".join(tokens[i : i + n]) for i in fresh]
            held[lang] = hashes, counts, numbers
            if len(phrases) >= KNOWN:
                yield from handed(held, phrases)
                held, phrases = {}, []
        yield from handed(held, phrases)
        if words:
            langs = list(words)
            at = [known[lang.encode("utf-8", "surrogatepass")] % places for lang in langs]
            totals = [np.array([words[lang]], np.int64).tobytes() for lang in langs]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(langs), pa.nulls(len(at), pa.binary()), pa.array(totals)], names)

    def handed(held, phrases):
        """The phrases of each place as one row."""
        for lang, (hashes, counts, numbers) in held.items():
            if not len(hashes):
                continue
            place = ((hashes >> np.uint64(32)) * np.uint64(places)) >> np.uint64(32)
            cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            ends = np.r_[cuts[1:], len(hashes)]
            texts = [b"\n".join(map(phrases.__getitem__, numbers[a:b].tolist())) for a, b in zip(cuts, ends, strict=True)]
            sums = [counts[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)]
            columns = [pa.array(place[cuts].astype(np.int32)), pa.array([lang] * len(cuts)), pa.array(texts, pa.binary()), pa.array(sums, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    def added(table: pa.Table) -> pa.Table:
        sums: dict[tuple[str, bytes | None], int] = {}
        for lang, texts, counts in zip(table["lang"].to_pylist(), table["phrases"], table["counts"], strict=True):
            texts = [None] if not texts.is_valid else texts.as_py().split(b"\n")
            for phrase, n in zip(texts, np.frombuffer(counts.as_buffer(), np.int64).tolist(), strict=True):
                sums[lang, phrase] = sums.get((lang, phrase), 0) + n
        found = [(lang, phrase, f) for (lang, phrase), f in sums.items() if f >= threshold or phrase is None]
        langs, texts, totals = zip(*found, strict=True) if found else ((), (), ())
        phrases = pa.array(texts, pa.binary()).cast(pa.string())
        return pa.table({"lang": pa.array(langs, pa.string()), "phrase": phrases, "f": pa.array(totals, pa.int64())})

    names = ["place", "lang", "phrases", "counts"]
    parts = docs.mapInArrow(count, "place int, lang string, phrases binary, counts binary")
    return parts.groupBy("place").applyInArrow(added, "lang string, phrase string, f bigint")


def _wide(column: str):
    """A count for products that may pass 64 bits."""
    return F.col(column).cast("decimal(28,0)")


def scored(frequent: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, score)``: the lowest-scoring cut of every phrase of two words or more."""
    size = F.size(F.split("phrase", " "))
    phrases = frequent.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words")).where(size > 1)
    cuts = phrases.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    first = F.array_join(F.slice("words", F.lit(1), F.col("k")), " ")
    rest = F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ")
    sides = F.explode(F.array(F.struct(F.lit(True).alias("left"), first.alias("text")), F.struct(F.lit(False).alias("left"), rest.alias("text"))))
    parts = cuts.select("lang", "phrase", "a", "k", sides.alias("side"))
    parts = parts.select("lang", "phrase", "a", "k", "side.left", F.struct("lang", "side.text").alias("part"))
    parts = staged(parts, "parts")
    # a frequent word is part of very many phrases, so its count is looked up by weight
    asked = parts.groupBy("part").agg(F.count("*").alias("weight"))
    known = asked.join(frequent.select(F.struct("lang", F.col("phrase").alias("text")).alias("part"), "f"), "part")
    found = join_counted(parts, known, "part", "weight", parts.count())
    sums = found.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r")
    )
    # exact: a product of wide integers, and their integral division
    sums = sums.withColumns({"_above": _wide("a") * F.lit(SCALE).cast("decimal(8,0)"), "_below": _wide("l") + _wide("r")})
    sums = sums.withColumn("score", F.expr("CAST(_above div _below AS bigint)"))
    best = sums.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def uncovered(phrases: DataFrame, percent: int = COVER_PERCENT) -> DataFrame:
    """The phrases that do not mostly occur within one longer phrase."""
    words, n = F.split("phrase", " "), F.size(F.split("phrase", " "))

    def parts(length: int):  # of phrases that are longer
        starts = F.sequence(F.lit(1), n - length + 1)
        return F.when(n > length, F.transform(starts, lambda at: F.array_join(F.slice(words, at, F.lit(length)), " "))).otherwise(
            F.array().cast("array<string>")
        )

    within = phrases.select("lang", F.explode(F.concat(*map(parts, range(2, LONGEST)))).alias("phrase"), F.col("a").alias("longer"))
    most = within.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    rare = F.col("longer").isNull() | (_wide("longer") * 100 < _wide("a") * percent)
    return phrases.join(most, ["lang", "phrase"], "left").where(rare).drop("longer")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` phrases of every language."""
    counts = staged(phrase_counts(docs, threshold), "phrases")
    frequent = counts.where("phrase IS NOT NULL")
    found = staged(uncovered(staged(scored(frequent), "scored")), "candidates")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = -(-found.count() // WINDOW_ROWS) or 1
    while True:  # the best of parts of a language, then of fewer parts, then of the language
        window = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(*order)
        found = found.withColumn("rank", F.row_number().over(window).cast("bigint")).where(F.col("rank") <= top)
        if parts == 1:
            break
        parts = -(-parts * top // WINDOW_ROWS) if top < WINDOW_ROWS // 2 else 1
    words = counts.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    return found.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11(docs: DataFrame) -> DataFrame:
    """The strongest collocations of every language."""
    return collocations(docs.select("text", "lang"))
