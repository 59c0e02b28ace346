"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

A bounded sample of labelled texts is turned into TF-IDF vectors over the terms (words and word
beginnings) that tell toxic from clean texts. Every text is compared with these examples through an
inverted index whose postings are grouped into blocks of examples with their largest weight: blocks
are looked at in order of their upper bound until no other block can hold a nearer example, so the
neighbours found are exactly the nearest. They vote by their nearness, and a logistic curve fitted to
leave-one-out votes of the examples makes the vote a probability. The index is broadcast: its size
is bounded by ``max_examples`` and ``max_terms``. Document frequencies are counted over all texts.

Defined cases: a null or empty text has no terms and gets the share of toxic texts among examples
without terms. Labels other than 0 and 1 and rows without doc_id teach nothing; of several labels of
a document the largest counts, of several texts the smallest. Without examples of either class every
text gets score 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Memo, release_kept, return_memory, staged

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
BLOCK = 64
COUNTED = 20_000  # terms of a class that a task counts before it hands them on: a bound on memory
RESULT = (
    "score double, n_terms int, evidence array<struct<doc_id bigint, similarity double, toxic int>>"
)


def chunk_terms(chunk: str) -> tuple[str, ...]:
    """Terms of a piece of text without spaces: its words, and their beginnings as ``abcd*``."""
    words = WORD.findall(chunk)
    return (*words, *(f"{w[:n]}*" for w in words for n in PREFIXES if len(w) > n))


def near_copy_key(text: str, seed: int) -> int:
    """The smallest hash of the text's five-word shingles: equal for most near copies."""
    words = text.lower().split()
    shingles = (" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))
    return min(xxhash.xxh64_intdigest(s, seed) for s in shingles) >> 1


class BlockMaxIndex:
    """Example vectors as postings, with the largest weight of each term in each block of examples."""

    def __init__(self, n_terms: int, terms: list[np.ndarray], weights: list[np.ndarray], ids: np.ndarray):
        # examples with the same strongest term lie together, which makes block bounds tight
        strongest = [int(t[np.argmax(w)]) if len(t) else -1 for t, w in zip(terms, weights, strict=True)]
        self.order = np.lexsort((ids, strongest))
        self.ids = ids[self.order]
        self.blocks = max(1, -(-len(ids) // BLOCK))
        sizes = np.array([len(terms[i]) for i in self.order], dtype=np.int64)
        at = np.repeat(np.arange(len(ids)), sizes)
        term = np.concatenate([terms[i] for i in self.order]) if len(ids) else np.zeros(0, np.int64)
        weight = np.concatenate([weights[i] for i in self.order]) if len(ids) else np.zeros(0)
        by_term = np.lexsort((at, term))
        self.at, self.weight = at[by_term], weight[by_term]
        cell = term[by_term].astype(np.int64) * self.blocks + self.at // BLOCK
        self.start = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1))
        self.most = np.zeros(n_terms * self.blocks)
        np.maximum.at(self.most, cell, self.weight)
        self.most = self.most.reshape(n_terms, self.blocks)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int | None = None):
        """Positions and cosines of the k nearest examples, nearest first, ties to the smaller id."""
        bound = weights @ self.most[terms]
        found, sims, floor = np.zeros(0, np.int64), np.zeros(0), 0.0
        for block in np.argsort(-bound, kind="stable"):
            if bound[block] <= 0 or bound[block] < floor - 1e-9:
                break
            scores = np.zeros(BLOCK)
            for t, w in zip(terms, weights, strict=True):
                cell = t * self.blocks + block
                part = slice(self.start[cell], self.start[cell + 1])
                scores[self.at[part] - block * BLOCK] += w * self.weight[part]
            hit = np.flatnonzero(scores > 0)
            hit = hit[scores[hit] >= floor - 1e-9]
            if skip is not None:
                hit = hit[self.ids[hit + block * BLOCK] != skip]
            found = np.concatenate([found, hit + block * BLOCK])
            sims = np.concatenate([sims, np.round(np.minimum(scores[hit], 1.0), 9)])
            if len(found) > k:
                best = np.lexsort((self.ids[found], -sims))[:k]
                found, sims = found[best], sims[best]
            if len(found) == k:
                floor = sims.min()
        best = np.lexsort((self.ids[found], -sims))
        return found[best], sims[best]


@dataclass
class ToxicityModel:
    """What scoring needs; a few MB at most."""

    vocabulary: dict[str, int]
    idf: np.ndarray
    terms: list[np.ndarray]
    weights: list[np.ndarray]
    ids: np.ndarray
    toxic: np.ndarray
    share: tuple[float, float]  # documents that an example of class 0 and 1 stands for
    prior: float  # of a text without terms
    k: int
    curve: tuple[float, float] = (1.0, 0.0)

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        terms = np.array(sorted(counts), dtype=np.int64)
        weights = np.array([(1 + math.log(counts[t])) for t in terms]) * self.idf[terms]
        return terms, weights / np.linalg.norm(weights)

    def counter(self):
        """A function from a text to the counts of its terms."""
        get = self.vocabulary.get
        known = Memo(lambda chunk: tuple(i for t in chunk_terms(chunk) if (i := get(t)) is not None))

        def count(text: str | None) -> Counter:
            chunks = (text or "").lower().split()
            return Counter(t for terms in map(known.__getitem__, chunks) if terms for t in terms)

        return count

    def vote(self, positions: np.ndarray, sims: np.ndarray, toxic: np.ndarray) -> float:
        """Share of toxic votes; the prior has one vote, so that weak evidence stays near it."""
        y = toxic[positions]
        w = np.where(y == 1, self.share[1], self.share[0]) / min(self.share) / (1.05 - sims)
        return float((w @ y + 0.5 * self.prior) / (w.sum() + 0.5))

    def curved(self, vote: float) -> float:
        vote = min(max(vote, 1e-6), 1 - 1e-6)
        return 1 / (1 + math.exp(-(self.curve[0] * math.log(vote / (1 - vote)) + self.curve[1])))


def _rows(batches: Iterator[pa.RecordBatch], *columns: str):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def _term_counts(batches):
    """Per task, how many toxic and clean examples have each term."""
    release_kept()
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush():
        terms = list(counts[0] | counts[1])
        data = [terms, [counts[1][t] for t in terms], [counts[0][t] for t in terms]]
        counts[0].clear(), counts[1].clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(data[0], pa.string()), pa.array(data[1], pa.int64()), pa.array(data[2], pa.int64())],
            ["term", "n_toxic", "n_clean"],
        )

    for text, toxic in _rows(batches, "text", "toxic"):
        counts[toxic].update({t for chunk in set((text or "").lower().split()) for t in chunk_terms(chunk)})
        if len(counts[toxic]) > COUNTED:
            yield flush()
    yield flush()


def _choose_terms(counts: DataFrame, n_toxic: int, n_clean: int, max_terms: int, lift: float, g2: float) -> list[str]:
    """Terms that at least ``lift`` times as many toxic as clean examples have, best by likelihood ratio."""
    a, b = F.col("n_toxic"), F.col("n_clean")
    n = n_toxic + n_clean
    expected_a, expected_b = (a + b) * (n_toxic / n), (a + b) * (n_clean / n)
    gain = 2 * (a * F.log(a / expected_a) + F.when(b > 0, b * F.log(b / expected_b)).otherwise(0.0))
    rate = ((a + 0.5) / (n_toxic + 1)) / ((b + 0.5) / (n_clean + 1))
    found = counts.where((a >= 2) & (rate >= lift) & (gain >= g2)).select("term", gain.alias("gain"))
    return [r.term for r in found.orderBy(F.desc("gain"), "term").limit(max_terms).collect()]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_examples: int = 4096,
    max_terms: int = 1024,
    lift: float = 3.0,
    g2: float = 25.0,
    k: int = 15,
) -> ToxicityModel | None:
    """Learn from ``labels (doc_id, toxic)``; at most ``max_examples`` documents of each class are kept.

    ``docs`` needs doc_id and text. Examples are the labelled documents with the smallest hashes of
    their id, a choice that no order of rows changes. None without examples of both classes.
    """
    marked = (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    sizes = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    sample = [marked.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples) for y in (0, 1)]
    # one example of a group of copies: else the rare words that copies share look like evidence
    keys = F.pandas_udf(
        lambda text: pd.DataFrame({f"k{s}": [near_copy_key(t, s) for t in text] for s in (0, 1)}), "k0 bigint, k1 bigint"
    )
    examples = (
        docs.select("doc_id", "text")
        .where("text IS NOT NULL")
        .join(F.broadcast(sample[0].union(sample[1])), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
        .select("*", keys("text").alias("key"))
    )
    for key in ("k0", "k1"):
        first = F.min_by(F.struct("doc_id", "toxic", "text", "key"), "doc_id").alias("e")
        examples = examples.groupBy(f"key.{key}", "toxic").agg(first).select("e.*")
    examples = staged(examples.drop("key"), "toxic-examples")
    kept = {r.toxic: r["count"] for r in examples.groupBy("toxic").count().collect()}
    if len(kept) < 2:
        return None
    counts = examples.mapInArrow(_term_counts, "term string, n_toxic bigint, n_clean bigint")
    counts = counts.groupBy("term").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
    terms = _choose_terms(counts, kept[1], kept[0], max_terms, lift, g2)
    model = ToxicityModel(
        {t: i for i, t in enumerate(terms)}, np.ones(len(terms)), [], [], np.zeros(0, np.int64), np.zeros(0, np.int64),
        (sizes[0] / kept[0], sizes[1] / kept[1]), 0.0, k,
    )

    def frequencies(batches):
        release_kept()
        count, n, total = model.counter(), np.zeros(len(terms) + 1, np.int64), 0
        for (text,) in _rows(batches, "text"):
            n[list(count(text))] += 1
            total += 1
        n[-1] = total
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["term", "n"])

    found = docs.select("text").mapInArrow(frequencies, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    frequency = {r.term: r.n for r in found.collect()}
    total = frequency.get(len(terms), 0)
    model.idf = np.array([math.log((total + 1) / (frequency.get(t, 0) + 1)) + 1 for t in range(len(terms))])

    def vectors(batches):
        count = model.counter()
        for doc_id, toxic, text in _rows(batches, "doc_id", "toxic", "text"):
            t, w = model.vector(c) if (c := count(text)) else ([], [])
            yield pa.RecordBatch.from_pydict(
                {"doc_id": [doc_id], "toxic": [toxic], "terms": [list(t)], "weights": [list(w)]}, schema=schema
            )

    schema = pa.schema(
        [("doc_id", pa.int64()), ("toxic", pa.int32()), ("terms", pa.list_(pa.int64())), ("weights", pa.list_(pa.float64()))]
    )
    stored = staged(examples.mapInArrow(vectors, "doc_id bigint, toxic int, terms array<bigint>, weights array<double>"), "vectors")
    rows = stored.orderBy("doc_id").toArrow()
    y, has = rows["toxic"].to_numpy(), np.array([len(t) > 0 for t in rows["terms"].to_pylist()], dtype=bool)
    weight = np.where(y == 1, model.share[1], model.share[0])
    blank = ~has
    model.prior = float((weight[blank] @ y[blank]) / (weight[blank].sum() + 1.0))
    model.ids, model.toxic = rows["doc_id"].to_numpy()[has], y[has]
    model.terms = [np.array(t, dtype=np.int64) for t, h in zip(rows["terms"].to_pylist(), has, strict=True) if h]
    model.weights = [np.array(w) for w, h in zip(rows["weights"].to_pylist(), has, strict=True) if h]
    if terms and has.any():
        model.curve = _calibrate(docs.sparkSession, stored.where(F.size("terms") > 0), model)
    return model


def _calibrate(spark, vectors: DataFrame, model: ToxicityModel) -> tuple[float, float]:
    """Fit a logistic curve to the votes that examples get from the other examples."""
    shared = spark.sparkContext.broadcast(model)

    def left_out(batches):
        m = shared.value
        index = BlockMaxIndex(len(m.vocabulary), m.terms, m.weights, m.ids)
        toxic = m.toxic[index.order]
        for doc_id, y, t, w in _rows(batches, "doc_id", "toxic", "terms", "weights"):
            found = index.nearest(np.array(t, dtype=np.int64), np.array(w), m.k, skip=doc_id)
            yield pa.RecordBatch.from_pydict({"toxic": [float(y)], "vote": [m.vote(*found, toxic)]})

    rows = vectors.mapInArrow(left_out, "toxic double, vote double").toArrow()
    y, v = rows["toxic"].to_numpy(), np.clip(rows["vote"].to_numpy(), 1e-6, 1 - 1e-6)
    weight = np.where(y == 1, model.share[1], model.share[0])
    x, target = np.log(v / (1 - v)), (weight[y == 1].sum() * y + 0.5) / (weight[y == 1].sum() + 1)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps with a small pull towards the plain vote
        p = 1 / (1 + np.exp(-(a * x + b)))
        g = np.array([(weight * (p - target)) @ x + (a - 1), (weight * (p - target)).sum() + 0.1 * b])
        s = weight * p * (1 - p)
        h = np.array([[(s * x) @ x + 1, s @ x], [s @ x, s.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (float(a), float(b)) if np.isfinite([a, b]).all() and a > 0 else (1.0, 0.0)


def scorer(spark, model: ToxicityModel | None):
    """A column function from a text to ``RESULT``: probability, number of known terms, neighbours."""
    shared = spark.sparkContext.broadcast(model)

    def score(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release_kept()
        m = shared.value
        if m is None:
            for texts in series:
                yield pd.DataFrame({"score": [0.0] * len(texts), "n_terms": 0, "evidence": [[]] * len(texts)})
            return
        index = BlockMaxIndex(len(m.vocabulary), m.terms, m.weights, m.ids)
        toxic, count = m.toxic[index.order], m.counter()

        def judged(items: tuple):
            if not items:
                return m.prior, 0, []
            found, sims = index.nearest(*m.vector(Counter(dict(items))), m.k)
            near = [{"doc_id": int(index.ids[p]), "similarity": float(s), "toxic": int(toxic[p])} for p, s in zip(found, sims, strict=True)]
            return m.curved(m.vote(found, sims, toxic)), len(items), near

        known = Memo(judged)
        for texts in series:
            results = [known[tuple(sorted(count(t).items()))] for t in texts]
            yield pd.DataFrame(results, columns=["score", "n_terms", "evidence"])
        known.clear()
        return_memory()

    return F.pandas_udf(score, RESULT)


def held_out(doc_id: Column) -> Column:
    """Documents that never teach: crc32 of the id as text is a multiple of five (a null id: true)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0)) == 0


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """All rows and columns of ``docs`` with a column ``toxicity`` of type ``RESULT``."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))), **options)
    return docs.withColumn("toxicity", scorer(docs.sparkSession, model)(F.coalesce("text", F.lit(""))))


def without_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that score below one half."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))), **options)
    scored = docs.withColumn("__toxicity", scorer(docs.sparkSession, model)(F.coalesce("text", F.lit(""))))
    return scored.where("__toxicity.score < 0.5").drop("__toxicity")


def op3(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The score of every document, with the examples it rests on."""
    found = score_documents(docs.select("doc_id", "text"), labels)
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        F.col("toxicity.n_terms").alias("n_terms"),
        F.col("toxicity.evidence").alias("evidence"),
    )
