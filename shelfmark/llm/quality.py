"""Quality scores from weak labels: heuristic labellers, their accuracies by EM, and a linear scorer.

Nine labellers look at a whole text and vote good, bad or nothing. Their vote patterns are counted over
all documents (at most 3**9 patterns), and expectation maximisation on these counts estimates how often
each labeller votes each way on good and on bad documents, which gives every pattern a posterior. The
posteriors of a bounded sample of documents train a logistic scorer on hashed words, word shapes and
repeats, which then scores every whole text.

Defined cases: a null text counts as empty; empty texts get the posterior of their pattern and the score
of the bias alone. Documents without doc_id are scored, but teach the scorer nothing; of several texts of
one doc_id the smallest teaches. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Memo, staged

ABSTAIN, BAD, GOOD = 0, 1, 2
LABELLERS = 9
PATTERNS = 3**LABELLERS
DIMENSIONS = 1 << 13
MAX_EXAMPLES = 4096
SYMBOLS = "#$%&*|<>{}\\^~=+_@"
# Frequent short words of four languages.
STOPWORDS = frozenset(
    "the of and to in is that for it as was with be by on not this are or from at an "
    "le la les de des et en un une du que est pour dans qui sur pas au avec par "
    "der die das und von zu den mit ist im nicht ein eine auf als auch dem sich für des "
    "el los las del que y en un una por con no para es se al lo como".split()
)
OTHER = re.compile(r"[^\w]|_")


def _vote(value: float, bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else ABSTAIN


def votes(text: str | None) -> list[int]:
    """The labellers' votes on a text."""
    text = text or ""
    words = text.split()
    n = len(words)
    lower = [w.lower() for w in words]
    lines = [line for line in text.split("\n") if line.strip()]
    repeats = sum(map(str.__eq__, lower, lower[1:])) / max(n - 1, 1)
    upper = sum(map(str.isupper, words)) / max(n, 1)
    symbols = sum(map(text.count, SYMBOLS)) / max(n, 1)
    ends = (text.count(".") + text.count("?") + text.count("!")) / max(n, 1)
    shouts = text.count("!!") / max(n, 1)
    stop = sum(map(STOPWORDS.__contains__, lower)) / max(n, 1)
    top = max(Counter(lower).values(), default=0) / max(n, 1)
    distinct = len(set(lines)) / max(len(lines), 1)
    size = len(text) / max(n, 1)
    some = n >= 10
    return [
        _vote(n, n < 5, n >= 30),
        _vote(repeats, some and repeats > 0.2, some and repeats < 0.05),
        _vote(upper, some and upper > 0.5, some and upper < 0.1),
        _vote(symbols, n > 0 and symbols > 0.3, some and symbols < 0.05),
        _vote(ends, (n >= 30 and ends < 0.01) or shouts > 0.1, some and 0.02 <= ends <= 0.35 and shouts < 0.02),
        _vote(stop, n >= 20 and stop < 0.03, some and stop >= 0.12),
        _vote(distinct, len(lines) >= 4 and distinct < 0.5, len(lines) >= 3 and distinct > 0.9),
        _vote(size, n > 0 and not 2.5 <= size <= 14, some and 3.5 <= size <= 11),
        _vote(top, some and top > 0.3, n >= 30 and top < 0.15),
    ]


def pattern(text: str | None) -> int:
    """The votes as one number."""
    number = 0
    for vote in votes(text):
        number = 3 * number + vote
    return number


def estimate(counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Posteriors of all patterns, ``rates[label, labeller, vote]``, and the share of good documents.

    ``counts`` are numbers of documents a pattern. Labellers vote independently given the label; the
    first guess is the share of good among the votes cast.
    """
    digits = (np.arange(PATTERNS)[:, None] // 3 ** np.arange(LABELLERS - 1, -1, -1)) % 3
    cast, good = (digits != ABSTAIN).sum(axis=1), (digits == GOOD).sum(axis=1)
    p = (good + 0.5) / (cast + 1)
    rates, share = np.full((2, LABELLERS, 3), 1 / 3), 0.5
    for _ in range(rounds):
        weight = np.stack([counts * (1 - p), counts * p])
        share = (weight[1].sum() + 1) / (counts.sum() + 2)
        for vote in range(3):
            rates[:, :, vote] = weight @ (digits == vote) + 1
        rates /= rates.sum(axis=2, keepdims=True)
        logs = np.log(rates)
        score = np.log([1 - share, share])[:, None] + sum(logs[:, k, :][:, digits[:, k]] for k in range(LABELLERS))
        after = 1 / (1 + np.exp(np.clip(score[0] - score[1], -500, 500)))
        if np.abs(after - p).max() < 1e-9:
            break
        p = after
    return p, rates, float(share)


def _place(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % DIMENSIONS


def _chunk_places(chunk: str) -> tuple[int, int]:
    """Places of a word and of its shape (letters by case, digits, other characters; runs shortened)."""
    kinds = ["A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in chunk]
    shape = "".join(k for k, before in zip(kinds, [None, *kinds], strict=False) if k != before)
    return _place("word " + OTHER.sub("", chunk).lower()), _place("shape " + shape[:8])


REPEAT, FEW = _place("repeat"), _place("few words")


def features():
    """A function from a text to places and weights, of length one."""
    known = Memo(_chunk_places)

    def vector(text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").split()
        if not words:
            return np.zeros(0, np.int64), np.zeros(0)
        pairs = np.array(list(map(known.__getitem__, words)), dtype=np.int64)
        counts = np.bincount(pairs[:, 0], minlength=DIMENSIONS).astype(float)
        counts += 2.0 * np.bincount(pairs[:, 1], minlength=DIMENSIONS)
        counts[REPEAT] += 4.0 * sum(map(str.__eq__, words, words[1:]))
        if len(words) < 5:
            counts[FEW] += len(words)
        places = np.flatnonzero(counts)
        weights = np.sqrt(counts[places])
        return places, weights / np.linalg.norm(weights)

    return vector


def train(starts: np.ndarray, places: np.ndarray, weights: np.ndarray, target: np.ndarray, rounds: int = 300, ridge: float = 1e-4):
    """Logistic regression on sparse rows with soft targets, by accelerated gradient steps: (weights, bias)."""
    row = np.repeat(np.arange(len(target)), np.diff(starts))
    w, before, bias, bias_before = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), 0.0, 0.0
    for t in range(rounds):
        ahead = w + t / (t + 3) * (w - before)
        bias_ahead = bias + t / (t + 3) * (bias - bias_before)
        z = np.bincount(row, weights * ahead[places], minlength=len(target)) + bias_ahead
        error = 1 / (1 + np.exp(-z)) - target
        gradient = np.bincount(places, weights * error[row], minlength=DIMENSIONS) / len(target) + ridge * ahead
        before, w, bias_before = w, ahead - 2.0 * gradient, bias
        bias = bias_ahead - 2.0 * error.mean()
    return w, bias


def score_quality(docs: DataFrame, max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """All rows and columns of ``docs`` with ``quality``: a struct of score, posterior and votes.

    The scorer learns from the ``max_examples`` documents with the smallest hashes of their id.
    """
    spark = docs.sparkSession

    def patterns(batches):
        counts: Counter = Counter()
        for batch in batches:
            counts.update(pattern(text.as_py()) for text in batch.column("text"))
        yield pa.RecordBatch.from_pydict({"pattern": list(counts.keys()), "n": list(counts.values())}, schema=schema)

    schema = pa.schema([("pattern", pa.int64()), ("n", pa.int64())])
    found = docs.select("text").mapInArrow(patterns, "pattern bigint, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))
    counts = np.zeros(PATTERNS)
    for r in found.collect():  # at most PATTERNS rows
        counts[r.pattern] = r.n
    posteriors, _, _ = estimate(counts)

    def examples(batches):
        vector = features()
        for batch in batches:
            for text in batch.column("text"):
                places, weights = vector(text.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([places], pa.list_(pa.int64())), pa.array([weights], pa.list_(pa.float64())), pa.array([pattern(text.as_py())])],
                    ["places", "weights", "pattern"],
                )

    sample = docs.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text")).select("text")
    rows = staged(texts.mapInArrow(examples, "places array<bigint>, weights array<double>, pattern bigint"), "examples").toArrow()
    places, weights = rows["places"].combine_chunks(), rows["weights"].combine_chunks()
    starts = np.r_[0, np.cumsum([len(p) for p in rows["places"].to_pylist()])] if len(rows) else np.zeros(1, np.int64)
    flat = (places.flatten().to_numpy(), weights.flatten().to_numpy()) if len(rows) else (np.zeros(0, np.int64), np.zeros(0))
    model = train(starts, *flat, posteriors[rows["pattern"].to_numpy()]) if len(rows) else (np.zeros(DIMENSIONS), 0.0)
    shared = spark.sparkContext.broadcast((*model, posteriors))

    def score(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        w, bias, known = shared.value
        vector = features()
        for batch in series:
            out = []
            for text in batch:
                at, weight = vector(text)
                number = pattern(text)
                out.append((1 / (1 + np.exp(-(w[at] @ weight + bias))), known[number], number))
            yield pd.DataFrame(out, columns=["score", "posterior", "pattern"])

    scorer = F.pandas_udf(score, "score double, posterior double, pattern int")
    return docs.withColumn("quality", scorer(F.coalesce("text", F.lit(""))))


def op1(docs: DataFrame) -> DataFrame:
    """Score, weak label and decision for every document."""
    found = score_quality(docs.select("doc_id", "text"))
    return found.select("doc_id", "quality.score", "quality.posterior", (F.col("quality.score") >= 0.5).cast("int").alias("keep"))
