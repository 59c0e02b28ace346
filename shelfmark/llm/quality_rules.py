"""Quality rules by line sequence labelling: a linear-chain conditional random field over a text's lines.

The lines of a text that hold a word are a sequence of observations, each a few binned measures: length,
symbols, repeated words, letters, digits, sentence ends, earlier equal lines, place in the text. The field
has a weight for each bin, and weights for the first label and for neighbouring labels; Viterbi decoding marks
every line as content or boilerplate. A document is kept if at least ``CONTENT_SHARE`` of its words lie in
content lines, and if it passes the base rules: ten words at least, and at most a fifth of them in five-word
windows that the text holds more than once.

The field is learned from documents with known quality, by maximum likelihood with exact forward-backward
sums. Lines of good documents are content. Which lines of bad documents are boilerplate is not known; all are
taken so at first, then those that the learned weights of their bins place among content are content, and the
field is learned again, ``ROUNDS`` times. It learns from at most ``MAX_EXAMPLES`` documents of each quality, those with
the smallest hashes of their id, and from at most ``MAX_CHUNKS`` stretches of ``CHUNK`` lines of these. This bound
is a parameter; statistics and decisions are made of whole texts.

Defined cases: a null text has no words, fails the base rules and is not kept, as an empty one. Lines are
split at line feeds only and are compared as they stand. Ties of label sequences go to content. Without examples
of both qualities nothing is learned and every line is content. A label that contradicts another of its doc_id
counts as bad; a doc_id with several texts teaches by the smallest. Documents without doc_id are judged as others,
repeated rows each for itself; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import staged
from shelfmark.llm.quality import STOPWORDS

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
CONTENT_SHARE = 0.5
MAX_EXAMPLES = 2048
MAX_CHUNKS = 4096
CHUNK = 64
ROUNDS = 3
STEPS = 100
RIDGE = 1e-3
GROUP = 1 << 14  # lines that are measured in one go

_SPACES = " \t\n\v\f\r"
_MARKS = b"#*$%&|<>{}[]=_~^+@\\"
_LOWER = bytes(range(97, 123))
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_STOPS = frozenset(word.encode() for word in STOPWORDS)
# Bins of the measures of a line, by their lower ends.
BINS = {
    "words": [2, 4, 8, 16, 32],
    "marks": [1e-9, 0.1, 0.3],
    "repeats": [1e-9, 0.1, 0.3],
    "distinct": [0.3, 0.6, 0.9],
    "stops": [1e-9, 0.05, 0.15, 0.3],
    "length": [2.5, 4, 9, 14],
    "digits": [1e-9, 0.1, 0.3],
    "upper": [0.05, 0.15, 0.5],
    "ends": [1e-9, 0.03, 0.2, 0.5],
    "closed": [1],
    "opened": [1],
    "bullet": [1],
    "earlier": [1],
    "place": [1, 2],
}
OFFSETS = np.cumsum([0, *(len(ends) + 1 for ends in BINS.values())])
WEIGHTS = int(OFFSETS[-1])


def _measures(line: bytes, words: list[bytes], earlier: bool, place: int) -> tuple:
    """The measures of one line, in the order of ``BINS``."""
    n, size = len(words), len(line)
    first, last = words[0][:1], words[-1][-1:]
    letters = size - len(line.translate(None, _LOWER))
    upper = size - len(line.translate(None, _UPPER))
    ends = line.count(b".") + line.count(b"!") + line.count(b"?")
    return (
        n,
        (size - len(line.translate(None, _MARKS))) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        len(set(words)) / n,
        sum(map(_STOPS.__contains__, line.lower().split())) / n,
        sum(map(len, words)) / n,
        (size - len(line.translate(None, _DIGITS))) / size,
        upper / (letters + upper + 1),
        ends / n,
        last in b".!?:;\"')",
        first in _UPPER or first >= b"\x80",
        first in b"-*#|>" or b" | " in line,
        earlier,
        place,
    )


def binned(measures: list[tuple]) -> np.ndarray:
    """Places of the weights of lines, a row a line."""
    values = np.array(measures, float).reshape(-1, len(BINS))
    places = [np.digitize(values[:, k], ends) for k, ends in enumerate(BINS.values())]
    return np.stack(places, axis=1) + OFFSETS[:-1]


def _dense(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers that tell pairs of small numbers apart, as small as can be."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in five-word windows that occur twice or more; words are compared exactly."""
    if len(words) <= WINDOW:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(word, len(known)) for word in words], np.int64)
    bits = len(known).bit_length()
    if WINDOW * bits < 64:
        windows = ids[: 1 - WINDOW]
        for k in range(1, WINDOW):
            windows = (windows << bits) | ids[k : len(ids) - WINDOW + 1 + k]
    else:
        two = _dense(ids[:-1], ids[1:])
        four = _dense(two[:-2], two[2:])
        windows = _dense(four[:-1], ids[WINDOW - 1 :])
    order = np.sort(windows)
    if not (order[1:] == order[:-1]).any():
        return 0
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    found = np.flatnonzero(counts[place] > 1)
    change = np.bincount(found, minlength=len(words) + 1) - np.bincount(found + WINDOW, minlength=len(words) + 1)
    return int(np.count_nonzero(np.cumsum(change)[: len(words)]))


def read_lines(text: str | None) -> tuple[tuple, list[tuple], list[int]]:
    """(base statistics, measures of the lines with a word, their numbers of words) of a whole text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words: list[bytes] = []
    sizes, seen, lines, copies = [], set(), [], []
    for line in data.split(b"\n"):
        own = line.split()
        if own:
            words += own
            sizes.append(len(own))
            lines.append((line, own))
            copies.append(line in seen)
            seen.add(line)
    measures = [
        _measures(line, own, earlier, 0 if k == 0 else 2 if k == len(lines) - 1 else 1)
        for k, ((line, own), earlier) in enumerate(zip(lines, copies, strict=True))
    ]
    word_chars = len(text) - sum(map(text.count, _SPACES))
    symbols = sum(data.count(SYMBOLS[k : k + 1]) for k in range(len(SYMBOLS)))
    return (len(words), word_chars, symbols, sum(copies), repeated_words(words)), measures, sizes


class LineField:
    """A linear-chain conditional random field with the labels 0 (content) and 1 (boilerplate).

    ``weights`` are those of a line's bins for label 1; ``start`` and ``step`` those of the first label and
    of neighbouring labels.
    """

    def __init__(self, weights: np.ndarray, start: np.ndarray, step: np.ndarray):
        self.weights, self.start, self.step = weights, start, step

    @classmethod
    def blank(cls) -> LineField:
        """The field that finds content only: all label sequences weigh the same, and ties go to content."""
        return cls(np.zeros(WEIGHTS), np.zeros(2), np.zeros((2, 2)))

    def scores(self, places: np.ndarray) -> np.ndarray:
        return self.weights[places].sum(axis=1)

    def decode(self, scores: list[float]) -> list[int]:
        """The best labels of one sequence by Viterbi; of equal ones content, from the last line on."""
        if not scores:
            return []
        (cc, cb), (bc, bb) = self.step.tolist()
        content, boiler = float(self.start[0]), float(self.start[1]) + scores[0]
        back = []
        for score in scores[1:]:
            stay, back_to = content + cc, boiler + bc
            to, keep = content + cb, boiler + bb
            back.append((int(back_to > stay), int(keep > to)))
            content, boiler = max(stay, back_to), max(to, keep) + score
        label = int(boiler > content)
        labels = [label]
        for choice in reversed(back):
            label = choice[label]
            labels.append(label)
        return labels[::-1]

    def expect(self, scores: np.ndarray, counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chances of label 1 for each line, sums of the chances of neighbouring labels, log-weights of sequences.

        Lines are in order of their place in their sequence, and there of the sequence; sequences are in
        order of falling length, so ``counts``, how many reach each place, never rise.
        """
        node = np.split(scores, np.cumsum(counts)[:-1])
        step, last = self.step, len(counts) - 1
        ahead = [np.stack([np.full(counts[0], self.start[0]), self.start[1] + node[0]], axis=1)]
        for t in range(1, last + 1):
            before = ahead[-1][: counts[t]]
            onward = [np.logaddexp(before[:, 0] + step[0, b], before[:, 1] + step[1, b]) for b in (0, 1)]
            ahead.append(np.stack([onward[0], onward[1] + node[t]], axis=1))
        total = np.empty(counts[0])
        for t, below in enumerate([*counts[1:], 0]):
            total[below : counts[t]] = np.logaddexp(*ahead[t][below:].T)
        behind, pairs, boiler = np.zeros((counts[last], 2)), np.zeros((2, 2)), []
        for t in range(last, -1, -1):
            n = counts[t]
            boiler.append(np.exp(ahead[t][:, 1] + behind[:, 1] - total[:n]))
            if t:
                after = behind[:, 0], behind[:, 1] + node[t]
                behind = np.zeros((counts[t - 1], 2))
                for a in (0, 1):
                    for b in (0, 1):
                        pairs[a, b] += np.exp(ahead[t - 1][:n, a] + step[a, b] + after[b] - total[:n]).sum()
                    behind[:n, a] = np.logaddexp(step[a, 0] + after[0], step[a, 1] + after[1])
        return np.concatenate(boiler[::-1]), pairs, total

    def slope(self, scores: np.ndarray, counts: list[int], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradient of the log-likelihood of ``labels`` by scores, ``start`` and ``step``; order as in ``expect``."""
        boiler, pairs, _ = self.expect(scores, counts)
        held, ends = np.zeros((2, 2)), np.cumsum(counts)
        for t in range(1, len(counts)):
            before, own = labels[ends[t] - counts[t] - counts[t - 1] :][: counts[t]], labels[ends[t] - counts[t] : ends[t]]
            held += np.bincount(2 * before + own, minlength=4).reshape(2, 2)
        first = np.bincount(labels[: counts[0]], minlength=2) - [(1 - boiler[: counts[0]]).sum(), boiler[: counts[0]].sum()]
        return labels - boiler, first, held - pairs

    def fit(self, places: np.ndarray, counts: list[int], labels: np.ndarray, steps: int = STEPS) -> LineField:
        """Climb the likelihood from here, with momentum; lines are in the order that ``expect`` takes."""
        now = np.concatenate([self.weights, self.start, self.step.ravel()])
        mean, square = np.zeros_like(now), np.zeros_like(now)
        for t in range(1, steps + 1):
            field = LineField(now[:WEIGHTS], now[WEIGHTS : WEIGHTS + 2], now[WEIGHTS + 2 :].reshape(2, 2))
            by_score, by_start, by_step = field.slope(field.scores(places), counts, labels)
            by_weight = np.bincount(places.ravel(), np.repeat(by_score, places.shape[1]), minlength=WEIGHTS)
            gradient = np.concatenate([by_weight, by_start, by_step.ravel()]) / len(labels) - RIDGE * now
            mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
            now = now + 0.1 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
        return LineField(now[:WEIGHTS], now[WEIGHTS : WEIGHTS + 2], now[WEIGHTS + 2 :].reshape(2, 2))


def by_place(chunks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Lines of sequences in the order that ``LineField.expect`` takes: (places, sequence of each line, counts)."""
    lengths = np.array([len(chunk) for chunk in chunks])
    at = np.concatenate([np.arange(n) for n in lengths])
    of = np.repeat(np.arange(len(chunks)), lengths)
    order = np.lexsort((of, -lengths[of], at))
    return np.concatenate(chunks)[order], of[order], np.bincount(at).tolist()


def train(chunks: list[np.ndarray], bad: np.ndarray, rounds: int = ROUNDS) -> LineField:
    """The field of stretches of lines (places, a row a line) from good and bad documents."""
    if not bad.any() or bad.all():
        return LineField.blank()
    places, of, counts = by_place(chunks)
    suspect = bad[of]
    labels, field = suspect.astype(np.int64), LineField.blank()
    for _ in range(rounds):
        field = field.fit(places, counts, labels)
        # what the bins of a line say, against what they say of lines of good documents
        own = field.scores(places)
        labels = (suspect & (own > np.quantile(own[~suspect], 0.95))).astype(np.int64)
        if not labels.any():
            break
    return field


def learn(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, max_chunks: int = MAX_CHUNKS) -> LineField:
    """The field that documents with known quality teach."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = staged(known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "known")
    order = F.xxhash64("doc_id")
    sample = None
    for quality in (0, 1):
        some = known.where(F.col("quality") == quality).orderBy(order, "doc_id").limit(max_examples)
        sample = some if sample is None else sample.union(some)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality"))

    def cut(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "quality"))
            for doc_id, quality, text in zip(*columns, batch.column("text"), strict=True):
                places = binned(read_lines(text.as_py())[1]).astype(np.uint8)
                parts = [places[at : at + CHUNK] for at in range(0, len(places), CHUNK)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([doc_id] * len(parts), pa.int64()), "quality": pa.array([quality] * len(parts), pa.int32()),
                    "part": pa.array(range(len(parts)), pa.int32()), "lines": pa.array([p.tobytes() for p in parts], pa.binary()),
                })

    texts = texts.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"), "text")
    parts = staged(texts.mapInArrow(cut, "doc_id bigint, quality int, part int, lines binary"), "stretches")
    chunks, bad = [], []
    for quality in (0, 1):
        some = parts.where(F.col("quality") == quality).orderBy(F.xxhash64("doc_id", "part"), "doc_id", "part").limit(max_chunks)
        for lines in some.select("lines").toArrow()["lines"].to_pylist():
            chunks.append(np.frombuffer(lines, np.uint8).reshape(-1, len(BINS)).astype(np.int64))
            bad.append(quality == 0)
    return train(chunks, np.array(bad, bool))


STATISTICS = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def judge(docs: DataFrame, field: LineField, share: float = CONTENT_SHARE) -> DataFrame:
    """Base statistics of every row of ``docs``, numbers of lines and words of content, and the verdicts."""

    def read(batches):
        for batch in batches:
            group, size = [], 0
            names = batch.column("doc_id")
            for at, text in enumerate(batch.column("text")):
                group.append((at, *read_lines(text.as_py())))
                size += len(group[-1][2])
                if size >= GROUP:
                    yield marked(group, names)
                    group, size = [], 0
            if group:
                yield marked(group, names)

    def marked(group, names):
        scores = field.scores(binned([m for _, _, measures, _ in group for m in measures])).tolist()
        rows, start = [], 0
        for _, base, _, sizes in group:
            labels = field.decode(scores[start : start + len(sizes)])
            start += len(sizes)
            rows.append((*base, len(sizes), labels.count(0), sum(n for n, label in zip(sizes, labels, strict=True) if not label)))
        columns = [names.take(pa.array([at for at, *_ in group])), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    schema = f"{STATISTICS}, n_lines bigint, n_content_lines bigint, n_content_words bigint"
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(read, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    content = F.col("n_content_words") >= F.lit(share) * F.col("n_words")
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & content)


def op12(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, base rules and verdict for every document."""
    docs = docs.select("doc_id", "text")
    return judge(docs, learn(docs, labels.select("doc_id", "quality")))
