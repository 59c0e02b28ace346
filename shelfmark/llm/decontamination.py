"""Benchmark decontamination by templates: finds copied and re-parameterised items in documents.

Texts become words in lower case; numbers, names and units become typed placeholders. Every window of
five words of every document is hashed, as template and, where it has placeholders, also as it stands,
and joined with the windows of the benchmark. What may match is first sieved by a bit sketch of the
benchmark's windows, whose size is fixed; the join itself decides. Matches on one diagonal (the same
shift between document and item) must bind the item's slots consistently: one value of the item
always to the same value in the document. A document leaks an item when windows on consistent diagonals cover at
least 80 % of its words, so that one changed word costs one word and not all the windows that hold it.

Names are words with a capital first letter within a sentence, units are the words of ``UNITS`` after
a number and currency signs. A template window needs ``MIN_PLAIN`` word that is no placeholder.
A capital word that begins a sentence may be a name or not: its windows are hashed in both forms, and those
with it as a name count where its value is bound as elsewhere. Names that follow each other, and number words,
are one value: windows that hold such a run are also hashed with one placeholder for it, shifts count it as
one word, and a diagonal may bind whole runs or single words.

Defined cases: null and empty texts match nothing; items with fewer than ``MIN_WORDS`` words are not
searched; documents that repeat doc_id and text are one document; a repeated item_id means items
that count as one, and an item without item_id is reported under null.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Memo, maybe_in_array, release_kept, return_memory, sketch, sketch_array, staged

WINDOW = 5
COVERAGE = 0.8
MIN_WORDS = 5
MIN_PLAIN = 1
TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[%$€£¥°]")
UNITS = frozenset(
    "mm cm m km inch inches feet foot yards yard mile miles mg g kg gram grams kilogram kilograms ton tons ounce ounces "
    "pound pounds ml l liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h hr hour hours "
    "day days week weeks month months year years cent cents dollar dollars euro euros percent degree degrees "
    "meter meters metre metres kilometer kilometers kilometre kilometres mph kmh watt watts volt volts".split()
)
NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred "
    "thousand million billion".split()
)
# words that begin sentences and are no names
COMMON = frozenset(
    "a an the this that these those my your his her its our their he she it we you they who whom whose what which when where "
    "why how if as at by for from in into of on to with after before during while since until then there here so but and or "
    "nor yet not no yes each every all both some any many much most more is are was were do does did has have had can could "
    "should would let".split()
)
NUMBER, NAME, UNIT = (np.uint64(n) for n in (1, 2, 3))  # no word has such a small hash in practice
START, WITHIN, COUNTED = 0, 1, 2  # where a word stands: first in its sentence, within it, after a number
MIX = np.uint64(0x9E3779B97F4A7C15)
OPEN, CLOSED, DIGITS = (np.uint64(n) for n in (1, 2, 4))  # nothing before a word, nothing after it, digits
BEHIND = ".,;:!?\"'”’)]}|*&#"  # marks behind a word that are no words themselves
ENDS = ".!?:;|"  # marks that end sentences
STANDS, TYPED, BEGINS = 0, 1, 2  # forms of a window: as it stands, as template, with names that begin sentences
GROUP = 1 << 15  # words that are hashed in one go


def _canonical(chunk: str, state: int) -> tuple[bytes, int]:
    """Four hashes or marks for each word of a chunk without spaces, and the state after it."""
    word = chunk.rstrip(BEHIND)
    return _one_word(chunk, word, state) if word.isalpha() else _any_words(chunk, state)


def _one_word(chunk: str, word: str, state: int) -> tuple[bytes, int]:
    """As ``_any_words``, for a chunk of letters only with marks behind them: most chunks."""
    plain = word.lower()
    raw = kind = begins = xxhash.xxh3_64_intdigest(plain)
    marks = (int(OPEN) if state != START else 0) | (int(CLOSED) if len(word) == len(chunk) else 0)
    here = WITHIN
    if plain in NUMBERS:
        kind = begins = int(NUMBER)
        here = COUNTED
    elif state == COUNTED and plain in UNITS:
        kind = begins = int(UNIT)
    elif len(word) > 1 and word[0].isupper() and word[1:].islower():
        kind = raw if state == START else int(NAME)
        begins = raw if state == START and plain in COMMON else int(NAME)
    if len(word) != len(chunk) and chunk.rstrip("\"'”’)]}")[-1:] in ENDS:
        here = START
    return struct.pack("=4Q", kind, raw, begins, marks), here


def _any_words(chunk: str, state: int) -> tuple[bytes, int]:
    out, here, end = [], state, 0
    for match in TOKEN.finditer(chunk):
        word = match.group()
        plain = word.lower()
        raw = xxhash.xxh3_64_intdigest(plain)
        open_ = chunk[end : match.start()] in ("", "-")
        if not open_ and out:
            out[-1] &= ~int(CLOSED)
        end = match.end()
        marks = (int(OPEN) if open_ and here != START else 0) | int(CLOSED)
        if word[0].isdigit() or plain in NUMBERS:
            out += [int(NUMBER), raw, int(NUMBER), marks | (int(DIGITS) if word[0].isdigit() else 0)]
            here = COUNTED
            continue
        begins = raw
        if word[0] in "%$€£¥°" or (here == COUNTED and plain in UNITS):
            kind = begins = int(UNIT)
        elif len(word) > 1 and word[0].isupper() and word[1:].islower():
            kind = int(NAME) if here != START else raw
            begins = raw if here == START and plain in COMMON else int(NAME)
        else:
            kind = raw
        out += [kind, raw, begins, marks]
        here = WITHIN
    if out and end != len(chunk):
        out[-1] &= ~int(CLOSED)
    if chunk.rstrip("\"'”’)]}")[-1:] in ENDS or (not out and here == WITHIN):
        here = START
    return np.array(out, np.uint64).tobytes(), here


def _memos() -> tuple[Memo, ...]:
    def make(state):
        return Memo(lambda chunk: _canonical(chunk, state))

    return tuple(make(state) for state in (START, WITHIN, COUNTED))


def templates(text: str | None, memos: tuple[Memo, ...]) -> np.ndarray:
    """Four columns for the words of a text: template and plain hash, template if sentences begin with names, marks."""
    out = []
    for line in (text or "").split("\n"):
        state = START
        for chunk in line.split():
            words, state = memos[state][chunk]
            out.append(words)
    return np.frombuffer(b"".join(out), np.uint64).reshape(-1, 4)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _folded(kinds: np.ndarray, raw: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of names or of numbers with a number word are one value: first words of runs, run of each word, values."""
    joined = (kinds[1:] == kinds[:-1]) & (marks[1:] & OPEN > 0) & (marks[:-1] & CLOSED > 0)
    joined &= (kinds[1:] == NAME) | ((kinds[1:] == NUMBER) & (marks[1:] & marks[:-1] & DIGITS == 0))
    start = np.flatnonzero(np.r_[True, ~joined])
    run = np.cumsum(np.r_[False, ~joined])
    sums = np.add.reduceat(_mixed(raw * MIX + (np.arange(len(raw)) - start[run]).astype(np.uint64)), start)
    return start, run, np.where(np.diff(np.r_[start, len(raw)]) > 1, sums, raw[start])


def _hashed(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    h = np.zeros(len(at), np.uint64)
    for k in range(WINDOW):
        h = _mixed(h * MIX + words[at + k])
    return h


def _typed(kinds: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which windows have placeholders and enough plain words."""
    plain = np.r_[0, np.cumsum(kinds == values)]
    plain = plain[at + WINDOW] - plain[at]
    return (plain < WINDOW) & (plain >= MIN_PLAIN)


def windows(words: np.ndarray, owner: np.ndarray):
    """Windows of texts as (form, places, span, hash, kinds, values, words): ``owner`` numbers the text of each word.

    ``places`` are first words, ``span`` the words that a window covers. The last three have a row a window.
    """
    if len(words) < WINDOW:
        return
    kinds, raw, begins, marks = (np.ascontiguousarray(words[:, c]) for c in range(4))
    around = np.arange(WINDOW)

    def rows(form, places, span, h, kinds, values, raws, at):
        def chosen(some):
            each = at[some][:, None] + around
            return form, places[some], span[some], h[some], kinds[each], values[each], raws[each]

        return h, chosen

    every = np.flatnonzero(owner[: 1 - WINDOW] == owner[WINDOW - 1 :])
    five = np.full(len(every), WINDOW)
    begin = np.r_[0, np.cumsum(kinds != begins)]
    names = begin[every + WINDOW] > begin[every]
    folded = [(kinds, *_folded(kinds, raw, marks)), (begins, *_folded(begins, raw, marks))]
    (_, _, run, values), (_, _, late_run, late) = folded
    yield rows(STANDS, every, five, _hashed(raw, every), kinds, values[run], raw, every)
    at = every[_typed(kinds, raw, every)]
    yield rows(TYPED, at, five, _hashed(kinds, at), kinds, values[run], raw, at)
    at = every[names]
    at = at[_typed(begins, raw, at)]
    yield rows(BEGINS, at, five, _hashed(begins, at), begins, late[late_run], raw, at)
    for form, (sort, start, _, value) in zip((TYPED, BEGINS), folded, strict=True):
        if len(start) < WINDOW or len(start) == len(raw):
            continue
        end = np.r_[start[1:], len(raw)]
        first, span = start[: 1 - WINDOW], end[WINDOW - 1 :] - start[: 1 - WINDOW]
        use = (span > WINDOW) & (owner[first] == owner[end[WINDOW - 1 :] - 1])
        if form == BEGINS:
            use &= begin[first + span] > begin[first]
        at, sort = np.flatnonzero(use), sort[start]
        at = at[_typed(sort, value, at)]
        yield rows(form, start[at], span[at], _hashed(sort, at), sort, value, value, at)


WINDOWS = "pos int, step int, span int, form int, hash bigint, words array<bigint>, values array<bigint>, plain array<bigint>"
COLUMNS = [column.split()[0] for column in WINDOWS.split(", ")]


def _window_batches(texts, known: np.ndarray | None = None):
    """For groups of texts: (number of the text of each window, columns of ``WINDOWS``), sieved by ``known``."""
    memos, group, size = _memos(), [], 0

    def done():
        words = np.concatenate([w for _, w in group])
        owner = np.repeat(np.arange(len(group)), [len(w) for _, w in group])
        first = np.cumsum([0, *(len(w) for _, w in group)])
        run = None
        for h, chosen in windows(words, owner):
            some = np.flatnonzero(maybe_in_array(known, h)) if known is not None else np.arange(len(h))
            if not len(some):
                continue
            form, at, span, h, *lists = chosen(some)
            if run is None:
                run = _folded(words[:, 0], words[:, 1], words[:, 3])[1]
            begin = first[owner[at]]
            columns = [pa.array(x, pa.int32()) for x in (at - begin, run[at] - run[begin], span, np.full(len(at), form))]
            columns.append(pa.array(h.view(np.int64)))
            columns += [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel().view(np.int64)), WINDOW).cast(pa.list_(pa.int64())) for x in lists]
            yield [group[n][0] for n in owner[at].tolist()], columns

    for name, text in texts:
        words = templates(text, memos)
        if len(words) < WINDOW:
            continue
        group.append(((name, len(words)), words))
        size += len(words)
        if size >= GROUP:
            yield from done()
            group, size = [], 0
    if group:
        yield from done()


def item_windows(benchmark: DataFrame) -> DataFrame:
    """``(item_id, n_words, pos, hash, words, plain)`` of the items with at least ``MIN_WORDS`` words."""

    def read(batches):
        for batch in batches:
            texts = zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
            for names, columns in _window_batches(texts):
                columns = [pa.array([x for x, _ in names], pa.int64()), pa.array([n for _, n in names], pa.int32()), *columns]
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "n_words", *COLUMNS])

    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text IS NOT NULL")
    return items.mapInArrow(read, f"item_id bigint, n_words int, {WINDOWS}")


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``(doc_id, text_hash, item_id, coverage, exact, doc_pos)``: which document leaks which item.

    ``exact`` is false where slots hold other values; ``doc_pos`` is the first matching word.
    """
    items = staged(item_windows(benchmark), "item-windows")
    sieve = docs.sparkSession.sparkContext.broadcast(sketch_array(sketch(items, "hash")))

    def read(batches):
        release_kept()
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash")), strict=True)
            texts = ((row, text.as_py()) for row, text in zip(rows, batch.column("text"), strict=True))
            for names, columns in _window_batches(texts, sieve.value):
                columns = [*(pa.array([x[c] for x, _ in names], pa.int64()) for c in (0, 1)), *columns]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", *COLUMNS])
        return_memory()

    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    found = texts.mapInArrow(read, f"doc_id bigint, text_hash bigint, {WINDOWS}")
    matches = found.withColumnsRenamed({c: f"doc_{c}" for c in COLUMNS if c != "hash"}).join(
        items.withColumnsRenamed({c: f"item_{c}" for c in COLUMNS if c != "hash"}), "hash"
    )

    def slots(kind, of):  # what the item has and what the document has there, for placeholders of the item
        return F.expr(f"""transform(filter(sequence(0, {WINDOW - 1}), k -> item_words[k] <> item_values[k]),
            k -> named_struct('item', item_{kind}[k], 'doc', {of}_{kind}[k]))""")

    stands = F.col("item_form") == STANDS
    shifted = matches.select(
        "doc_id", "text_hash", "item_id", "n_words", "item_pos", "doc_pos",
        (F.col("doc_step") - F.col("item_step")).alias("shift"),
        (F.greatest("item_form", "doc_form") == BEGINS).alias("begins"),
        (F.greatest("item_span", "doc_span") > WINDOW).alias("wide"),
        F.expr("sequence(item_pos, item_pos + item_span - 1)").alias("covers"),
        F.when(stands, slots("values", "item")).otherwise(slots("values", "doc")).alias("slots"),
        F.when(stands, slots("plain", "item")).otherwise(slots("plain", "doc")).alias("singles"),
    )

    def every(condition, column):
        return F.array_distinct(F.flatten(F.collect_set(F.when(F.expr(condition), F.col(column)))))

    diagonals = shifted.groupBy("doc_id", "text_hash", "item_id", "shift").agg(
        F.max("n_words").alias("n_words"),
        F.min(F.when(~F.col("begins"), F.col("doc_pos"))).alias("doc_pos"),
        every("NOT begins", "covers").alias("found"),
        every("NOT begins AND NOT wide", "covers").alias("narrow"),
        every("NOT begins", "slots").alias("pairs"),
        every("NOT begins AND NOT wide", "singles").alias("singles"),
        every("begins", "slots").alias("more"),
        F.collect_set(F.when(F.col("begins"), F.struct("covers", "slots", "doc_pos"))).alias("starts"),
    )

    def consistent(pairs):
        return F.expr(f"size(array_distinct(transform({pairs}, x -> x.item))) = size({pairs})")

    # a window with a name that begins a sentence counts where no other value is bound to what it binds
    agreeing = F.expr("""filter(starts, w -> forall(w.slots, s -> array_contains(pairs, s)
        OR NOT exists(concat(pairs, more), p -> p.item = s.item AND p.doc <> s.doc)))""")
    diagonals = diagonals.withColumn("runs_agree", consistent("pairs")).withColumn("words_agree", consistent("singles"))
    diagonals = diagonals.withColumn("starts", F.when(F.col("runs_agree"), agreeing).otherwise(F.expr("filter(starts, w -> false)")))
    diagonals = diagonals.select(
        "doc_id", "text_hash", "item_id", "n_words",
        F.expr("""array_distinct(concat(flatten(starts.covers),
            CASE WHEN runs_agree THEN found WHEN words_agree THEN narrow ELSE filter(found, x -> false) END))""").alias("found"),
        F.expr("""forall(if(runs_agree, pairs, singles), x -> x.item = x.doc)
            AND forall(flatten(starts.slots), x -> x.item = x.doc)""").alias("exact"),
        F.expr("least(if(runs_agree OR words_agree, doc_pos, NULL), array_min(starts.doc_pos))").alias("doc_pos"),
    )
    whole = F.size(F.array_distinct(F.flatten(F.collect_set("found")))) / F.max("n_words")
    return (
        diagonals.where(F.size("found") > 0)
        .groupBy("doc_id", "text_hash", "item_id")
        .agg(whole.alias("coverage"), F.bool_and("exact").alias("exact"), F.min("doc_pos").alias("doc_pos"))
        .where(F.col("coverage") >= coverage)
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that leak no item."""
    found = leaks(docs.select("doc_id", "text"), benchmark, coverage)
    bad = found.select(F.struct("doc_id", "text_hash").alias("__key")).distinct()
    key = F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    return docs.withColumn("__key", key).join(bad, "__key", "left_anti").drop("__key")


def op7(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Each document with each item that it leaks."""
    return leaks(docs.select("doc_id", "text"), benchmark).drop("text_hash")
