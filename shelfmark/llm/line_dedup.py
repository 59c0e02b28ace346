"""Line dedup by pairwise alignment: common blocks of lines go from the later of two documents.

What founds a pair is a shared line that is rare because it is long: at each line begins, and at each ends,
a run of as many lines as have ``min_words`` words together, and the run's hash points every document that
holds it at the first that does. That makes pairs in proportion to the lines, however many documents share
one, and each line of a block of so many words that occurs in an earlier document is in such a run. The lines of each pair
are aligned by patience diff: common beginnings and ends, then lines that occur once on both sides, in
their longest common order, and the same again between these; where only repeated lines are left, the first of
one side goes with the first of the other. Aligned lines that follow each other on both
sides make a block; blocks of at least ``min_words`` words are deleted from the later document, and the
rest is aligned again until nothing is found, as blocks may have changed places. A moved block that short
lines outvote in every alignment is found by its runs at the end, so none of so many words is left.

Documents are ordered by (doc_id, hash of the text), nulls first. Defined cases: a null text stays
null, an empty one empty; blank lines are neither compared nor deleted; rows that repeat doc_id and
text count as one document and get the same result; rows of one doc_id with other texts are documents
of their own. A document of which only blank lines are left gets the empty text.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections import Counter, defaultdict

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import join_counted, release_kept, return_memory, staged

MIN_WORDS = 20  # of a block that is deleted
ROWS_PER_COPY = 10_000  # pairs with one first document that share a copy of its lines


def _ordered(positions: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs (i, j), sorted by i, in which j rises."""
    tails, ends, back = [], [], [None] * len(positions)
    for n, (_, j) in enumerate(positions):
        at = bisect_left(tails, j)
        back[n] = ends[at - 1] if at else None
        tails[at:at + 1], ends[at:at + 1] = [j], [n]
    chain, n = [], ends[-1] if ends else None
    while n is not None:
        chain.append(positions[n])
        n = back[n]
    return chain[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of two sequences, rising on both sides."""
    aligned, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            aligned.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            aligned.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at = {h: j for j, h in enumerate(b[b0:b1], b0) if in_b[h] == 1}
        anchors = _ordered([(i, at[h]) for i, h in enumerate(a[a0:a1], a0) if in_a[h] == 1 and h in at])
        if not anchors:  # repeated lines only: the first of one side with the first of the other, and so on
            places = defaultdict(list)
            for j in range(b1 - 1, b0 - 1, -1):
                places[b[j]].append(j)
            anchors = _ordered([(i, places[a[i]].pop()) for i in range(a0, a1) if places.get(a[i])])
        if anchors:
            aligned += anchors
            edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(aligned)


def spans(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(start, end) of the shortest runs of lines with at least ``min_words`` words, one from and one to each line."""
    found, start, end, total = [], 0, 0, 0
    for start in range(len(words)):
        while total < min_words and end < len(words):
            total += words[end]
            end += 1
        if total < min_words:
            break
        found.append((start, end))
        total -= words[start]
    start, total = 0, 0
    for end in range(len(words)):
        total += words[end]
        while total - words[start] >= min_words:
            total -= words[start]
            start += 1
        if total >= min_words:
            found.append((start, end + 1))
    return found


def common_blocks(a: list[int], b: list[int], words: list[int], min_words: int) -> list[int]:
    """Positions in ``b`` of common blocks with at least ``min_words`` words; ``words`` belong to ``b``.

    An alignment may prefer many short lines to one long block that moved. What no round has aligned is
    found by its runs: each line of a common block is in a shortest run, from its first line or to its
    last one, that lies within the block.
    """
    left, found = list(range(len(b))), []
    while True:
        more, block, last = [], [], (-2, -2)
        aligned = [(i, left[j]) for i, j in patience(a, [b[j] for j in left])]
        for i, j in [*aligned, (-9, -9)]:
            if (i, j) != (last[0] + 1, last[1] + 1):
                if sum(words[n] for n in block) >= min_words:
                    more += block
                block = []
            block.append(j)
            last = (i, j)
        if not more:
            break
        found += more
        gone = set(more)
        left = [j for j in left if j not in gone]
    if left:
        of = dict(zip(b, words, strict=True))
        held = {tuple(a[i:k]) for i, k in spans([of.get(h, 0) for h in a], min_words) if all(h in of for h in a[i:k])}
        for j, k in spans(words, min_words):
            if tuple(b[j:k]) in held:
                found += range(j, k)
    return sorted(set(found))


def runs(hashes: list[int], words: list[int], min_words: int) -> set[int]:
    """Hashes of the shortest runs of lines with at least ``min_words`` words, one from and one to each line."""
    return {xxhash.xxh3_64_intdigest(struct.pack(f"{end - start}q", *hashes[start:end])) - (1 << 63) for start, end in spans(words, min_words)}


def _run_reader(min_words: int):
    def read(batches):
        release_kept()
        for batch in batches:
            keys, out = [], []
            for n, lines in enumerate(batch.column("lines").to_pylist()):
                some = [x for x in lines if x["words"]]
                found = sorted(runs([x["hash"] for x in some], [x["words"] for x in some], min_words))
                keys += [n] * len(found)
                out += found
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(keys, pa.int64())), pa.array(out, pa.int64())], ["key", "hash"])
        return_memory()

    return read


def _aligner(min_words: int):
    def align(batches):
        for batch in batches:
            keys, out = batch.column("key"), []
            for later, first in zip(batch.column("later"), batch.column("first_lines"), strict=True):
                lines = [x for x in later.as_py() if x["words"]]
                blocks = common_blocks(
                    [x["hash"] for x in first.as_py() if x["words"]], [x["hash"] for x in lines], [x["words"] for x in lines], min_words
                )
                out.append([lines[n]["pos"] for n in blocks])
            yield pa.RecordBatch.from_arrays([keys, pa.array(out, pa.list_(pa.int32()))], ["key", "deleted"])
        return_memory()

    return align


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(key, deleted)``: line positions to delete from each document that loses some.

    ``key`` is the struct (doc_id, xxhash64 of the text).
    """
    trimmed = "trim(BOTH FROM l)"
    lines = f"""transform(split(text, '\n'), (l, i) -> named_struct('pos', i, 'hash', xxhash64({trimmed}), 'words',
        if({trimmed} = '', 0, length({trimmed}) - length(replace({trimmed}, ' ', '')) + 1)))"""
    every = docs.where("text IS NOT NULL").select(document_key().alias("key"), F.expr(lines).alias("lines"))
    every = staged(every, "lines")
    once = every.dropDuplicates(["key"])
    held = staged(once.mapInArrow(_run_reader(min_words), "key struct<doc_id:bigint,hash:bigint>, hash bigint"), "runs")
    holders = held.groupBy("hash").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1")
    pairs = join_counted(held.select("hash", "key"), holders, "hash", "n", held.count())
    pairs = staged(pairs.where("first IS NOT NULL AND key > first").select("key", "first").distinct(), "pairs")
    partners = pairs.groupBy("first").agg(F.count("*").alias("n"))
    copies = F.ceil(F.col("n") / ROWS_PER_COPY).cast("int")
    # the lines of a first document of many pairs are copied, so that its pairs need not meet in one task
    firsts = partners.join(once.withColumnRenamed("key", "first"), "first").select(
        "first", F.col("lines").alias("first_lines"), F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy")
    )
    placed = join_counted(pairs, partners, "first", "n", pairs.count())
    placed = placed.withColumn("copy", F.pmod(F.xxhash64("key"), copies).cast("int")).drop("n")
    both = placed.join(once.withColumnRenamed("lines", "later"), "key").join(firsts, ["first", "copy"])
    aligned = both.select("key", "later", "first_lines").mapInArrow(
        _aligner(min_words), "key struct<doc_id:bigint,hash:bigint>, deleted array<int>"
    )
    found = aligned.where(F.size("deleted") > 0).groupBy("key").agg(F.collect_set("deleted").alias("deleted"))
    return found.select("key", F.array_distinct(F.flatten("deleted")).alias("deleted"))


def document_key():
    return F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("hash"))


def _dedup(docs: DataFrame, min_words: int) -> DataFrame:
    """``docs`` with the new text, the number of deleted lines and whether only blank ones are left."""
    found = deletions(docs, min_words).select(F.col("key").alias("__key"), F.col("deleted").alias("__deleted"))
    joined = docs.withColumn("__key", document_key()).join(found, "__key", "left")
    # only texts that lose lines go through Python
    cut = F.pandas_udf(_without, "string")(F.when(F.col("__deleted").isNotNull(), F.col("text")), F.col("__deleted"))
    joined = joined.withColumn("__left", cut)
    text = F.when(F.col("__deleted").isNull(), F.col("text")).otherwise(F.col("__left"))
    columns = [text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    count = F.coalesce(F.size("__deleted"), F.lit(0)).alias("__count")
    return joined.select(*columns, count, F.coalesce(F.col("__left") == "", F.lit(False)).alias("__emptied"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of ``docs`` with the deleted lines gone from ``text``.

    Two columns are added: ``lines_deleted`` (int) and ``emptied`` (boolean: it lost lines, and only
    blank ones are left).
    """
    return _dedup(docs, min_words).withColumnsRenamed({"__count": "lines_deleted", "__emptied": "emptied"})


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the deleted lines gone, and without the documents that this empties.

    A column ``n_chars`` is brought up to date.
    """
    left = _dedup(docs, min_words).where("NOT __emptied")
    if "n_chars" in docs.columns:
        n = F.when(F.col("__count") > 0, F.length("text")).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))
    return left.select(*(f"`{c}`" for c in docs.columns))


def _without(texts: pd.Series, deleted: pd.Series) -> pd.Series:
    """Texts without the lines at these positions, or the empty text if only blank lines are left."""

    def cut(text, positions):
        if text is None:
            return None
        gone = set(positions)
        left = [line for n, line in enumerate(text.split("\n")) if n not in gone]
        return "\n".join(left) if any(line.strip(" ") for line in left) else ""

    return pd.Series([cut(t, p) for t, p in zip(texts, deleted, strict=True)], dtype=object)


def op2(docs: DataFrame) -> DataFrame:
    """The text of every document without the lines that earlier documents have."""
    return dedup_lines(docs.select("doc_id", "text"))
