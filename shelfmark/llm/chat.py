"""Chat formatting: a hidden Markov model recovers who speaks, then turns are rendered canonically.

A text may be one turn or a whole transcript: it is cut before every line that begins with a speaker marker, and
lines without one stay with the speaker before them. What is left uncut is a line of the model below. Each shows a
speaker marker, if any, its length, its number of lines and whether it asks. From lines with known roles the model counts how roles follow each other and what their
lines show. Roles of all lines are then recovered by Viterbi, never looking at a given role.

Lines are sorted by conversation and cut into parts of about ``PART_ROWS`` lines wherever they fall. A
conversation may thus lie in several parts: each part sums up its first and last conversation as a table
of best scores between a role before and a role at the end, so that the roles at the cuts can be chosen
from these tables alone; then every part recovers its own lines. No conversation has to fit in a task.

Defined cases: a given role of a text that holds several turns teaches nothing, since it is not known whose it is.
Lines without conversation are one conversation, named null; lines are ordered by turn,
nulls first, then by a hash of their text and by their place in it; a null text is an empty line; roles other than ``ROLES`` and their
``ALIASES`` teach nothing; without any known role the markers decide. Repeated rows are lines of their own.
Of several equally likely sequences of roles one is taken; which one may depend on where parts end.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import staged

ROLES = ("system", "user", "assistant")
ALIASES = {
    "system": ("system", "instruction", "instructions", "developer"),
    "user": ("user", "human", "customer", "question", "q", "prompter", "client"),
    "assistant": ("assistant", "bot", "ai", "agent", "answer", "a", "model", "gpt"),
}
NAMES = {alias: n for n, role in enumerate(ROLES) for alias in ALIASES[role]}
MARKER = r"(?i)^\s*(?:<\|?|\[|\*\*|#+\s*)?(" + "|".join(sorted(NAMES, key=lambda x: (-len(x), x))) + r")\s*(?:\|?>|\]|:\s*\*\*|\*\*\s*:|:|\s*>)\s*"
# Before a line that begins with a marker.
TURN = "(?i)\\n(?=[ \\t]*" + MARKER.removeprefix(r"(?i)^\s*").removesuffix(r"\s*") + ")"
SIZES = 14  # classes of length, by powers of two
LINE_COUNTS = 4
SHAPES = 4 * SIZES * LINE_COUNTS * 2
SMOOTHING = 0.5
MARKER_COUNTS = 50.0  # as if so many lines of each role had shown their own marker
PART_ROWS = 20_000
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def canonical_role(role: Column) -> Column:
    """Index of a role in ``ROLES`` by its name or alias, else null."""
    name = F.lower(F.trim(role))
    known = F.lit(None).cast("int")
    for n, r in enumerate(ROLES):
        known = F.when(name.isin(*ALIASES[r]), F.lit(n)).otherwise(known)
    return known


def shape(text: Column) -> Column:
    """What a line shows, as one number: marker, length class, number of lines, question."""
    text = F.coalesce(text, F.lit(""))
    marker = F.coalesce(canonical_role(F.regexp_extract(text, MARKER, 1)) + 1, F.lit(0))
    size = F.least(F.floor(F.log2(F.length(text) + 1)), F.lit(SIZES - 1)).cast("int")
    lines = F.least(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))), F.lit(LINE_COUNTS - 1))
    asks = F.trim(text).endswith("?").cast("int")
    return (((marker * SIZES + size) * LINE_COUNTS + lines) * 2 + asks).cast("int")


class RoleModel:
    """Log probabilities of first roles, of roles after roles, and of what lines show."""

    def __init__(self, starts: np.ndarray, steps: np.ndarray, shapes: np.ndarray):
        n = len(ROLES)
        self.start = np.log((starts + SMOOTHING) / (starts + SMOOTHING).sum())
        self.step = np.log((steps + SMOOTHING) / (steps + SMOOTHING).sum(axis=1, keepdims=True))
        counts = shapes.reshape(n, 4, SIZES, LINE_COUNTS, 2).astype(float)
        marker = counts.sum(axis=(2, 3, 4)) + SMOOTHING
        for r in range(n):
            marker[r, r + 1] += MARKER_COUNTS
            marker[r, 0] += MARKER_COUNTS
        # features are taken as independent given the role
        parts = [marker, *(counts.sum(axis=axes) + SMOOTHING for axes in ((1, 3, 4), (1, 2, 4), (1, 2, 3)))]
        logs = [np.log(p / p.sum(axis=1, keepdims=True)) for p in parts]
        self.emit = (
            logs[0][:, :, None, None, None] + logs[1][:, None, :, None, None] + logs[2][:, None, None, :, None] + logs[3][:, None, None, None, :]
        ).reshape(n, SHAPES)

    def table(self, shapes: np.ndarray, first: bool) -> np.ndarray:
        """Best scores of these lines from each role before them (or the start) to each role at their end."""
        if first:
            best = np.tile(self.start + self.emit[:, shapes[0]], (len(ROLES), 1))
        else:
            best = self.step + self.emit[:, shapes[0]]
        for s in shapes[1:]:
            best = (best[:, :, None] + self.step[None]).max(axis=1) + self.emit[:, s]
        return best

    def decode(self, shapes: np.ndarray, before: int | None, end: int | None) -> list[int]:
        """The best roles of these lines, after role ``before`` (or at the start) and up to role ``end``."""
        best = (self.start if before is None else self.step[before]) + self.emit[:, shapes[0]]
        back = []
        for s in shapes[1:]:
            scores = best[:, None] + self.step
            back.append(scores.argmax(axis=0))
            best = scores.max(axis=0) + self.emit[:, s]
        roles = [int(best.argmax()) if end is None else end]
        for pointers in reversed(back):
            roles.append(int(pointers[roles[-1]]))
        return roles[::-1]


def _lines(lines: DataFrame) -> DataFrame:
    """Lines in order, cut into parts: ``(part, at, conv, turn, piece, text, shape, known)``."""
    whole = F.coalesce("text", F.lit(""))
    cut = lines.select("conv_id", "turn", "known", F.xxhash64(whole).alias("row"), F.split(whole, TURN).alias("pieces"))
    cut = cut.withColumn("copy", F.monotonically_increasing_id())  # keeps the lines of repeated rows apart
    named = cut.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("bigint").alias("turn"), "row", "copy",
        F.when(F.size("pieces") == 1, F.col("known")).alias("known"), F.posexplode("pieces").alias("piece", "text"),
    )
    named = staged(named.withColumn("shape", shape(F.col("text"))), "turns")
    parts = max(1, -(-named.count() // PART_ROWS))
    order = ["conv", "turn", "row", "copy", "piece"]
    dealt = named.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("row", "copy")
    return staged(dealt.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "lines")


def _runs(convs: list) -> list[tuple[int, int]]:
    """First and last positions of the conversations in a sorted list."""
    cuts = [0, *(n for n in range(1, len(convs)) if convs[n] != convs[n - 1]), len(convs)]
    return list(zip(cuts, cuts[1:], strict=False))


def _count(table: pa.Table) -> pa.Table:
    """Counts of one part, and its first and last line, which may have neighbours in other parts."""
    table = table.sort_by("at")
    convs, known, shapes = (table[c].to_pylist() for c in ("conv", "known", "shape"))
    part, n = table["part"][0].as_py(), len(convs)
    counts: dict[tuple, int] = {}
    for i in range(n):
        if known[i] is None:
            continue
        keys = [("shape", known[i], shapes[i])]
        if i and convs[i] == convs[i - 1]:
            keys += [("step", known[i - 1], known[i])] if known[i - 1] is not None else []
        elif i:
            keys.append(("start", known[i], 0))
        for key in keys:
            counts[key] = counts.get(key, 0) + 1
    rows = [(part, kind, a, b, c, None, None) for (kind, a, b), c in counts.items()]
    rows.append((part, "edge", known[0], known[-1], n, convs[0], convs[-1]))
    types = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string()]
    names = ["part", "kind", "a", "b", "n", "first", "last"]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def fit(parts: DataFrame) -> tuple[RoleModel, list]:
    """Count over all lines with a known role; also the first and last conversation of each part, in order."""
    found = parts.select("part", "at", "conv", "known", "shape").groupBy("part").applyInArrow(
        _count, "part int, kind string, a int, b int, n bigint, first string, last string"
    )
    found = staged(found, "role-counts")
    starts, steps, shapes = np.zeros(3), np.zeros((3, 3)), np.zeros((3, SHAPES))
    for r in found.where("kind <> 'edge'").groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect():
        {"start": starts, "step": steps[r.a], "shape": shapes[r.a]}[r.kind][r.a if r.kind == "start" else r.b] += r.n
    # one row a part
    edges = found.where("kind = 'edge'").orderBy("part").collect()
    for before, edge in zip([None, *edges], edges, strict=False):
        if edge.a is not None and (before is None or before.last != edge.first):
            starts[edge.a] += 1
        elif edge.a is not None and before.b is not None:
            steps[before.b, edge.a] += 1
    return RoleModel(starts, steps, shapes), edges


def _roles_at_cuts(parts: DataFrame, model: RoleModel, edges: list) -> dict[int, tuple]:
    """For each part: whether its first line continues a conversation and after which role, and whether
    its last line is continued and with which role it must end.

    Tables of the conversations that are cut, at most two a part, decide.
    """
    joined = [a.last == b.first for a, b in zip(edges, edges[1:], strict=False)]
    from_before = {b.part: j for b, j in zip(edges[1:], joined, strict=False)} | {e.part: False for e in edges[:1]}
    to_next = {a.part: j for a, j in zip(edges, joined, strict=False)} | {e.part: False for e in edges[-1:]}
    if not any(joined):
        return {e.part: (False, None, False, None) for e in edges}

    def summed(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        part, convs, shapes = table["part"][0].as_py(), table["conv"].to_pylist(), table["shape"].to_numpy()
        rows = []
        for lo, hi in {_runs(convs)[0], _runs(convs)[-1]}:
            if (lo == 0 and from_before[part]) or (hi == len(convs) and to_next[part]):
                scores = model.table(shapes[lo:hi], not (lo == 0 and from_before[part]))
                rows.append((part, lo, hi == len(convs), scores.ravel().tolist()))
        types = [pa.int32(), pa.int64(), pa.bool_(), pa.list_(pa.float64())]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "lo", "ends", "scores"])

    tables = parts.select("part", "at", "conv", "shape").groupBy("part").applyInArrow(summed, "part int, lo bigint, ends boolean, scores array<double>")
    rows = tables.orderBy("part", "lo").collect()
    ends: dict[int, int] = {}
    chain: list = []

    def choose():
        """Viterbi over the pieces of one conversation."""
        best, back = np.array(chain[0].scores).reshape(3, 3)[0], []
        for piece in chain[1:]:
            scores = best[:, None] + np.array(piece.scores).reshape(3, 3)
            back.append(scores.argmax(axis=0))
            best = scores.max(axis=0)
        role = int(best.argmax())
        for piece, pointers in zip(reversed(chain), [*reversed(back), None], strict=True):
            if piece.ends and to_next[piece.part]:
                ends[piece.part] = role
            role = int(pointers[role]) if pointers is not None else role

    for row in rows:
        if not (row.lo == 0 and from_before[row.part]):
            chain = []
        chain.append(row)
        if not (row.ends and to_next[row.part]):
            choose()
    number = {e.part: n for n, e in enumerate(edges)}
    before = {p: ends[edges[number[p] - 1].part] if from_before[p] else None for p in number}
    return {p: (from_before[p], before[p], to_next[p], ends.get(p)) for p in number}


def rendered(text: str, role: int, before: int | None, last: bool) -> str:
    """A line's piece of the canonical transcript; the pieces of a conversation in order make it up."""
    body = re.sub(MARKER, "", text, count=1).strip().replace("<|", "< |")
    if role == before:
        opened = "\n"
    else:
        opened = ("" if before is None else CLOSE) + f"{OPEN}{ROLES[role]}\n"
    return opened + body + (CLOSE if last else "")


def format_chats(lines: DataFrame) -> DataFrame:
    """``(conv_id, turn, piece, role, starts, rendered)`` of every line of ``lines (conv_id, turn, text, known)``.

    ``piece`` numbers the lines that a text was cut into, from 0.

    ``known`` is the index of a role to learn from, or null. ``starts`` marks the lines that begin a
    turn of the canonical transcript.
    """
    parts = _lines(lines)
    model, edges = fit(parts)
    cuts = _roles_at_cuts(parts, model, edges)

    def read(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        convs, texts, shapes = table["conv"].to_pylist(), table["text"].to_pylist(), table["shape"].to_numpy()
        joined, before, goes_on, end = cuts[table["part"][0].as_py()]
        roles, starts, pieces = [], [], []
        for lo, hi in _runs(convs):
            role = before if lo == 0 and joined else None
            open_end = hi == len(convs) and goes_on
            for i, found in enumerate(model.decode(shapes[lo:hi], role, end if open_end else None), lo):
                roles.append(ROLES[found])
                starts.append(found != role)
                pieces.append(rendered(texts[i], found, role, i == hi - 1 and not open_end))
                role = found
        return pa.table({"conv_id": table["conv"], "turn": table["turn"], "piece": table["piece"], "role": pa.array(roles, pa.string()), "starts": pa.array(starts, pa.bool_()), "rendered": pa.array(pieces, pa.string())})

    found = parts.select("part", "at", "conv", "turn", "piece", "text", "shape").groupBy("part").applyInArrow(
        read, "conv_id string, turn bigint, piece int, role string, starts boolean, rendered string"
    )
    return found.withColumn("conv_id", F.col("conv_id").cast(lines.schema["conv_id"].dataType))


def held_out(conv_id: Column) -> Column:
    """Conversations whose roles are never learned from: a fifth."""
    return F.coalesce(F.crc32(conv_id.cast("string").cast("binary")) % 5, F.lit(0)) == 0


def op10(conversations: DataFrame) -> DataFrame:
    """Recovered role and canonical rendering of every turn; given roles of a fifth are never seen."""
    known = F.when(~held_out(F.col("conv_id")), canonical_role(F.col("role"))).alias("known")
    found = format_chats(conversations.select("conv_id", "turn", "text", known))
    return found.withColumn("held_out", held_out(F.col("conv_id")))
