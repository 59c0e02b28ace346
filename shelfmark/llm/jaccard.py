"""N-gram Jaccard join with prefix trees: components of documents whose shingle sets nearly agree.

A document's set holds hashes of its word n-grams in one global order, that of the hash. Candidates
come from runs of that order: two sets that are similar enough differ in so few n-grams that, cut into
more runs than that, they agree in at least one whole run. Runs are ordered by how many documents have them, and
each set leaves out its most common ones, as many as it has more than a set of its own size needs. Only sets that share the hash of a
run that both keep can be linked; they form clusters. Within a cluster the sets are stored in a trie, ordered by how common
an n-gram is among their differences from the usual set; each set walks it once, so that sets with a common beginning share the counting of their overlap, and
a subtree is left as soon as what remains cannot reach the overlap needed, or when all of it is
already connected to the walking set. Clusters beyond ``CELL`` n-grams are cut into chunks of sets that
share runs with the same small set. What is not connected by the joins within chunks is compared across them:
a set visits those chunks where a set of another component shares a run with it, and no others.

Equal sets are one set throughout, so copies cost nothing. No link between different sets is lost;
sets and n-grams are told apart by 64-bit hashes.

Defined cases: a null or empty text, or one without words, has the empty set and is its own component;
with fewer words than ``n`` the whole sequence is the one n-gram. Documents without doc_id count as
members, but name no component; a component without any doc_id has a null name.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Memo, components, join_counted, maybe_in, release_kept, return_memory, sketch, staged
from shelfmark.sources.tables import drop_table

N = 3
PERCENT = 90
SLACK = 3  # more runs than needed, so that sets with an empty run still agree in a full one
SPARE = 4  # and one more for so many, so that sets can leave out the most common ones
CELL = 1_000_000  # n-grams of a chunk, and of the visitors of a chunk that meet it in one trie, about
SLICE = 512  # documents whose keys are handed on together
KEY_SLICE = 1 << 28  # characters of texts whose keys are shuffled at once, about: keys are taken slice by slice
BUNDLE = 256  # sets of a branch that is not split further
SET_WEIGHT = 1_000  # n-grams that a set counts for besides its own, since sets are compared in pairs
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def shingles(text: str | None, n: int, memo: Memo) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams, A-Z in lower case."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = min(n, len(words))
    h = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        h = mixed(h * MIX + ids[k : len(words) - n + 1 + k])
    return np.unique(h)


def runs(size: int, percent: int) -> tuple[int, int]:
    """For sets of at most ``size`` n-grams: in how many they can differ, and the number of runs."""
    differ = 2 * size * (100 - percent) // (100 + percent)
    return differ, differ + 1 + SLACK + differ // SPARE


def run_keys(s: np.ndarray, percent: int) -> tuple[np.ndarray, list[int]]:
    """Hashes of the whole runs of a set, for its own size class and the next if a partner may be there.

    The last bit of a key is that of its size class. The numbers tell for either bit how many keys a set may leave
    out, if all sets leave out their last ones in the same order of keys, and still agree with each partner in one:
    a partner differs in so many runs at most, so it agrees in all others that are full.
    """
    largest, spare = 100 * len(s) // percent, [0, 0]
    if (len(s) + largest) * (100 - percent) // (100 + percent) < 1:
        return np.zeros(0, np.int64), spare  # such a small set is linked with equal ones only
    keys, scrambled = [], mixed(s)
    for size_class in {len(s).bit_length(), largest.bit_length()}:
        top = (1 << size_class) - 1
        _, m = runs(top, percent)
        differ = (len(s) + min(largest, top)) * (100 - percent) // (100 + percent)  # from a partner of that class
        run = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        start = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        names, sums = run[start], np.add.reduceat(scrambled, start)
        if len(names) <= differ:  # too few full runs to be sure of one: empty ones count as well
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), names)
            names, sums = np.r_[names, empty], np.r_[sums, np.zeros(len(empty), np.uint64)]
        else:
            spare[size_class & 1] = len(names) - differ - 1
        h = mixed(sums * MIX + mixed(names + np.uint64(size_class << 32)))
        keys.append((h & ~np.uint64(1)) | np.uint64(size_class & 1))
    return np.concatenate(keys).view(np.int64), spare


def _set_id(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def key_slices(docs: DataFrame) -> list[str]:
    """Columns that hold the keys of sets, each those of one range of keys: as many as the size of the texts asks for."""
    length = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return [f"keys_{n}" for n in range(1 + length // KEY_SLICE)]


def shingle_sets(docs: DataFrame, n: int, percent: int, slices: Sequence[str]) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, set_id, spare)`` and the keys of every document; set_id is null for empty sets."""

    def sets(batches):
        release_kept()
        memo = word_hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                yield slice_sets(batch.slice(at, SLICE), memo)
        memo.clear()
        return_memory()

    def slice_sets(batch, memo):
        sizes, ids, keys, spares = [], [], [], []
        for text in batch.column("text"):
            s = shingles(text.as_py(), n, memo)
            sizes.append(len(s))
            ids.append(_set_id(s) if len(s) else None)
            found, spare = run_keys(s, percent)
            keys.append(found)
            spares.append(spare)
        columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64())]
        columns.append(pa.array(spares, pa.list_(pa.int32())))
        owner, flat = np.repeat(np.arange(len(keys)), [len(k) for k in keys]), np.concatenate(keys)
        place = ((flat.view(np.uint64) >> np.uint64(32)) * np.uint64(len(slices))) >> np.uint64(32)
        for k in range(len(slices)):
            here = place == k
            ends = np.r_[0, np.cumsum(np.bincount(owner[here], minlength=len(keys)))]
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat[here])))
        return pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "text_hash", "n_shingles", "set_id", "spare", *slices]
    schema = "doc_id bigint, text_hash bigint, n_shingles bigint, set_id bigint, spare array<int>"
    schema += "".join(f", {name} array<bigint>" for name in slices)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(sets, schema)


class Trie:
    """Sets as a prefix tree, each as its differences from what most of them have.

    Two sets that differ little from a third differ little from each other, and their differences from
    it are far shorter than they are: |x ^ y| = |(x ^ c) ^ (y ^ c)|. N-grams are ordered by how many
    differences have them, most first, so that prefixes are shared; those of one set alone count for
    its length only. A node is the run that its sets share and the range of its sets; small branches
    are not split further, but looked at in one go.
    """

    def __init__(self, sets: list[np.ndarray]):
        ids, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        usual = 2 * counts > len(sets)
        held = np.where(usual, len(sets) - counts, counts)
        rank = np.empty(len(ids), np.int64)
        rank[np.argsort(-held, kind="stable")] = np.arange(len(ids))
        consensus, cuts = np.flatnonzero(usual), np.cumsum([len(s) for s in sets])[:-1]
        differences = [np.setxor1d(p, consensus, assume_unique=True) for p in np.split(places, cuts)]
        found = [np.sort(rank[d[held[d] > 1]]) for d in differences]
        self.order = sorted(range(len(sets)), key=lambda n: found[n].astype(">u4").tobytes())
        self.runs = runs = [found[n] for n in self.order]
        self.sizes = np.array([len(sets[n]) for n in self.order])
        self.differ = np.array([len(differences[n]) for n in self.order])
        lengths = np.array([len(r) for r in runs])
        self.size = len(ids)
        # run, first and last set, sizes of sets, least difference, longest run from the root, depth,
        # children, leaves
        self.nodes = []
        todo: list = [(0, len(runs), 0, None)]
        while todo:
            lo, hi, depth, parent = todo.pop()
            a, b = runs[lo][depth:], runs[hi - 1][depth:]
            m = min(len(a), len(b))
            other = np.flatnonzero(a[:m] != b[:m])
            end = depth + (int(other[0]) if len(other) else m)
            children: list[int] = []
            leaves: list[np.ndarray] = []
            if parent is not None:
                parent.append(len(self.nodes))
            sizes = self.sizes[lo:hi]
            self.nodes.append((
                runs[lo][depth:end], lo, hi, int(sizes.min()), int(sizes.max()),
                int(self.differ[lo:hi].min()), int(lengths[lo:hi].max()), end, children, leaves,
            ))
            if hi - lo <= BUNDLE or len(runs[lo]) == len(runs[hi - 1]) == end:
                rests = [r[end:] for r in runs[lo:hi]]
                leaves += [np.arange(lo, hi), np.concatenate(rests), np.r_[0, np.cumsum([len(r) for r in rests])]]
                continue
            at = start = lo
            while at < hi:  # neighbouring branches are taken together up to a bundle
                low, high = at, hi
                if len(runs[at]) == end:
                    while low < hi and len(runs[low]) == end:
                        low += 1
                    high = low
                else:
                    first = runs[at][end]
                    while high - low > 1:
                        mid = (low + high) // 2
                        low, high = (mid, high) if runs[mid][end] == first else (low, mid)
                if high - start > BUNDLE and at > start:
                    todo.append((start, at, end, children))
                    start = at
                at = high
            todo.append((start, hi, end, children))

    def join(self, labels: np.ndarray, left: np.ndarray, percent: int) -> np.ndarray:
        """Connect linked sets whose labels differ, one of them in ``left``; labels become those of components."""
        labels, left = labels[self.order], left[self.order]
        changes = np.r_[0, np.cumsum(labels[1:] != labels[:-1])]
        lefts = np.r_[0, np.cumsum(left)]
        mine = np.zeros(self.size, bool)
        for i, x in enumerate(self.runs):
            n, size, own = len(x), int(self.sizes[i]), int(self.differ[i])
            mine[x] = True
            todo = [(0, 0)]
            while todo:
                node, overlap = todo.pop()
                run, lo, hi, least, most, shortest, longest, depth, children, leaves = self.nodes[node]
                if hi <= i + 1 or 100 * most < percent * size or 100 * size < percent * least:
                    continue
                if changes[hi - 1] == changes[lo] and labels[lo] == labels[i]:
                    continue
                if not left[i] and lefts[hi] == lefts[lo]:
                    continue
                overlap += int(np.count_nonzero(mine[run]))
                # linked sets differ in so many n-grams at most, so their differences share so many at least
                needed = (own + shortest - (size + most) * (100 - percent) // (100 + percent) + 1) // 2
                rest = n - int(np.searchsorted(x, run[-1], side="right")) if len(run) else n
                if overlap + min(rest, longest - depth) < needed:
                    continue
                todo.extend((child, overlap) for child in children)
                if not leaves:
                    continue
                below, flat, ends = leaves
                counted = np.r_[0, np.cumsum(mine[flat])][ends]
                shared = overlap + counted[1:] - counted[:-1]
                total = size + self.sizes[below]
                both = (total - (own + self.differ[below] - 2 * shared)) // 2
                linked = (100 * both >= percent * (total - both)) & (below > i) & (left[i] | left[below])
                for j in below[linked & (labels[below] != labels[i])].tolist():
                    if labels[j] != labels[i]:
                        labels[labels == labels[j]] = labels[i]
                        changes = np.r_[0, np.cumsum(labels[1:] != labels[:-1])]
            mine[x] = False
        after = np.empty_like(labels)
        after[self.order] = labels
        return after


def _cell_join(n: int, percent: int):
    """Links within one cell as (a, b): each set with one that stands for its component."""

    def join(table: pa.Table) -> pa.Table:
        release_kept()
        memo = word_hashes()
        rows = zip(*(table[c].to_pylist() for c in ("set_id", "label", "left")), table["text"], strict=True)
        known: dict[int, tuple[np.ndarray, int]] = {}
        marked = set()
        for set_id, label, left, text in rows:
            if set_id not in known:
                known[set_id] = shingles(text.as_py(), n, memo), label
            if left:
                marked.add(set_id)
        ids = sorted(known)
        _, labels = np.unique([known[x][1] for x in ids], return_inverse=True)
        after = Trie([known[x][0] for x in ids]).join(labels, np.array([x in marked for x in ids]), percent)
        first: dict[int, int] = {}
        for label, x in zip(after.tolist(), ids, strict=True):
            first.setdefault(label, x)
        links = [(x, first[label]) for label, x in zip(after.tolist(), ids, strict=True) if x != first[label]]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})

    return join


def _common_runs(sets: DataFrame, keys: str, total: int) -> DataFrame:
    """``(set_id, spare, key, n)``: keys of one slice that different sets share, and how many documents have each."""
    rows = sets.where(F.size(keys) > 0).select("set_id", "spare", F.explode(keys).alias("key"))
    rows = rows.select("set_id", "key", F.get("spare", F.col("key").bitwiseAND(F.lit(1)).cast("int")).alias("spare"))
    shared = rows.groupBy("key").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high"), F.count("*").alias("n"))
    shared = staged(shared.where("low < high").select("key", "n"), "shared-runs")
    some = maybe_in(rows, sketch(shared, "key"), "key")
    common = staged(join_counted(some, shared, "key", "n", total).where("n IS NOT NULL"), "common-runs")
    drop_table(shared)
    return common


def _kept_runs(sets: DataFrame, slices: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(set_id, key)`` of the runs that sets keep and share, and ``(key, hub, n)``: the first set of each, and how many have it.

    In one global order, by how many documents have a run, every set leaves out its last runs, as many as it may
    spare: those of common lines and passages, which would chain unlike sets. All keys together are far more than
    those that sets share; they are shuffled a slice at a time, so that only few lie on disk twice.
    """
    totals = sets.agg(*(F.sum(F.size(keys)) for keys in slices)).first()
    found = [_common_runs(sets, keys, total or 0) for keys, total in zip(slices, totals, strict=True)]
    common = reduce(DataFrame.union, found)
    listed = common.groupBy("set_id", F.col("key").bitwiseAND(F.lit(1)).alias("bit")).agg(
        F.sort_array(F.collect_set(F.struct("n", "key"))).alias("runs"), F.max("spare").alias("spare")
    )
    kept = F.expr("slice(runs, 1, greatest(size(runs) - spare, 0))")
    kept = staged(listed.select("set_id", F.explode(kept).alias("run")).select("set_id", "run.key", "run.n"), "kept-runs")
    for table in found:
        drop_table(table)
    hubs = kept.groupBy("key").agg(F.min("set_id").alias("hub"), F.max("set_id").alias("last"), F.count("*").alias("n"))
    hubs = staged(hubs.where("hub < last").select("key", "hub", "n"), "hubs")
    return kept.drop("n"), hubs


def _with_text(cells: DataFrame, docs: DataFrame) -> DataFrame:
    """``cells`` with a text for each ``text_hash``: texts are smaller to move than their n-grams."""
    hashed = docs.where("text IS NOT NULL").select(F.xxhash64("text").alias("text_hash"), "text")
    texts = maybe_in(hashed, sketch(cells, "text_hash"), "text_hash").groupBy("text_hash").agg(F.first("text").alias("text"))
    return cells.join(texts, "text_hash")


def linked_sets(docs: DataFrame, sets: DataFrame, kept: DataFrame, hubs: DataFrame, n: int, percent: int, cell: int = CELL) -> DataFrame:
    """``(node, root)``: connected components of linked sets; sets without links are not listed."""
    edges = join_counted(kept, hubs, "key", "n", kept.count()).where("hub IS NOT NULL AND hub <> set_id")
    edges = staged(edges.select(F.col("set_id").alias("a"), F.col("hub").alias("b")).distinct(), "edges")
    # the smallest set that a set shares a run with by a hub: alike sets mostly name the same one
    stars = edges.groupBy(F.col("a").alias("set_id")).agg(F.least("set_id", F.min("b")).alias("star"))
    known = sets.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("text_hash").alias("text_hash"), F.max("n_shingles").alias("size"))
    members = components(edges).withColumnRenamed("node", "set_id").join(known, "set_id").join(stars, "set_id", "left")
    members = staged(members.withColumn("star", F.coalesce("star", "set_id")), "members")
    weight = F.sum(F.col("size") + SET_WEIGHT)
    weights = members.groupBy("root").agg(weight.alias("weight"), F.count("*").alias("n"))
    chunks = F.when(F.col("weight") <= cell, 1).otherwise(F.ceil(F.col("weight") * 2 / cell)).cast("int")
    members = join_counted(members, weights.select("root", "n", chunks.alias("chunks")), "root", "n", members.count()).drop("n")
    members = staged(members, "members")
    large = members.where("chunks > 1").groupBy("star").agg(weight.alias("weight"), F.count("*").alias("n"))
    large = staged(large.where(F.col("weight") * 2 > cell).select("star", "n", F.ceil(F.col("weight") / cell).cast("int").alias("parts")), "stars")
    # large stars have chunks of their own, the others share some; chunks that clash would only be one
    part = F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int")
    own = F.xxhash64("star", part).bitwiseOR(F.lit(1 << 40))
    chunk = F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("star"), F.col("chunks"))).otherwise(own)
    members = join_counted(members, large, "star", "n", members.count()).withColumn("chunk", chunk).drop("star", "n", "parts")
    members = staged(members, "members")
    schema, join = "a bigint, b bigint", _cell_join(n, percent)
    columns = ["root", "chunk", "set_id", "text_hash"]
    whole = members.select(*columns, F.col("set_id").alias("label"), F.lit(True).alias("left"))
    # the set that a star shares runs with meets each part of it
    parts = large.where("parts > 1").select(F.col("star").alias("set_id"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    pivots = members.drop("chunk").join(parts, "set_id").withColumn("chunk", F.xxhash64("set_id", "part").bitwiseOR(F.lit(1 << 40)))
    pivots = pivots.select(*columns, F.col("set_id").alias("label"), F.lit(True).alias("left"))
    links = _with_text(whole.union(pivots), docs).groupBy("root", "chunk").applyInArrow(join, schema)
    links = staged(links, "links")
    cut = members.where("chunks > 1").drop("chunks")
    if cut.isEmpty():
        return components(links)
    labels = components(links).select(F.col("node").alias("set_id"), F.col("root").alias("label"))
    cut = cut.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    cut = staged(cut, "cut")
    main = cut.groupBy("root", "label").agg(F.count("*").alias("n"))
    main = main.groupBy("root").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("parts"), F.sum("n").alias("n"))
    rest = join_counted(cut, main.where("parts > 1"), "root", "n", cut.count()).where("parts IS NOT NULL")
    rest = staged(rest.withColumn("left", F.col("label") != F.col("main")).drop("main", "parts", "n"), "rest")
    columns = ["root", "chunk", "set_id", "text_hash", "label"]
    visits = _visits(kept, rest)
    guests = visits.join(rest.select("set_id", "text_hash", "label", "size"), "set_id")
    rooms = guests.groupBy("root", "chunk").agg(F.ceil(weight / cell).cast("int").alias("rooms"))
    room = F.pmod(F.xxhash64("set_id"), F.col("rooms")).cast("int").alias("room")
    guests = guests.join(rooms, ["root", "chunk"]).select(*columns, room, F.lit(True).alias("left"))
    rooms = rooms.withColumn("room", F.explode(F.sequence(F.lit(0), F.col("rooms") - 1)))
    hosts = rest.join(rooms, ["root", "chunk"]).select(*columns, "room", F.lit(False).alias("left"))
    more = _with_text(guests.union(hosts), docs).groupBy("root", "chunk", "room").applyInArrow(join, schema)
    return components(links.union(staged(more, "links")))


def _visits(kept: DataFrame, rest: DataFrame) -> DataFrame:
    """``(set_id, root, chunk)``: the other chunks where sets outside their cluster's main component may find a link.

    There, a set of another component shares a run with it. Sets of the main component visit none, and of two
    others the one of the lower chunk visits, so that all pairs meet that may be linked and are not connected.
    """
    places = staged(kept.join(rest.select("set_id", "root", "chunk", "label", "left"), "set_id"), "places")
    there = places.groupBy("key", "chunk").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.bool_or(~F.col("left")).alias("main"), F.count("*").alias("n")
    )
    there = there.groupBy("key").agg(
        F.collect_list(F.struct("chunk", "low", "high", "main")).alias("chunks"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")
    )
    there = staged(there.where("low < high AND size(chunks) > 1").select("key", "chunks", "n"), "places-by-run")
    met = join_counted(places.where("left"), there, "key", "n", places.count()).where("chunks IS NOT NULL")
    wanted = F.expr("filter(chunks, c -> c.chunk <> chunk AND (c.low <> label OR c.high <> label) AND (c.main OR c.chunk > chunk)).chunk")
    visits = staged(met.select("set_id", "root", F.explode(wanted).alias("chunk")).distinct(), "visits")
    for spent in (places, there):
        drop_table(spent)
    return visits


def jaccard_components(docs: DataFrame, n: int = N, percent: int = PERCENT, cell: int = CELL) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, component_id, first)`` of every row of ``docs``.

    Documents are linked when 100 * intersection >= ``percent`` * union; a component is named by its
    smallest doc_id. ``first`` marks the rows of its first document by (doc_id, text_hash), nulls last.
    """
    slices = key_slices(docs)
    keyed = staged(shingle_sets(docs, n, percent, slices), "keyed-sets")
    kept, hubs = _kept_runs(keyed, slices)
    sets = staged(keyed.drop("spare", *slices), "sets")
    drop_table(keyed)  # its keys are by far the largest table
    linked = linked_sets(docs, sets, kept, hubs, n, percent, cell).withColumnRenamed("node", "set_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    known = sets.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min(order).alias("least"), F.count("*").alias("n"))
    known = staged(known.join(linked, "set_id", "left").where("n > 1 OR root IS NOT NULL"), "known")
    named = known.groupBy(F.coalesce("root", "set_id").alias("root")).agg(F.min("least").alias("leader"))
    groups = known.select("set_id", "n", F.coalesce("root", "set_id").alias("root")).join(named, "root").drop("root")
    found = join_counted(sets, groups, "set_id", "n", sets.count())
    alone = F.col("leader").isNull()
    return found.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("leader.doc_id")).alias("component_id"),
        (alone | (order == F.col("leader"))).alias("first"),
    )


def keep_first(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """The first document of each component; rows that repeat doc_id and text are one document."""
    found = jaccard_components(docs.select("doc_id", "text"), n, percent).where("first")
    kept = found.select(F.struct("doc_id", "text_hash").alias("__key")).distinct()
    key = F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    return docs.withColumn("__key", key).join(kept, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")


def op9(docs: DataFrame) -> DataFrame:
    """The component of every document."""
    return jaccard_components(docs.select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")
