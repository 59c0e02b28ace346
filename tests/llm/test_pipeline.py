import random

import corpus_pipeline
from tests.llm.odd import documents, sentence


def shingles(text, n):
    words = text.lower().split()
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def first_of_each(rows, n, percent):
    """The smallest doc_id of each component, by comparing all pairs."""
    sets = {doc_id: shingles(text, n) for doc_id, text in rows}
    least = {doc_id: doc_id for doc_id in sets}
    for x in sorted(sets):
        for y in sorted(sets):
            both = len(sets[x] & sets[y])
            if x < y and least[x] != least[y] and 100 * both >= percent * len(sets[x] | sets[y]):
                low, high = sorted((least[x], least[y]))
                least = {d: low if r == high else r for d, r in least.items()}
    return sorted(set(least.values()))


def test_near_copies_are_those_of_five_words_and_four_fifths(spark):
    rng = random.Random(7)
    rows = []
    for doc_id in range(0, 300, 3):
        words = sentence(rng, rng.choice([30, 50, 80, 200])).split()
        rows.append((doc_id, " ".join(words)))
        for copy in (1, 2):
            words = list(words)
            for _ in range(rng.choice([1, 1, 2, 4])):
                words[rng.randrange(len(words))] = sentence(rng, 1)
            rows.append((doc_id + copy, " ".join(words)))
    expected = first_of_each(rows, 5, 80)
    assert expected != first_of_each(rows, 3, 90)
    kept = corpus_pipeline.drop_near_copies(spark, documents(spark, rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == expected


BAD = ["grub", "wretchling", "nitwit"]
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, __key string, score double"


def made(rng):
    """Tables of a small corpus, and what should become of it: {doc_id: text that is packed}."""
    rows, labels, kept = [], [], {}

    def add(text, stays=None):
        doc_id = len(rows)
        rows.append((doc_id, text, "en", "s", len(text or ""), "x", 0.5))
        if stays is not None:
            kept[doc_id] = stays
        return doc_id

    for _ in range(120):  # clean or toxic, labelled
        words = sentence(rng, rng.randrange(30, 90)).split()
        toxic = rng.random() < 0.3
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        text = " ".join(words)
        labels.append((add(text, None if toxic else text), 1, int(toxic)))
    passage = sentence(rng, 60)
    opening, closing = sentence(rng, 40), sentence(rng, 45)
    add(f"{opening}\n{passage}", f"{opening}\n{passage}")
    add(f"{passage}\n{closing}", closing)  # the passage goes from the later document
    add(f"{passage}")  # nothing is left
    base = sentence(rng, 100).split()
    add(" ".join(base), " ".join(base))
    for at in (10, 50):  # near copies of five words and four fifths
        words = list(base)
        words[at] = "changed"
        add(" ".join(words))
    item = "Carla has 5 apples and buys 5 more so that Carla then owns twice as many apples as before"
    add(f"{sentence(rng, 30)} {item} {sentence(rng, 30)}")
    add(f"{sentence(rng, 30)} {item.replace('5', '8').replace('Carla', 'Marta')} {sentence(rng, 30)}")
    far = sentence(rng, 2500)
    add(far, far)
    return rows, labels, kept, [(1, item), (2, None), (None, "")]


def stored(spark, root, rows, labels, benchmark):
    tables = {
        "documents": spark.createDataFrame(rows, DOCUMENTS),
        "labels": spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
        "benchmark": spark.createDataFrame(benchmark, "item_id bigint, text string"),
    }
    for name, table in tables.items():
        table.write.parquet(f"{root}/{name}.parquet")
    return str(root)


def lengths(found):
    """Number of ids of each document in the result, whose pieces must be whole."""
    out = {}
    for r in sorted(found, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.start)):
        assert r.start == out.get(r.doc_id, 0)
        out[r.doc_id] = r.start + r.length
    return out


def test_run_keeps_and_packs_what_all_stages_leave(spark, tmp_path):
    from tokenizers import Tokenizer

    import public_tokenizers

    rows, labels, kept, benchmark = made(random.Random(12))
    found = corpus_pipeline.run(spark, stored(spark, tmp_path, rows, labels, benchmark)).collect()
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    want = {d: len(tokenizer.encode(text, add_special_tokens=False).ids) + 1 for d, text in kept.items()}
    assert lengths(found) == want
    assert max(r.offset + r.length for r in found) <= 2048


def test_odd_rows_pass_all_stages(spark, tmp_path):
    rng = random.Random(3)
    rows, labels, kept, benchmark = made(rng)
    odd = [(None, None), (None, "a text without an id"), (500, None), (501, ""), (502, " \n "), (503, "x"), (504, rows[0][1]), (504, rows[0][1])]
    rows += [(d, t, None, None, None, None, None) for d, t in odd]
    labels += [(None, 1, 1), (500, None, None), (10_000, 0, 1)]
    found = corpus_pipeline.run(spark, stored(spark, tmp_path, rows, labels, benchmark)).collect()
    ids = {r.doc_id for r in found}
    # without words nothing can be a copy or a leak; a copy of an earlier document goes with its lines
    assert set(kept) <= ids | {0} and {503, None} <= ids and 504 not in ids


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, stored(spark, tmp_path, [], [], [])).collect() == []
