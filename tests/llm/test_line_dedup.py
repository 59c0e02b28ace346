import random

from hypothesis import given
from hypothesis import strategies as st

from shelfmark.llm import line_dedup
from tests.llm.odd import documents, odd_rows, sentence


@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_patience_aligns_equal_lines_in_order(a, b):
    aligned = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in aligned)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(aligned, aligned[1:], strict=False))


@given(st.lists(st.integers(), unique=True, max_size=12), st.data())
def test_patience_finds_the_longest_common_order_of_unique_lines(a, data):
    b = data.draw(st.permutations(a))
    best = [1] * len(b)
    for j in range(len(b)):
        for i in range(j):
            if a.index(b[i]) < a.index(b[j]):
                best[j] = max(best[j], best[i] + 1)
    # the ends are matched first; what remains is aligned as long as can be
    assert len(line_dedup.patience(a, b)) <= max(best, default=0)
    assert line_dedup.patience(a, a) == [(i, i) for i in range(len(a))]


def content(text):
    return [line.strip(" ") for line in text.split("\n") if line.strip(" ")]


def seeds(lines, min_words):
    """The shortest runs of lines with so many words, from each line."""
    found = []
    for start in range(len(lines)):
        for end in range(start + 1, len(lines) + 1):
            if sum(len(x.split(" ")) for x in lines[start:end]) >= min_words:
                found.append(tuple(lines[start:end]))
                break
    return found


def brute(rows, min_words):
    """Texts after deletion: each document against the first holders of its runs."""
    first, result = {}, {}
    for doc_id, text in rows:
        mine = content(text)
        for run in seeds(mine, min_words):
            first.setdefault(run, doc_id)
    texts = dict(rows)
    for doc_id, text in rows:
        at = [i for i, line in enumerate(text.split("\n")) if line.strip(" ")]
        mine, gone = content(text), set()
        for partner in {first[run] for run in seeds(mine, min_words)} - {doc_id}:
            blocks = line_dedup.common_blocks(content(texts[partner]), mine, [len(x.split(" ")) for x in mine], min_words)
            gone |= {at[b] for b in blocks}
        left = [line for i, line in enumerate(text.split("\n")) if i not in gone]
        result[doc_id] = text if not gone else "\n".join(left) if any(x.strip(" ") for x in left) else ""
    return result


def shuffled_passages(rng):
    passages = ["\n".join(sentence(rng, rng.randrange(2, 30)) for _ in range(rng.randrange(1, 5))) for _ in range(6)]
    rows = []
    for doc_id in range(60):
        parts = [sentence(rng, rng.randrange(1, 20)) for _ in range(rng.randrange(1, 5))]
        for passage in rng.choices(passages, k=rng.randrange(0, 4)):
            parts.insert(rng.randrange(len(parts) + 1), passage)
        rows.append((doc_id, "\n".join(parts)))
    return rows


def test_common_blocks_go_from_the_later_document(spark):
    rows = shuffled_passages(random.Random(3))
    found = line_dedup.dedup_lines(documents(spark, rows)).collect()
    texts = {r.doc_id: r.text for r in found}
    assert texts == brute(rows, line_dedup.MIN_WORDS)
    # no run of twenty words that an earlier document has is left where it stood
    known = set()
    for doc_id, text in rows:
        lines, left = content(text), content(texts[doc_id])
        for run in seeds(lines, line_dedup.MIN_WORDS):
            if run in known and lines.count(run[0]) == 1:
                assert not any(tuple(left[i : i + len(run)]) == run for i in range(len(left))), (doc_id, run)
        known |= set(seeds(lines, line_dedup.MIN_WORDS))


def test_short_common_lines_do_not_hide_a_moved_block():
    a, b = ["P", "h1", "x", "h2"], ["h1", "y", "h2", "P"]
    assert line_dedup.common_blocks(a, b, [2, 9, 3, 60], 20) == [3]


@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14), st.integers(1, 25))
def test_common_blocks_are_all_that_two_documents_share(a, b, min_words):
    words = [2 * x + 1 for x in b]
    blocks = {tuple(a[i:k]) for i in range(len(a)) for k in range(i + 1, len(a) + 1)}
    expected = set()
    for j in range(len(b)):
        for k in range(j + 1, len(b) + 1):
            if sum(words[j:k]) >= min_words and tuple(b[j:k]) in blocks:
                expected |= set(range(j, k))
    assert line_dedup.common_blocks(a, b, words, min_words) == sorted(expected)


def test_moved_passages_go_between_frequent_short_lines(spark):
    rng = random.Random(9)
    heads, passages = [f"Notice {n}" for n in range(6)], [sentence(rng, 40) for _ in range(4)]
    rows = []
    for doc_id in range(40):
        lines = [x for head in heads for x in (head, sentence(rng, 8))]
        at = rng.randrange(len(lines) + 1)
        lines[at:at] = [sentence(rng, 8), passages[doc_id % 4], sentence(rng, 8)]
        rows.append((doc_id, "\n".join(lines)))
    found = line_dedup.dedup_lines(documents(spark, rows)).collect()
    assert {r.doc_id: r.lines_deleted for r in found} == {n: int(n > 3) for n in range(40)}


def test_the_end_of_a_block_goes_that_the_first_holder_lacks(spark):
    rng = random.Random(12)
    one, two, three = (sentence(rng, n) for n in (15, 15, 3))
    rows = [(1, f"{one}\n{two}"), (2, f"{one}\n{two}\n{three}"), (3, f"{sentence(rng, 5)}\n{one}\n{two}\n{three}")]
    found = line_dedup.dedup_lines(documents(spark, rows)).collect()
    assert {r.doc_id: r.lines_deleted for r in found} == {1: 0, 2: 2, 3: 3}


def test_a_line_that_all_documents_share_stays_in_the_first_only(spark):
    rng = random.Random(4)
    passage = sentence(rng, 60)
    rows = [(n, f"{sentence(rng, 30)}\n{passage}\n{sentence(rng, 9)}") for n in range(300)]
    found = line_dedup.dedup_lines(documents(spark, rows)).collect()
    assert [r.doc_id for r in found if passage in r.text] == [0]
    assert all(r.lines_deleted == (r.doc_id > 0) and not r.emptied for r in found)


def test_odd_rows_and_clashing_columns(spark):
    rows = [(*row, n, 5) for n, row in enumerate(odd_rows(random.Random(1)))]
    docs = documents(spark, rows, ", n_chars int, emptied int")
    left = line_dedup.without_repeats(docs)
    assert left.columns == docs.columns
    by_row = {r.n_chars if r.text is None or r.doc_id != 6 else -1: r for r in left.collect()}
    assert 6 not in {r.doc_id for r in by_row.values()}  # a copy of document 5
    assert {r.doc_id for r in by_row.values()} == {None, 1, 2, 3, 4, 5, 7, 8, 9}
    assert left.where("doc_id = 1").first().text is None
    assert left.where("doc_id = 4").count() == 3


def test_empty_table(spark):
    assert line_dedup.dedup_lines(documents(spark, [])).collect() == []
