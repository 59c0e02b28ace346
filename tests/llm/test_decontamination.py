import random
import re

from shelfmark.llm import decontamination
from tests.llm.odd import documents, odd_rows, sentence

QUESTION = "A train from Bristol covers 120 km in 2 hours and then waits while Anna counts 35 sheep near the river bank"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def pairs(spark, docs, benchmark):
    found = decontamination.leaks(documents(spark, docs), items(spark, benchmark)).collect()
    return {(r.doc_id, r.item_id): r for r in found}


def test_copies_and_new_parameters_are_found_and_others_left_alone(spark):
    other = QUESTION.replace("Bristol", "Leeds").replace("120", "95").replace("2 hours", "3 hours").replace("Anna", "Omar").replace("35", "18")
    docs = [
        (1, f"Some words before it. {QUESTION} and some after."),
        (2, f"Nothing to see.\n{other}. The end."),
        (3, QUESTION.lower()),
        (4, "A train from the north covers much ground while a child counts sheep near the river bank"),
        (5, " ".join(QUESTION.split()[:9])),
        (6, None), (7, ""),
    ]
    found = pairs(spark, docs, [(10, QUESTION), (11, "Too short"), (12, None)])
    assert set(found) == {(1, 10), (2, 10), (3, 10)}
    assert found[1, 10].exact and found[3, 10].exact and not found[2, 10].exact
    assert found[1, 10].doc_pos == 4


def test_slots_must_be_bound_consistently(spark):
    item = "Carla has 5 apples and buys 5 more so that Carla then owns twice as many apples as before"
    same = item.replace("5", "7").replace("Carla", "Marta")
    mixed = item.replace("5 more", "8 more").replace("5 apples", "7 apples")
    found = pairs(spark, [(1, f"So: {same}"), (2, f"So: {mixed}")], [(1, item)])
    assert set(found) == {(1, 1)}


def test_names_that_begin_sentences_and_values_of_other_lengths(spark):
    tom = "Tom buys 3 pens. Tom sells 2 pens. How many pens does Tom have left?"
    city = "Last week a bus left New York with thirteen children and twenty five bags and came to New York again after one hour"
    shop = "Maria bakes zero cakes on Monday. Maria bakes nineteen cakes on Friday. Maria eats one. How many cakes are left?"
    benchmark = [(1, tom), (2, city), (3, shop)]
    other = city.replace("New York", "Leeds").replace("thirteen", "3").replace("twenty five", "25").replace("one", "two")
    docs = [
        (1, "Ann buys 4 pens. Ann sells 1 pens. How many pens does Ann have left?"),
        (2, f"It is said: {other}."),
        (3, city.lower()),
        (4, shop.replace("Maria", "Omar").replace("zero", "7").replace("nineteen", "twenty one").replace("one.", "2.")),
        (5, "Ann buys 4 pens. Bob sells 1 pens. How many pens does Eve have left?"),
        (6, f"Today we ask: {tom.replace('Tom', 'Mary Ann')}"),
    ]
    found = pairs(spark, docs, benchmark)
    assert set(found) == {(1, 1), (2, 2), (3, 2), (4, 3), (6, 1)}
    assert all(r.coverage == 1 for r in found.values())
    assert [found[x].exact for x in sorted(found)] == [False, False, True, False, False]


def test_equals_brute_force_without_placeholders(spark):
    rng = random.Random(7)
    benchmark = [(n, sentence(rng, rng.randrange(5, 30))) for n in range(25)]
    benchmark = [(n, re.sub(r"\d+", lambda m: "abcdefghij"[int(m.group()) % 10], t)) for n, t in benchmark]
    docs = []
    for n in range(150):
        words = re.sub(r"\d+", "", sentence(rng, rng.randrange(1, 60))).split()
        if n % 2:
            item = rng.choice(benchmark)[1].split()
            part = item[: rng.randrange(1, len(item) + 1)] if n % 4 == 1 else item
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        docs.append((n, " ".join(words)))
    expected = set()
    for doc_id, text in docs:
        words = text.split()
        windows = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        for item_id, item in benchmark:
            parts = item.split()
            covered = {i + k for i in range(len(parts) - 4) if tuple(parts[i : i + 5]) in windows for k in range(5)}
            if len(parts) > 4 and 10 * len(covered) >= 8 * len(parts):
                expected.add((doc_id, item_id))
    assert set(pairs(spark, docs, benchmark)) == expected


def test_one_changed_word_of_a_short_item(spark):
    item = "the lamp stands beside a green door while seven birds sing under that old stone bridge tonight"
    words = item.split()
    docs = [(n, " ".join(["before", *words[:n], "changed", *words[n + 1 :], "after"])) for n in range(len(words))]
    found = pairs(spark, [*docs, (99, " ".join(["before", *words[:7], "changed", *words[8:14]]))], [(1, item)])
    # what is left of the item on either side counts from five words on
    parts = {n: [part for part in (n, len(words) - n - 1) if part >= 5] for n in range(len(words))}
    assert {d for d, _ in found} == {n for n, kept in parts.items() if 10 * sum(kept) >= 8 * len(words)}


def test_letters_take_the_short_way_to_the_same_words():
    rng = random.Random(3)
    words = ["the", "The", "Anna", "anna", "two", "Two", "km", "KM", "hours", "X", "x", "Éa", "éA", "mcDonald", "½", "a1", "don't", "ªb", "İx"]
    marks = ["", ".", ",", "...", "!?", '."', "')", "***", "&&&", "%%%", "$$$", "###", "|", "-", "’s", ":)", "—", "”."]
    for _ in range(4000):
        chunk = rng.choice(["", "", "", "(", '"', "-", "$"]) + rng.choice(words) + rng.choice(marks) + rng.choice(["", "", rng.choice(words)])
        for state in (decontamination.START, decontamination.WITHIN, decontamination.COUNTED):
            assert decontamination._canonical(chunk, state) == decontamination._any_words(chunk, state), (chunk, state)


def test_odd_rows_and_clashing_columns(spark):
    rng = random.Random(1)
    rows = [(*r, 1, "a") for r in [*odd_rows(rng), (50, QUESTION), (50, QUESTION), (None, QUESTION)]]
    docs = documents(spark, rows, ", item_id int, hash string")
    left = decontamination.without_leaks(docs, items(spark, [(1, QUESTION), (1, QUESTION), (None, QUESTION)]))
    assert left.columns == docs.columns
    assert left.count() == len(rows) - 3


def test_empty_tables(spark):
    assert pairs(spark, [], [(1, QUESTION)]) == {}
    assert pairs(spark, [(1, QUESTION)], []) == {}
