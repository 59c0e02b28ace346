"""Small tables with everything that may go wrong in a column."""

from __future__ import annotations

import random

WORDS = "the of and river stone lamp green seven walk bread under light paper north cold rain apple wheel house song".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def documents(spark, rows, extra=""):
    """Rows ``(doc_id, text, ...)`` with further columns as named in ``extra``."""
    return spark.createDataFrame(rows, "doc_id bigint, text string" + extra)


def odd_rows(rng: random.Random) -> list[tuple]:
    """Nulls, empty and blank texts, repeated rows, one id with two texts, a very long text, odd characters."""
    long = "\n".join(sentence(rng, 40) for _ in range(300))
    return [
        (1, None), (2, ""), (3, "  \n \n"), (None, "a text without id, that is long enough to be compared with others"),
        (None, "a text without id, that is long enough to be compared with others"), (None, None),
        (4, "one two three"), (4, "one two three"), (4, "another text of the same id"), (5, long), (6, long),
        (7, "x"), (8, "\x00\x1c\x1f tab\tand\x85next line 😀 ÀÉ́"), (9, "word " * 3000),
    ]
