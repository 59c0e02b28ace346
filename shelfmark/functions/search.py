"""Binary search in a short sorted list, as a Column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_below(value: Column, ordered: Sequence[str]) -> Column:
    """How many members of the sorted list are smaller than ``value``.

    A fold over halving steps: log2(n) comparisons a row where a filter over the list needs n. The
    list travels as one literal.
    """
    if not ordered:
        return F.when(value.isNotNull(), F.lit(0))
    steps = [1 << bit for bit in reversed(range(len(ordered).bit_length()))]
    members = F.lit(list(ordered))
    found = F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda below, step: F.when(
            # get() is NULL past the end, which counts as not smaller
            F.get(members, below + step - F.lit(1)) < value,
            below + step,
        ).otherwise(below),
    )
    return F.when(value.isNotNull(), found)
