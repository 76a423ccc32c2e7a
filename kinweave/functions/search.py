"""Placing a value among sorted boundaries inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def interval_of(value: Column, bounds: list) -> Column:
    """Number of ``bounds`` (ascending) that are <= ``value``, as a balanced tree of comparisons."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < F.lit(bounds[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(bounds))
