"""Aggregate expressions: conditional counts, percentages, tiers."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(cond: Column) -> Column:
    """Rows of the group for which ``cond`` holds; zero if none does."""
    return F.count(F.when(cond, 1))


def pct(part: Column, whole: Column, places: int = 2) -> Column:
    """``part`` in percent of ``whole``, rounded half up in exact decimals.

    NULL when ``whole`` is zero. Returned as double so that results compare
    and store like any other measure.
    """
    rate = F.expr("100.0BD") * part / F.nullif(whole, F.lit(0))
    return F.round(rate, places).cast("double")


def tier(c: Column, floors: Sequence[tuple[int, str]], rest: str) -> Column:
    """Label of the first floor that ``c`` reaches; ``floors`` descend."""
    expr = F.when(F.lit(False), rest)
    for floor, label in floors:
        expr = expr.when(c >= floor, label)
    return expr.otherwise(rest)
