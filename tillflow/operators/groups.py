"""Joins on keys of any frequency, and values that compare like an order of rows.

Joins leave hot keys to adaptive execution; ordered work over groups of any size is in ``scan``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.options import GroupLimits


def null_safe_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, nulls_match: bool = True
) -> DataFrame:
    """Equi join on equally named columns in which null matches null."""
    if not nulls_match:
        return left.join(right, list(on), how)
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in on])
    joined = left.join(right, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in on])


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    limits: GroupLimits | None = None,
    nulls_match: bool = True,
) -> DataFrame:
    """Join ``left``, in which a key may be hot, to ``right``; null keys match null unless told not to.

    ``how`` keeps or filters left rows: left, inner, left_semi or left_anti. For these, adaptive execution splits the
    left rows of a hot key over tasks.
    """
    return null_safe_join(left, right, on, how, nulls_match)


def order_key(order: Sequence[str]) -> Column:
    """One value that compares like ``order`` ascending with nulls last."""
    fields = []
    for i, c in enumerate(order):
        fields += [F.isnull(c).alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*fields)
