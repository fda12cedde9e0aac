"""Joins against reduced key sets and lookups, safe for hot keys on either side.

The small side is first reduced to one row per key, which the map side already
does most of. It is then joined by null-safe equality: that gives the reduced
side an exchange of its own, and adaptive execution splits a skewed partition
only between two plain exchanges. Small sides still become broadcasts by their
measured size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame

from docledger.functions import named


def null_safe_on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(and_, [left[f"`{a}`"].eqNullSafe(right[f"`{b}`"]) for a, b in pairs])


def _without_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(reduce(and_, [named(c).isNotNull() for c in columns]))


def members(df: DataFrame, keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key columns occur in ``keys``; NULL is no member."""
    wanted = _without_nulls(keys, columns).select(*[named(c).alias(f"__k_{i}") for i, c in enumerate(columns)])
    wanted = wanted.distinct()
    pairs = [(c, f"__k_{i}") for i, c in enumerate(columns)]
    return df.join(wanted, null_safe_on(df, wanted, pairs), "left_semi")


def look_up(
    df: DataFrame, unique: DataFrame, on: Sequence[tuple[str, str]], take: dict[str, str], how: str = "left"
) -> DataFrame:
    """Add ``take`` ({column: new name}) from a frame with one row per key."""
    side = _without_nulls(unique, [b for _, b in on]).select(
        *[named(b).alias(f"__k_{i}") for i, (_, b) in enumerate(on)],
        *[named(c).alias(new) for c, new in take.items()],
    )
    pairs = [(a, f"__k_{i}") for i, (a, _) in enumerate(on)]
    return df.join(side, null_safe_on(df, side, pairs), how).drop(*[b for _, b in pairs])
