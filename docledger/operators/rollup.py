"""Line-to-document rollup, group totals and per-key first rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.functions import named
from docledger.operators.joins import null_safe_on


class Agg(Enum):
    SUM = "SUM"
    FIRST = "FIRST"
    SET = "SET"


def rollup(df: DataFrame, key: Sequence[str], spec: Mapping[str, Agg], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: SUM adds, FIRST takes the first row's value (NULL included)
    in ``order_by`` order, SET joins distinct non-empty values, descending, by ``|``.

    All FIRST columns ride in one minimum over (order, values), so ties cannot
    mix rows and the map side already reduces each key to one candidate.
    """
    firsts = [c for c, how in spec.items() if how is Agg.FIRST]
    if firsts and not order_by:
        raise ValueError("FIRST needs order_by: a frame has no row order of its own")

    aggregates = []
    for name, how in spec.items():
        if how is Agg.SUM:
            aggregates.append(F.sum(named(name)).alias(name))
        elif how is Agg.SET:
            values = F.collect_set(F.nullif(named(name).cast("string"), F.lit("")))
            aggregates.append(F.array_join(F.sort_array(values, asc=False), "|").alias(name))
    if firsts:
        order = [named(c).alias(f"o{i}") for i, c in enumerate(order_by)]
        picked = [named(c).alias(f"v{i}") for i, c in enumerate(firsts)]
        aggregates.append(F.min(F.struct(*order, *picked)).alias("__first"))

    rolled = df.groupBy(*[named(c) for c in key]).agg(*aggregates)
    slot = {c: F.col(f"__first.v{i}") for i, c in enumerate(firsts)}
    return rolled.select(
        *[named(c) for c in key if c not in spec],
        *[slot.get(c, named(c)).alias(c) for c in spec],
    )


def with_group_total(df: DataFrame, key: Sequence[str], amount: str, name: str) -> DataFrame:
    """Sum of ``amount`` over the key group on every row; NULL keys form a group.

    Equal to a windowed sum with an unbounded frame, but aggregated before the
    shuffle and joined back, so a hot key is summed on the map side and its
    rows can be split by adaptive skew-join handling. The totals, a narrow row a
    key, are the hashed side: the wide rows are not sorted.
    """
    totals = df.groupBy(*[named(c) for c in key]).agg(F.sum(named(amount)).alias(name))
    totals = totals.select(name, *[named(c).alias(f"__key_{i}") for i, c in enumerate(key)]).hint("shuffle_hash")
    pairs = [(c, f"__key_{i}") for i, c in enumerate(key)]
    return df.join(totals, null_safe_on(df, totals, pairs), "left").drop(*[b for _, b in pairs])


def first_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """The first whole row of each key in ``order_by`` order (default: all columns)."""
    rest = [c for c in df.columns if c not in key]
    order = [named(c).alias(f"o{i}") for i, c in enumerate(order_by or rest)]
    values = [named(c).alias(f"v{i}") for i, c in enumerate(rest)]
    picked = df.groupBy(*[named(c) for c in key]).agg(F.min(F.struct(*order, *values)).alias("__row"))
    slot = {c: F.col(f"__row.v{i}") for i, c in enumerate(rest)}
    return picked.select(*[slot.get(c, named(c)).alias(c) for c in df.columns])
