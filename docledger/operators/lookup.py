"""Lookup enrichment from small seed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.functions import named
from docledger.operators.joins import look_up
from docledger.operators.rollup import first_per_key


def enrich(
    df: DataFrame,
    lookup: DataFrame,
    on: dict[str, str],
    take: dict[str, str],
    order_by: Sequence[str] | None = None,
    duplicates: str = "first",
) -> DataFrame:
    """Left join ``lookup`` on {df column: lookup column}, adding {lookup column: new name}.

    A key defined twice would multiply lines, so either its first row (in
    ``order_by`` order) is kept or, with ``duplicates='fail'``, the load stops.
    Whether the lookup is broadcast follows from its measured size.
    """
    keys = list(on.values())
    if duplicates == "fail":
        repeated = lookup.groupBy(*[named(c) for c in keys]).count().where(F.col("count") > 1)
        if not repeated.isEmpty():
            raise ValueError(f"lookup repeats a key of {keys}")
        unique = lookup
    else:
        unique = first_per_key(lookup, keys, order_by)
    return look_up(df, unique, list(on.items()), take)
