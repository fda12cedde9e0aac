"""Operators on sets of keys: common, union, statistics, first-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.functions import named
from docledger.operators.joins import members

def common_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys present on both sides; NULL matches NULL. One shuffle of tagged keys."""
    sides = left.select(named(key), F.lit(1).alias("__side")).unionByName(right.select(named(key), F.lit(2).alias("__side")))
    seen = sides.groupBy(named(key)).agg(F.bit_or("__side").alias("__sides"))
    return seen.where(F.col("__sides") == 3).select(named(key))


def key_union(frames: Sequence[tuple[DataFrame, str]], name: str) -> DataFrame:
    """Distinct non-NULL keys found in any of the (frame, column) pairs."""
    union = None
    for frame, column in frames:
        part = frame.select(named(column).alias(name)).where(named(name).isNotNull()).distinct()
        union = part if union is None else union.unionByName(part)
    return union.distinct()


def key_stats(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct key counts of left, right and both, from one shuffle of tagged keys."""
    tagged = (
        left.select(named(key).alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r"))
        .unionByName(right.select(named(key).alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r")))
        .where(F.col("k").isNotNull())
    )
    seen = tagged.groupBy("k").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return seen.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_count"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_count"),
        F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).alias("common_count"),
    )


def restrict_to_first_keys(df: DataFrame, keys: DataFrame, key: str, limit: int) -> DataFrame:
    """Rows of ``df`` whose key is among the first ``limit`` keys in key order."""
    first = keys.select(named(key)).distinct().orderBy(named(key)).limit(limit)
    return members(df, first, [key])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(named(column)).distinct()
