"""Row positions, in-group ordinals and running totals without a one-task window.

Spark's window without a partition key sends every row to one task, and a
window whose key is hot does the same to that key's rows. The helpers here
number rows inside ranges and add the offset of the ranges before.

Positions and totals sort the frame; its layout is checkpointed first, as a
recomputed sample could shift the ranges between their two uses. Ordinals need
no sorted frame: the places where hot keys are cut are constants of the plan, so
every use of them agrees, and rows are laid out once by (key, range).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docledger.functions import named
from docledger.session import checkpoint

SAMPLED_PER_RANGE = 20
_ROW_BITS = 33


def _offsets(parts: DataFrame, amount: str) -> DataFrame:
    # One row per range partition, so this window is bounded by the shuffle width.
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        F.col("__pid").alias("__opid"),
        F.coalesce(F.sum(amount).over(before), F.lit(0)).alias("__offset"),
    )


def with_position(df: DataFrame, order_by: Sequence[str], name: str = "position") -> DataFrame:
    """Global 1-based position in ``order_by`` order, as a long."""
    return numbered(df.orderBy(*[named(c) for c in order_by]), name)


def numbered(ordered: DataFrame, name: str = "position") -> DataFrame:
    """1-based place of every row of a frame that has just been sorted, as a long."""
    laid = checkpoint(ordered.withColumn("__id", F.monotonically_increasing_id()))
    laid = laid.withColumn("__pid", F.shiftright("__id", _ROW_BITS)).withColumn(
        "__row", F.col("__id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    offsets = _offsets(laid.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n")), "__n")
    return (
        laid.join(F.broadcast(offsets), F.col("__pid") == F.col("__opid"))
        .withColumn(name, F.col("__row") + F.col("__offset") + 1)
        .drop("__id", "__pid", "__row", "__opid", "__offset")
    )


def running_total(df: DataFrame, order_by: Sequence[str], amount: str, name: str) -> DataFrame:
    """Inclusive running sum of ``amount`` over the whole frame in ``order_by`` order.

    ``order_by`` must identify a row.
    """
    keys = [named(c) for c in order_by]
    laid = checkpoint(df.repartitionByRange(*keys).withColumn("__pid", F.spark_partition_id()))
    offsets = _offsets(laid.groupBy("__pid").agg(F.sum(named(amount)).alias("__n")), "__n")
    within = Window.partitionBy("__pid").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    return (
        laid.withColumn("__run", F.sum(named(amount)).over(within))
        .join(F.broadcast(offsets), F.col("__pid") == F.col("__opid"))
        .withColumn(name, F.col("__run") + F.col("__offset"))
        .drop("__pid", "__run", "__opid", "__offset")
    )


def _place(key: Sequence[str], order_by: Sequence[str]) -> Column:
    """Where a row stands: its key, then its place in the key's group."""
    k = F.struct(*[named(c).alias(f"c{i}") for i, c in enumerate(key)])
    return F.struct(k.alias("k"), F.struct(*[named(c).alias(f"c{i}") for i, c in enumerate(order_by)]).alias("o"))


def range_bounds(df: DataFrame, key: Sequence[str], order_by: Sequence[str], ranges: int) -> Column | None:
    """Places, ascending and as one constant, at which groups of more than a range's share of the rows are cut.

    Of ``ranges`` - 1 places that cut all rows evenly, those count that share
    their key with a neighbour. They come from a sample of bounded size, drawn
    in one pass over the key and order columns alone. Whatever they are, they
    only decide how even the work gets.
    """
    per = SAMPLED_PER_RANGE
    sampled = df.select(_place(key, order_by).alias("s")).orderBy(F.rand(7)).limit(per * ranges)
    ordered = sampled.agg(F.sort_array(F.collect_list("s")).alias("s"))
    cuts = ordered.select(F.array_distinct(F.filter("s", lambda _, i: i % per == per - 1)).alias("s"))

    def same(x: Column, i: Column) -> Column:
        return F.coalesce(F.get("s", i)["k"] == x["k"], F.lit(False))

    inside = F.filter("s", lambda x, i: same(x, i - 1) | same(x, i + 1))
    text = cuts.select(F.to_json(inside)).first()[0]
    return None if text in (None, "[]") else F.from_json(F.lit(text), cuts.schema["s"].dataType)


def range_of(place: Column, bounds: Column, ranges: int) -> Column:
    """How many bounds are at or below ``place``, by bisection; it never falls as ``place`` rises."""
    steps = F.array(*[F.lit(1 << i) for i in range(ranges.bit_length(), -1, -1)])
    return F.aggregate(
        steps, F.lit(0), lambda low, step: F.when(F.get(bounds, low + step - 1) <= place, low + step).otherwise(low)
    )


def with_ordinal(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    name: str = "ordinal",
    ranges: int | None = None,
) -> DataFrame:
    """1-based ordinal inside each key group, in ``order_by`` order; NULL is a key like any other.

    Rows are laid out once, by (key, range), and numbered inside. A key whose
    group is larger than a task's share, of as many as a shuffle has, is cut into
    ranges of its order; any other has one. Rows of a later range then get the
    number of their key's rows in the ranges before it, from a table of those
    (key, range) pairs: no more than there are ranges, so it is broadcast. Only
    rows with one key and one place in its order can't be cut apart.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [named(c) for c in order_by]
    bounds = range_bounds(df, key, order_by, ranges)
    if bounds is None:
        rows = Window.partitionBy(*[named(c) for c in key]).orderBy(*order)
        return df.withColumn(name, F.row_number().over(rows).cast("long"))
    place = _place(key, order_by)
    parts = df.select("*", place["k"].alias("__k"), range_of(place, bounds, ranges).alias("__range"))
    at = F.col("__range")
    is_cut = (F.get(bounds, at - 1)["k"] == F.col("__k")) | (F.get(bounds, at)["k"] == F.col("__k"))
    before = Window.partitionBy("__k").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.where(is_cut).groupBy("__k", "__range").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        F.col("__k").alias("__ok"), F.col("__range").alias("__or"), F.sum("__n").over(before).alias("__before")
    ).where("__before > 0")
    within = Window.partitionBy("__k", "__range").orderBy(*order)
    numbered_rows = parts.withColumn(name, F.row_number().over(within).cast("long"))
    joined = numbered_rows.join(
        F.broadcast(offsets), (F.col("__k") == F.col("__ok")) & (F.col("__range") == F.col("__or")), "left"
    )
    return joined.withColumn(name, named(name) + F.coalesce("__before", F.lit(0))).select(
        *[named(c) for c in df.columns], named(name)
    )
