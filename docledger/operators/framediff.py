"""Cell-level comparison of two versions of a frame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docledger.functions import named, value_text
from docledger.operators.joins import null_safe_on
from docledger.operators.ordering import with_ordinal, with_position

POSITION = "position"


def split_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """(array columns, scalar columns) by declared type."""
    arrays = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    return arrays, [c for c in df.columns if c not in arrays]


def header_difference(left: DataFrame, right: DataFrame) -> set[str]:
    return set(left.columns) ^ set(right.columns)


def narrowed(df: DataFrame, include: Sequence[str] | None, ignore: Sequence[str] | None) -> DataFrame:
    if include:
        df = df.select(*[named(c) for c in include])
    return df.drop(*ignore) if ignore else df


@dataclass(frozen=True)
class Shape:
    left_rows: int
    right_rows: int
    left_columns: int
    right_columns: int
    header_difference: frozenset[str]

    @property
    def both_empty(self) -> bool:
        return self.left_rows == 0 and self.right_rows == 0

    @property
    def comparable(self) -> bool:
        return (
            self.left_rows == self.right_rows
            and self.left_rows > 0
            and self.left_columns == self.right_columns
            and not self.header_difference
        )


def shape_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows and columns of both sides, and the headers found on one side only."""
    sides = left.select(F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    nought = F.lit(0).cast("long")
    return sides.agg(
        F.coalesce(F.sum("l"), nought).alias("left_rows"),
        F.coalesce(F.sum("r"), nought).alias("right_rows"),
        F.lit(len(left.columns)).cast("long").alias("left_columns"),
        F.lit(len(right.columns)).cast("long").alias("right_columns"),
        F.lit(",".join(sorted(header_difference(left, right)))).alias("header_difference"),
    )


def shape_check(left: DataFrame, right: DataFrame) -> Shape:
    """Row counts of both sides from one job, headers from the schemas."""
    counts = shape_counts(left, right).first()
    return Shape(
        counts["left_rows"],
        counts["right_rows"],
        len(left.columns),
        len(right.columns),
        frozenset(header_difference(left, right)),
    )


def cells_equal(left: Column, right: Column, is_array: bool, ordered_arrays: bool) -> Column:
    """Null-safe equality; unordered arrays compare sorted, NULL equal to empty."""
    if is_array and not ordered_arrays:
        nothing = (F.coalesce(F.size(left), F.lit(0)) <= 0) & (F.coalesce(F.size(right), F.lit(0)) <= 0)
        return nothing | F.sort_array(left).eqNullSafe(F.sort_array(right))
    return left.eqNullSafe(right)


def require_unique(df: DataFrame, key: Sequence[str], side: str) -> None:
    """Rows with one key would pair all with all; NULL is a key like any other."""
    repeated = df.groupBy(*[named(c) for c in key]).count().where(F.col("count") > 1)
    if not repeated.isEmpty():
        raise ValueError(f"repeated {', '.join(key)} on the {side}: give order_by to pair its rows by place")


def _paired(
    left: DataFrame, right: DataFrame, key: Sequence[str] | None, order_by: Sequence[str] | None
) -> tuple[DataFrame, DataFrame, list[str]]:
    if key and order_by:
        return (
            with_ordinal(left, key, order_by),
            with_ordinal(right, key, order_by),
            [*key, "ordinal"],
        )
    if key:
        require_unique(left, key, "left")
        require_unique(right, key, "right")
        return left, right, list(key)
    if not order_by:
        raise ValueError("give a key, or order_by to compare by row position")
    return with_position(left, order_by, POSITION), with_position(right, order_by, POSITION), [POSITION]


def frame_diff(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    include: Sequence[str] | None = None,
    ignore: Sequence[str] | None = None,
    ordered_arrays: bool = True,
) -> DataFrame:
    """Differing cells as rows (alignment columns, column, left_value, right_value).

    ``key`` alone aligns rows by a unique key (inner; a repeated key is an error);
    ``key`` with ``order_by`` pairs repeated keys by their place in the group;
    ``order_by`` alone pairs by row position, and every cell of a row beyond the
    shorter frame differs. Columns found on one side only are left to ``shape_check``.
    """
    compared = [
        c for c in narrowed(left, include, ignore).columns
        if c in narrowed(right, include, ignore).columns and c not in (key or ())
    ]
    needed = list(dict.fromkeys([*(key or ()), *(order_by or ()), *compared]))
    a, b, align = _paired(
        left.select(*[named(c) for c in needed]), right.select(*[named(c) for c in needed]), key, order_by
    )
    b = b.select(*[named(c).alias(f"__r_{c}") for c in b.columns])
    by_position = align == [POSITION]
    joined = a.join(b, null_safe_on(a, b, [(c, f"__r_{c}") for c in align]), "full" if by_position else "inner")
    one_sided = F.lit(False)
    if by_position:
        mine, theirs = named(POSITION), named(f"__r_{POSITION}")
        one_sided = mine.isNull() | theirs.isNull()

    types = {f.name: f.dataType for f in left.schema}
    right_types = {f.name: f.dataType for f in right.schema}
    cells = []
    for c in compared:
        mine, theirs = named(c), named(f"__r_{c}")
        same = cells_equal(mine, theirs, isinstance(types[c], T.ArrayType), ordered_arrays)
        cell = F.struct(
            F.lit(c).alias("column"),
            value_text(mine, types[c]).alias("left_value"),
            value_text(theirs, right_types[c]).alias("right_value"),
        )
        cells.append(F.when(~same | one_sided, cell))
    aligned = [F.coalesce(named(c), named(f"__r_{c}")).alias(c) if by_position else named(c) for c in align]
    return joined.select(
        *aligned, F.inline(F.array_compact(F.array(*cells)))
    )


def frames_equal(left: DataFrame, right: DataFrame, **options) -> bool:
    """Whole-frame verdict: both empty is equal, a shape or header difference is not.

    With ``key`` given, rows without a partner are outside the comparison.
    """
    include, ignore = options.get("include"), options.get("ignore")
    shape = shape_check(narrowed(left, include, ignore), narrowed(right, include, ignore))
    if shape.both_empty:
        return True
    return shape.comparable and frame_diff(left, right, **options).isEmpty()


def side_by_side(
    left: DataFrame,
    right: DataFrame,
    key: str,
    order_by: Sequence[str],
    right_order_by: Sequence[str] | None = None,
    left_prefix: str = "left_",
    right_prefix: str = "right_",
) -> DataFrame:
    """The i-th row of a key on the left next to the i-th on the right."""
    a = with_ordinal(left, [key], order_by)
    b = with_ordinal(right, [key], right_order_by or order_by)
    a = a.select(
        named(key).alias("Key"), "ordinal", *[named(c).alias(left_prefix + c) for c in left.columns]
    )
    b = b.select(
        named(key).alias("__key"),
        F.col("ordinal").alias("__ordinal"),
        *[named(c).alias(right_prefix + c) for c in right.columns],
    )
    paired = a.join(b, (a["Key"] == b["__key"]) & (a["ordinal"] == b["__ordinal"]), "inner")
    return paired.drop("__key", "__ordinal")
