"""Column expressions on identifiers and text. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts read as missing when a delimited or sheet cell holds them.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def named(name: str) -> Column:
    """Column by its exact name; names here hold spaces, dots and slashes."""
    return F.col("`" + name.replace("`", "``") + "`")


def null_if_na(column: Column) -> Column:
    return F.when(~column.isin(*NA_TOKENS), column)


def composite_key(columns: Iterable[str], sep: str = "") -> Column:
    """Key parts as text, NULL as empty, joined by ``sep`` (none by default, so
    ('AB', 'C') and ('A', 'BC') share a key unless a separator is given)."""
    return F.concat_ws(sep, *[F.coalesce(named(c).cast("string"), F.lit("")) for c in columns])


def pad_key(column: Column, width: int, cut: bool = False) -> Column:
    """Zero-pad on the left. Longer text fails, as two keys could become one;
    ``cut`` cuts it to ``width`` instead."""
    padded = F.lpad(column, width, "0")
    if cut:
        return padded
    message = F.concat(F.lit(f"key longer than {width}: "), column)
    return F.when(F.length(column) > width, F.raise_error(message)).otherwise(padded)


def rjust_key(column: Column, width: int) -> Column:
    """Zero-pad on the left; longer text is kept whole."""
    return F.when(F.length(column) < width, F.lpad(column, width, "0")).otherwise(column)


def stripped(column: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(column, r"(?U)^\s+|\s+$", "")


def prefix_int(column: Column, length: int) -> Column:
    """Leading characters as an integer, NULL when they are not a number."""
    return F.left(column, F.lit(length)).try_cast("int")


def dotted_date(column: Column) -> Column:
    return F.date_format(column, "dd.MM.yyyy")


def suffix_match(columns: Sequence[str], number: str) -> Column:
    """True where any column ends in ``number``; % and _ in it stay wildcards, a
    backslash is a plain character."""
    pattern = "%" + number.replace("\\", "\\\\")
    return reduce(or_, [named(c).like(pattern) for c in columns])


def split_fields(column: Column) -> Column:
    """Comma list to array: no trimming, empty parts kept, NULL stays NULL."""
    return F.split(column, ",", -1)


def split_bracketed(column: Column) -> Column:
    """Split ``[E1] a, b, [E2] c`` before each bracketed code only."""
    return F.split(column, r", (?=\[)", -1)


def value_text(column: Column, data_type: T.DataType) -> Column:
    """Text form of any value; nested values as JSON with NULL members kept."""
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(column, {"ignoreNullFields": "false"})
    return column.cast("string")


def _has_map(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.MapType):
        return True
    if isinstance(data_type, T.ArrayType):
        return _has_map(data_type.elementType)
    return isinstance(data_type, T.StructType) and any(_has_map(f.dataType) for f in data_type)


def sorted_maps(column: Column, data_type: T.DataType) -> Column:
    """The value with every map as its entries in key order, nested ones too."""
    if not _has_map(data_type):
        return column
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda x: sorted_maps(x, data_type.elementType))
    if isinstance(data_type, T.StructType):
        members = [sorted_maps(column.getField(f.name), f.dataType).alias(f.name) for f in data_type]
        return F.when(column.isNotNull(), F.struct(*members))
    keys = F.array_sort(F.map_keys(column))
    entries = F.transform(
        keys, lambda k: F.struct(k.alias("key"), sorted_maps(F.element_at(column, k), data_type.valueType).alias("value"))
    )
    return F.when(column.isNotNull(), entries)


def row_hash(columns: Iterable[tuple[str, T.DataType]]) -> Column:
    """md5 over length-prefixed cell texts, so neighbours cannot run together."""
    cells = []
    for name, data_type in columns:
        text = value_text(sorted_maps(named(name), data_type), data_type)
        cells.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.md5(F.concat(*cells))
