"""Declared table schemas and their application to loaded frames."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docledger.functions import named, pad_key

# Declared type names and what they load as. A bare NUMERIC holds
# 18 digits, 3 of them decimals.
TYPES = {
    "VARCHAR": T.StringType(),
    "TEXT": T.StringType(),
    "NUMERIC": T.DecimalType(18, 3),
    "DECIMAL": T.DecimalType(18, 3),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.FloatType(),
    "REAL": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
}
_SIZED = re.compile(r"(\w+)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)")


def declared_type(text: str) -> T.DataType:
    """Type for a declared name; a text length is not enforced."""
    name = text.strip().upper()
    sized = _SIZED.fullmatch(name)
    if sized and sized[1] in ("NUMERIC", "DECIMAL"):
        return T.DecimalType(int(sized[2]), int(sized[3] or 0))
    base = sized[1] if sized else name
    if base not in TYPES:
        raise ValueError(f"unknown column type {text!r}")
    return TYPES[base]


def schema_catalog(rows: Iterable[tuple[str, str, str]]) -> dict[str, T.StructType]:
    """Schema per table from (table, column, type) rows, tables in first-seen order."""
    catalog: dict[str, T.StructType] = {}
    for table, column, type_name in rows:
        catalog.setdefault(table, T.StructType()).add(column, declared_type(type_name))
    return catalog


def read_catalog(spark: SparkSession, path: str) -> dict[str, T.StructType]:
    """Catalog from a ``TABLE,COLUMN,TYPE`` file (a few rows per column of the project)."""
    rows = spark.read.csv(path, header=True, inferSchema=False)
    return schema_catalog((r[0], r[1], r[2]) for r in rows.collect())


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns by name and type: extras dropped, missing ones NULL.

    A value that does not cast fails the load.
    """
    present = set(df.columns)
    return df.select(
        *[
            (named(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by {source header: register column}; absent headers are ignored."""
    return df.withColumnsRenamed({old: new for old, new in mapping.items() if old in df.columns})


def type_name(data_type: T.DataType) -> str:
    if isinstance(data_type, T.DecimalType):
        return f"DECIMAL({data_type.precision},{data_type.scale})"
    return next((n for n, t in TYPES.items() if t == data_type), data_type.simpleString().upper())


def schema_inventory(spark: SparkSession, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(TABLE, COLUMN, TYPE) of the given frames, or of every catalog table."""
    if tables is None:
        tables = {t.name: spark.table(t.name) for t in spark.catalog.listTables()}
    rows = [(name, f.name, type_name(f.dataType)) for name, df in tables.items() for f in df.schema]
    return spark.createDataFrame(rows, "TABLE string, COLUMN string, TYPE string")


def rewrite_key(df: DataFrame, column: str, width: int, cut: bool = False) -> DataFrame:
    """Replace a key by its zero-padded form, moved to the end of the table.

    A longer key fails unless ``cut`` allows two keys to become one.
    """
    padded = pad_key(named(column), width, cut).alias(column)
    return df.select(*[named(c) for c in df.columns if c != column], padded)
