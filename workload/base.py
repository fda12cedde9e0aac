"""Query registry, and input views written once for Spark and for the SQL twin."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from docledger.functions import named
from docledger.session import ensure_checkpoint_dir
from workload.views import VIEWS

_REFERENCE = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")
_QUERIES: dict[str, Callable[["Tables"], DataFrame]] = {}
_TWINS: dict[str, str] = {}


class Tables:
    """Given tables and derived views by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        text = VIEWS[name]
        return self.spark.sql(text, **{r: self(r) for r in sorted(set(_REFERENCE.findall(text)))})

    def scratch(self) -> str:
        """A new folder in the storage all executors share."""
        ensure_checkpoint_dir(self.spark)
        return f"{self.spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}"


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is already registered")
        _QUERIES[name] = build
        if sql is not None:
            _TWINS[name] = with_views(sql)
        return build

    return register


def with_views(sql: str) -> str:
    """SQL with every view it refers to as a WITH clause, in dependency order."""
    ordered: dict[str, str] = {}

    def need(text: str) -> str:
        for name in _REFERENCE.findall(text):
            if name in VIEWS and name not in ordered:
                body = need(VIEWS[name])
                ordered[name] = body
        names = set(_REFERENCE.findall(text))
        return text.format(**{n: n for n in names})

    body = need(sql).strip()
    if not ordered:
        return body
    clauses = ",\n".join(f"{name} as (\n{text.strip()}\n)" for name, text in ordered.items())
    for opening in ("with recursive ", "with "):
        if body.lower().startswith(opening):
            return f"{opening}{clauses},\n{body[len(opening):]}"
    return f"with {clauses}\n{body}"


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals and reals as doubles, so both engines hand over one number type."""
    wide = (T.DecimalType, T.FloatType)
    return df.select(
        *[
            (named(f.name).cast("double") if isinstance(f.dataType, wide) else named(f.name)).alias(f.name)
            for f in df.schema
        ]
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Tables], DataFrame]):
        return lambda spark, folder: plain_numbers(build(Tables(spark, folder)))

    return {name: bind(build) for name, build in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_TWINS)
