"""Upstream closure and row-level trace over the model graph."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.functions import named
from docledger.session import checkpoint

# Columns that can hold the traced document number.
TRACE_KEYS = ("Document Number", "BELNR", "VBELN", "AWKEY")

FEW_NUMBERS = 100_000


def upstream(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(start, node, depth): everything each start depends on, itself at depth 0.

    ``edges`` is (child, parent), ``starts`` is (node). Every way of up to a
    known length is covered after a round, so only nodes at just that depth can
    lead further. They are taken on by jumps, the shortest lengths of all ways of
    up to twice as many edges as in the round before; a chain of a thousand
    takes eleven rounds. Jumps and reached nodes are reduced to one row a pair,
    on the map side first, and checkpointed, so plans stay short and cycles end.
    """
    one = F.lit(1).alias("steps")
    jumps = checkpoint(edges.where(F.col("child") != F.col("parent")).select("child", "parent", one).distinct())
    seen = starts.select(F.col("node").alias("start"), "node").distinct().withColumn("depth", F.lit(0))
    last, covered, length = seen, 0, 1
    while True:
        further = (
            last.select("start", F.col("node").alias("child"), "depth")
            .join(jumps, "child")
            .select("start", F.col("parent").alias("node"), (F.col("depth") + F.col("steps")).alias("depth"))
        )
        seen = checkpoint(seen.unionByName(further).groupBy("start", "node").agg(F.min("depth").alias("depth")))
        covered += length
        last = seen.where(F.col("depth") == covered)
        if last.isEmpty():
            return seen
        if covered > 1:
            jumps = checkpoint(_doubled(jumps, length))
            length *= 2


def _doubled(jumps: DataFrame, length: int) -> DataFrame:
    """Jumps of up to twice ``length`` steps: a longer one begins with one of just that many."""
    onward = jumps.select(F.col("child").alias("over"), F.col("parent").alias("to"), F.col("steps").alias("more"))
    longer = (
        jumps.where(F.col("steps") == length)
        .join(onward, F.col("parent") == F.col("over"))
        .where(F.col("child") != F.col("to"))
        .select("child", F.col("to").alias("parent"), (F.col("steps") + F.col("more")).alias("steps"))
    )
    return jumps.unionByName(longer).groupBy("child", "parent").agg(F.min("steps").alias("steps"))


def downstream(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(start, node, depth): everything that depends on each start, itself at depth 0."""
    return upstream(edges.select(F.col("parent").alias("child"), F.col("child").alias("parent")), starts)


@dataclass(frozen=True)
class Project:
    """Models of a project: parents and children by node, table name (schema.name) by node."""

    parents: Mapping[str, Sequence[str]]
    children: Mapping[str, Sequence[str]]
    tables: Mapping[str, str]

    @classmethod
    def from_manifest(cls, text: str) -> Project:
        """From the JSON of a project manifest; its size is the number of models."""
        manifest = json.loads(text)
        nodes = {**manifest.get("nodes", {}), **manifest.get("sources", {})}
        return cls(
            manifest.get("parent_map", {}),
            manifest.get("child_map", {}),
            {node: f"{of['schema']}.{of['name']}" for node, of in nodes.items()},
        )

    def edges(self, spark: SparkSession) -> DataFrame:
        """(child, parent) pairs of the graph."""
        pairs = [(child, parent) for child, parents in self.parents.items() for parent in parents]
        return spark.createDataFrame(pairs, "child string, parent string")


def walk(parents: Mapping[str, Sequence[str]], node: str) -> list[tuple[str, int]]:
    """(model, depth) depth-first from ``node``, each model once."""
    visited: dict[str, int] = {}
    stack = [(node, 0)]
    while stack:
        current, depth = stack.pop()
        if current not in visited:
            visited[current] = depth
            stack.extend((p, depth + 1) for p in reversed(parents.get(current, ())))
    return list(visited.items())


def matching_rows(df: DataFrame, numbers: DataFrame | str | None, keys: Sequence[str] = TRACE_KEYS) -> DataFrame:
    """Rows with a wanted number in any key column the table has; all rows when
    it has none. ``numbers`` is one number or a frame with a ``number`` column.

    Whether a row is wanted depends on its key columns alone. A single one joins
    the numbers as it is. With more, their values are looked for first, all columns
    in one join, and the rows then join the key combinations that were found: they
    move once, however many key columns there are, and not at all where what they
    are joined with is few.
    """
    if numbers is None or isinstance(numbers, str):
        return _matching(df, numbers, keys, False)
    wanted, many = _wanted(numbers)
    return _matching(df, wanted, keys, many)


def _wanted(numbers: DataFrame) -> tuple[DataFrame, bool]:
    """The different numbers, found once for all tables, and whether they are more than ``FEW_NUMBERS``."""
    named_so = numbers.select(F.col("number").cast("string").alias("number")).where("number is not null")
    wanted = checkpoint(named_so.distinct())
    return wanted, wanted.limit(FEW_NUMBERS + 1).count() > FEW_NUMBERS


def _matching(df: DataFrame, numbers: DataFrame | str | None, keys: Sequence[str], many: bool) -> DataFrame:
    """The rows with one of the different ``numbers``. If these are many, joins hash
    their narrow side, so the rows need no sort; else Spark goes by measured sizes."""
    present = [c for c in keys if c in df.columns]
    if numbers is None or not present:
        return df
    if isinstance(numbers, str):
        return df.where(reduce(or_, [named(c) == numbers for c in present]))

    def narrow(side: DataFrame) -> DataFrame:
        return side.hint("shuffle_hash") if many else side

    wanted = narrow(numbers.select(F.col("number").alias("__number")))
    if len(present) == 1:
        key = df[f"`{present[0]}`"]
        return df.where(key.isNotNull()).join(wanted, key.cast("string").eqNullSafe(F.col("__number")), "left_semi")
    place = F.struct(*[named(c).cast("string").alias(f"k{i}") for i, c in enumerate(present)])
    values = F.array_distinct(F.array_compact(F.array(*[named(c).cast("string") for c in present])))
    told = df.select(place.alias("__at"), F.explode(values).alias("__value"))
    found = told.join(wanted, F.col("__value").eqNullSafe(F.col("__number")), "left_semi").select("__at").distinct()
    marked = df.withColumn("__place", place)
    return marked.join(narrow(found), F.col("__place").eqNullSafe(F.col("__at")), "left_semi").drop("__place")


def trace(
    tables: Mapping[str, DataFrame],
    parents: Mapping[str, Sequence[str]],
    node: str,
    numbers: DataFrame | str | None = None,
    keys: Sequence[str] = TRACE_KEYS,
) -> DataFrame:
    """(table, visit, depth, row) for ``node`` and its ancestors, rows as JSON.

    One pass per table of the graph, unioned; the graph itself is the handful
    of models of a project.
    """
    many = False
    if numbers is not None and not isinstance(numbers, str):
        numbers, many = _wanted(numbers)
    traced = None
    for visit, (name, depth) in enumerate(walk(parents, node)):
        rows = _matching(tables[name], numbers, keys, many)
        part = rows.select(
            F.lit(name).alias("table"),
            F.lit(visit).alias("visit"),
            F.lit(depth).alias("depth"),
            F.to_json(F.struct(*[named(c) for c in rows.columns]), {"ignoreNullFields": "false"}).alias("row"),
        )
        traced = part if traced is None else traced.unionByName(part)
    return traced
