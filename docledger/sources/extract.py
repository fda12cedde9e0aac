"""Declarative extracts: select list, source table and AND-ed predicates."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, ge, gt, le, lt
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docledger.functions import named

# Fixed value: how extract specs write dates.
DATE_LITERAL = "dd-MMM-yyyy"


def literal(text: str, data_type: T.DataType) -> Column:
    """A spec value in the type of its column, so the filter can reach the scan."""
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.to_date(F.lit(text), DATE_LITERAL).cast(data_type)
    return F.lit(text).cast(data_type)


def predicate(df: DataFrame, column: str, operator: str, values: Sequence[str]) -> Column:
    """One predicate of a spec: equal to any of the values, unequal to all of them,
    or ordered against a single one."""
    if not values:
        raise ValueError(f"no value for {column} {operator}")
    wanted = [literal(v, df.schema[column].dataType) for v in values]
    target = named(column)
    if operator.upper() in ("=", "IN"):
        return target.isin(*wanted) if len(wanted) > 1 else target == wanted[0]
    if operator in ("!=", "<>"):
        return ~target.isin(*wanted) if len(wanted) > 1 else target != wanted[0]
    ordered = {">=": ge, "<=": le, ">": gt, "<": lt}
    if operator not in ordered:
        raise ValueError(f"unknown operator {operator} for {column}")
    if len(wanted) > 1:
        raise ValueError(f"{column} {operator} takes one value, not {len(wanted)}")
    return ordered[operator](target, wanted[0])


def extract(df: DataFrame, spec: Mapping[str, Any]) -> DataFrame:
    """Apply one table's ``select`` and ``where`` to its frame."""
    joiners = {
        e["booleanOperator"] for g in spec.get("where", []) for e in [g, *g["listOfExpr"]] if "booleanOperator" in e
    }
    if joiners - {"AND"}:
        raise ValueError(f"only AND joins predicates, not {sorted(joiners - {'AND'})}")
    conditions = [
        predicate(df, e["expr"]["column"]["name"], e["expr"]["operator"], e["expr"]["value"])
        for group in spec.get("where", [])
        for e in group["listOfExpr"]
        if "expr" in e
    ]
    rows = df.where(reduce(and_, conditions)) if conditions else df
    return rows.select(*[named(c["name"]) for c in spec["select"]])


def table_specs(text: str) -> dict[str, dict[str, Any]]:
    """Specs by source table from the JSON of an extract request."""
    tables = json.loads(text)["config"]["tables"]
    return {t["fromTable"]["name"]: t for t in tables}
