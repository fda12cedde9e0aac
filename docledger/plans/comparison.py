"""Compare a register with the file a customer keeps of the same documents."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from docledger.functions import named
from docledger.operators.reconcile import ReconcileSpec, reconcile
from docledger.sources.commits import path_exists
from docledger.sources.files import ROW_ORDER, read_borrowed
from docledger.sources.sinks import write_report


@dataclass(frozen=True)
class Override:
    """Per-customer settings: header mapping, compared fields, row filters."""

    columns_mapping: Mapping[str, str] = field(default_factory=dict)
    fields_to_compare: Sequence[str] = ()
    customer_input_filter: Sequence[str] = ()

    @classmethod
    def from_json(cls, text: str) -> Override:
        settings = json.loads(text)
        return cls(
            settings.get("columns_mapping", {}),
            settings.get("fields_to_compare", []),
            settings.get("customer_input_filter", []),
        )


def compare_with_file(
    spark: SparkSession,
    register: DataFrame,
    customer_path: str,
    spec: ReconcileSpec,
    override: Override,
    order_by: Sequence[str],
) -> DataFrame:
    """Report of the register against the customer file, read with borrowed types.

    FIRST follows ``order_by`` in the register and file order in the file.
    """
    customer = read_borrowed(spark, customer_path, register.schema, override.columns_mapping)
    for condition in override.customer_input_filter:
        customer = customer.where(condition)
    needed = list(dict.fromkeys([*spec.required, *order_by]))
    return reconcile(
        register.select(*[named(c) for c in needed]),
        customer,
        spec,
        order_by,
        customer_order_by=[ROW_ORDER],
        fields=override.fields_to_compare or None,
    )


@dataclass(frozen=True)
class Comparison:
    """One template of a run: the register, the customer's file, and where the report goes."""

    register: DataFrame
    customer_path: str
    spec: ReconcileSpec
    override: Override
    order_by: Sequence[str]
    output: str


def run_comparisons(spark: SparkSession, comparisons: Mapping[str, Comparison], only_diff: bool = False) -> list[str]:
    """Run every template whose customer file is there; returns the names of those that ran."""
    ran = []
    for name, each in comparisons.items():
        if path_exists(spark, each.customer_path):
            run_comparison(
                spark, each.register, each.customer_path, each.spec, each.override, each.order_by, each.output, only_diff
            )
            ran.append(name)
    return ran


def run_comparison(
    spark: SparkSession,
    register: DataFrame,
    customer_path: str,
    spec: ReconcileSpec,
    override: Override,
    order_by: Sequence[str],
    output: str,
    only_diff: bool = False,
) -> None:
    report = compare_with_file(spark, register, customer_path, spec, override, order_by)
    write_report(report, output, only_diff, spec.labels)
