"""Text comparison of two registers: dossiers of their first common documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from docledger.functions import named, text_to_real
from docledger.operators.documents import dossier
from docledger.operators.framediff import side_by_side
from docledger.operators.joins import members
from docledger.operators.keys import common_keys, restrict_to_first_keys

_AMOUNT = "__amount"


@dataclass(frozen=True)
class DossierSpec:
    """How a register prints: key, whole-number columns, padded columns, columns
    left out, the amount that orders a document's rows, and how many of the common
    documents to take, in key order: all of them unless ``limit`` is given."""

    key: str
    numbers: Sequence[str] = ()
    pads: Mapping[str, int] = field(default_factory=dict)
    skip: Sequence[str] = ()
    order_amount: str | None = None
    limit: int | None = None


# The two dossier layouts.
PURCHASE = DossierSpec(
    key="Voucher Number",
    numbers=("CGST Amount", "SGST Amount", "IGST Amount"),
    pads={"Vendor Code": 10},
)
SALES = DossierSpec(
    key="Document Number",
    numbers=(
        "Item Taxable Value *", "CGST Rate", "CGST Amount", "SGST Rate", "SGST Amount", "IGST Rate", "IGST Amount",
        "Item Discount Amount", "Quantity",
    ),
    pads={"Document Number": 10},
    skip=(
        "Status", "Document Type Code", "Recipient Billing Name", "Recipient Billing City", "Place of Supply",
        "Shipping Port Code - Export", "Shipping Bill Number - Export", "Shipping Bill Date - Export",
        "Item Description", "Cess Amount", "Cess Rate", "Is this document cancelled?", "Type of Export",
        "Return Filing Month", "Total Document Value",
    ),
    order_amount="Item Taxable Value *",
)


def common_documents(left: DataFrame, right: DataFrame, spec: DossierSpec) -> tuple[DataFrame, DataFrame]:
    """Both registers cut to their common documents, or to the first of them."""
    keys = common_keys(left, right, spec.key)
    if spec.limit is None:
        return tuple(members(side, keys, [spec.key]) for side in (left, right))
    return tuple(restrict_to_first_keys(side, keys, spec.key, spec.limit) for side in (left, right))


def _row_order(df: DataFrame, spec: DossierSpec) -> tuple[DataFrame, list[str]]:
    """Rows of a document by amount, remaining columns breaking ties."""
    rest = [c for c in df.columns if c != spec.key]
    if spec.order_amount is None:
        return df, rest
    return df.withColumn(_AMOUNT, text_to_real(named(spec.order_amount))), [_AMOUNT, *rest]


def register_dossier(register: DataFrame, spec: DossierSpec) -> DataFrame:
    rows, order = _row_order(register, spec)
    return dossier(rows, [spec.key], order, spec.numbers, spec.pads, [*spec.skip, _AMOUNT])


def compare_dossiers(left: DataFrame, right: DataFrame, spec: DossierSpec) -> tuple[DataFrame, DataFrame]:
    """Dossiers of both sides over the same documents, ready for a text diff."""
    return tuple(register_dossier(side, spec) for side in common_documents(left, right, spec))


def compare_rows(left: DataFrame, right: DataFrame, spec: DossierSpec) -> DataFrame:
    """Rows of the common documents side by side, in the text order of the amount."""
    a, b = common_documents(left, right, spec)
    first = [spec.order_amount] if spec.order_amount else []

    def order(df: DataFrame) -> list[str]:
        return [*first, *[c for c in df.columns if c not in (spec.key, *first)]]

    return side_by_side(a, b, spec.key, order(a), order(b))
