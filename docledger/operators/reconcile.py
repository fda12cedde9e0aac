"""Reconcile a generated register against a second source at document level."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docledger.functions import composite_key, dotted_date, named
from docledger.operators.rollup import Agg, rollup

# Column and label texts of the comparison report.
KEY = "Composite_Key"
KEY_OUT = "Composite_Key_Out"
KEY_CUS = "Composite_Key_Cus"
FIELDS = "Mismatched Fields"
STATUS = "Matching Status"
EXACT = "Exact"
MISSING_GENERATED = "Missing in CT Generated"
MISSING_CUSTOMER = "Missing in Customer"
MISMATCH = "Mismatch"
UNKNOWN = "Unknown"


@dataclass(frozen=True)
class Labels:
    exact: str = EXACT
    missing_generated: str = MISSING_GENERATED
    missing_customer: str = MISSING_CUSTOMER
    mismatch: str = MISMATCH
    unknown: str = UNKNOWN


@dataclass(frozen=True)
class ReconcileSpec:
    keys: Sequence[str]
    columns: Mapping[str, Agg]
    labels: Labels = field(default_factory=Labels)
    key_sep: str = ""

    @property
    def required(self) -> list[str]:
        return list(dict.fromkeys([*self.columns, *self.keys]))


# The two comparison templates.
SALES = ReconcileSpec(
    keys=("Document Number", "My GSTIN"),
    columns={
        "My GSTIN": Agg.SET,
        "Item Taxable Amount": Agg.SUM,
        "Document Number": Agg.FIRST,
        "Document Date": Agg.FIRST,
    },
)
PURCHASE = ReconcileSpec(
    keys=("Voucher Number", "My GSTIN", "Supplier GSTIN"),
    columns={
        "Voucher Number": Agg.FIRST,
        "My GSTIN": Agg.SET,
        "Supplier GSTIN": Agg.FIRST,
        "Item Taxable Amount": Agg.SUM,
        "Voucher Date": Agg.FIRST,
        "CGST Amount": Agg.SUM,
        "SGST Amount": Agg.SUM,
        "IGST Amount": Agg.SUM,
    },
)


def require_columns(df: DataFrame, columns: Sequence[str], side: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns in {side}: {', '.join(missing)}")


def document_level(df: DataFrame, spec: ReconcileSpec, order_by: Sequence[str]) -> DataFrame:
    keyed = df.withColumn(KEY, composite_key(spec.keys, spec.key_sep))
    return rollup(keyed, [KEY], spec.columns, order_by)


def reconcile(
    generated: DataFrame,
    customer: DataFrame,
    spec: ReconcileSpec,
    order_by: Sequence[str],
    customer_order_by: Sequence[str] | None = None,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Full outer comparison of both sides rolled up to one row per composite key.

    Both rollups shuffle on the key and the join keeps that layout, so there
    are two exchanges in all and no key is duplicated when the sides meet.
    ``fields`` narrows what is compared; the default is every rolled-up column.
    """
    require_columns(customer, spec.required, "customer file")
    require_columns(generated, spec.required, "generated register")
    compared = list(fields or spec.columns)

    left = document_level(generated, spec, order_by).withColumn(KEY_OUT, F.col(KEY))
    right = document_level(customer, spec, customer_order_by or order_by).select(
        F.col(KEY).alias(KEY_CUS), *[named(c).alias(f"{c}_cus") for c in spec.columns]
    )
    joined = left.join(right, left[KEY] == right[KEY_CUS], "full")

    differs = [F.when(~named(c).eqNullSafe(named(f"{c}_cus")), F.lit(c)) for c in compared]
    labels = spec.labels
    no_difference = F.col(f"`{FIELDS}`") == ""
    status = (
        F.when(no_difference & F.col(KEY_OUT).isNotNull() & F.col(KEY_CUS).isNotNull(), labels.exact)
        .when(F.col(KEY_OUT).isNull(), labels.missing_generated)
        .when(F.col(KEY_CUS).isNull(), labels.missing_customer)
        .when(~no_difference, labels.mismatch)
        .otherwise(labels.unknown)
    )
    return (
        joined.withColumn(FIELDS, F.concat_ws("|", *differs))
        .withColumn(STATUS, status)
        .select(
            F.coalesce(F.col(KEY_OUT), F.col(KEY_CUS)).alias(KEY),
            *[named(c) for c in spec.columns],
            KEY_OUT,
            *[named(f"{c}_cus") for c in spec.columns],
            KEY_CUS,
            named(FIELDS),
            named(STATUS),
        )
    )


def only_differences(report: DataFrame, labels: Labels = Labels()) -> DataFrame:
    return report.where(named(STATUS) != labels.exact)


def common_voucher_sums(
    generated: DataFrame,
    customer: DataFrame,
    group: Mapping[str, str],
    amounts: Sequence[str],
    key: str,
    dates: Sequence[str] = (),
    amount_type: str = "decimal(18,3)",
) -> DataFrame:
    """Voucher sums of both sides (column ``side``) for the vouchers both have.

    Both sides are read once, tagged and summed together, partly before their
    shuffle. The sums of a voucher then meet once more, which shows whether both
    sides have it: two exchanges, of sums only. A NULL voucher is on no side.
    """
    sides = [
        _voucher_lines(df, group, amounts, dates, amount_type).withColumn("side", F.lit(side))
        for side, df in (("generated", generated), ("customer", customer))
    ]
    lines = sides[0].unionByName(sides[1]).where(named(key).isNotNull())
    sums = lines.groupBy(*[named(c) for c in group.values()], "side").agg(*[F.sum(named(c)).alias(c) for c in amounts])
    voucher = Window.partitionBy(named(key))
    on_both = (F.min("side").over(voucher) != F.max("side").over(voucher)).alias("__both")
    return sums.select("*", on_both).where("__both").select(*[named(c) for c in group.values()], *[named(c) for c in amounts], "side")


def voucher_sums(
    df: DataFrame,
    group: Mapping[str, str],
    amounts: Sequence[str],
    dates: Sequence[str] = (),
    amount_type: str = "decimal(18,3)",
) -> DataFrame:
    """Sums of ``amounts`` by every column of ``group`` ({input: output}).

    Amounts are decimals by default: sums of reals depend on the order of their
    rows. ``dates`` print as dd.MM.yyyy first.
    """
    lines = _voucher_lines(df, group, amounts, dates, amount_type)
    return lines.groupBy(*[named(c) for c in group.values()]).agg(*[F.sum(named(c)).alias(c) for c in amounts])


def _voucher_lines(
    df: DataFrame, group: Mapping[str, str], amounts: Sequence[str], dates: Sequence[str], amount_type: str
) -> DataFrame:
    keys = [(dotted_date(named(c)) if c in dates else named(c)).alias(out) for c, out in group.items()]
    return df.select(*keys, *[named(c).cast(amount_type).alias(c) for c in amounts])
