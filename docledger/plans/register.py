"""Sales register and export-type model, derived from raw invoice lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.functions import prefix_int, zero_default
from docledger.operators.rollup import with_group_total

# Codes and texts of the register rules.
DROPPED_CODES = ("EINVC-TAL-BC", "EINVC-TAL", "EINVC-SIL", "DNCNGS")
DEBIT_NOTE_CODES = ("DSASIL", "DSATAL", "DSA-V")
EXPORT_FORMS = ("EXPORT", "NEPAL", "BHUTAN")
SEZ_FORM = "SEZ SALE"
BILL_OF_SUPPLY_FORMS = ("EXEMPT", "NIL RATED", "NON-GST")
ZERO_TAX_FORMS = ("EXEMPTED", "NIL_RATED", "NON_GST_SUPPLY")
EXPORT_PLACE = "96"
BLANK = " "

# Line columns the rules read.
LINE_COLUMNS = (
    "ADDRESS", "BASE_UOM", "CESS", "CGST_TOTAL", "CITY_CODE", "COMP_NAME", "CUST_NAME",
    "DIS", "DIS_QTY", "EXPORT_CODE", "GST_NO", "GST_NOO", "GST_RTE", "HSN_CODE",
    "IGST_TOTAL", "INR_RATE", "INVH_COMP_CODE", "INVH_DT", "INVH_FORM_CODE", "INVH_NO",
    "INVH_TXN_CODE", "INVI_ITEM_DESC", "ITEM_TOTAL", "SGUST_TOTAL", "SHIPPING_BILL_DT",
    "SHIPPING_BILL_NO", "TCS_TOTAL", "TOTAL", "TRANS_TYPE",
)


def _exported() -> Column:
    return F.col("INVH_FORM_CODE").isin(*EXPORT_FORMS)


def item_category() -> Column:
    """Service when the tariff code starts with 99, goods for any other code."""
    return F.when(prefix_int(F.col("HSN_CODE"), 2) == 99, "S").when(F.col("HSN_CODE").isNotNull(), "G")


def export_kind(null_rate_is_zero: bool) -> Column:
    """Export or special-zone sale, with (WP) or without (WOP) payment of tax."""
    rate = F.col("GST_RTE")
    untaxed = (rate == 0) | rate.isNull() if null_rate_is_zero else rate == 0
    special = F.col("INVH_FORM_CODE") == SEZ_FORM
    return (
        F.when(_exported() & (rate != 0), "EXPWP")
        .when(_exported() & untaxed, "EXPWOP")
        .when(special & (rate != 0), "SEZWP")
        .when(special & untaxed, "SEZWOP")
    )


def _document_type() -> Column:
    invoice = F.col("TRANS_TYPE") == "INV"
    return (
        F.when(invoice & F.col("INVH_TXN_CODE").isin(*DEBIT_NOTE_CODES), "Debit Note")
        .when(invoice, "Invoice")
        .when(F.col("TRANS_TYPE") == "SARTN", "Credit Note")
        .otherwise("")
    )


def _local_sale_to(*customer_ids: str) -> Column:
    return (F.col("INVH_FORM_CODE") == "LOCAL") & F.col("GST_NO").isin(*customer_ids)


def _shipping_bill(column: str) -> Column:
    """Only exported goods with a known rate carry a shipping bill."""
    prefix = prefix_int(F.col("HSN_CODE"), 2)
    goods = F.coalesce(prefix != 99, F.col("HSN_CODE").isNotNull())
    return F.when(goods & _exported() & F.col("GST_RTE").isNotNull(), F.col(column)).otherwise(BLANK)


def _none(data_type: str = "string") -> Column:
    return F.lit(None).cast(data_type)


def sales_register(lines: DataFrame) -> DataFrame:
    """The 48-column register. Dropped and code-less lines go first, so they
    neither reach the shuffle nor count into the document total."""
    kept = lines.select(*LINE_COLUMNS).where(~F.col("INVH_TXN_CODE").isin(*DROPPED_CODES))
    totalled = with_group_total(kept, ["INVH_NO", "INVH_TXN_CODE"], "TOTAL", "__document_total")
    form, col = F.col("INVH_FORM_CODE"), F.col
    columns = {
        "Document Type": _document_type(),
        "Document Number": F.concat("INVH_TXN_CODE", "INVH_NO"),
        "Document Date": col("INVH_DT"),
        "Place of Supply": F.when(_exported(), EXPORT_PLACE)
        .when(_local_sale_to("URP", "*URP*"), BLANK)
        .otherwise(F.left("GST_NO", F.lit(2))),
        "Applicable Tax Rate": _none(),
        "Is this a Bill of supply": F.when(form.isin(*BILL_OF_SUPPLY_FORMS), "Y"),
        "Is Reverse Charge": _none(),
        "Is GST TDS Deducted": _none(),
        "My GSTIN": col("GST_NOO"),
        "Company Name": col("COMP_NAME"),
        "Comapany Code": col("INVH_COMP_CODE"),
        "Customer GSTIN": F.when(_local_sale_to("URP", "URP*"), BLANK)
        .when(_exported(), "URP")
        .otherwise(col("GST_NO")),
        "Customer Name": col("CUST_NAME"),
        "Customer Address": col("ADDRESS"),
        "Customer City": col("CITY_CODE"),
        "Customer State": _none(),
        "Customer Taxpayer Type": _none(),
        "Item_Category": item_category(),
        "Item Description": col("INVI_ITEM_DESC"),
        "HSN or SAC code": col("HSN_CODE"),
        "Item Quantity": col("DIS_QTY"),
        "Item Unit Code": col("BASE_UOM"),
        "Item Unit Price": col("INR_RATE"),
        "Item Discount Amount": col("DIS"),
        "Item Taxable Amount": col("ITEM_TOTAL"),
        "Zero Tax Category": F.when(form.isin(*ZERO_TAX_FORMS), form),
        "GST Rate": zero_default(col("GST_RTE")),
        "CGST Amount": zero_default(col("CGST_TOTAL")),
        "SGST Amount": zero_default(col("SGUST_TOTAL")),
        "IGST Amount": zero_default(col("IGST_TOTAL")),
        "CESS Amount": col("CESS"),
        "TCS": col("TCS_TOTAL"),
        "Document Total Amount": col("__document_total"),
        "Export Type": export_kind(null_rate_is_zero=True),
        "Export Bill Number": _shipping_bill("SHIPPING_BILL_NO"),
        "Export Bill Date": _shipping_bill("SHIPPING_BILL_DT"),
        "Export Port Code": col("EXPORT_CODE"),
        "Linked Advance Document Number": _none(),
        "Linked Advance Document Date": _none("date"),
        "Linked Advance Adjustment Amount": _none("decimal(18,3)"),
        "Original Document Number": _none(),
        "Original Document Date": _none("date"),
        "Original Document Customer GSTIN": _none(),
        "Linked Invoice Number": _none(),
        "Linked Invoice Date": _none("date"),
        "Linked Invoice Customer GSTIN": _none(),
        "Is Linked Invoice Pre GST": _none(),
        "Reason for Issuing CDN": _none(),
    }
    return totalled.select(*[c.alias(name) for name, c in columns.items()])


def export_type(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("INVH_NO").alias("invh_no"),
        item_category().alias("item_category"),
        export_kind(null_rate_is_zero=False).alias("export_type"),
    )
