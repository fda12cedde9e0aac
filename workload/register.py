"""Register, export type, model run and lookup queries."""

from pyspark.sql import functions as F

from docledger.operators.lookup import enrich
from docledger.plans.models import attach_published, published, sale_project
from docledger.plans.register import export_type, sales_register
from docledger.sources.files import attach_layer
from docledger.sources.sinks import write_register
from workload.base import query

_X = "INVH_FORM_CODE in ('EXPORT','NEPAL','BHUTAN')"
_P2 = "try_cast(left(HSN_CODE, 2) as integer)"
_CATEGORY = f"case when {_P2} = 99 then 'S' when HSN_CODE is not null then 'G' end"
_BILL = f"coalesce({_P2} <> 99, HSN_CODE is not null) and {_X} and GST_RTE is not null"
_NULL_TEXTS = (
    "Applicable Tax Rate", "Is Reverse Charge", "Is GST TDS Deducted", "Customer State", "Customer Taxpayer Type",
    "Linked Advance Document Number", "Original Document Number", "Original Document Customer GSTIN",
    "Linked Invoice Number", "Linked Invoice Customer GSTIN", "Is Linked Invoice Pre GST", "Reason for Issuing CDN",
)
_NULL_DATES = ("Linked Advance Document Date", "Original Document Date", "Linked Invoice Date")

_REGISTER = f"""
select
    case when TRANS_TYPE = 'INV' and INVH_TXN_CODE in ('DSASIL','DSATAL','DSA-V') then 'Debit Note'
         when TRANS_TYPE = 'INV' then 'Invoice' when TRANS_TYPE = 'SARTN' then 'Credit Note' else '' end as "Document Type",
    INVH_TXN_CODE || INVH_NO as "Document Number",
    INVH_DT as "Document Date",
    case when {_X} then '96' when GST_NO in ('URP','*URP*') and INVH_FORM_CODE = 'LOCAL' then ' '
         else left(GST_NO, 2) end as "Place of Supply",
    case when INVH_FORM_CODE in ('EXEMPT','NIL RATED','NON-GST') then 'Y' end as "Is this a Bill of supply",
    GST_NOO as "My GSTIN", COMP_NAME as "Company Name", INVH_COMP_CODE as "Comapany Code",
    case when INVH_FORM_CODE = 'LOCAL' and GST_NO in ('URP','URP*') then ' ' when {_X} then 'URP'
         else GST_NO end as "Customer GSTIN",
    CUST_NAME as "Customer Name", ADDRESS as "Customer Address", CITY_CODE as "Customer City",
    {_CATEGORY} as "Item_Category",
    INVI_ITEM_DESC as "Item Description", HSN_CODE as "HSN or SAC code", DIS_QTY as "Item Quantity",
    BASE_UOM as "Item Unit Code", cast(INR_RATE as double) as "Item Unit Price",
    cast(DIS as double) as "Item Discount Amount", cast(ITEM_TOTAL as double) as "Item Taxable Amount",
    case when INVH_FORM_CODE in ('EXEMPTED','NIL_RATED','NON_GST_SUPPLY') then INVH_FORM_CODE end as "Zero Tax Category",
    cast(coalesce(GST_RTE, 0) as double) as "GST Rate",
    cast(coalesce(CGST_TOTAL, 0) as double) as "CGST Amount",
    cast(coalesce(SGUST_TOTAL, 0) as double) as "SGST Amount",
    cast(coalesce(IGST_TOTAL, 0) as double) as "IGST Amount",
    cast(CESS as double) as "CESS Amount", cast(TCS_TOTAL as double) as "TCS",
    cast(sum(TOTAL) over (partition by INVH_NO, INVH_TXN_CODE) as double) as "Document Total Amount",
    case when {_X} and GST_RTE <> 0 then 'EXPWP' when {_X} then 'EXPWOP'
         when INVH_FORM_CODE = 'SEZ SALE' and GST_RTE <> 0 then 'SEZWP'
         when INVH_FORM_CODE = 'SEZ SALE' then 'SEZWOP' end as "Export Type",
    case when {_BILL} then SHIPPING_BILL_NO else ' ' end as "Export Bill Number",
    case when {_BILL} then SHIPPING_BILL_DT else ' ' end as "Export Bill Date",
    EXPORT_CODE as "Export Port Code",
    cast(null as double) as "Linked Advance Adjustment Amount",
    {", ".join(f'cast(null as varchar) as "{c}"' for c in _NULL_TEXTS)},
    {", ".join(f'cast(null as date) as "{c}"' for c in _NULL_DATES)}
from {{sales}}
where INVH_TXN_CODE not in ('EINVC-TAL-BC','EINVC-TAL','EINVC-SIL','DNCNGS')
"""

_EXPORT = f"""
select INVH_NO as invh_no, {_CATEGORY} as item_category,
    case when {_X} and GST_RTE <> 0 then 'EXPWP' when {_X} and GST_RTE = 0 then 'EXPWOP'
         when INVH_FORM_CODE = 'SEZ SALE' and GST_RTE <> 0 then 'SEZWP'
         when INVH_FORM_CODE = 'SEZ SALE' and GST_RTE = 0 then 'SEZWOP' end as export_type
from {{sales}}
"""


@query("sales_register", _REGISTER)
def _sales_register(t):
    return sales_register(t("sales"))


@query("export_type", _EXPORT)
def _export_type(t):
    return export_type(t("sales"))


@query("model_run", _REGISTER)
def _model_run(t):
    """The register as the project publishes it, all its columns."""
    root = t.scratch()
    sale_project().run(t.spark, {"raw.sales": t("sales")}, root)
    return published(t.spark, root)["s_sale.sales_register"]


@query("model_run_after_failure", _EXPORT)
def _model_run_after_failure(t):
    """A later run whose second model fails leaves both tables of the run before."""
    root = t.scratch()
    project = sale_project()
    project.run(t.spark, {"raw.sales": t("sales")}, root)

    def broken(register):
        return register.select(F.raise_error(F.concat(F.lit("no "), F.col("Document Number"))).cast("string").alias("x"))

    project.add("sale", "late", ["s_sale.sales_register"], broken)
    try:
        project.run(t.spark, {"raw.sales": t("sales").where(F.col("HSN_CODE").isNotNull())}, root)
    except Exception as error:
        if "no " not in str(error):
            raise
    else:
        raise AssertionError("the run should have failed")
    tables = published(t.spark, root)
    if set(tables) != {"s_sale.sales_register", "s_sale.export_type"}:
        raise AssertionError(f"published {sorted(tables)}")
    return tables["s_sale.export_type"]


@query(
    "layers_by_name",
    f"""
    select r.invh_no, r.lines, e.typed from
        (select INVH_NO as invh_no, count(*) as lines from {{sales}} group by 1) r
        join (select invh_no, count(export_type) as typed from ({_EXPORT}) group by 1) e on r.invh_no = e.invh_no
    """,
)
def _layers_by_name(t):
    """Raw and model layers read by their SQL names, one built from the other."""
    root = t.scratch()
    write_register(t("sales"), f"{root}/input/sales")
    attach_layer(t.spark, "raw", {"sales": f"{root}/input/sales"}, f"{root}/catalog")
    sale_project().run(t.spark, {"raw.sales": t.spark.table("raw.sales")}, root)
    attach_published(t.spark, root)
    return t.spark.sql(
        """
        select r.invh_no, r.lines, e.typed
        from (select INVH_NO as invh_no, count(*) as lines from raw.sales group by 1) r
        join (select invh_no, count(export_type) as typed from s_sale.export_type group by 1) e on r.invh_no = e.invh_no
        """
    )


@query(
    "seed_enrich",
    """
    select c_custkey, c_name, c_nationkey, label as nation_label
    from {customer} left join (select code, min(label) as label from {labels_by_nation} group by code) l
    on c_nationkey = l.code
    """,
)
def _seed_enrich(t):
    lines = t("customer").select("c_custkey", "c_name", "c_nationkey")
    return enrich(lines, t("labels_by_nation"), {"c_nationkey": "code"}, {"label": "nation_label"})
