"""Rollup, reconciliation and key-set queries."""

from pyspark.sql import functions as F

from docledger.functions import composite_key
from docledger.operators.keys import common_keys, distinct_values, key_stats, key_union, restrict_to_first_keys
from docledger.operators.rollup import Agg, rollup
from docledger.operators.reconcile import PURCHASE, SALES, STATUS, common_voucher_sums, only_differences, reconcile
from docledger.operators.reports import status_summary
from docledger.sources.catalog import rename_columns
from workload.base import query

TIES = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_taxable"]
_SALES_NAMES = {
    "doc_no": "Document Number", "gstin": "My GSTIN", "taxable": "Item Taxable Amount", "doc_date": "Document Date",
}
_PURCHASE_NAMES = {
    "doc_no": "Voucher Number", "gstin": "My GSTIN", "supplier_gstin": "Supplier GSTIN",
    "taxable": "Item Taxable Amount", "doc_date": "Voucher Date", "cgst": "CGST Amount", "sgst": "SGST Amount",
    "igst": "IGST Amount",
}


def _side(df, names):
    return rename_columns(df.withColumn("l_taxable", F.col("taxable")), names)


def _report(t, spec, names):
    return reconcile(_side(t("gen"), names), _side(t("cus"), names), spec, TIES)


def _rolled(view: str, key: str, columns: dict[str, tuple[str, Agg]]) -> str:
    order = "row(l_linenumber, l_partkey, l_suppkey, l_quantity, taxable)"
    forms = {
        Agg.SUM: "sum({c})",
        Agg.FIRST: "arg_min_null({c}, " + order + ")",
        Agg.SET: "coalesce(string_agg(distinct nullif({c}, ''), '|' order by nullif({c}, '') desc), '')",
    }
    picks = ", ".join(f'{forms[how].replace("{c}", c)} as "{name}"' for name, (c, how) in columns.items())
    return f"select {key} as k, {picks} from {{{view}}} group by 1"


def _report_sql(spec, names) -> str:
    source = {new: old for old, new in names.items()}
    key = " || ".join(f"coalesce({source[c]}, '')" for c in spec.keys)
    columns = {c: (source[c], how) for c, how in spec.columns.items()}

    def number(side: str, c: str) -> str:
        cell = f'{side}."{c}"'
        return f"cast({cell} as double)" if spec.columns[c] is Agg.SUM else cell

    diffs = ", ".join(f"""case when o."{c}" is distinct from c."{c}" then '{c}' end""" for c in columns)
    return f"""
    with o as ({_rolled("gen", key, columns)}), c as ({_rolled("cus", key, columns)}),
    j as (
        select coalesce(o.k, c.k) as "Composite_Key", o.k as "Composite_Key_Out", c.k as "Composite_Key_Cus",
            {", ".join(f'{number("o", c)} as "{c}", {number("c", c)} as "{c}_cus"' for c in columns)},
            concat_ws('|', {diffs}) as "Mismatched Fields"
        from o full join c on o.k = c.k
    ), report as (
        select *, case
            when "Mismatched Fields" = '' and "Composite_Key_Out" is not null and "Composite_Key_Cus" is not null
                then 'Exact'
            when "Composite_Key_Out" is null then 'Missing in CT Generated'
            when "Composite_Key_Cus" is null then 'Missing in Customer'
            else 'Mismatch' end as "Matching Status"
        from j
    )
    """


_SALES_SQL = _report_sql(SALES, _SALES_NAMES)


@query("reconcile_status", _SALES_SQL + "select * from report")
def _reconcile_status(t):
    return _report(t, SALES, _SALES_NAMES)


@query("reconcile_diff_only", _SALES_SQL + "select * from report where \"Matching Status\" <> 'Exact'")
def _reconcile_diff_only(t):
    return only_differences(_report(t, SALES, _SALES_NAMES))


@query("reconcile_purchase", _report_sql(PURCHASE, _PURCHASE_NAMES) + "select * from report")
def _reconcile_purchase(t):
    return _report(t, PURCHASE, _PURCHASE_NAMES)


@query(
    "reconcile_summary",
    _SALES_SQL
    + """
    select "Matching Status" as "Match Status", count("Composite_Key_Cus") as "2b doc count",
        sum("Item Taxable Amount_cus") as "2b taxableValue", count("Composite_Key_Out") as "pr doc count",
        sum("Item Taxable Amount") as "pr taxableValue"
    from report group by 1
    """.replace('sum("Item Taxable Amount_cus")', 'cast(sum(cast("Item Taxable Amount_cus" as decimal(18,3))) as double)')
    .replace('sum("Item Taxable Amount")', 'cast(sum(cast("Item Taxable Amount" as decimal(18,3))) as double)'),
)
def _reconcile_summary(t):
    report = _report(t, SALES, _SALES_NAMES)
    return status_summary(
        report, STATUS, "Composite_Key_Cus", "Item Taxable Amount_cus", "Composite_Key_Out", "Item Taxable Amount"
    )


@query(
    "rollup_sum_first_set",
    _rolled(
        "cus",
        "doc_no",
        {
            "taxable": ("taxable", Agg.SUM),
            "doc_date": ("doc_date", Agg.FIRST),
            "gstin": ("gstin", Agg.SET),
            "supplier_gstin": ("supplier_gstin", Agg.FIRST),
        },
    )
    .replace("as k,", "as doc_no,")
    .replace('sum(taxable) as "taxable"', 'cast(sum(taxable) as double) as "taxable"'),
)
def _rollup(t):
    lines = t("cus").withColumn("l_taxable", F.col("taxable"))
    spec = {"taxable": Agg.SUM, "doc_date": Agg.FIRST, "gstin": Agg.SET, "supplier_gstin": Agg.FIRST}
    return rollup(lines, ["doc_no"], spec, TIES)


@query(
    "composite_key",
    """
    select l_partkey, l_suppkey, coalesce(doc_no, '') || coalesce(gstin, '') as tight,
        coalesce(doc_no, '') || '/' || coalesce(gstin, '') as spaced
    from {gen}
    """,
)
def _composite_key(t):
    return t("gen").select(
        "l_partkey",
        "l_suppkey",
        composite_key(["doc_no", "gstin"]).alias("tight"),
        composite_key(["doc_no", "gstin"], "/").alias("spaced"),
    )


@query("common_keys", "select distinct doc_no from {gen} intersect select distinct doc_no from {cus}")
def _common_keys(t):
    return common_keys(t("gen"), t("cus"), "doc_no")


@query(
    "key_stats",
    """
    select (select count(distinct doc_no) from {gen}) as left_count,
        (select count(distinct doc_no) from {cus}) as right_count,
        (select count(*) from (select doc_no from {gen} intersect select doc_no from {cus})) as common_count
    """,
)
def _key_stats(t):
    return key_stats(t("gen"), t("cus"), "doc_no")


@query("key_union", "select doc_no from {gen} union select doc_no from {cus}")
def _key_union(t):
    return key_union([(t("gen"), "doc_no"), (t("cus"), "doc_no")], "doc_no")


@query(
    "limited_semi",
    """
    select g.doc_no, g.l_partkey, g.l_suppkey, cast(g.taxable as double) as taxable from {gen} g
    where g.doc_no in (
        select doc_no from (select doc_no from {gen} intersect select doc_no from {cus}) order by doc_no limit 10000)
    """,
)
def _limited_semi(t):
    keys = common_keys(t("gen"), t("cus"), "doc_no")
    lines = t("gen").select("doc_no", "l_partkey", "l_suppkey", "taxable")
    return restrict_to_first_keys(lines, keys, "doc_no", 10_000)


_VOUCHERS = {
    "doc_date": "Voucher Date", "doc_no": "Voucher Number", "gstin": "Voucher Reference",
    "supplier_gstin": "Vendor Code",
}


@query(
    "voucher_rollup",
    """
    with g as (
        select 'generated' as side, strftime(doc_date, '%d.%m.%Y') as "Voucher Date", doc_no as "Voucher Number",
            gstin as "Voucher Reference", supplier_gstin as "Vendor Code", cast(sum(cast(cgst as decimal(18,3))) as double) as cgst,
            cast(sum(cast(sgst as decimal(18,3))) as double) as sgst, cast(sum(cast(igst as decimal(18,3))) as double) as igst
        from {gen} group by all),
    c as (
        select 'customer' as side, strftime(doc_date, '%d.%m.%Y') as "Voucher Date", doc_no as "Voucher Number",
            gstin as "Voucher Reference", supplier_gstin as "Vendor Code", cast(sum(cast(cgst as decimal(18,3))) as double) as cgst,
            cast(sum(cast(sgst as decimal(18,3))) as double) as sgst, cast(sum(cast(igst as decimal(18,3))) as double) as igst
        from {cus} group by all),
    k as (select "Voucher Number" from g intersect select "Voucher Number" from c)
    select * from (select * from g union all select * from c)
    where "Voucher Number" in (select "Voucher Number" from k)
    """,
)
def _voucher_rollup(t):
    return common_voucher_sums(
        t("gen"), t("cus"), _VOUCHERS, ["cgst", "sgst", "igst"], "Voucher Number", dates=["doc_date"]
    )


@query("document_types", "select distinct blart from {bkpf}")
def _document_types(t):
    return distinct_values(t("bkpf"), "blart")
