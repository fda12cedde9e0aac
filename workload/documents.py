"""Voucher queries: search, ledger, tax, billing, pricing, parties, dossier."""

from pyspark.sql import functions as F

from docledger.operators import documents as doc
from docledger.operators.keys import common_keys, restrict_to_first_keys
from docledger.operators.ordering import numbered
from docledger.plans.dossiers import DossierSpec, register_dossier
from docledger.sources.files import attach
from workload.base import query

_KEY = "bukrs, gjahr, belnr"
_SHOWN = "bukrs, gjahr, belnr, awkey, xblnr, blart"


@query(
    "doc_search",
    f"""
    select {_SHOWN} from {{bkpf}}
    where (belnr like '%42' or awkey like '%42' or xblnr like '%42') and blart in ('RV', 'DR')
    """,
)
def _doc_search(t):
    return doc.search(t("bkpf"), ["RV", "DR"], "42")


def _numbers(t):
    return t("supplier").select(F.col("s_suppkey").cast("string").alias("number"))


_FOUND = f"""
    select distinct number, {_SHOWN}
    from {{bkpf}} join (select cast(s_suppkey as varchar) as number from {{supplier}}) n
    on belnr like '%' || number or awkey like '%' || number or xblnr like '%' || number
    where blart in ('RV', 'KR')
"""


@query("doc_search_many", _FOUND)
def _doc_search_many(t):
    return doc.search_many(t("bkpf"), _numbers(t), ["RV", "KR"])


@query(
    "doc_search_outcome",
    f"""
    select n.number, count(f.number) as documents,
        case count(f.number) when 0 then 'none' when 1 then 'one' else 'many' end as outcome
    from (select distinct cast(s_suppkey as varchar) as number from {{supplier}}) n
    left join ({_FOUND}) f on f.number = n.number group by 1
    """,
)
def _doc_search_outcome(t):
    numbers = _numbers(t)
    return doc.search_outcome(numbers, doc.search_many(t("bkpf"), numbers, ["RV", "KR"]))


@query(
    "doc_sample",
    f"""
    select {_SHOWN} from {{bkpf}} where blart in ('RV', 'SA')
    order by md5(bukrs || '|' || gjahr || '|' || belnr), {_KEY} limit 1000
    """,
)
def _doc_sample(t):
    return doc.sample_documents(t("bkpf"), ["RV", "SA"], 1000)


@query(
    "doc_header",
    f"""
    select {", ".join(doc.HEADER_COLUMNS)} from {{bkpf}}
    where ({_KEY}) in (select {_KEY} from {{bseg}} where koart = 'K')
    """,
)
def _doc_header(t):
    return doc.header(t("bkpf"), t("bseg").where("koart = 'K'"))


def _texted(lines: str, join: str = "left join") -> str:
    return f"""{lines} b left join {{t001}} c on c.bukrs = b.bukrs
    {join} {{skat}} s on b.hkont = s.saknr and s.spras = 'E' and s.ktopl = c.ktopl"""


_PAYABLE = "(select * from {bseg} where (bukrs, gjahr, belnr) in (select bukrs, gjahr, belnr from {bkpf} where blart = 'RV'))"
_SIDES = """case when shkzg = 'S' then cast(cast(dmbtr as float) as double) / 1.0 end as dmbtr_debit,
    case when shkzg = 'H' then cast(cast(dmbtr as float) as double) / 1.0 end as dmbtr_credit"""
_LEDGER = ", ".join(
    "b.bukrs" if c == "bukrs" else c for c in (*doc.DOC_KEY, *doc.LEDGER_COLUMNS) if not c.startswith("dmbtr")
)


def _chosen(t):
    return t("bkpf").where("blart = 'RV'")


@query("ledger_lines", f"select {_LEDGER}, {_SIDES} from {_texted(_PAYABLE)}")
def _ledger_lines(t):
    return doc.ledger_lines(t("bseg"), t("t001"), t("skat"), _chosen(t))


@query("require_text", f"select {_LEDGER}, {_SIDES} from {_texted('{bseg}', 'join')}")
def _require_text(t):
    return doc.ledger_lines(t("bseg"), t("t001"), t("skat"), require_text=True)


@query(
    "ledger_summary",
    f"""
    select b.bukrs, gjahr, belnr, hkont, txt50,
        cast(cast(sum(case when shkzg = 'S' then cast(cast(dmbtr as float) as double) else 0 end) as float) as double)
            as dmbtr_debit_sum,
        cast(cast(sum(case when shkzg = 'H' then cast(cast(dmbtr as float) as double) else 0 end) as float) as double)
            as dmbtr_credit_sum
    from {_texted("{bseg}")} group by all
    """,
)
def _ledger_summary(t):
    return doc.ledger_summary(t("bseg"), t("t001"), t("skat"))


@query(
    "tax_lines",
    f"""
    select {_KEY}, buzei, kschl, ktosl, txgrp, mwskz, hkont, txt50,
        cast(cast(hwbas as float) as double) / 100.0 as hwbas, cast(cast(hwste as float) as double) / 100.0 as hwste,
        cast(cast(kbetr as float) as double) / 100.0 as kbetr
    from {{bset}} left join {{skat}} on hkont = saknr and spras = 'E'
    """,
)
def _tax_lines(t):
    return doc.tax_lines(t("bset"), t("skat"), factor=100.0)


@query(
    "tax_codes",
    f"""
    select {_KEY}, mwskz, text1
    from (select {_KEY}, mwskz from {{bseg}} union select {_KEY}, mwskz from {{bset}})
    join {{t007s}} using (mwskz) where spras = 'E' and kalsm = 'TAXINN'
    """,
)
def _tax_codes(t):
    return doc.tax_codes(t("bseg"), t("bset"), t("t007s"), "TAXINN")


_BILLED = "(select awkey from {bkpf} where blart = 'RV')"


def _billing(t):
    return doc.billing_keys(_chosen(t))


@query("billing_header", f"select * from {{vbrk}} where vbeln in {_BILLED}")
def _billing_header(t):
    return doc.billing_rows(t("vbrk"), _billing(t))


@query("billing_items", f"select * from {{vbrp}} where vbeln in {_BILLED}")
def _billing_items(t):
    return doc.billing_rows(t("vbrp"), _billing(t))


@query("billing_partners", f"select * from {{vbpa}} where vbeln in {_BILLED}")
def _billing_partners(t):
    return doc.billing_rows(t("vbpa"), _billing(t))


_TEXT = """(select kschl, vtext from (select *, row_number() over (partition by kschl order by spras, vtext) as rn
    from {t685t}) where rn = 1)"""


@query(
    "pricing_text",
    f"""
    select knumv, kposn, p.kschl, kinak, cast(kwert as double) as kwert, vtext from {{prcd}} p join {_TEXT} x
    on x.kschl = p.kschl
    where knumv in (select knumv from {{vbrk}} where vbeln in {_BILLED})
    """,
)
def _pricing_text(t):
    billed = doc.billing_rows(t("vbrk"), _billing(t))
    return doc.pricing_lines(t("prcd"), t("t685t"), billed)


@query(
    "pricing_summary",
    f"""
    select knumv, kinak, p.kschl, vtext, cast(sum(kwert) as double) as kwert_sum from {{prcd}} p join {_TEXT} x
    on x.kschl = p.kschl group by all
    """,
)
def _pricing_summary(t):
    return doc.pricing_summary(t("prcd"), t("t685t"))


@query(
    "vendors",
    f"""
    select {_KEY}, l.lifnr, name1, stcd3
    from (select {_KEY}, lifnr from {{bseg}} where lifnr <> '' union
          select {_KEY}, gst_part from {{bseg}} where gst_part <> '') i join {{lfa1}} l on l.lifnr = i.lifnr
    """,
)
def _vendors(t):
    return doc.vendors(t("bseg"), t("lfa1"))


_WITH_DOC = "(select {bkpf}.bukrs, {bkpf}.gjahr, {bkpf}.belnr, v.* from {bkpf} join {table} v on v.vbeln = {bkpf}.awkey)"


def _with_doc(table: str) -> str:
    return _WITH_DOC.replace("{table}", "{" + table + "}")


@query(
    "customers",
    f"""
    select {_KEY}, k.kunnr, name1, stcd3, land1
    from (select {_KEY}, kunnr from {{bseg}} where kunnr <> '' union
          select {_KEY}, kunrg from {_with_doc("vbrk")} union
          select {_KEY}, kunag from {_with_doc("vbrk")}) i join {{kna1}} k on k.kunnr = i.kunnr
    """,
)
def _customers(t):
    billed = doc.with_document(t("vbrk"), doc.billing_keys(t("bkpf")))
    return doc.customers(t("bseg"), billed, t("kna1"))


@query(
    "own_tax_ids",
    f"""
    select {_KEY}, w.werks, name1, stcd3
    from (select {_KEY}, bupla as werks from {{bseg}} union
          select {_KEY}, bupla from {_with_doc("vbrk")} union
          select {_KEY}, werks from {_with_doc("vbrp")}) i
    join {{t001w}} w on w.werks = i.werks join {{lfa1}} l on l.lifnr = w.lifnr
    """,
)
def _own_tax_ids(t):
    keys = doc.billing_keys(t("bkpf"))
    return doc.own_tax_ids(
        t("bseg"), doc.with_document(t("vbrk"), keys), doc.with_document(t("vbrp"), keys), t("t001w"), t("lfa1")
    )


_DOSSIER_FIELDS = (("doc_date", "cast(doc_date as varchar)"), ("supplier_gstin", "lpad(supplier_gstin, 10, '0')"),
                   ("taxable", "cast(cast(round_even(abs(cast(taxable as double)), 0) as bigint) as varchar)"))
_BLOCK = "doc_no || chr(10) || " + " || ".join(
    f"chr(10) || chr(9) || '{name.ljust(15)}: ' || coalesce({cell}, '')" for name, cell in _DOSSIER_FIELDS
) + " || chr(10) || chr(10)"
_DOSSIER_ORDER = "taxable, l_linenumber, l_partkey, l_suppkey, l_quantity"


def _dossier_sql(source: str) -> str:
    return f"""
    select doc_no as document, page, string_agg(block, '' order by ordinal) as "text"
    from (select doc_no, ordinal, (ordinal - 1) // 3 + 1 as page, {_BLOCK} as block
          from (select *, row_number() over (partition by doc_no order by {_DOSSIER_ORDER}) as ordinal from {source}))
    group by 1, 2
    """


def _dossier(df):
    return doc.dossier(
        df,
        key=["doc_no"],
        order_by=_DOSSIER_ORDER.split(", "),
        numbers=["taxable"],
        pads={"supplier_gstin": 10},
        skip=["gstin", "cgst", "sgst", "igst", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"],
        rows_per_page=3,
    )


@query("dossier", _dossier_sql("{gen}"))
def _dossier_all(t):
    return _dossier(t("gen"))


@query(
    "dossier_common",
    _dossier_sql(
        """(select * from {cus} where doc_no in (select doc_no from (
            select doc_no from {gen} intersect select doc_no from {cus}) order by doc_no limit 1000))"""
    ),
)
def _dossier_common(t):
    keys = common_keys(t("gen"), t("cus"), "doc_no")
    return _dossier(restrict_to_first_keys(t("cus"), keys, "doc_no", 1000))


@query(
    "ledger_ordered",
    f"""
    select {_KEY}, buzei, row_number() over (
        order by bukrs, gjahr, belnr, shkzg desc nulls last, buzei nulls last) as position
    from {_PAYABLE} l
    """,
)
def _ledger_ordered(t):
    ledger = doc.ledger_lines(t("bseg"), t("t001"), t("skat"), _chosen(t))
    return numbered(doc.ledger_order(ledger)).select(*doc.DOC_KEY, "buzei", "position")


@query(
    "summary_ordered",
    f"""
    with s as (
        select b.bukrs, gjahr, belnr, hkont, txt50,
            cast(sum(case when shkzg = 'S' then cast(cast(dmbtr as float) as double) else 0 end) as float) as debit,
            cast(sum(case when shkzg = 'H' then cast(cast(dmbtr as float) as double) else 0 end) as float) as credit
        from {_texted("{bseg}")} group by all)
    select {_KEY}, cast(debit + credit as double) as both_sides,
        row_number() over (order by bukrs, gjahr, belnr, debit + credit) as position
    from s
    """,
)
def _summary_ordered(t):
    summary = doc.ledger_summary(t("bseg"), t("t001"), t("skat"))
    total = (F.col("dmbtr_debit_sum") + F.col("dmbtr_credit_sum")).alias("both_sides")
    return numbered(doc.summary_order(summary)).select(*doc.DOC_KEY, total, "position")


@query(
    "tax_ordered",
    f"""
    select {_KEY}, buzei, row_number() over (order by {_KEY}, buzei nulls last, kschl, hkont, txt50) as position
    from {{bset}} left join {{skat}} on hkont = saknr and spras = 'E'
    """,
)
def _tax_ordered(t):
    lines = doc.tax_lines(t("bset"), t("skat"), factor=100.0)
    return numbered(doc.tax_order(lines)).select(*doc.DOC_KEY, "buzei", "position")


@query(
    "pricing_ordered",
    f"""
    select knumv, kposn, row_number() over (order by knumv, kposn nulls last) as position
    from {{prcd}} p join {_TEXT} x on x.kschl = p.kschl
    """,
)
def _pricing_ordered(t):
    return numbered(doc.pricing_order(doc.pricing_lines(t("prcd"), t("t685t")))).select("knumv", "kposn", "position")


@query(
    "pricing_summary_ordered",
    f"""
    with s as (
        select knumv, kinak, p.kschl, vtext, cast(sum(kwert) as double) as kwert_sum from {{prcd}} p join {_TEXT} x
        on x.kschl = p.kschl group by all)
    select knumv, kinak, kwert_sum, row_number() over (order by knumv, kinak nulls last, kwert_sum nulls last) as position from s
    """,
)
def _pricing_summary_ordered(t):
    summary = doc.pricing_summary(t("prcd"), t("t685t"))
    return numbered(doc.pricing_summary_order(summary)).select("knumv", "kinak", "kwert_sum", "position")


_BY_AMOUNT = DossierSpec(
    key="doc_no", numbers=("taxable",), pads={"supplier_gstin": 10}, order_amount="amount",
    skip=("gstin", "cgst", "sgst", "igst", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "amount"),
)
_AMOUNT = "case when l_linenumber = 3 then 'n/a' else replace(cast(cast(taxable as decimal(18,2)) as varchar), '.', ',') end"


@query(
    "dossier_by_amount",
    f"""
    select doc_no as document, page, string_agg(block, '' order by ordinal) as "text"
    from (select doc_no, ordinal, (ordinal - 1) // 10000 + 1 as page, {_BLOCK} as block
          from (select *, row_number() over (partition by doc_no order by
                    cast(try_cast(replace(amount, ',', '') as float) as double) nulls first,
                    gstin nulls first, supplier_gstin nulls first, doc_date nulls first, taxable, cgst, sgst, igst, l_linenumber,
                    l_partkey, l_suppkey, l_quantity, amount) as ordinal
                from (select *, {_AMOUNT} as amount from {{gen}})))
    group by 1, 2
    """,
)
def _dossier_by_amount(t):
    """Rows of a document by an amount read from text, commas removed, unreadable ones first."""
    amount = F.when(F.col("l_linenumber") == 3, "n/a").otherwise(
        F.translate(F.col("taxable").cast("decimal(18,2)").cast("string"), ".", ",")
    )
    return register_dossier(t("gen").withColumn("amount", amount), _BY_AMOUNT)


@query(
    "attached_fallback",
    "select knumv, kschl, cast(kwert as double) as kwert from {prcd}",
)
def _attached_fallback(t):
    """Pricing rows through an attached layer, under the second name of two."""
    attach({"prcd_elements": t("prcd")}, "layer")
    return t.spark.table(doc.first_available(t.spark, ["layer_konv", "layer_prcd_elements"])).select("knumv", "kschl", "kwert")
