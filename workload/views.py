"""Input views over the given tables, in SQL both engines read the same way.

Each view keeps every row of its tables. Codes that the rules branch on are
derived from the row's own columns.
"""

_KEYS = """cast(1000 + {key} % 3 as string) as bukrs,
    cast(1995 + {key} % 7 as string) as gjahr,
    lpad(cast({key} as string), 10, '0') as belnr"""


def _doc_key(key: str) -> str:
    return _KEYS.replace("{key}", key)


def _billing_no(key: str) -> str:
    return f"'B' || lpad(cast({key} as string), 9, '0')"


VIEWS = {
    # Raw invoice lines, one per lineitem row.
    "sales": """
    select
        'Company ' || cast(l_suppkey % 4 as string) as COMP_NAME,
        cast(100 + l_suppkey % 3 as string) as INVH_COMP_CODE,
        case when l_linestatus = 'O' then '27AAAAA' else '07BBBBB' end || cast(l_suppkey % 5 as string) as GST_NOO,
        case when l_linenumber = 3 then null
             else cast(cast(l_tax as decimal(4,2)) * 100 as decimal(18,3)) end as GST_RTE,
        case when l_linenumber = 7 then 'OTH' when l_returnflag = 'R' then 'SARTN' else 'INV' end as TRANS_TYPE,
        case l_suppkey % 10 when 0 then 'DSASIL' when 1 then 'DSATAL' when 2 then 'DSA-V' when 3 then 'TALMOL'
             when 4 then 'SILTRF' when 5 then 'RTNSIL' when 6 then 'EINVC-TAL' when 7 then 'DNCNGS'
             when 8 then null else 'TRDEXP' end as INVH_TXN_CODE,
        case when l_quantity = 13 then null else cast(l_orderkey as string) end as INVH_NO,
        cast(l_shipdate as date) as INVH_DT,
        'Customer ' || cast(l_partkey % 97 as string) as CUST_NAME,
        case l_partkey % 13 when 0 then 'EXPORT' when 1 then 'NEPAL' when 2 then 'BHUTAN' when 3 then 'SEZ SALE'
             when 4 then 'EXEMPT' when 5 then 'NIL RATED' when 6 then 'NON-GST' when 7 then 'EXEMPTED'
             when 8 then 'NIL_RATED' when 9 then 'NON_GST_SUPPLY' when 10 then null else 'LOCAL' end as INVH_FORM_CODE,
        case l_partkey % 5 when 0 then '2710' when 1 then '9965' when 2 then 'AB12' when 3 then null
             else '84' end || case when l_linenumber > 4 then '00' else '' end as HSN_CODE,
        'Item ' || cast(l_partkey as string) as INVI_ITEM_DESC,
        cast(l_extendedprice as decimal(18,3)) as ITEM_TOTAL,
        case when l_linenumber = 2 then null
             else cast(cast(l_discount as decimal(4,2)) * 10 as decimal(18,3)) end as CESS,
        cast(cast(l_tax as decimal(4,2)) * 7 as decimal(18,3)) as TCS_TOTAL,
        cast(l_discount as decimal(18,3)) as DIS,
        case when l_linestatus = 'O' then cast(l_quantity as decimal(18,3)) end as CGST_TOTAL,
        case when l_linestatus = 'O' then cast(l_quantity as decimal(18,3)) end as SGUST_TOTAL,
        case when l_linestatus = 'F' then cast(l_quantity as decimal(18,3)) end as IGST_TOTAL,
        cast(cast(l_extendedprice as decimal(18,3)) + cast(l_quantity as decimal(18,3)) as decimal(18,3)) as TOTAL,
        'Street ' || cast(l_suppkey as string) as ADDRESS,
        'City' || cast(l_suppkey % 7 as string) as CITY_CODE,
        case l_suppkey % 6 when 0 then 'URP' when 1 then '*URP*' when 2 then 'URP*' when 3 then null
             else '24CCCCC' || cast(l_suppkey as string) end as GST_NO,
        'SB' || cast(l_orderkey % 1000 as string) as SHIPPING_BILL_NO,
        cast(cast(l_shipdate as date) as string) as SHIPPING_BILL_DT,
        cast(cast(l_quantity as decimal(18,0)) as string) as DIS_QTY,
        cast(l_extendedprice as decimal(18,3)) as INR_RATE,
        case when l_linenumber % 2 = 0 then 'KGS' else 'LTR' end as BASE_UOM,
        case when l_partkey % 13 < 3 then 'PORT' || cast(l_suppkey % 4 as string) end as EXPORT_CODE
    from {lineitem}
    """,
    # Generated register lines and the customer's own list of the same documents.
    "gen": """
    select
        'D' || cast(l_orderkey as string) as doc_no,
        case when l_suppkey % 4 = 3 then null else 'G' || cast(l_suppkey % 4 as string) end as gstin,
        'S' || cast(l_suppkey % 2 as string) as supplier_gstin,
        cast(l_shipdate as date) as doc_date,
        cast(l_extendedprice as decimal(18,3)) as taxable,
        cast(l_quantity as decimal(18,3)) as cgst,
        cast(l_quantity as decimal(18,3)) as sgst,
        cast(cast(l_discount as decimal(4,2)) * 100 as decimal(18,3)) as igst,
        l_linenumber, l_partkey, l_suppkey, l_quantity
    from {lineitem}
    """,
    "cus": """
    select
        'D' || cast(l_orderkey as string) || case when l_discount = 0.1 then 'R' else '' end as doc_no,
        case when l_suppkey % 4 = 3 then null else 'G' || cast(l_suppkey % 4 as string) end as gstin,
        'S' || cast(l_suppkey % 2 as string) as supplier_gstin,
        case when l_quantity = 50 then null else cast(l_shipdate as date) end as doc_date,
        cast(cast(l_extendedprice as decimal(18,3)) + case when l_tax = 0.08 then 1 else 0 end as decimal(18,3)) as taxable,
        cast(l_quantity as decimal(18,3)) as cgst,
        cast(cast(l_quantity as decimal(18,3)) + case when l_tax = 0.07 then 2 else 0 end as decimal(18,3)) as sgst,
        cast(cast(l_discount as decimal(4,2)) * 100 as decimal(18,3)) as igst,
        l_linenumber, l_partkey, l_suppkey, l_quantity
    from {lineitem}
    """,
    # Reconciliation details, ingestion errors and statistics.
    "details": """
    select
        l_orderkey as doc_id, l_linenumber as line_no, l_partkey as part_id,
        'row' as bucket_label,
        case when l_returnflag = 'N' then 'Exact' when l_returnflag = 'A' or l_linestatus = 'O' then 'Mismatch'
             else 'Missing in register' end as match_status,
        case l_linenumber when 1 then 'Taxable Value,IGST' when 2 then 'Document Date' when 3 then 'CGST, SGST'
             when 4 then 'CGST,,IGST' when 5 then '' when 6 then 'Place of Supply,' else null end as mismatch_fields,
        cast(l_extendedprice as decimal(18,3)) as govt_taxable,
        cast(case l_linenumber when 1 then l_extendedprice + 5 when 2 then l_extendedprice
             when 3 then l_extendedprice - l_quantity when 4 then l_extendedprice - l_quantity * 20
             when 5 then l_extendedprice - l_quantity * 300 else 0 end as decimal(18,3)) as register_taxable,
        cast(case l_linenumber when 1 then 0 - l_quantity when 2 then l_discount when 3 then l_quantity
             when 4 then l_quantity * 10 when 5 then l_quantity * 100 when 6 then l_extendedprice * 10
             else null end as decimal(18,3)) as tax_diff,
        case l_suppkey % 5 when 0 then 'B2B' when 1 then 'CDN' when 2 then 'B2BA' when 3 then 'CDNA' else 'IMPG' end
            as govt_section,
        case l_partkey % 5 when 0 then 'B2B' when 1 then 'CDN' when 2 then 'B2BA' when 3 then 'CDNA' else null end
            as register_section
    from {lineitem}
    """,
    "errors": """
    select event_id as row_id,
        '[E' || cast(user_id % 5 as string) || '] ' || event_type || ' is, not valid'
        || case when event_type in ('error', 'click') then ', [E9] amount, wrong' else '' end as error_message
    from {events}
    """,
    "stats": """
    select event_id,
        '[{{"gstin":"G' || cast(user_id as string) || '","totalDocumentCount":' || cast(event_id as string)
        || ',"processedRecords":' || cast(event_id + 3 as string) || ',"invalidRecords":1,"validRecords":'
        || cast(event_id + 2 as string) || '}},{{"gstin":"' || event_type
        || '","totalDocumentCount":2,"processedRecords":2,"invalidRecords":0,"validRecords":2}}]' as stats
    from {events}
    """,
    "tasks": """
    select o_orderkey,
        '{{"request":{{"fileInfo":{{"sales":[{{"s3FileUrl":"u/' || cast(o_orderkey as string)
        || '","userFileName":"a.csv"}},{{"s3FileUrl":"v/' || cast(o_custkey as string)
        || '","userFileName":"b.csv"}}],"purchase":[{{"s3FileUrl":"w/' || o_orderstatus
        || '","userFileName":"c.xlsx"}}]}}}}}}' as task
    from {orders}
    """,
    # Voucher tables.
    "bkpf": f"""
    select {_doc_key("o_orderkey")},
        {_billing_no("o_orderkey")} as awkey, 'VBRK' as awtyp,
        case o_orderpriority when '1-URGENT' then 'RV' when '2-HIGH' then 'DR' when '3-MEDIUM' then 'KR'
             else 'SA' end as blart,
        'R' || cast(o_custkey as string) as xblnr,
        cast(o_orderdate as date) as budat, cast(o_orderdate as date) as bldat, cast(o_orderdate as date) as cpudt,
        case when o_orderstatus = 'P' then 'X' else '' end as xreversal,
        'FB' || o_orderstatus as tcode, 'user' || cast(o_custkey % 10 as string) as usnam
    from {{orders}}
    """,
    "bseg": f"""
    select {_doc_key("l_orderkey")},
        l_linenumber as buzei, case when l_returnflag = 'R' then 'K' else 'S' end as koart,
        case when l_tax = 0 then '' else 'T' end as buzid, cast(l_linenumber % 3 as string) as txgrp,
        case when l_linestatus = 'O' then 'S' else 'H' end as shkzg,
        'V' || cast(l_partkey % 30 as string) as mwskz, 'JI' || l_returnflag as ktosl,
        cast(l_suppkey as string) as hkont, 'Part ' || cast(l_partkey as string) as sgtxt,
        cast(l_orderkey - 1 as string) as rebzg, '1999' as rebzj,
        cast(cast(l_extendedprice as decimal(18,2)) as string) as dmbtr,
        'P' || cast(l_suppkey % 25 as string) as bupla, 'P' || cast(l_partkey % 25 as string) as werks,
        'C' || cast(l_partkey % 9 as string) as prctr, cast(l_suppkey as string) as lifnr,
        case when l_linenumber = 1 then cast(l_partkey as string) else '' end as kunnr,
        case when l_returnflag = 'R' then cast(l_suppkey + 1 as string) end as gst_part,
        cast(l_partkey % 9000 as string) as hsn_sac
    from {{lineitem}}
    """,
    "bset": f"""
    select {_doc_key("l_orderkey")},
        l_linenumber as buzei, 'JO' || l_linestatus as kschl, 'JI' || l_returnflag as ktosl,
        cast(l_linenumber % 3 as string) as txgrp, 'V' || cast(l_suppkey % 30 as string) as mwskz,
        cast(l_suppkey as string) as hkont,
        cast(cast(l_extendedprice as decimal(18,2)) as string) as hwbas,
        cast(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)) as string) as hwste,
        cast(cast(l_tax as decimal(4,2)) * 1000 as string) as kbetr
    from {{lineitem}}
    """,
    "t001": """
    select cast(1000 + r_regionkey as string) as bukrs,
        case when r_regionkey % 2 = 0 then 'INT' else 'CAIN' end as ktopl
    from {region}
    """,
    "skat": """
    select cast(s_suppkey as string) as saknr, 'E' as spras,
        case when s_nationkey % 2 = 0 then 'INT' else 'CAIN' end as ktopl, s_name as txt50 from {supplier}
    union all
    select cast(s_suppkey as string) as saknr, 'D' as spras,
        case when s_nationkey % 2 = 0 then 'INT' else 'CAIN' end as ktopl, 'Konto ' || s_name as txt50 from {supplier}
    union all
    select cast(s_suppkey as string) as saknr, 'E' as spras, 'YK' as ktopl, 'Other ' || s_name as txt50
    from {supplier} where s_nationkey < 5
    """,
    "t007s": """
    select 'E' as spras, case when n_regionkey < 3 then 'TAXINN' else 'TAXD' end as kalsm,
        'V' || cast(n_nationkey as string) as mwskz, n_name as text1 from {nation}
    union all
    select 'D' as spras, 'TAXINN' as kalsm, 'V' || cast(n_nationkey as string) as mwskz, 'Steuer ' || n_name as text1
    from {nation}
    """,
    "vbrk": f"""
    select {_billing_no("o_orderkey")} as vbeln, 'K' || cast(o_orderkey as string) as knumv,
        cast(o_custkey as string) as kunrg, cast(o_custkey + 1 as string) as kunag,
        'P' || cast(o_custkey % 25 as string) as bupla
    from {{orders}} where o_orderstatus <> 'P'
    """,
    "vbrp": f"""
    select {_billing_no("l_orderkey")} as vbeln, l_linenumber as posnr,
        'P' || cast(l_partkey % 25 as string) as werks, l_partkey as matnr
    from {{lineitem}}
    """,
    "vbpa": f"""
    select {_billing_no("o_orderkey")} as vbeln, case when o_orderstatus = 'F' then 'AG' else 'RG' end as parvw,
        cast(o_custkey as string) as kunnr
    from {{orders}}
    """,
    "prcd": """
    select 'K' || cast(l_orderkey as string) as knumv, l_linenumber as kposn, 'PR0' || l_returnflag as kschl,
        case when l_linestatus = 'O' then 'X' else '' end as kinak, cast(l_extendedprice as decimal(18,2)) as kwert
    from {lineitem}
    """,
    "t685t": """
    select 'PR0' || case p_size % 3 when 0 then 'A' when 1 then 'N' else 'Z' end as kschl,
        case when p_size % 2 = 0 then 'E' else 'D' end as spras, p_name || ' ' || p_brand as vtext
    from {part}
    """,
    "lfa1": """
    select cast(s_suppkey as string) as lifnr, s_name as name1, '27V' || cast(s_suppkey as string) as stcd3
    from {supplier}
    """,
    "kna1": """
    select cast(c_custkey as string) as kunnr, c_name as name1, '24K' || cast(c_custkey as string) as stcd3,
        'L' || cast(c_nationkey as string) as land1
    from {customer}
    """,
    "t001w": """
    select 'P' || cast(n_nationkey as string) as werks, cast(n_nationkey * 3 as string) as lifnr from {nation}
    """,
    # A lookup that defines some codes more than once.
    "labels_by_nation": """
    select n_nationkey as code, n_name as label from {nation} where n_regionkey < 4
    union all
    select s_nationkey as code, s_name as label from {supplier} where s_acctbal > 0
    """,
    # Two versions of the order table.
    "orders_old": """
    select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as decimal(18,2)) as total,
        cast(o_orderdate as date) as order_date, o_orderpriority
    from {orders}
    """,
    "orders_new": """
    select case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then 0 - o_orderkey - 1 else o_orderkey end
            as o_orderkey,
        o_custkey, case when o_custkey % 50 = 7 then null else o_orderstatus end as o_orderstatus,
        cast(cast(o_totalprice as decimal(18,2)) + case when o_orderpriority = '1-URGENT' then 1 else 0 end
            as decimal(18,2)) as total,
        cast(o_orderdate as date) as order_date, o_orderpriority
    from {orders}
    """,
    # Edges order -> customer -> nation -> region, and order -> nation as a second path.
    "edges": """
    select 'O' || cast(o_orderkey as string) as child, 'C' || cast(o_custkey as string) as parent from {orders}
    union all
    select 'C' || cast(c_custkey as string) as child, 'N' || cast(c_nationkey as string) as parent from {customer}
    union all
    select 'N' || cast(n_nationkey as string) as child, 'R' || cast(n_regionkey as string) as parent from {nation}
    union all
    select 'O' || cast(o_orderkey as string) as child, 'N' || cast(o_custkey % 25 as string) as parent from {orders}
    """,
    "starts": """
    select 'O' || cast(o_orderkey as string) as node from {orders}
    """,
    "version_log": """
    select o_orderkey as version, o_orderstatus || cast(o_custkey as string) as file_hash, 'saved' as message,
        'user' as created_by, cast(cast(o_orderdate as date) as string) || ' 00:00:00' as created_at
    from {orders}
    """,
}
