"""Source, schema and scalar-expression queries."""

from pyspark.sql import functions as F

from docledger.functions import composite_key, dotted_date, pad_key, rjust_key, rounded_amount, text_to_real
from docledger.operators.reconcile import PURCHASE, SALES
from docledger.operators.reports import error_counts
from docledger.plans.comparison import Comparison, Override, compare_with_file, run_comparisons
from docledger.sources.catalog import conform, rename_columns, rewrite_key, schema_catalog
from docledger.sources.extract import extract
from docledger.sources.files import read_delimited, read_seed, read_staged, task_files
from docledger.sources.sinks import write_register
from workload.base import query
from workload.reconciliation import _SALES_NAMES, _SALES_SQL, TIES, _side
from workload.reports import _MESSAGES, _ranges

_SPEC = {
    "select": [{"name": c} for c in ("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")],
    "where": [
        {
            "booleanOperator": "AND",
            "listOfExpr": [
                {"expr": {"column": {"name": "o_orderstatus"}, "operator": "=", "value": ["F"]}},
                {"booleanOperator": "AND"},
                {"expr": {"column": {"name": "o_orderdate"}, "operator": ">=", "value": ["01-Apr-1996"]}},
                {"booleanOperator": "AND"},
                {"expr": {"column": {"name": "o_orderdate"}, "operator": "<=", "value": ["01-Jan-1999"]}},
            ],
        }
    ],
}


@query(
    "extract_spec",
    """
    select o_orderkey, o_custkey, o_orderdate, o_totalprice from {orders}
    where o_orderstatus = 'F' and o_orderdate >= timestamp '1996-04-01' and o_orderdate <= timestamp '1999-01-01'
    """,
)
def _extract_spec(t):
    return extract(t("orders"), _SPEC)


@query(
    "conform",
    """
    select p_partkey, p_name, cast(cast(p_retailprice as decimal(18,3)) as double) as p_retailprice,
        cast(p_size as varchar) as p_size, cast(null as varchar) as p_origin, cast(null as date) as p_since
    from {part}
    """,
)
def _conform(t):
    catalog = schema_catalog(
        [
            ("part", "p_partkey", "BIGINT"),
            ("part", "p_name", "VARCHAR(4)"),
            ("part", "p_retailprice", "NUMERIC"),
            ("part", "p_size", "VARCHAR"),
            ("part", "p_origin", "VARCHAR"),
            ("part", "p_since", "DATE"),
        ]
    )
    return conform(t("part"), catalog["part"])


_LINES = [
    ("lineitem", "l_orderkey", "BIGINT"),
    ("lineitem", "l_linenumber", "INTEGER"),
    ("lineitem", "l_returnflag", "VARCHAR"),
    ("lineitem", "l_extendedprice", "NUMERIC"),
    ("lineitem", "l_shipdate", "DATE"),
    ("lineitem", "l_origin", "VARCHAR"),
]


@query(
    "staged_files",
    """
    select l_orderkey, l_linenumber, nullif(l_returnflag, 'N') as l_returnflag,
        cast(cast(l_extendedprice as decimal(18,3)) as double) as l_extendedprice,
        cast(l_shipdate as date) as l_shipdate, cast(null as varchar) as l_origin
    from {lineitem}
    """,
)
def _staged_files(t):
    """Line files in two column orders under one table folder; 'NA' reads as missing."""
    root = t.scratch()
    lines = t("lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "N", "NA").otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"),
    )
    write_register(lines.where("l_linenumber <= 3"), f"{root}/a/lineitem", "csv")
    write_register(lines.where("l_linenumber > 3").select(*reversed(lines.columns)), f"{root}/b/lineitem", "csv")
    return read_staged(t.spark, root, schema_catalog(_LINES))["lineitem"]


@query(
    "delimited_inferred",
    """
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from {orders}
    """,
)
def _delimited_inferred(t):
    root = t.scratch()
    orders = t("orders").drop("o_orderdate")
    orders.write.option("header", True).option("sep", ";").csv(f"{root}/orders")
    return read_delimited(t.spark, f"{root}/orders", sep=";", all_text=False).select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"),
        F.col("o_custkey").cast("long").alias("o_custkey"),
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
    )


_HEADERS = {"doc_no": "Doc. No/BOE", "gstin": "My GSTIN", "taxable": "Taxable Value", "doc_date": "Document Date"}


def _write_customer(t, path):
    """The customer's lines as files; all lines of a document are in one, in order.

    Documents are dealt out by a hash: a range of each would take a scan of its own to find.
    """
    customer = t("cus").select(*_HEADERS, *TIES[:-1])
    dealt = customer.repartition(composite_key(["doc_no", "gstin"]))
    ordered = dealt.sortWithinPartitions("doc_no", *TIES[:-1], "taxable")
    write_register(rename_columns(ordered, _HEADERS), path, "csv")


@query("compare_with_file", _SALES_SQL + "select * from report")
def _compare_with_file(t):
    """The customer side arrives as a file with its own headers and file order."""
    path = f"{t.scratch()}/customer"
    _write_customer(t, path)
    mapping = {header: _SALES_NAMES[column] for column, header in _HEADERS.items()}
    register = _side(t("gen"), _SALES_NAMES)
    return compare_with_file(t.spark, register, path, SALES, Override(columns_mapping=mapping), TIES)


@query(
    "comparisons_of_templates",
    _SALES_SQL
    + """select cast('sales' as varchar) as ran, "Composite_Key" as document, nullif("Mismatched Fields", '') as fields,
        "Matching Status" as status from report where "Matching Status" <> 'Exact'""",
)
def _comparisons_of_templates(t):
    """Both templates are asked for; the purchase file is missing, so only sales runs. Differences are reported."""
    root = t.scratch()
    _write_customer(t, f"{root}/sales")
    mapping = {header: _SALES_NAMES[column] for column, header in _HEADERS.items()}
    register = _side(t("gen"), _SALES_NAMES)
    runs = {
        "sales": Comparison(register, f"{root}/sales", SALES, Override(columns_mapping=mapping), TIES, f"{root}/out/sales"),
        "purchase": Comparison(register, f"{root}/purchase", PURCHASE, Override(), TIES, f"{root}/out/purchase"),
    }
    ran = run_comparisons(t.spark, runs, only_diff=True)
    return read_delimited(t.spark, f"{root}/out/sales").select(
        F.lit(",".join(ran)).alias("ran"), F.col("Composite_Key").alias("document"),
        F.col("`Mismatched Fields`").alias("fields"), F.col("`Matching Status`").alias("status"),
    )


@query("error_file_counts", _ranges("error_message", _MESSAGES))
def _error_file_counts(t):
    path = f"{t.scratch()}/errors"
    write_register(t("errors"), path, "csv")
    return error_counts(read_delimited(t.spark, path))


@query(
    "task_files",
    """
    select 'sales' as "table", json_extract_string(f, '$.s3FileUrl') as url, json_extract_string(f, '$.userFileName') as file
    from (select unnest(json_extract(task, '$.request.fileInfo.sales[*]')) as f from {tasks})
    union all
    select 'purchase' as "table", json_extract_string(f, '$.s3FileUrl') as url, json_extract_string(f, '$.userFileName') as file
    from (select unnest(json_extract(task, '$.request.fileInfo.purchase[*]')) as f from {tasks})
    """,
)
def _task_files(t):
    return task_files(t("tasks"), "task")


_AMOUNTS = """
    select l_orderkey, l_partkey, ' ' || cast(cast(l_extendedprice as decimal(18,2)) as varchar) as a,
        case when l_linenumber = 2 then '' when l_linenumber = 3 then null
             when l_linenumber = 4 then '-1,' || lpad(cast(l_partkey as varchar), 6, '0') || '.5'
             else cast(cast(l_quantity as decimal(18,1)) as varchar) || ' ' end as b
    from {lineitem}
"""


@query(
    "amount_clean",
    f"""
    select l_orderkey, l_partkey,
        cast(cast(round_even(abs(cast(replace(trim(a), ',', '') as double)), 0) as bigint) as varchar) as whole_a,
        cast(cast(round_even(abs(coalesce(cast(nullif(replace(trim(b), ',', ''), '') as double), 0)), 0) as bigint)
            as varchar) as whole_b,
        cast(cast(replace(trim(a), ',', '') as float) as double) as real_a
    from ({_AMOUNTS})
    """,
)
def _amount_clean(t):
    number = F.col("l_linenumber")
    quantity = F.col("l_quantity").cast("decimal(18,1)").cast("string")
    odd = F.concat(F.lit("-1,"), F.lpad(F.col("l_partkey").cast("string"), 6, "0"), F.lit(".5"))
    a = F.concat(F.lit(" "), F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
    b = (
        F.when(number == 2, "")
        .when(number == 3, F.lit(None))
        .when(number == 4, odd)
        .otherwise(F.concat(quantity, F.lit(" ")))
    )
    return t("lineitem").select(
        "l_orderkey",
        "l_partkey",
        rounded_amount(a).alias("whole_a"),
        rounded_amount(b).alias("whole_b"),
        text_to_real(F.trim(a)).alias("real_a"),
    )


@query(
    "pad_keys",
    """
    select l_orderkey, l_partkey, lpad(cast(l_orderkey * 1000 as varchar), 5, '0') as padded,
        case when length(cast(l_orderkey * 1000 as varchar)) < 5 then lpad(cast(l_orderkey * 1000 as varchar), 5, '0')
             else cast(l_orderkey * 1000 as varchar) end as justified,
        strftime(l_shipdate, '%d.%m.%Y') as shipped
    from {lineitem}
    """,
)
def _pad_keys(t):
    number = (F.col("l_orderkey") * 1000).cast("string")
    return t("lineitem").select(
        "l_orderkey",
        "l_partkey",
        pad_key(number, 5, cut=True).alias("padded"),
        rjust_key(number, 5).alias("justified"),
        dotted_date(F.col("l_shipdate")).alias("shipped"),
    )


@query(
    "rewrite_key",
    "select doc_no[1:3] as doc_no, l_partkey, l_suppkey, cast(taxable as double) as taxable from (select case when "
    "length(doc_no) < 3 then lpad(doc_no, 3, '0') else doc_no end as doc_no, l_partkey, l_suppkey, taxable from {gen})",
)
def _rewrite_key(t):
    lines = t("gen").select("doc_no", "l_partkey", "l_suppkey", "taxable")
    return rewrite_key(lines, "doc_no", 3, cut=True)


@query(
    "seed_load",
    """
    select cast(s_suppkey as varchar) as code, nullif(s_name, 'NA') as "Description", s_nationkey as nation from {supplier}
    """,
)
def _seed_load(t):
    """A lookup file whose header has blanks, one column of it typed."""
    path = f"{t.scratch()}/seed"
    seed = t("supplier").select(
        F.col("s_suppkey").alias("code"), F.col("s_name").alias(" Description"), F.col("s_nationkey").alias("nation")
    )
    write_register(seed, path, "csv")
    return read_seed(t.spark, path, {"nation": t("supplier").schema["s_nationkey"].dataType})


@query("write_once", "select o_orderkey, o_orderpriority from {orders}")
def _write_once(t):
    """A second write with mode ``ignore`` leaves what is there."""
    path = f"{t.scratch()}/once"
    orders = t("orders").select("o_orderkey", "o_orderpriority")
    write_register(orders, path)
    write_register(orders.where("o_orderkey < 0"), path, mode="ignore")
    return t.spark.read.parquet(path)
