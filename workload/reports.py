"""Report queries over reconciliation details and ingestion feedback."""

from pyspark.sql import functions as F

from docledger.operators.reports import (
    cross_section,
    difference_counts,
    error_counts,
    error_details,
    ingestion_summary,
    mismatch_counts,
    mismatch_details,
    ordered,
    recon_bundle,
    tax_difference_details,
    taxable_difference_details,
)
from docledger.operators.ordering import numbered
from workload.base import query

_ROWS = """doc_id, line_no, part_id, match_status, mismatch_fields, cast(govt_taxable as double) as govt_taxable,
    cast(register_taxable as double) as register_taxable, cast(tax_diff as double) as tax_diff, govt_section,
    register_section"""
_PARTS = f"""
    select * replace (unnest(string_split(mismatch_fields, ',')) as mismatch_fields)
    from (select {_ROWS}, bucket_label from {{details}}
          where match_status = 'Mismatch' and mismatch_fields is not null)
    union all
    select * replace (cast(null as varchar) as mismatch_fields)
    from (select {_ROWS}, bucket_label from {{details}}
          where match_status = 'Mismatch' and mismatch_fields is null)
"""
_MESSAGES = """
    select row_id, unnest(string_split(replace(error_message, ', [', chr(1) || '['), chr(1))) as error_message
    from {errors} where error_message is not null
    union all
    select row_id, cast(null as varchar) from {errors} where error_message is null
"""


def _ranges(value: str, counted: str) -> str:
    return f"""
    select {value}, document_count,
        cast(sum(document_count) over (order by {value} nulls first) - document_count + 2 as bigint) as first_row,
        cast(sum(document_count) over (order by {value} nulls first) + 1 as bigint) as last_row
    from (select {value}, count(*) as document_count from ({counted}) group by 1)
    """


def _key(amount: str) -> str:
    return f"""case when {amount} is null then null when {amount} < 0 then 0 when {amount} < 1 then 1
        when {amount} < 10 then 2 when {amount} < 100 then 3 when {amount} < 1000 then 4 when {amount} < 10000 then 5
        when {amount} < 100000 then 6 else 7 end"""


_LABEL = """case bucket_key when 0 then '< 0 Rs Difference' when 1 then '0 - 1 Rs Difference'
    when 2 then '1-10 Rs Difference' when 3 then '11- 100 Rs Difference' when 4 then '101- 1000 Rs Difference'
    when 5 then '1001 - 100000 Rs Difference' when 6 then '100001 - 1000000 Rs Difference'
    when 7 then '> 1000000' end"""


def _bucketed(amount: str) -> str:
    return f"""
    select *, {_LABEL} as bucket_label
    from (select {_ROWS}, {_key(amount)} as bucket_key from {{details}} where match_status = 'Mismatch')
    """


def _bucket_counts(amount: str) -> str:
    return f"select *, {_LABEL} as bucket_label from ({_ranges('bucket_key', _bucketed(amount))})"


_TAXABLE = "(govt_taxable - register_taxable)"


@query("mismatch_explode", _PARTS)
def _mismatch_explode(t):
    return mismatch_details(t("details"))


@query("mismatch_counts", _ranges("mismatch_fields", _PARTS))
def _mismatch_counts(t):
    return mismatch_counts(t("details"))


@query("error_explode", _MESSAGES)
def _error_explode(t):
    return error_details(t("errors"))


@query("error_explode_counts", _ranges("error_message", _MESSAGES))
def _error_counts(t):
    return error_counts(t("errors"))


@query("tax_diff_buckets", _bucketed("tax_diff"))
def _tax_diff_buckets(t):
    return tax_difference_details(t("details"))


@query("tax_diff_counts", _bucket_counts("tax_diff"))
def _tax_diff_counts(t):
    return difference_counts(tax_difference_details(t("details")))


@query("taxable_diff_buckets", _bucketed(_TAXABLE))
def _taxable_diff_buckets(t):
    return taxable_difference_details(t("details"))


@query("taxable_diff_counts", _bucket_counts(_TAXABLE))
def _taxable_diff_counts(t):
    return difference_counts(taxable_difference_details(t("details")))


_GRID = ("B2B", "CDN", "B2BA", "CDNA", "OTHER")
_CROSS = f"""
    with d as (
        select case when govt_section in ('B2B','CDN','B2BA','CDNA') then govt_section else 'OTHER' end as g,
            case when register_section in ('B2B','CDN','B2BA','CDNA') then register_section else 'OTHER' end as r
        from {{details}} where match_status = 'Mismatch')
    select s.r as register_section,
        {", ".join(f"count(case when d.g = '{c}' then 1 end) as {chr(34)}{c}{chr(34)}" for c in _GRID)}
    from (values {", ".join(f"('{c}')" for c in _GRID)}) s(r) left join d on d.r = s.r group by 1
"""


@query("cross_section", _CROSS)
def _cross_section(t):
    return cross_section(t("details"))


@query(
    "recon_bundle_counts",
    f"""
    select * from (
        select 'fields' as report, mismatch_fields as value, document_count, first_row, last_row
        from ({_ranges("mismatch_fields", _PARTS)})
        union all
        select 'tax', cast(bucket_key as varchar), document_count, first_row, last_row
        from ({_ranges("bucket_key", _bucketed("tax_diff"))})
        union all
        select 'taxable', cast(bucket_key as varchar), document_count, first_row, last_row
        from ({_ranges("bucket_key", _bucketed(_TAXABLE))}))
    """,
)
def _recon_bundle(t):
    reports = recon_bundle(t("details"))
    columns = ["report", "value", "document_count", "first_row", "last_row"]
    parts = [
        reports[name].select(
            F.lit(title).alias("report"), F.col(value).cast("string").alias("value"), *columns[2:]
        )
        for name, title, value in (
            ("mismatch_counts", "fields", "mismatch_fields"),
            ("tax_difference_counts", "tax", "bucket_key"),
            ("taxable_difference_counts", "taxable", "bucket_key"),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_DETAIL = "cast(doc_id as varchar) as doc_id, cast(line_no as bigint) as line_no, cast(part_id as bigint) as part_id"
_NO_ROW = "cast(null as varchar) as doc_id, cast(null as bigint) as line_no, cast(null as bigint) as part_id"
_NO_COUNT = "cast(null as bigint) as document_count, cast(null as bigint) as first_row, cast(null as bigint) as last_row"
_COUNT = "cast(document_count as bigint) as document_count, first_row, last_row"


def _sections(value: str) -> str:
    return f"case when {value} in ('B2B','CDN','B2BA','CDNA') then {value} else 'OTHER' end"


@query(
    "recon_bundle",
    f"""
    select 'mismatch_rows' as report, {_DETAIL}, mismatch_fields as value, cast(null as varchar) as other, {_NO_COUNT}
    from {{details}} where match_status = 'Mismatch'
    union all
    select 'mismatch_details', {_DETAIL}, mismatch_fields, null, {_NO_COUNT} from ({_PARTS})
    union all
    select 'tax_difference_details', {_DETAIL}, bucket_label, cast(bucket_key as varchar), {_NO_COUNT} from ({_bucketed("tax_diff")})
    union all
    select 'taxable_difference_details', {_DETAIL}, bucket_label, cast(bucket_key as varchar), {_NO_COUNT} from ({_bucketed(_TAXABLE)})
    union all
    select 'mismatch_counts', {_NO_ROW}, mismatch_fields, null, {_COUNT} from ({_ranges("mismatch_fields", _PARTS)})
    union all
    select 'tax_difference_counts', {_NO_ROW}, bucket_label, cast(bucket_key as varchar), {_COUNT} from ({_bucket_counts("tax_diff")})
    union all
    select 'taxable_difference_counts', {_NO_ROW}, bucket_label, cast(bucket_key as varchar), {_COUNT} from ({_bucket_counts(_TAXABLE)})
    union all
    select 'cross_section', {_NO_ROW}, s.r, s.g, cast(count(d.r) as bigint), cast(null as bigint), cast(null as bigint)
    from (select a.c as r, b.c as g from (values {", ".join(f"('{c}')" for c in _GRID)}) a(c),
        (values {", ".join(f"('{c}')" for c in _GRID)}) b(c)) s
    left join (select {_sections("register_section")} as r, {_sections("govt_section")} as g
        from {{details}} where match_status = 'Mismatch') d on d.r = s.r and d.g = s.g
    group by s.r, s.g
    """,
)
def _bundle(t):
    """Every output of the bundle; its counts come from one pass."""
    reports = recon_bundle(t("details"))
    none = F.lit(None)
    shown = {
        "mismatch_rows": ("mismatch_fields", None),
        "mismatch_details": ("mismatch_fields", None),
        "tax_difference_details": ("bucket_label", "bucket_key"),
        "taxable_difference_details": ("bucket_label", "bucket_key"),
        "mismatch_counts": ("mismatch_fields", None),
        "tax_difference_counts": ("bucket_label", "bucket_key"),
        "taxable_difference_counts": ("bucket_label", "bucket_key"),
    }
    grid = reports["cross_section"]
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("other"), F.col(c).alias("document_count")) for c in _GRID]))
    frames = {name: reports[name] for name in shown} | {
        "cross_section": grid.select(F.col("register_section").alias("value"), cells)
    }
    united = None
    for name, frame in frames.items():
        value, other = shown.get(name, ("value", "other"))
        has = set(frame.columns)

        def column(source, kind, alias, has=has):
            return (F.col(source) if source in has else none).cast(kind).alias(alias)

        part = frame.select(
            F.lit(name).alias("report"), column("doc_id", "string", "doc_id"), column("line_no", "long", "line_no"),
            column("part_id", "long", "part_id"), column(value, "string", "value"), column(other, "string", "other"),
            *[column(c, "long", c) for c in ("document_count", "first_row", "last_row")],
        )
        united = part if united is None else united.unionByName(part)
    return united


@query(
    "ingestion_summary",
    """
    select json_extract_string(o, '$.gstin') as "GSTIN", json_extract_string(o, '$.totalDocumentCount') as "Docs",
        json_extract_string(o, '$.processedRecords') as "Rows", json_extract_string(o, '$.invalidRecords') as "Errors",
        json_extract_string(o, '$.validRecords') as "No Errors"
    from (select unnest(json_extract(stats, '$[*]')) as o from {stats})
    """,
)
def _ingestion_summary(t):
    return ingestion_summary(t("stats"), "stats")


@query(
    "error_ordered",
    f"""
    select row_id, error_message, row_number() over (order by error_message nulls first, row_id) as position
    from ({_MESSAGES})
    """,
)
def _error_ordered(t):
    return numbered(ordered(error_details(t("errors")), "error_message", ["row_id"])).select("row_id", "error_message", "position")
