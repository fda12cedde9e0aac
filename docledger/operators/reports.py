"""Reports over reconciliation details and ingestion feedback.

Detail frames come back unsorted; ``ordered`` sorts them for a sink. The counts
carry the row range each value takes in that sorted report (row 1 is the
header), computed from the counts alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docledger.functions import (
    BUCKET_LABELS,
    bucket_key,
    bucket_label,
    named,
    split_bracketed,
    split_fields,
)
from docledger.operators.ordering import running_total

MISMATCH = "Mismatch"
# The document sections of the cross-section report.
SECTIONS = ("B2B", "CDN", "B2BA", "CDNA")
OTHER_SECTION = "OTHER"
# Reports of a bundle's counts.
FIELDS, TAX, TAXABLE, CROSS = "fields", "tax", "taxable", "cross"
# Headers of the overall summary and of the ingestion summary.
SUMMARY_HEADERS = ("Match Status", "2b doc count", "2b taxableValue", "pr doc count", "pr taxableValue")
INGESTION_HEADERS = ("GSTIN", "Docs", "Rows", "Errors", "No Errors")
STATS_SCHEMA = (
    "array<struct<gstin:string,totalDocumentCount:string,processedRecords:string,"
    "invalidRecords:string,validRecords:string>>"
)


def mismatched(details: DataFrame, status: str = "match_status") -> DataFrame:
    return details.where(named(status) == MISMATCH)


def explode_parts(df: DataFrame, column: str, parts: Column) -> DataFrame:
    """One row per part, the part replacing ``column``; a NULL list is one NULL part."""
    exploded = df.withColumn("__part", F.explode_outer(parts))
    return exploded.select(
        *[F.col("__part").alias(c) if c == column else named(c) for c in df.columns]
    )


def mismatch_details(
    details: DataFrame, field: str = "mismatch_fields", status: str = "match_status"
) -> DataFrame:
    return explode_parts(mismatched(details, status), field, split_fields(named(field)))


def error_details(errors: DataFrame, message: str = "error_message") -> DataFrame:
    return explode_parts(errors, message, split_bracketed(named(message)))


def ordered(details: DataFrame, value: str, row_order: Sequence[str]) -> DataFrame:
    """Sort by value, input order inside a value. Range sorting on both splits a hot value."""
    return details.orderBy(named(value), *[named(c) for c in row_order])


def value_counts(details: DataFrame, value: str, few_values: bool = False) -> DataFrame:
    """Count per value with its first and last row in the sorted report.

    ``few_values`` states that the values come from a fixed short list (labels,
    column names); free-text values use a running total spread over tasks.
    """
    counts = details.groupBy(named(value)).agg(F.count(F.lit(1)).alias("document_count"))
    if few_values:
        upto = Window.orderBy(named(value)).rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("last_row", F.sum("document_count").over(upto))
    else:
        counts = running_total(counts, [value], "document_count", "last_row")
    return counts.select(
        named(value),
        "document_count",
        (F.col("last_row") - F.col("document_count") + 2).alias("first_row"),
        (F.col("last_row") + 1).alias("last_row"),
    )


def mismatch_counts(details: DataFrame, field: str = "mismatch_fields", status: str = "match_status") -> DataFrame:
    return value_counts(mismatch_details(details, field, status), field)


def error_counts(errors: DataFrame, message: str = "error_message") -> DataFrame:
    return value_counts(error_details(errors, message), message)


def difference_details(
    details: DataFrame,
    amount: Column,
    label: str = "bucket_label",
    status: str = "match_status",
    labels: Sequence[str] = BUCKET_LABELS,
) -> DataFrame:
    """Mismatch rows with the bucket of ``amount`` as ``bucket_key`` and its label
    written over ``label``; a NULL amount has a NULL bucket."""
    keyed = mismatched(details, status).withColumn("bucket_key", bucket_key(amount))
    return keyed.withColumn(label, bucket_label(F.col("bucket_key"), labels))


def tax_difference_details(details: DataFrame, amount: str = "tax_diff", **options) -> DataFrame:
    return difference_details(details, named(amount), **options)


def taxable_difference_details(
    details: DataFrame, govt: str = "govt_taxable", register: str = "register_taxable", **options
) -> DataFrame:
    return difference_details(details, named(govt) - named(register), **options)


def difference_counts(bucketed: DataFrame, labels: Sequence[str] = BUCKET_LABELS) -> DataFrame:
    counts = value_counts(bucketed, "bucket_key", few_values=True)
    return counts.withColumn("bucket_label", bucket_label(F.col("bucket_key"), labels))


def cross_section(
    details: DataFrame,
    govt: str = "govt_section",
    register: str = "register_section",
    status: str = "match_status",
    sections: Sequence[str] = SECTIONS,
) -> DataFrame:
    """Documents per register section (rows) and government section (columns).

    Every section has its row, and anything outside the list counts as OTHER.
    """
    def known(name: str) -> Column:
        return F.when(named(name).isin(*sections), named(name)).otherwise(OTHER_SECTION)

    pairs = (
        mismatched(details, status)
        .select(known(register).alias("register_section"), known(govt).alias("g"))
        .groupBy("register_section", "g")
        .count()
    )
    return section_grid(pairs, sections)


def section_grid(pairs: DataFrame, sections: Sequence[str] = SECTIONS) -> DataFrame:
    """The grid of (register_section, g, count) rows."""
    columns = [*sections, OTHER_SECTION]
    counted = pairs.groupBy("register_section").pivot("g", columns).agg(F.sum("count"))
    grid = F.array(*[F.lit(c) for c in columns])
    rows = pairs.sparkSession.range(1).select(F.explode(grid).alias("register_section"))
    return rows.join(counted, "register_section", "left").select(
        "register_section", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in columns]
    )


def status_summary(
    documents: DataFrame, status: str, govt_key: str, govt_amount: str, register_key: str, register_amount: str
) -> DataFrame:
    """Documents and taxable value of each side per match status."""
    names = SUMMARY_HEADERS
    return documents.groupBy(named(status).alias(names[0])).agg(
        F.count(named(govt_key)).alias(names[1]),
        F.sum(named(govt_amount)).alias(names[2]),
        F.count(named(register_key)).alias(names[3]),
        F.sum(named(register_amount)).alias(names[4]),
    )


def ingestion_summary(stats: DataFrame, column: str) -> DataFrame:
    """One row of texts per statistics object in the JSON arrays of ``column``; malformed JSON fails."""
    rows = stats.select(F.inline(F.from_json(named(column), STATS_SCHEMA, {"mode": "FAILFAST"})))
    return rows.toDF(*INGESTION_HEADERS)


def bundle_counts(
    details: DataFrame,
    field: str = "mismatch_fields",
    tax: str = "tax_diff",
    govt: str = "govt_taxable",
    register: str = "register_taxable",
    govt_section: str = "govt_section",
    register_section: str = "register_section",
    status: str = "match_status",
    sections: Sequence[str] = SECTIONS,
) -> DataFrame:
    """(report, value, other, document_count, first_row, last_row): all count reports from one pass.

    A mismatch row emits one entry per report that it counts in, and its values;
    one grouped count serves them all. Row ranges are a running total over
    (report, value), less what the reports before take. The counts are written
    once, so what is picked from them doesn't read the details again.
    """

    def entry(report: str, value: Column, other: Column | None = None) -> Column:
        second = F.lit(None).cast("string") if other is None else other
        return F.struct(F.lit(report).alias("report"), value.cast("string").alias("value"), second.alias("other"))

    def known(name: str) -> Column:
        return F.when(named(name).isin(*sections), named(name)).otherwise(OTHER_SECTION)

    parts = F.coalesce(split_fields(named(field)), F.array(F.lit(None).cast("string")))
    fields = F.transform(parts, lambda part: entry(FIELDS, part))
    single = F.array(
        entry(TAX, bucket_key(named(tax))),
        entry(TAXABLE, bucket_key(named(govt) - named(register))),
        entry(CROSS, known(register_section), known(govt_section)),
    )
    entries = mismatched(details, status).select(F.inline(F.concat(fields, single)))
    counts = entries.groupBy("report", "value", "other").agg(F.count(F.lit(1)).alias("document_count"))
    total = running_total(counts, ["report", "value", "other"], "document_count", "upto")
    before = total.groupBy("report").agg(F.min(F.col("upto") - F.col("document_count")).alias("start"))
    starts = F.broadcast(before.withColumnRenamed("report", "of"))  # a row a report
    return total.join(starts, F.col("report") == F.col("of")).select(
        "report", "value", "other", "document_count",
        (F.col("upto") - F.col("start") - F.col("document_count") + 2).alias("first_row"),
        (F.col("upto") - F.col("start") + 1).alias("last_row"),
    )


def recon_bundle(details: DataFrame, **options) -> dict[str, DataFrame]:
    """All reconciliation reports over the mismatch rows.

    Row reports are narrow passes. All counts come from one pass over the
    details, made when the bundle is built, and are read from its result.
    """
    rows = mismatched(details)
    counts = bundle_counts(details)
    labels = options.get("labels", BUCKET_LABELS)
    ranges = ["document_count", "first_row", "last_row"]

    def buckets(report: str) -> DataFrame:
        keyed = counts.where(F.col("report") == report).select(F.col("value").cast("int").alias("bucket_key"), *ranges)
        return keyed.withColumn("bucket_label", bucket_label(F.col("bucket_key"), labels))

    return {
        "mismatch_rows": rows,
        "mismatch_details": mismatch_details(rows),
        "mismatch_counts": counts.where(F.col("report") == FIELDS).select(F.col("value").alias("mismatch_fields"), *ranges),
        "tax_difference_details": tax_difference_details(rows, **options),
        "tax_difference_counts": buckets(TAX),
        "taxable_difference_details": taxable_difference_details(rows, **options),
        "taxable_difference_counts": buckets(TAXABLE),
        "cross_section": section_grid(
            counts.where(F.col("report") == CROSS).select(
                F.col("value").alias("register_section"), F.col("other").alias("g"), F.col("document_count").alias("count")
            )
        ),
    }
