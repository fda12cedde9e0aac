from decimal import Decimal

import pytest

from docledger.operators import reports

COLUMNS = (
    "id int, bucket_label string, match_status string, mismatch_fields string, govt_taxable decimal(18,3), "
    "register_taxable decimal(18,3), tax_diff decimal(18,3), govt_section string, register_section string"
)


@pytest.fixture(scope="module")
def details(spark):
    rows = [
        (1, "r", "Mismatch", "a,b", 10, 5, 0, "B2B", "B2B"),
        (2, "r", "Mismatch", "a,,b", 10, 10, -1, "B2B", "CDN"),
        (3, "r", "Mismatch", None, 10, None, None, "X", "CDN"),
        (4, "r", "Exact", "a", 10, 5, 7, "B2B", "B2B"),
        (5, "r", "Mismatch", "a, b", 10, -200000, 1000, "CDNA", None),
    ]
    rows = [tuple(Decimal(v) if i in (4, 5, 6) and v is not None else v for i, v in enumerate(r)) for r in rows]
    return spark.createDataFrame(rows, COLUMNS)


def test_mismatch_explosion(details):
    parts = sorted((r.id, r.mismatch_fields or "-") for r in reports.mismatch_details(details).collect())
    assert parts == [(1, "a"), (1, "b"), (2, "-"), (2, "a"), (2, "b"), (3, "-"), (5, " b"), (5, "a")]
    assert {r.id for r in reports.mismatch_details(details).collect()} == {r.id for r in reports.mismatched(details).collect()}


def test_counts_carry_row_ranges(details):
    rows = {r.mismatch_fields: tuple(r)[1:] for r in reports.mismatch_counts(details).collect()}
    assert rows == {None: (1, 2, 2), "": (1, 3, 3), " b": (1, 4, 4), "a": (3, 5, 7), "b": (2, 8, 9)}
    ordered = reports.ordered(reports.mismatch_details(details), "mismatch_fields", ["id"]).collect()
    assert [r.mismatch_fields for r in ordered][3:6] == ["a", "a", "a"]


def test_difference_reports(details):
    tax = reports.tax_difference_details(details)
    assert {r.id: r.bucket_key for r in tax.collect()} == {1: 1, 2: 0, 3: None, 5: 5}
    taxable = reports.taxable_difference_details(details)
    assert {r.id: r.bucket_label for r in taxable.collect()} == {
        1: "1-10 Rs Difference", 2: "0 - 1 Rs Difference", 3: None, 5: "> 1000000",
    }
    counts = {r.bucket_key: (r.document_count, r.first_row, r.last_row) for r in reports.difference_counts(tax).collect()}
    assert counts == {None: (1, 2, 2), 0: (1, 3, 3), 1: (1, 4, 4), 5: (1, 5, 5)}


def test_own_labels(details):
    labels = [f"L{i}" for i in range(8)]
    rows = reports.tax_difference_details(details, labels=labels).collect()
    assert {r.id: r.bucket_label for r in rows} == {1: "L1", 2: "L0", 3: None, 5: "L5"}


def test_cross_section_has_every_row_and_other(details):
    grid = {r.register_section: tuple(r)[1:] for r in reports.cross_section(details).collect()}
    assert grid == {
        "B2B": (1, 0, 0, 0, 0), "CDN": (1, 0, 0, 0, 1), "B2BA": (0,) * 5, "CDNA": (0,) * 5, "OTHER": (0, 0, 0, 1, 0),
    }


def test_bundle_agrees_with_single_reports(details):
    bundle = reports.recon_bundle(details)
    assert sorted(map(str, bundle["mismatch_counts"].collect())) == sorted(
        map(str, reports.mismatch_counts(details).collect())
    )
    assert bundle["cross_section"].count() == 5
    bundle["mismatch_rows"].unpersist()


def test_error_counts(spark):
    errors = spark.createDataFrame(
        [(1, "[E1] a, b, [E2] c"), (2, "[E1] a, b"), (3, None)], "id int, error_message string"
    )
    rows = {r.error_message: (r.document_count, r.first_row, r.last_row) for r in reports.error_counts(errors).collect()}
    assert rows == {None: (1, 2, 2), "[E1] a, b": (2, 3, 4), "[E2] c": (1, 5, 5)}


def test_status_summary(spark):
    docs = spark.createDataFrame([("Exact", "a", 1, "a", 1), ("Missing", None, None, "b", 2)],
                                 "s string, g string, gv int, r string, rv int")
    rows = reports.status_summary(docs, "s", "g", "gv", "r", "rv").collect()
    assert sorted(map(tuple, rows)) == [("Exact", 1, 1, 1, 1), ("Missing", 0, None, 1, 2)]
    assert rows[0].__fields__ == list(reports.SUMMARY_HEADERS)


def test_ingestion_summary(spark):
    text = '[{"gstin":"G1","totalDocumentCount":3,"processedRecords":5,"invalidRecords":1,"validRecords":4}]'
    rows = reports.ingestion_summary(spark.createDataFrame([(text,)], "j string"), "j").collect()
    assert [tuple(r) for r in rows] == [("G1", "3", "5", "1", "4")]
