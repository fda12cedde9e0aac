"""Rules of the sales register on hand-made lines."""

from decimal import Decimal

import pytest

from docledger.plans.models import Project, published, sale_project
from docledger.plans.register import LINE_COLUMNS, export_type, sales_register

NUMBERS = {
    "CESS", "CGST_TOTAL", "DIS", "GST_RTE", "IGST_TOTAL", "INR_RATE", "ITEM_TOTAL", "SGUST_TOTAL", "TCS_TOTAL", "TOTAL",
}
DRIVING = ["TRANS_TYPE", "INVH_TXN_CODE", "INVH_NO", "INVH_FORM_CODE", "GST_NO", "HSN_CODE", "GST_RTE", "TOTAL"]
LINES = [
    ("INV", "TALMOL", "100", "LOCAL", "27AAAAA0000A1Z5", "2710", 18, 118),
    ("INV", "TALMOL", "100", "LOCAL", "27AAAAA0000A1Z5", "9965", 18, 118),
    ("INV", "DSATAL", "7", "LOCAL", "URP", "2710", None, 50),
    ("SARTN", "RTNSIL", "8", "EXPORT", "X1", "2710", 0, 10),
    ("INV", "SILTRF", "9", "NEPAL", "X1", "2710", 5, 10),
    ("INV", "SILTRF", "10", "NEPAL", "X1", "9965", 5, 10),
    ("INV", "SILTRF", "11", "SEZ SALE", "24B", "2710", None, 10),
    ("INV", "SILTRF", "12", "EXEMPT", "24B", None, 0, 10),
    ("INV", "SILTRF", "13", "LOCAL", "*URP*", "AB12", 18, 10),
    ("X", "EINVC-TAL", "14", "LOCAL", "24B", "2710", 18, 10),
    ("INV", None, "15", "LOCAL", "24B", "2710", 18, 10),
    ("INV", "SILTRF", None, "LOCAL", "24B", "2710", 18, 3),
    ("INV", "SILTRF", None, "LOCAL", "24B", "2710", 18, 4),
]


@pytest.fixture(scope="module")
def lines(spark):
    kinds = {c: "decimal(18,3)" if c in NUMBERS else "date" if c == "INVH_DT" else "string" for c in LINE_COLUMNS}
    rows = []
    for line in LINES:
        given = dict(zip(DRIVING, line), SHIPPING_BILL_NO="SB", SHIPPING_BILL_DT="D")
        rows.append(tuple(
            Decimal(given[c]) if c in NUMBERS and given.get(c) is not None else given.get(c) for c in LINE_COLUMNS
        ))
    return spark.createDataFrame(rows, ", ".join(f"{c} {k}" for c, k in kinds.items()))


@pytest.fixture(scope="module")
def register(lines):
    rows = sales_register(lines).collect()
    return {(r["Document Number"], r["HSN or SAC code"]): r for r in rows if r["Document Number"]}


def test_columns_and_filter(lines):
    built = sales_register(lines)
    assert len(built.columns) == 48
    assert built.count() == len(LINES) - 2


def test_document_total_covers_the_whole_document(register):
    assert {register["TALMOL100", h]["Document Total Amount"] for h in ("2710", "9965")} == {Decimal(236)}


def test_lines_without_number_form_one_document(lines):
    rows = [r for r in sales_register(lines).collect() if r["Document Number"] is None]
    assert [r["Document Total Amount"] for r in rows] == [Decimal(7), Decimal(7)]


@pytest.mark.parametrize(
    ("key", "column", "expected"),
    [
        (("TALMOL100", "2710"), "Document Type", "Invoice"),
        (("TALMOL100", "2710"), "Place of Supply", "27"),
        (("TALMOL100", "2710"), "Item_Category", "G"),
        (("TALMOL100", "9965"), "Item_Category", "S"),
        (("TALMOL100", "2710"), "Export Type", None),
        (("DSATAL7", "2710"), "Document Type", "Debit Note"),
        (("DSATAL7", "2710"), "Place of Supply", " "),
        (("DSATAL7", "2710"), "Customer GSTIN", " "),
        (("DSATAL7", "2710"), "GST Rate", Decimal(0)),
        (("RTNSIL8", "2710"), "Document Type", "Credit Note"),
        (("RTNSIL8", "2710"), "Place of Supply", "96"),
        (("RTNSIL8", "2710"), "Customer GSTIN", "URP"),
        (("RTNSIL8", "2710"), "Export Type", "EXPWOP"),
        (("RTNSIL8", "2710"), "Export Bill Number", "SB"),
        (("SILTRF9", "2710"), "Export Type", "EXPWP"),
        (("SILTRF9", "2710"), "Export Bill Number", "SB"),
        (("SILTRF10", "9965"), "Export Bill Number", " "),
        (("SILTRF11", "2710"), "Export Type", "SEZWOP"),
        (("SILTRF12", None), "Is this a Bill of supply", "Y"),
        (("SILTRF12", None), "Item_Category", None),
        (("SILTRF13", "AB12"), "Place of Supply", " "),
        (("SILTRF13", "AB12"), "Customer GSTIN", "*URP*"),
        (("SILTRF13", "AB12"), "Item_Category", "G"),
    ],
)
def test_rule(register, key, column, expected):
    assert register[key][column] == expected


def test_export_type_has_no_null_rate_branch(lines):
    kinds = {r["invh_no"]: r["export_type"] for r in export_type(lines).collect()}
    assert kinds["11"] is None and kinds["8"] == "EXPWOP" and kinds["9"] == "EXPWP"


def test_filter_runs_before_the_document_total(lines):
    plan = sales_register(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert plan.index("Join") < plan.index("Filter")


def test_models_run_in_dependency_order(spark, lines, tmp_path):
    project = sale_project()
    project.add("report", "totals", ["s_sale.sales_register"], lambda r: r.groupBy("Document Type").count())
    built = project.run(spark, {"raw.sales": lines}, str(tmp_path))
    assert set(built) == {"s_sale.sales_register", "s_sale.export_type", "s_report.totals"}
    assert built["s_report.totals"].count() == 3
    assert published(spark, str(tmp_path))["s_report.totals"].count() == 3


def test_unknown_input_is_named(spark):
    project = Project()
    project.add("sale", "m", ["raw.nothing"], lambda df: df)
    with pytest.raises(ValueError, match="raw.nothing"):
        project.run(spark, {}, "/nowhere")
