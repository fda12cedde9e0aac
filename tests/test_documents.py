import re

import pytest

from docledger.operators import documents as doc

KEY = ("1000", "2023", "01")


@pytest.fixture(scope="module")
def masters(spark):
    companies = spark.createDataFrame([("1000", "INT")], "bukrs string, ktopl string")
    accounts = spark.createDataFrame(
        [("4000", "E", "INT", "Sales"), ("4000", "D", "INT", "Umsatz"), ("4000", "E", "YK", "Other"),
         ("5000", "D", "INT", "Kosten")],
        "saknr string, spras string, ktopl string, txt50 string",
    )
    return companies, accounts


@pytest.fixture(scope="module")
def ledger(spark):
    columns = (
        "bukrs string, gjahr string, belnr string, buzei int, shkzg string, mwskz string, hkont string, dmbtr string, "
        "bupla string, lifnr string, kunnr string, gst_part string"
    )
    return spark.createDataFrame(
        [
            (*KEY, 2, "S", "V1", "4000", "10.5", "P1", "L1", "", "L2"),
            (*KEY, 1, "H", "V2", "5000", "4.0", "P1", "L1", "C1", None),
            (*KEY, 3, "S", "V1", "4000", "2.0", "P2", "", None, ""),
            ("1000", "2023", "02", 1, "S", "V1", "4000", "1.0", "P1", "L9", None, None),
        ],
        columns,
    )


def test_ledger_lines(spark, ledger, masters):
    wanted = spark.createDataFrame([KEY], "bukrs string, gjahr string, belnr string")
    rows = doc.ledger_order(doc.ledger_lines(ledger, *masters, wanted)).collect()
    assert [(r.buzei, r.txt50, r.dmbtr_debit, r.dmbtr_credit) for r in rows] == [
        (2, "Sales", 10.5, None), (3, "Sales", 2.0, None), (1, None, None, 4.0),
    ]
    assert doc.ledger_lines(ledger, *masters, wanted, require_text=True).count() == 2


def test_ledger_summary(spark, ledger, masters):
    rows = doc.summary_order(doc.ledger_summary(ledger, *masters, factor=2.0)).collect()
    assert [(r.belnr, r.hkont, r.txt50, r.dmbtr_debit_sum, r.dmbtr_credit_sum) for r in rows] == [
        ("01", "5000", None, 0.0, 2.0), ("01", "4000", "Sales", 6.25, 0.0), ("02", "4000", "Sales", 0.5, 0.0),
    ]


def test_tax_lines_may_repeat(spark, masters):
    taxes = spark.createDataFrame(
        [(*KEY, 1, "A", "B", "C", "V1", "4000", "10", "1.5", "9")],
        "bukrs string, gjahr string, belnr string, buzei int, kschl string, ktosl string, txgrp string, mwskz string, "
        "hkont string, hwbas string, hwste string, kbetr string",
    )
    rows = doc.tax_lines(taxes, masters[1]).collect()
    assert sorted((r.txt50, r.hwste) for r in rows) == [("Other", 1.5), ("Sales", 1.5)]


def test_tax_codes(spark, ledger):
    texts = spark.createDataFrame(
        [("E", "TAXINN", "V1", "one"), ("D", "TAXINN", "V1", "eins"), ("E", "OTHER", "V2", "two")],
        "spras string, kalsm string, mwskz string, text1 string",
    )
    rows = doc.tax_codes(ledger, ledger.where("belnr = '01'"), texts, "TAXINN").collect()
    assert sorted((r.belnr, r.mwskz, r.text1) for r in rows) == [("01", "V1", "one"), ("02", "V1", "one")]


def test_parties(spark, ledger):
    vendor_master = spark.createDataFrame(
        [("L1", "One", "27A"), ("L2", "Two", "27B"), ("L9", "Nine", "27C")], "lifnr string, name1 string, stcd3 string"
    )
    found = doc.vendors(ledger, vendor_master).collect()
    assert sorted((r.belnr, r.lifnr) for r in found) == [("01", "L1"), ("01", "L2"), ("02", "L9")]
    without = doc.vendors(ledger.drop("gst_part"), vendor_master).collect()
    bare = doc.vendors(ledger.drop("gst_part", "lifnr"), vendor_master)
    assert bare.count() == 0 and bare.columns == doc.vendors(ledger, vendor_master).columns
    assert sorted((r.belnr, r.lifnr) for r in without) == [("01", "L1"), ("02", "L9")]

    billing = spark.createDataFrame(
        [(*KEY, "C2", "C1", "P3")], "bukrs string, gjahr string, belnr string, kunrg string, kunag string, bupla string"
    )
    customer_master = spark.createDataFrame(
        [("C1", "a", "x", "IN"), ("C2", "b", "y", "IN")], "kunnr string, name1 string, stcd3 string, land1 string"
    )
    found = doc.customers(ledger, billing, customer_master).collect()
    assert sorted((r.belnr, r.kunnr) for r in found) == [("01", "C1"), ("01", "C2")]

    items = spark.createDataFrame([(*KEY, "P4")], "bukrs string, gjahr string, belnr string, werks string")
    plants = spark.createDataFrame([("P1", "L1"), ("P3", "L2"), ("P4", "L9")], "werks string, lifnr string")
    found = doc.own_tax_ids(ledger, billing, items, plants, vendor_master).collect()
    assert sorted((r.belnr, r.werks, r.stcd3) for r in found) == [
        ("01", "P1", "27A"), ("01", "P3", "27B"), ("01", "P4", "27C"), ("02", "P1", "27A"),
    ]


@pytest.fixture(scope="module")
def headers(spark):
    return spark.createDataFrame(
        [("1", "2023", "100042", "B7", "R42", "RV"), ("1", "2023", "100043", "B42", None, "SA"),
         ("1", "2023", "200", "B8", "R9", "RV")],
        "bukrs string, gjahr string, belnr string, awkey string, xblnr string, blart string",
    )


def test_search(headers):
    assert [r.belnr for r in doc.search(headers, ["RV"], "42").collect()] == ["100042"]
    assert doc.search(headers, ["RV", "SA"], "42").count() == 2
    assert doc.search(headers, ["RV", "SA"], "").count() == 3
    assert doc.search(headers, ["RV", "SA"], "\\42").count() == 0
    sample = doc.sample_documents(headers, ["RV", "SA"], 2)
    assert sample.count() == 2 and sample.collect() == doc.sample_documents(headers, ["RV", "SA"], 2).collect()


def test_search_many(spark, headers):
    numbers = spark.createDataFrame([("42",), ("200",), ("nope",), ("42",), ("",)], "number string")
    found = doc.search_many(headers, numbers)
    assert sorted((r.number, r.belnr) for r in found.collect()) == [
        ("200", "200"), ("42", "100042"), ("42", "100043"),
    ]
    outcome = {r.number: (r.documents, r.outcome) for r in doc.search_outcome(numbers, found).collect()}
    assert outcome == {"42": (2, "many"), "200": (1, "one"), "nope": (0, "none"), "": (0, "none")}


def test_fallback_table(spark):
    spark.range(1).createOrReplaceTempView("prcd_elements")
    assert doc.first_available(spark, ["konv", "prcd_elements"]) == "prcd_elements"
    spark.range(1).createOrReplaceTempView("konv")
    assert doc.first_available(spark, ["konv", "prcd_elements"]) == "konv"
    spark.catalog.dropTempView("konv")
    spark.catalog.dropTempView("prcd_elements")


def test_condition_texts_take_the_first_row(spark):
    texts = spark.createDataFrame([("E", "K1", "b"), ("D", "K1", "c"), ("E", "K2", "z")], "spras string, kschl string, vtext string")
    rows = {r.kschl: r.vtext for r in doc.condition_texts(texts).collect()}
    assert rows == {"K1": "c", "K2": "z"}


def test_dossier_text(spark):
    df = spark.createDataFrame(
        [("D1", "2", "-1,234.5", " 7 ", "s"), ("D1", "1", "", None, "s"), (None, "1", "1", "12345", "s")],
        "doc string, line string, amount string, code string, skipped string",
    )
    pages = doc.dossier(df, ["doc"], ["line"], numbers=["amount"], pads={"code": 3}, skip=["skipped"], rows_per_page=1)
    texts = {(r.document, r.page): r.text for r in pages.collect()}
    assert texts["D1", 1] == "D1\n\n\tamount  : 0\n\tcode    : 000\n\tline    : 1\n\n"
    assert texts["D1", 2] == "D1\n\n\tamount  : 1234\n\tcode    : 007\n\tline    : 2\n\n"
    assert texts["None", 1].endswith("code    : 12345\n\tline    : 1\n\n")
    whole = doc.dossier(df, ["doc"], ["line"], numbers=["amount"], pads={"code": 3}, skip=["skipped"]).collect()
    assert {r.document: r.text for r in whole}["D1"] == texts["D1", 1] + texts["D1", 2]


def test_dossier_of_a_hot_document(spark):
    df = spark.createDataFrame([("hot", i) for i in range(100)] + [("cold", 1)], "doc string, n int")
    pages = doc.dossier(df, ["doc"], ["n"], rows_per_page=7).collect()
    assert len(pages) == 16
    told = "".join(r.text for r in sorted(pages, key=lambda r: r.page) if r.document == "hot")
    assert [int(n) for n in re.findall(r"\tn\s*: (\d+)", told)] == list(range(100))
