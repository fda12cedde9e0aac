import datetime
import json
import zipfile
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from docledger.operators.reconcile import SALES, STATUS
from docledger.plans.comparison import Comparison, Override, compare_with_file, run_comparison, run_comparisons
from docledger.sources import catalog as cat
from docledger.sources import files
from docledger.sources.excel import read_sheet, read_xlsx, sheet_region
from docledger.sources.extract import extract, predicate, table_specs
from docledger.sources.sinks import write_register

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def write_workbook(path, rows):
    """A minimal workbook; a cell is text (shared), a (kind, value) pair, or None."""
    texts, body = [], []
    for r, row in enumerate(rows, 1):
        cells = []
        for c, value in enumerate(row):
            at = f"{chr(65 + c)}{r}"
            if value is None:
                continue
            if isinstance(value, str):
                texts.append(value)
                cells.append(f'<c r="{at}" t="s"><v>{len(texts) - 1}</v></c>')
            elif value[0] == "date":
                cells.append(f'<c r="{at}" s="1"><v>{value[1]}</v></c>')
            elif value[0] == "inlineStr":
                cells.append(f'<c r="{at}" t="inlineStr"><is><t>{value[1]}</t></is></c>')
            else:
                cells.append(f'<c r="{at}" t="{value[0]}"><v>{value[1]}</v></c>')
        body.append(f'<row r="{r}">{"".join(cells)}</row>')
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>'
        '<sheet name="One" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="x"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
        "</Relationships>",
        "xl/styles.xml": f'<styleSheet xmlns="{MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        "xl/sharedStrings.xml": f'<sst xmlns="{MAIN}">' + "".join(f"<si><t>{t}</t></si>" for t in texts) + "</sst>",
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{MAIN}"><sheetData>{"".join(body)}</sheetData></worksheet>',
    }
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)


CATALOG = cat.schema_catalog(
    [("sales", "NO", "VARCHAR"), ("sales", "AMOUNT", "NUMERIC"), ("sales", "DT", "DATE"), ("sales", "NOTE", "VARCHAR"),
     ("purchase", "NO", "VARCHAR")]
)


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)
    return str(path)


def test_catalog(spark, tmp_path):
    assert list(CATALOG) == ["sales", "purchase"]
    assert CATALOG["sales"]["AMOUNT"].dataType == T.DecimalType(18, 3)
    path = put(tmp_path / "schema.csv", "TABLE,COLUMN,TYPE\nsales,A,VARCHAR(4)\nsales,B,\"NUMERIC(10,2)\"\n")
    read = cat.read_catalog(spark, path)
    assert read["sales"]["A"].dataType == T.StringType() and read["sales"]["B"].dataType == T.DecimalType(10, 2)
    with pytest.raises(ValueError, match="BLOB"):
        cat.declared_type("BLOB")


def test_staged_folder(spark, tmp_path):
    put(tmp_path / "input/sales/a.csv", "﻿NO,AMOUNT,DT,EXTRA\n007,1.5,2023-04-01,x\nNA,,2023-04-02,y\n")
    put(tmp_path / "input/deep/sales/b.csv", 'DT,NO,AMOUNT\n2023-05-01,"a ""q"", b",2\n')
    write_workbook(tmp_path / "input/sales/c.xlsx", [["NO", "AMOUNT"], [None, None], ["8", ("n", "3.25")], [None, None]])
    put(tmp_path / "input/purchase/p.csv", "NO\n1\n")
    loaded = files.read_staged(spark, str(tmp_path / "input"), CATALOG)
    assert set(loaded) == {"sales", "purchase"}
    rows = {tuple(r) for r in loaded["sales"].collect()}
    assert loaded["sales"].count() == 5
    assert rows == {
        (None, None, None, None),
        (None, None, datetime.date(2023, 4, 2), None),
        ("007", Decimal("1.500"), datetime.date(2023, 4, 1), None),
        ("8", Decimal("3.250"), None, None),
        ('a "q", b', Decimal("2.000"), datetime.date(2023, 5, 1), None),
    }


def test_headers_of_all_files_are_found_in_one_job(spark, tmp_path):
    for i in range(6):
        put(tmp_path / f"input/sales/f {i}.csv", "NO,AMOUNT\n1,1\n" if i % 2 else "\ufeffAMOUNT,NO\n2,2\n")
    group = "first-lines"
    spark.sparkContext.setJobGroup(group, group)
    lines = files.first_lines(spark, files.list_files(spark, str(tmp_path / "input"), "*"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(lines) == 6 and len(jobs) <= 12
    rows = files.read_staged(spark, str(tmp_path / "input"), CATALOG)["sales"].collect()
    assert sorted(r.NO for r in rows) == ["1", "1", "1", "2", "2", "2"]


@pytest.mark.parametrize("name", ["a.xls", "a.txt", "a.csv.gz"])
def test_unknown_kinds_of_files_fail(spark, tmp_path, name):
    put(tmp_path / "input/sales/ok.CSV", "NO,AMOUNT\n1,1\n")
    assert files.read_staged(spark, str(tmp_path / "input"), CATALOG)["sales"].count() == 1
    put(tmp_path / f"input/sales/{name}", "NO,AMOUNT\n1,1\n")
    with pytest.raises(ValueError, match="neither CSV nor XLSX"):
        files.read_staged(spark, str(tmp_path / "input"), CATALOG)


def test_rows_are_neither_cut_nor_torn(spark, tmp_path):
    put(tmp_path / "input/sales/a.csv", 'NO,NOTE\n1,"two\nlines"\n2,x\n')
    rows = files.read_staged(spark, str(tmp_path / "input"), CATALOG)["sales"].collect()
    assert sorted((r.NO, r.NOTE) for r in rows) == [("1", "two\nlines"), ("2", "x")]
    put(tmp_path / "input/sales/b.csv", "NO,NOTE\n1,2,3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_staged(spark, str(tmp_path / "input"), CATALOG)["sales"].collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_delimited(spark, str(tmp_path / "input/sales/b.csv")).collect()


def test_malformed_json_fails(spark):
    tasks = spark.createDataFrame([("{not json",)], "task string")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.task_files(tasks, "task").collect()


def test_workbooks_are_read_by_header(spark, tmp_path):
    write_workbook(tmp_path / "input/sales/a.xlsx", [["NO", "NOTE"], ["1", "x"]])
    write_workbook(tmp_path / "input/sales/b.xlsx", [["NO", "NOTE"], ["2", "y"]])
    write_workbook(tmp_path / "input/sales/c.xlsx", [["NOTE", "NO"], ["z", "3"]])
    rows = files.read_staged(spark, str(tmp_path / "input"), CATALOG)["sales"].collect()
    assert sorted((r.NO, r.NOTE) for r in rows) == [("1", "x"), ("2", "y"), ("3", "z")]


def test_staged_value_that_does_not_cast_fails(spark, tmp_path):
    put(tmp_path / "input/sales/a.csv", "NO,AMOUNT\n1,many\n")
    with pytest.raises(PySparkException):
        files.read_staged(spark, str(tmp_path / "input"), CATALOG)["sales"].collect()


def test_staged_table_must_be_declared(spark, tmp_path):
    put(tmp_path / "input/other/a.csv", "NO\n1\n")
    with pytest.raises(ValueError, match="other"):
        files.read_staged(spark, str(tmp_path / "input"), CATALOG)


def test_header_guard(spark, tmp_path):
    good = put(tmp_path / "a.csv", '﻿Doc No,"Amount, net",Date\n')
    assert files.read_header(spark, good) == ["Doc No", "Amount, net", "Date"]
    with pytest.raises(ValueError, match="Duplicate.*a"):
        files.read_header(spark, put(tmp_path / "b.csv", "a,b,a\n"))


REFERENCE = T.StructType([
    T.StructField("Document Number", T.StringType()), T.StructField("My GSTIN", T.StringType()),
    T.StructField("Item Taxable Amount", T.DecimalType(18, 3)), T.StructField("Document Date", T.DateType()),
])
MAPPING = {"Inv. No./BOE": "Document Number", "Taxable Value": "Item Taxable Amount", "Absent": "X"}


def test_borrowed_schema(spark, tmp_path):
    path = put(tmp_path / "c.csv", "Inv. No./BOE,My GSTIN,Taxable Value,Document Date,Other\n01,G,2.5,2023-04-01,7\n")
    df = files.read_borrowed(spark, path, REFERENCE, MAPPING)
    assert df.columns[:5] == ["Document Number", "My GSTIN", "Item Taxable Amount", "Document Date", "Other"]
    assert tuple(df.first())[:5] == ("01", "G", Decimal("2.500"), datetime.date(2023, 4, 1), "7")


def test_borrowed_schema_fails_on_a_bad_cell(spark, tmp_path):
    path = put(tmp_path / "c.csv", "Inv. No./BOE,My GSTIN,Taxable Value,Document Date\n01,G,many,2023-04-01\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.read_borrowed(spark, path, REFERENCE, MAPPING).collect()


def test_compare_with_file(spark, tmp_path):
    """FIRST on the customer side follows the file's own row order."""
    path = put(
        tmp_path / "c.csv",
        "Inv. No./BOE,My GSTIN,Taxable Value,Document Date\n"
        "D1,G,60,2023-04-02\nD1,G,40,2023-04-01\nD2,G,5,\nD9,G,1,2023-04-01\n",
    )
    register = spark.createDataFrame(
        [("D1", "G", Decimal(100), datetime.date(2023, 4, 2), 1), ("D2", "G", Decimal(5), datetime.date(2023, 4, 1), 2),
         ("D3", "G", Decimal(5), None, 3)],
        T.StructType([*REFERENCE.fields, T.StructField("n", T.IntegerType())]),
    )
    override = Override.from_json(json.dumps({"columns_mapping": MAPPING}))
    report = compare_with_file(spark, register, path, SALES, override, ["n"])
    assert {r["Composite_Key"]: r[STATUS] for r in report.collect()} == {
        "D1G": "Exact", "D2G": "Mismatch", "D3G": "Missing in Customer", "D9G": "Missing in CT Generated",
    }
    filtered = Override(columns_mapping=MAPPING, customer_input_filter=["`Document Number` <> 'D9'"])
    assert compare_with_file(spark, register, path, SALES, filtered, ["n"]).count() == 3
    run_comparison(spark, register, path, SALES, override, ["n"], str(tmp_path / "out"), only_diff=True)
    written = files.read_delimited(spark, str(tmp_path / "out"))
    assert written.count() == 3 and "Mismatched Fields" in written.columns
    same = replace(SALES, labels=replace(SALES.labels, exact="Same"))
    templates = {
        "sales": Comparison(register, path, same, override, ["n"], str(tmp_path / "sales")),
        "purchase": Comparison(register, str(tmp_path / "missing.csv"), same, override, ["n"], str(tmp_path / "purchase")),
    }
    assert run_comparisons(spark, templates, only_diff=True) == ["sales"]
    labelled = files.read_delimited(spark, str(tmp_path / "sales")).collect()
    assert len(labelled) == 3 and "Same" not in {r["Matching Status"] for r in labelled}
    assert not (tmp_path / "purchase").exists()


def test_inference_switch(spark, tmp_path):
    path = put(tmp_path / "p.csv", "n|t\n007|x\n")
    assert files.read_delimited(spark, path, sep="|").first().n == "007"
    assert files.read_delimited(spark, path, sep="|", all_text=False).first().n == 7


def test_seed(spark, tmp_path):
    path = put(tmp_path / "s.csv", "CODE, Description\n0100,\n400,Return\n")
    seed = files.read_seed(spark, path)
    assert seed.columns == ["CODE", "Description"]
    assert [tuple(r) for r in seed.collect()] == [("0100", None), ("400", "Return")]
    assert files.read_seed(spark, path, {"CODE": T.LongType()}).first().CODE == 100


def test_workbook_cells(spark, tmp_path):
    path = tmp_path / "w.xlsx"
    write_workbook(path, [
        ["Name", "When", None, "Flag"],
        ["a", ("date", "45017"), "x", ("b", "1")],
        [("inlineStr", "b"), ("date", "45017.5"), None, ("b", "0")],
        [("str", "NA"), None, None, ("n", "5")],
    ])
    df = read_xlsx(spark, str(path))
    assert df.columns == ["Name", "When", "Flag"]
    assert [tuple(r) for r in df.collect()] == [
        ("a", "2023-04-01 00:00:00", "True"), ("b", "2023-04-01 12:00:00", "False"), (None, None, "5"),
    ]
    region = sheet_region(read_sheet(spark, str(path)), 2, 3, "AD").orderBy("row_no").collect()
    assert [tuple(r) for r in region] == [(2, "a", "True"), (3, "b", "False")]


def test_large_sheet_comes_in_batches(spark, tmp_path):
    path = tmp_path / "big.xlsx"
    write_workbook(path, [["n"], *[[("n", str(i))] for i in range(25_000)]])
    assert read_xlsx(spark, str(path)).selectExpr("sum(cast(n as long))").first()[0] == 25_000 * 24_999 // 2


def test_extract_spec(spark):
    spec = {"config": {"tables": [{
        "select": [{"alias": "b", "name": "NO"}, {"name": "DT", "alias": "b"}],
        "fromTable": {"name": "lines", "alias": "b"},
        "where": [{"booleanOperator": "AND", "listOfExpr": [
            {"expr": {"column": {"name": "YEAR"}, "operator": "=", "value": ["19"]}},
            {"booleanOperator": "AND"},
            {"expr": {"column": {"name": "DT"}, "operator": ">=", "value": ["01-Apr-2023"]}},
            {"booleanOperator": "AND"},
            {"expr": {"column": {"name": "DT"}, "operator": "<=", "value": ["01-Jan-2024"]}},
        ]}],
    }]}}
    day = datetime.date
    lines = spark.createDataFrame(
        [("1", Decimal(19), day(2023, 4, 1)), ("2", Decimal(18), day(2023, 5, 1)), ("3", Decimal(19), day(2024, 1, 2)),
         ("4", Decimal(19), None)],
        "NO string, YEAR decimal(18,3), DT date",
    )
    parsed = table_specs(json.dumps(spec))["lines"]
    assert [tuple(r) for r in extract(lines, parsed).collect()] == [("1", day(2023, 4, 1))]
    parsed["where"][0]["listOfExpr"][1]["booleanOperator"] = "OR"
    with pytest.raises(ValueError, match="OR"):
        extract(lines, parsed)


def test_extract_value_lists(spark):
    lines = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "x string")
    rows = lambda operator, values: sorted(r.x for r in lines.where(predicate(lines, "x", operator, values)).collect())
    assert rows("!=", ["a", "b"]) == rows("<>", ["a", "b"]) == ["c"]
    assert rows("in", ["a", "c"]) == rows("=", ["a", "c"]) == ["a", "c"]
    assert rows(">=", ["b"]) == ["b", "c"]
    for operator, values in ((">", ["a", "b"]), ("=", []), ("~", ["a"])):
        with pytest.raises(ValueError):
            predicate(lines, "x", operator, values)


def test_extract_filter_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    spec = {
        "select": [{"name": "o_orderkey"}],
        "where": [{"listOfExpr": [{"expr": {"column": {"name": "o_orderdate"}, "operator": ">=", "value": ["01-Apr-1997"]}}]}],
    }
    plan = extract(orders, spec)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1997-04-01" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_sink_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2,)], "a int")
    write_register(one, path)
    write_register(two, path, mode="ignore")
    assert spark.read.parquet(path).first().a == 1
    write_register(two, path)
    assert spark.read.parquet(path).first().a == 2
    quoted = spark.createDataFrame([('x "y", z',)], "`a b` string")
    write_register(quoted, str(tmp_path / "c"), "csv")
    assert files.read_delimited(spark, str(tmp_path / "c")).first()["a b"] == 'x "y", z'


def test_schema_inventory_and_layers(spark):
    frames = {"sales": spark.createDataFrame([], CATALOG["sales"])}
    rows = [tuple(r) for r in cat.schema_inventory(spark, frames).collect()]
    assert rows[1] == ("sales", "AMOUNT", "DECIMAL(18,3)")
    files.attach(frames, "raw")
    assert ("raw_sales", "DT", "DATE") in [tuple(r) for r in cat.schema_inventory(spark).collect()]
    spark.catalog.dropTempView("raw_sales")


def test_task_files(spark):
    task = {"request": {"fileInfo": {"sales": [{"s3FileUrl": "u", "userFileName": "f"}], "none": []}}}
    rows = files.task_files(spark.createDataFrame([(json.dumps(task),)], "t string"), "t").collect()
    assert [tuple(r) for r in rows] == [("sales", "u", "f")]


def test_rewrite_key_moves_the_column(spark):
    df = cat.rewrite_key(spark.createDataFrame([("7", 1)], "no string, n int"), "no", 3)
    assert df.columns == ["n", "no"] and df.first().no == "007"
