from docledger.plans.dossiers import PURCHASE, SALES, DossierSpec, compare_dossiers, compare_rows

SCHEMA = "`Document Number` string, `Item Taxable Value *` string, Status string, Note string"


def frames(spark):
    left = spark.createDataFrame(
        [("0000000001", "1,000.5", "x", "b"), ("0000000001", "9", "y", "a"), ("0000000002", "1", "z", "c")], SCHEMA
    )
    right = spark.createDataFrame([("0000000001", "-9", "q", "a"), ("0000000003", "1", "q", None)], SCHEMA)
    return left, right


def test_both_sides_print_the_same_documents(spark):
    left, right = (side.collect() for side in compare_dossiers(*frames(spark), SALES))
    assert [r.document for r in left] == [r.document for r in right] == ["0000000001"]
    head = "0000000001\n\n\tItem Taxable Value * : "
    assert left[0].text == (
        f"{head}9\n\tNote                 : a\n\n" f"{head}1000\n\tNote                 : b\n\n"
    )
    assert right[0].text == f"{head}9\n\tNote                 : a\n\n"


def test_rows_side_by_side(spark):
    rows = compare_rows(*frames(spark), SALES).collect()
    assert [(r["Key"], r["left_Item Taxable Value *"], r["right_Item Taxable Value *"]) for r in rows] == [
        ("0000000001", "1,000.5", "-9")
    ]


def test_limit_takes_the_first_keys(spark):
    df = spark.createDataFrame([("b", "1"), ("a", "2"), ("c", "3")], "k string, v string")
    left, _ = compare_dossiers(df, df, DossierSpec(key="k", limit=2))
    assert sorted(r.document for r in left.collect()) == ["a", "b"]
    every, _ = compare_dossiers(df, df, DossierSpec(key="k"))
    assert every.count() == 3 and PURCHASE.limit is None and SALES.limit is None
