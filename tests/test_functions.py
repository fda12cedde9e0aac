from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docledger import functions as fn


def values(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_bucket_keys_and_labels(spark):
    amounts = ["-0.01", "0", "0.99", "1", "10", "100", "1000", "10000", "100000", None]
    amounts = [a and Decimal(a) for a in amounts]
    assert values(spark, amounts, fn.bucket_key, "decimal(18,3)") == [0, 1, 1, 2, 3, 4, 5, 6, 7, None]
    labels = values(spark, amounts, lambda c: fn.bucket_label(fn.bucket_key(c)), "decimal(18,3)")
    assert labels[0] == "< 0 Rs Difference" and labels[8] == "> 1000000" and labels[9] is None


def test_rounded_amount(spark):
    inputs = ["-1,234.5", "2.5", "3.5", " 7.2\t", "", None, "-0.2"]
    assert values(spark, inputs, fn.rounded_amount) == ["1234", "2", "4", "7", "0", "0", "0"]


def test_text_to_real(spark):
    assert values(spark, ["1,234.5", "x", None], fn.text_to_real) == [1234.5, None, None]


def test_padding(spark):
    assert values(spark, ["7", "12345", None], lambda c: fn.pad_key(c, 3, cut=True)) == ["007", "123", None]
    assert values(spark, ["7", "123", None], lambda c: fn.pad_key(c, 3)) == ["007", "123", None]
    with pytest.raises(Exception, match="longer than 3"):
        values(spark, ["1234"], lambda c: fn.pad_key(c, 3))
    assert values(spark, ["7", "12345", None], lambda c: fn.rjust_key(c, 3)) == ["007", "12345", None]


def test_splits(spark):
    assert values(spark, ["a,b", "a,,b", "a, b", "a,", None], fn.split_fields) == [
        ["a", "b"], ["a", "", "b"], ["a", " b"], ["a", ""], None,
    ]
    assert values(spark, ["[E1] a, b, [E2] c"], fn.split_bracketed) == [["[E1] a, b", "[E2] c"]]


def test_missing_tokens(spark):
    assert values(spark, ["NA", "n/a", "", "x", "na"], fn.null_if_na) == [None, None, None, "x", "na"]


def test_prefix_int(spark):
    assert values(spark, ["9965", "AB12", "", None], lambda c: fn.prefix_int(c, 2)) == [99, None, None, None]


def test_composite_key_collides_without_separator(spark):
    df = spark.createDataFrame([("AB", "C"), ("A", "BC"), (None, "X")], "a string, b string")
    keys = [tuple(r) for r in df.select(fn.composite_key(["a", "b"]), fn.composite_key(["a", "b"], "|")).collect()]
    assert keys == [("ABC", "AB|C"), ("ABC", "A|BC"), ("X", "|X")]


def test_debit_credit(spark):
    df = spark.createDataFrame([("S", "10.5"), ("H", "4")], "flag string, amount string")
    rows = df.select(
        fn.debit_credit(F.col("flag"), F.col("amount"), "S"),
        fn.debit_credit(F.col("flag"), F.col("amount"), "H", 2.0, 0.0),
    ).collect()
    assert [tuple(r) for r in rows] == [(10.5, 0.0), (None, 2.0)]


def test_suffix_match_keeps_wildcards(spark):
    df = spark.createDataFrame([("100042", "x"), ("7", "a9z"), (None, None)], "a string, b string")
    assert df.where(fn.suffix_match(["a", "b"], "42")).count() == 1
    assert df.where(fn.suffix_match(["a", "b"], "9_")).count() == 1


def test_row_hash_keeps_cells_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("abc", None), (None, "abc")], "x string, y string")
    types = [(f.name, f.dataType) for f in df.schema]
    assert df.select(fn.row_hash(types)).distinct().count() == 4
