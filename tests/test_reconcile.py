from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from docledger.operators.reconcile import FIELDS, KEY, SALES, STATUS, only_differences, reconcile
from docledger.operators.rollup import Agg, first_per_key, rollup, with_group_total

SCHEMA = "`Document Number` string, `My GSTIN` string, `Item Taxable Amount` decimal(18,3), `Document Date` string, n int"


def frame(spark, rows):
    rows = [(d, g, None if a is None else Decimal(a), date, i) for i, (d, g, a, date) in enumerate(rows)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def sides(spark):
    generated = frame(spark, [
        ("D1", "G1", 60, "d1"), ("D1", "G1", 40, "d1"), ("D2", "G1", 50, "d1"), ("D3", "G1", 5, "d1"),
        ("D6", "G1", 5, "d1"), ("D4", None, 5, "d1"),
    ])
    customer = frame(spark, [
        ("D1", "G1", 100, "d1"), ("D2", "G1", 51, "d1"), ("D3", "G1", 5, None), ("D6", "G1", 6, "d2"),
        ("D5", "G1", 5, "d1"),
    ])
    return generated, customer


def outcome(report):
    return {r[KEY]: (r[STATUS], r[FIELDS]) for r in report.collect()}


def test_statuses(sides):
    found = outcome(reconcile(*sides, SALES, ["n"]))
    assert found["D1G1"] == ("Exact", "")
    assert found["D2G1"] == ("Mismatch", "Item Taxable Amount")
    assert found["D3G1"] == ("Mismatch", "Document Date")
    assert found["D6G1"] == ("Mismatch", "Item Taxable Amount|Document Date")
    assert found["D4"][0] == "Missing in Customer"
    assert found["D5G1"][0] == "Missing in CT Generated"
    assert len(found) == 6


def test_one_sided_rows_list_their_filled_columns(sides):
    found = outcome(reconcile(*sides, SALES, ["n"]))
    assert found["D4"][1] == "My GSTIN|Item Taxable Amount|Document Number|Document Date"


def test_only_differences(sides):
    report = reconcile(*sides, SALES, ["n"])
    assert only_differences(report).count() == 5


def test_narrowed_fields(sides):
    found = outcome(reconcile(*sides, SALES, ["n"], fields=["Document Date"]))
    assert found["D2G1"] == ("Exact", "") and found["D6G1"] == ("Mismatch", "Document Date")


def test_missing_columns_are_named(sides):
    generated, customer = sides
    with pytest.raises(ValueError, match="customer file: Document Date"):
        reconcile(generated, customer.drop("Document Date"), SALES, ["n"])


def test_two_exchanges(spark, sides):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = reconcile(*sides, SALES, ["n"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange ") == 2


LINE = st.tuples(
    st.sampled_from(["D1", "D2", "D3"]), st.sampled_from(["G1", "G2", "", None]),
    st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b", None]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(LINE, max_size=8), right=st.lists(LINE, max_size=8))
def test_properties(spark, left, right):
    a, b = frame(spark, left), frame(spark, right)
    itself = outcome(reconcile(a, frame(spark, left).repartition(3), SALES, ["n"]))
    assert {s for s, _ in itself.values()} <= {"Exact"}

    forward, backward = outcome(reconcile(a, b, SALES, ["n"])), outcome(reconcile(b, a, SALES, ["n"]))
    swap = {"Missing in Customer": "Missing in CT Generated", "Missing in CT Generated": "Missing in Customer"}
    assert {k: (swap.get(s, s), f) for k, (s, f) in forward.items()} == backward
    keys = {d + (g or "") for d, g, _, _ in left + right}
    assert set(forward) == keys


def test_first_keeps_a_leading_null(spark):
    df = spark.createDataFrame([("k", 1, None), ("k", 2, "x"), ("j", 5, "y")], "k string, n int, v string")
    rows = rollup(df, ["k"], {"v": Agg.FIRST}, ["n"]).collect()
    assert {r.k: r.v for r in rows} == {"k": None, "j": "y"}


def test_first_needs_an_order(spark):
    df = spark.createDataFrame([("k", "x")], "k string, v string")
    with pytest.raises(ValueError):
        rollup(df, ["k"], {"v": Agg.FIRST})


def test_set_and_sum(spark):
    df = spark.createDataFrame(
        [("k", "b", 1), ("k", "", 2), ("k", "c", 3), ("k", "b", 4), ("e", None, None)], "k string, v string, n int"
    )
    rows = {r.k: (r.v, r.n) for r in rollup(df, ["k"], {"v": Agg.SET, "n": Agg.SUM}).collect()}
    assert rows == {"k": ("c|b", 10), "e": ("", None)}


def test_group_total_with_null_keys(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("a", "x", 4), (None, None, 8)], "p string, q string, n int")
    rows = sorted((r.n, r.t) for r in with_group_total(df, ["p", "q"], "n", "t").collect())
    assert rows == [(1, 3), (2, 3), (4, 4), (8, 8)]


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, None)], "k string, n int, v string")
    assert sorted(map(tuple, first_per_key(df, ["k"]).collect())) == [("a", 1, "y"), ("b", 3, None)]
