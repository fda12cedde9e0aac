import datetime
import random

import pytest
from pyspark.sql import functions as F

from docledger.operators.ordering import range_bounds, range_of, running_total, with_ordinal, with_position


def shuffled(spark, rows, schema, parts=5):
    rows = list(rows)
    random.Random(7).shuffle(rows)
    return spark.createDataFrame(rows, schema).repartition(parts)


def test_position_is_dense_and_ordered(spark):
    df = shuffled(spark, [(i // 3, i) for i in range(500)], "a int, b int")
    placed = with_position(df, ["a", "b"])
    assert {(r.b, r.position) for r in placed.collect()} == {(i, i + 1) for i in range(500)}


def test_running_total(spark):
    df = shuffled(spark, [(f"v{i:03d}", i) for i in range(200)], "v string, n long")
    totals = {r.v: r.t for r in running_total(df, ["v"], "n", "t").collect()}
    assert totals == {f"v{i:03d}": i * (i + 1) // 2 for i in range(200)}


def ranked(rows, key=lambda r: r[0], order=lambda r: (r[1] is not None, r[1])):
    """Ordinals by plain lists, as a set of (key, order, ordinal)."""
    groups = {}
    for r in rows:
        groups.setdefault(key(r), []).append(order(r))
    return sorted((str(k), str(o[-1]), i) for k, values in groups.items() for i, o in enumerate(sorted(values), 1))


@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
def test_ordinals_are_the_same_in_any_ranges(spark, ranges):
    """A third of the rows share one key, some have no key or no place, some rows repeat."""
    rows = [("hot", i % 290) for i in range(300)] + [(None, i) for i in range(80)] + [("hot", None)] * 3
    rows += [(f"k{i % 130}", i) for i in range(520)]
    placed = with_ordinal(shuffled(spark, rows, "k string, v int"), ["k"], ["v"], ranges=ranges)
    assert placed.columns == ["k", "v", "ordinal"]
    assert sorted((str(r.k), str(r.v), r.ordinal) for r in placed.collect()) == ranked(rows)


def test_ordinals_by_several_columns_of_any_type(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice([None, "a", "b"]), rng.choice([None, datetime.date(2024, 1, 1)]), rng.choice([None, 1.5, float("nan"), float("inf"), -0.0]),
         datetime.datetime(2024, 1, 1, 0, 0, 0, rng.randrange(1_000_000)), i)
        for i in range(400)
    ]
    df = shuffled(spark, rows, "k string, d date, x double, t timestamp, i int")
    one, many = (with_ordinal(df, ["k", "d"], ["x", "t", "i"], ranges=n).orderBy("i").collect() for n in (1, 50))
    assert list(map(str, one)) == list(map(str, many))
    assert max(r.ordinal for r in many) > 50


def test_a_hot_key_is_spread_and_wide_rows_move_once(spark):
    df = spark.range(0, 40_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 997).cast("string")).alias("k"),
        "id", F.md5(F.col("id").cast("string")).alias("wide"),
    )
    placed = with_ordinal(df, ["k"], ["id"], ranges=32)
    bounds = range_bounds(df, ["k"], ["id"], 32)
    place = F.struct(F.struct(F.col("k").alias("c0")).alias("k"), F.struct(F.col("id").alias("c0")).alias("o"))
    laid = df.select("*", range_of(place, bounds, 32).alias("r"))
    hot = laid.where("k = 'hot'").groupBy("r").count().collect()
    assert len(hot) >= 8 and max(r["count"] for r in hot) < 40_000 / 32 * 3
    assert laid.where("k <> 'hot'").groupBy("k").agg(F.count_distinct("r").alias("n")).where("n > 1").isEmpty()
    assert placed.where("k = 'hot'").agg(F.max("ordinal")).first()[0] == df.where("k = 'hot'").count()


def test_small_groups_are_not_cut(spark):
    df = shuffled(spark, [(f"k{i % 400}", i) for i in range(2_000)], "k string, v int")
    assert range_bounds(df, ["k"], ["v"], 16) is None
    plan = with_ordinal(df, ["k"], ["v"], ranges=16)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "Join" not in plan


def test_wide_rows_have_one_exchange(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(100).select((F.col("id") % 3).alias("k"), "id", F.md5(F.col("id").cast("string")).alias("wide"))
        plan = with_ordinal(df, ["k"], ["id"], ranges=16)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    text = plan.toString()
    below = text[: text.index("BroadcastExchange")]
    assert below.count("Exchange hashpartitioning") == 1


def test_empty_frame(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert with_position(df, ["v"]).count() == 0
    assert with_ordinal(df, ["k"], ["v"]).count() == 0
    assert running_total(df.withColumn("n", F.lit(1)), ["v"], "n", "t").count() == 0
