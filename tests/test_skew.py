"""A third of the rows on one key: adaptive execution splits the hot side."""

import pytest
from pyspark.sql import functions as F

from docledger.operators.joins import look_up, members
from docledger.operators.rollup import with_group_total

SETTINGS = {
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
}
ROWS = 60_000


@pytest.fixture()
def lines(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark.range(0, ROWS, 1, 24).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7919).cast("string")).alias("k"),
        F.md5(F.col("id").cast("string")).alias("wide"),
        F.lit(1).alias("n"),
    )
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def finished_plan(df):
    """The plan after running; the digest keeps every column in play."""
    digest = df.agg(F.count(F.lit(1)), F.max(F.xxhash64(*df.columns)))
    count = digest.collect()[0][0]
    return count, digest._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("operator", ["total", "members", "look_up"])
def test_hot_side_is_split(spark, lines, operator):
    keys = lines.select("k")
    built = {
        "total": lambda: with_group_total(lines, ["k"], "n", "t"),
        "members": lambda: members(lines, keys, ["k"]),
        "look_up": lambda: look_up(lines, keys.distinct(), [("k", "k")], {"k": "found"}),
    }[operator]()
    count, plan = finished_plan(built)
    assert count == ROWS
    assert "skew=true" in plan
