"""Shuffle files go when the step that wrote them ends."""

import gc
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docledger.llm.words import written
from docledger.plans.models import Project, published
from docledger.session import SHUFFLE_FILES_KEY, checkpoint
from docledger.sources.sinks import write_register


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in disk.localDirsString() for f in Path(d).rglob("shuffle_*.data")}


def summed(spark):
    return spark.range(10_000).repartition(4, "id").groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s"))


def test_steps_leave_no_shuffle_files(spark):
    gc.collect()
    for step in (checkpoint, lambda df: written(df, "disk")):
        asked = summed(spark)
        before = shuffle_files(spark)
        kept = step(asked)
        assert shuffle_files(spark) <= before
        assert kept.count() == asked.count() == 100
        assert kept.agg(F.sum("s")).first()[0] == sum(range(10_000))
    assert spark.conf.get(SHUFFLE_FILES_KEY) == "false"


def test_a_written_register_leaves_no_shuffle_files(spark, tmp_path):
    gc.collect()
    for fmt in ("parquet", "csv"):
        asked = summed(spark)
        before = shuffle_files(spark)
        write_register(asked, f"{tmp_path}/{fmt}", fmt)
        assert shuffle_files(spark) <= before
    assert spark.read.parquet(f"{tmp_path}/parquet").count() == 100
    assert spark.conf.get(SHUFFLE_FILES_KEY) == "false"


def test_a_run_that_fails_leaves_no_shuffle_files_and_the_setting(spark, tmp_path):
    gc.collect()
    root = str(tmp_path)
    project = Project()
    project.add("x", "sums", ["raw.t"], lambda t: t.groupBy("k").agg(F.sum("id").alias("s")))
    raw = {"raw.t": spark.range(1_000).select("id", (F.col("id") % 10).alias("k"))}
    project.run(spark, raw, root)
    project.add("x", "late", ["s_x.sums"], lambda t: t.groupBy(F.col("k") % 3).agg(F.max(F.raise_error(F.lit("no"))).cast("string").alias("e")))
    before = shuffle_files(spark)
    with pytest.raises(Exception, match="no"):
        project.run(spark, raw, root)
    assert shuffle_files(spark) <= before
    assert {n: t.count() for n, t in published(spark, root).items()} == {"s_x.sums": 10}
    assert spark.conf.get(SHUFFLE_FILES_KEY) == "false"
