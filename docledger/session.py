"""Session defaults and the reliable checkpoint used to cut lineage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
SHUFFLE_FILES_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "docledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew-join splitting on.

    Registers are wide: their fused stages can outgrow the 8000 bytes of bytecode
    the JVM still compiles, and then run interpreted. The method limit makes
    such a stage fall back to per-operator code, which stays compiled. Joins may
    hash instead of sort once every partition of the smaller side has been
    measured below the local-map threshold. Checkpoints go when nothing refers to
    them any more.
    Shuffle width is left to the cluster's own settings; pass it in ``conf``
    (``**{"spark.sql.shuffle.partitions": "8"}``) for a laptop run.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the session names; only a local run may fall back to scratch."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = context.getConf().get(CHECKPOINT_KEY, None) or spark.conf.get(CHECKPOINT_KEY, None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="docledger-checkpoint-")
    context.setCheckpointDir(folder)


@contextmanager
def shuffle_files_dropped(spark: SparkSession) -> Iterator[None]:
    """Frames run within drop their shuffle files when they end.

    Otherwise these stay until the driver happens to collect its garbage, and disk
    holds the shuffles of all steps before. A frame made before keeps its own
    setting; one that runs again shuffles again.
    """
    before = spark.conf.get(SHUFFLE_FILES_KEY, "false")
    spark.conf.set(SHUFFLE_FILES_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_FILES_KEY, before)


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise in shared storage, so a lost executor cannot lose or change it."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffle_files_dropped(df.sparkSession):
        return df.select("*").checkpoint(eager=True)
