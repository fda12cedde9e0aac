"""Register and report outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from docledger.operators.reconcile import Labels, only_differences
from docledger.session import shuffle_files_dropped
from docledger.sources.commits import beside, drop_folder, replace_folder, restore_folder


def write_register(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Full refresh by default; ``mode='ignore'`` keeps what is already there.

    A refresh is written beside the table and takes its place when it is whole,
    so a job that fails leaves the table as it was, and a table may be refreshed
    from itself. CSV output carries a header and doubles embedded quotes. Parquet
    is compressed by zstandard; shuffle files of the write go when it ends.
    """
    if mode != "overwrite":
        _write(df, path, fmt, mode)
        return
    spark = df.sparkSession
    restore_folder(spark, path)
    fresh = beside(spark, path)
    try:
        _write(df, fresh, fmt, "errorifexists")
        replace_folder(spark, fresh, path)
    finally:
        drop_folder(spark, fresh)


def _write(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    with shuffle_files_dropped(df.sparkSession):
        writer = df.write.mode(mode)
        if fmt == "csv":
            writer.option("header", True).option("sep", ",").option("escape", '"').csv(path)
        elif fmt == "parquet":
            writer.option("compression", "zstd").parquet(path)
        else:
            writer.format(fmt).save(path)


def write_report(report: DataFrame, path: str, only_diff: bool = False, labels: Labels = Labels()) -> None:
    """Comparison report as CSV, all rows or only those that ``labels`` doesn't call exact."""
    write_register(only_differences(report, labels) if only_diff else report, path, "csv")
