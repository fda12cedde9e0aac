import csv
from collections import defaultdict
from pathlib import Path

from workload import inputs
from workload.base import Tables

COLUMNS = ("Doc. No/BOE", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "Taxable Value", "My GSTIN")


def test_a_customers_document_is_in_one_file_in_order_without_ranges(spark, tmp_path):
    lines = spark.range(3_000).selectExpr(
        "id % 400 as l_orderkey", "cast(id % 7 as int) as l_linenumber", "id % 11 as l_partkey", "id % 4 as l_suppkey",
        "cast(id % 50 as double) as l_quantity", "cast(1000 - id % 90 as double) as l_extendedprice",
        "if(id % 9 = 0, 0.1d, 0.05d) as l_discount", "0.08d as l_tax", "timestamp'1996-01-02' as l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("customer", "")
    inputs._write_customer(Tables(spark, str(tmp_path)), f"{tmp_path}/customer")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs.getJobIdsForGroup("customer")) == 3  # schema, shuffle and files, none for the bounds of ranges
    files, rows = defaultdict(set), []
    for path in sorted(Path(tmp_path, "customer").glob("*.csv")):
        with open(path, newline="") as file:
            part = [tuple(r[c] for c in COLUMNS) for r in csv.DictReader(file)]
        order = [(r[0], *map(float, r[1:6])) for r in part]
        assert order == sorted(order)
        for r in part:
            files[r[0], r[6]].add(path)
        rows += part
    assert len(rows) == 3_000 and all(len(f) == 1 for f in files.values())
