"""Registered llm queries: names, twins in SQL, and brute force where there is none."""

import check_twins
import pytest
from test_jaccard import brute as groups
from test_substrings import brute as repeats

import __spark_entry__ as entry
from docledger.llm import registry

FOLDER = "/root/testdata/sf0.001"


def test_names():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_twin(spark, name):
    assert check_twins.compare(spark, check_twins.connect(FOLDER), FOLDER, name) is None


def test_components_and_repeats_of_the_given_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert sorted(map(tuple, registry.op6_jaccard(spark, FOLDER).collect())) == sorted(groups(rows, 4, 85))
    found = registry.op7_substrings(spark, FOLDER).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in found) == [r[:4] for r in repeats(rows)]
