"""Every registered query gives the rows of its SQL twin."""

import check_twins
import pytest

import __spark_entry__ as entry
import workload

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check_twins.connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(workload.queries()) == set(workload.oracle_sql())


@pytest.mark.parametrize("name", sorted(workload.queries()))
def test_twin(spark, connection, name):
    assert check_twins.compare(spark, connection, FOLDER, name) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
