"""Every registered query against its SQL counterpart, on the smallest test tables."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as registry
from compare import oracle_connection, oracle_rows, spark_rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    if not os.path.isdir(FOLDER):
        pytest.skip(f"no test tables in {FOLDER}")
    return oracle_connection(FOLDER)


WITHOUT_SQL = {"calculate_period_history"}  # too many rows to compare; see test_marts_of_seven_years


def test_every_query_has_sql():
    assert registry.bank_queries().keys() - WITHOUT_SQL == registry.bank_sql().keys()


@pytest.mark.parametrize("name", list(registry.bank_sql()))
def test_query_equals_sql(spark, oracle, name):
    columns, rows = spark_rows(registry.queries()[name](spark, FOLDER))
    expected_columns, expected = oracle_rows(oracle, registry.oracle_sql()[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected


def test_entry_returns_the_report(spark):
    report = registry.entry(spark)
    assert report.count() == 10
    assert report.columns[:5] == ["date_from", "date_to", "ledger2", "name", "characteristic"]


def test_the_bank_part_stands_without_libraries_of_the_other():
    """A library that only the training-data part needs is missing."""
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.bank_queries()))"
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=registry.__file__.rsplit("/", 1)[0])
    everything, bank = map(int, found.stdout.split())
    assert everything == bank > 50
