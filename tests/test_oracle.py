import os, sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
"""Every registered query against its DuckDB SQL, plus the driver smoke entry."""
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import compare, duck
from tallyho.plans.catalog import QUERIES
from tallyho.plans.oracle import ORACLE

NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["term_name", "mismatches"]
