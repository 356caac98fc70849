"""Registered queries against their SQL oracle on the smallest test tables."""

import os

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck

import __spark_entry__ as entry
from tessera.plans.catalog import QUERIES as CATALOG
from tessera.plans.oracle import SQL

# Queries of the analytics operators; those of an optional subpackage have their own tests.
CORE = [k for k in CATALOG if k in SQL]


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test tables not present")
    return duck(SF_SMALL)


def test_every_query_has_oracle_or_is_documented():
    assert set(CATALOG) - set(SQL) == {"als_recommend"}
    assert set(CATALOG) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_survives_a_missing_third_party_module():
    """The analytics queries import where a module of the optional subpackage is
    not installed; an error in its own code is not hidden."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = """import builtins, sys
sys.path.insert(0, {root!r})
plain = builtins.__import__
def blocked(name, *a, **k):
    if name.split('.')[0] == 'zstandard':
        raise ModuleNotFoundError("No module named 'zstandard'", name='zstandard')
    return plain(name, *a, **k)
builtins.__import__ = blocked
import __spark_entry__ as e
from tessera.plans.catalog import QUERIES
assert set(QUERIES) <= set(e.queries()), 'analytics queries are missing'
""".format(root=root)
    assert subprocess.run([sys.executable, "-c", code], capture_output=True).returncode == 0


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["item1", "item2", "score", "n"]
    assert df.count() == 45  # all pairs of the ten items


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert r["status"] == "match", r
