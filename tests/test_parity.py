"""Every query against its DuckDB oracle, and the entry module itself."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from testbed import parity
from testbed.queries import ORACLES, QUERIES

SF = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return parity.duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_duckdb(spark, con, name):
    assert parity.compare(spark, con, name, SF) > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_all_tiers_occur(spark):
    rows = QUERIES["nexus_exposure_scaled"](spark, "/root/testdata/sf0.01").collect()
    assert {r.exposure_tier for r in rows} == {"no_sales_tax", "below_threshold", "at_threshold", "high_exposure"}


def test_entry(spark):
    assert entry.entry(spark).count() == 49
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_module_needs_no_session():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = "import __spark_entry__ as e; assert len(e.queries()) >= 57 and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
