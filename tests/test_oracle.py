"""Every registered query against its DuckDB oracle: rows, columns and exact values."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as ent  # noqa: E402
from check_oracle import digest, duck_conn  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from metroflux.plans.catalog import QUERIES  # noqa: E402

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_conn(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ent.oracle_sql()) <= set(ent.queries())


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert "has_subway_disruption" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = ent.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ent.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]
