"""Every registered query equals its DuckDB oracle on the smallest data."""
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from compare import duck, row_hash, type_diffs  # noqa: E402
from marginlib.plans.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL) and set(QUERIES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "contribution_margin_pct" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    r = con.execute(SQL[name])
    drows = r.fetchall()
    dcols = [d[0] for d in r.description]
    assert sorted(df.columns) == sorted(dcols)
    assert not type_diffs(df, r.description)
    assert len(srows) == len(drows)
    hs, ls = row_hash(srows, df.columns)
    hd, ld = row_hash(drows, dcols)
    assert hs == hd, (sorted(set(ls) - set(ld))[:2], sorted(set(ld) - set(ls))[:2])
