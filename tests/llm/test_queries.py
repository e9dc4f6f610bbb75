"""Registration, and the queries that have SQL against DuckDB."""

import pytest

import __spark_entry__
from compare import duck, row_hash, type_diffs
from marginlib.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    result = duck(SF).execute(ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns) and not type_diffs(df, result.description)
    assert row_hash([tuple(r) for r in df.collect()], df.columns) == row_hash(result.fetchall(), columns)
