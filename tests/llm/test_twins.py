"""Queries of the training-data operators against their SQL twins, and the pipeline against a plain one."""

from collections import Counter
from pathlib import Path

import pytest

from tablepact.llm.queries import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def twin():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_twin(spark, twin, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = twin.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(r[i] for i in order) for r in cursor.fetchall())
    assert Counter(map(tuple, df.select(*columns).collect())) == theirs
