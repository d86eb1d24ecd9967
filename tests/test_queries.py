"""Every query against its SQL twin in a second engine, over the same files."""

import math
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__
from workload.oracles import ORACLES
from workload.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def twin():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def comparable(row):
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_twin(spark, twin, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = Counter(comparable(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    cursor = twin.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = Counter(comparable(r[i] for i in order) for r in cursor.fetchall())
    assert ours == theirs


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
