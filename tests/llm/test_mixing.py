from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tablepact.llm import mixing
from tablepact.llm.mixing import mix_sources, sainte_lague, source_targets, word_count
from tests.llm.conftest import ODD


def plain_targets(sizes):
    """Targets by resharing, source by source, until none is above twice its size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), Fraction(3, 2) * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_} if total else {}
        full = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not full:
            return target | share
        target |= {s: Fraction(2 * sizes[s]) for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full


def plain_seats(votes, seats):
    got = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (Fraction(votes[i], 2 * got[i] + 1), -i))
        got[best] += 1
    return got


@pytest.mark.parametrize("votes, seats", [([53, 24, 23], 7), ([5, 5, 5, 5], 6), ([1, 0, 0], 3), ([900, 1, 1, 1, 1, 1, 1], 40), ([7, 3], 0), ([340, 333, 320], 1000)])
def test_seats_by_highest_quotients(spark, votes, seats):
    frame = spark.createDataFrame([("g", i, v, sum(votes), seats) for i, v in enumerate(votes)], "g string, i int, v long, t long, n long")
    for within in ([], ["g"]):
        rows = sainte_lague(frame, "v", "t", "n", [F.col("i")], within).orderBy("i").collect()
        assert [r["quota"] for r in rows] == plain_seats(votes, seats)


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 50}, {"a": 1, "b": 1000, None: 3, "": 40, "Z": 5}, {"a": 0, "b": 0}, {None: 9}])
def test_targets(spark, sizes):
    rows = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    expected = plain_targets(sizes)
    assert {r["source"]: r["target"] for r in rows} == pytest.approx({s: float(t) for s, t in expected.items()})


def test_mix_comes_near_its_targets(spark):
    rows = mix_sources(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert sum(r["taken"] for r in own) == pytest.approx(own[0]["target"], abs=1)


def test_shards_of_a_hot_source(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    monkeypatch.setattr(mixing, "GROUP_SHARDS", 3)
    texts = [(i, "w " * (7 + i % 90), None, "hot" if i % 4 else f"s{i % 7}") for i in range(400)]
    first = mix_sources(documents(*texts)).collect()
    again = mix_sources(documents(*texts[::-1]).repartition(5)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    for source in {r["source"] for r in first}:
        own = [r for r in first if r["source"] == source]
        shards = -(-own[0]["source_size"] // 500)
        assert sum(r["taken"] for r in own) == pytest.approx(own[0]["target"], abs=(shards + 2) * mixing.BLOCK_WORDS)
        assert all(r["taken"] <= 2 * r["size"] for r in own)


@pytest.mark.parametrize("words", [1, 2, 3, 31, 32, 33, 63, 64, 65, 100, 1000])
def test_small_sources_reach_their_targets(documents, words):
    """Beside a large source, one of a few words is near twice its size."""
    rows = [(i, "w " * 500, None, "big") for i in range(40)]
    rows += [(100 + i, "w " * n, None, "small") for i, n in enumerate([words // 2, words - words // 2])]
    got = mix_sources(documents(*rows)).collect()
    for source in ("big", "small"):
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)


def test_very_long_text(documents):
    got = mix_sources(documents((0, "word " * 1_500_000, None, "a"), (1, "w " * 900, None, "a"), (2, "w " * 70, None, "b"))).collect()
    assert {r["doc_id"]: r["size"] for r in got} == {0: 1_500_000, 1: 900, 2: 70}
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    a = [r for r in got if r["source"] == "a"]
    assert sum(r["taken"] for r in a) == pytest.approx(a[0]["target"], abs=2 * mixing.BLOCK_WORDS)


def test_too_many_sources(documents, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    with pytest.raises(Exception, match="over 2 sources"):
        mix_sources(documents(*[(i, "a b", None, f"s{i}") for i in range(3)])).collect()


def test_odd_rows(documents):
    rows = [(i, t, None, ["s", None, "t"][i % 3]) for i, t in enumerate(ODD)] + [(50, "a b c", None, "u")] * 2 + [(None, "many words " * 80, None, None)]
    frame = documents(*rows).withColumn("taken", F.lit("mine")).withColumn("source_size", F.lit("mine"))
    got = mix_sources(frame).collect()
    assert len(got) == len(rows)
    assert [r["size"] for r in sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"])) if r["doc_id"] in range(4)] == [0, 0, 0, 1]
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert mix_sources(documents()).collect() == []
    assert [r["taken"] for r in mix_sources(documents(None, "")).collect()] == [0, 0]


def test_word_count(documents):
    rows = documents("", " ", " a\tb\x0bc ", "a b", None).select(word_count("text")).collect()
    assert [r[0] for r in rows] == [0, 0, 3, 1, 0]
