import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablepact.llm import simhash
from tablepact.llm.graph import connected_components
from tablepact.llm.simhash import _masks, hamming_links, keep_one_of_each, near_duplicates, op6_simhash
from tests.llm.conftest import ODD

xxhash = pytest.importorskip("xxhash")


def plain_fingerprint(text, shingle=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    parts = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, radius=3):
    """For each value the index of the first it is linked to, directly or not."""
    label = list(range(len(values)))
    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                old, new = sorted((label[i], label[j]))[::-1]
                label = [new if x == old else x for x in label]
    return label


def test_query_matches_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    values = [plain_fingerprint(r["text"]) for r in docs]
    label = classes(values)
    got = op6_simhash(spark, sf).orderBy("doc_id").collect()
    expected = [(r["doc_id"], f"{v:016x}", docs[k]["doc_id"]) for r, v, k in zip(docs, values, label, strict=True)]
    assert [tuple(r) for r in got] == expected


@pytest.mark.parametrize("size, cell", [(400, 20_000), (1500, 100)])
def test_links_span_all_classes(spark, monkeypatch, size, cell):
    monkeypatch.setattr(simhash, "TREE_SIZE", cell)  # the second one splits its shards
    monkeypatch.setattr(simhash, "FRONTIER", 2_000)
    monkeypatch.setattr(simhash, "BATCH_ROWS", 300)
    rng = random.Random(size)
    values = {rng.getrandbits(64) for _ in range(size // 4)}
    hot = rng.getrandbits(64)
    while len(values) < size:
        base = rng.choice([hot, hot, *list(values)[:20]])
        for _ in range(rng.randint(1, 5)):
            base ^= 1 << rng.randrange(64)
        values.add(base)
    values = sorted(values)
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    links = hamming_links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    assert len(links) <= 4 * len(values)
    place = {v: i for i, v in enumerate(signed)}
    assert all((values[place[a]] ^ values[place[b]]).bit_count() > 0 for a, b in links)
    label = list(range(len(values)))
    for a, b in links:
        old, new = sorted((label[place[a]], label[place[b]]))[::-1]
        label = [new if x == old else x for x in label]
    assert label == classes(values)


@pytest.mark.parametrize("distinct", [10, 10**8, 10**11])
def test_masks_catch_all_close_pairs(distinct):
    rng = random.Random(1)
    masks = _masks(distinct, 3)
    for _ in range(300):
        flips = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not flips & m for m in masks)


def test_odd_rows(documents):
    same = "one two three four five six seven"
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, same), (50, same), (None, same), (None, "alone " * 9)]
    frame = documents(*rows).withColumn("fp", F.lit("mine")).withColumn("component_id", F.lit(-1))
    got = near_duplicates(frame).collect()
    assert len(got) == len(rows)
    blank = [r for r in got if r["fp"] == 0]
    assert len(blank) >= 3 and {r["component_id"] for r in blank} == {0}
    assert [r["component_id"] for r in got if r["doc_id"] == 50] == [50, 50]
    kept = keep_one_of_each(frame)
    assert set(kept.columns) == set(frame.columns)
    rows = kept.collect()
    assert sorted((r["doc_id"] for r in rows if r["doc_id"] is not None)).count(50) == 1
    assert [r["text"] for r in rows if r["doc_id"] is None] == ["alone " * 9]
    assert {r["fp"] for r in rows} == {"mine"}


def test_keeps_the_smallest_id(documents):
    same = "a b c d e f g"
    got = keep_one_of_each(documents((9, same), (3, same), (7, same.upper()), (4, "quite another text than that"))).collect()
    assert sorted(r["doc_id"] for r in got) == [3, 4]


def test_no_rows(documents):
    assert near_duplicates(documents()).collect() == [] and keep_one_of_each(documents()).collect() == []


def test_long_text(documents, monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLES", 1000)
    text = " ".join(f"w{i % 997}" for i in range(30_000))
    assert np.uint64(plain_fingerprint(text)).astype(np.int64) == near_duplicates(documents(text)).first()["fp"]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (1, 2), (2, 1)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(chain, "a long, b long")).collect()))
    expected = {i: 40 for i in range(40, 61)} | {i: 100 for i in range(100, 140)} | {1: 1, 2: 1}
    assert got == expected
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
