import random

import pytest
from pyspark.sql import functions as F

from tablepact.llm.wumanber import Patterns, drop_contaminated, find_benchmark, patterns_of, words
from tests.llm.conftest import ODD


def plain(text, items, window=10):
    """(n_words, words hit, items) of a text, place by place."""
    found, hit, named = words((text or "").encode()), set(), set()
    for name, body in items:
        item = words((body or "").encode())
        m = min(len(item), window)
        grams = {tuple(item[i : i + m]) for i in range(len(item) - m + 1)} if m else set()
        for i in range(len(found) - m + 1) if m else ():
            if tuple(found[i : i + m]) in grams:
                hit |= set(range(i, i + m))
                named |= {str(name)} if name is not None else set()
    return len(found), len(hit), sorted(named)


@pytest.fixture
def corpus():
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice("the of And, to in-it was X9 é").strip() for _ in range(n))
    items = [(i, " ".join(rng.choice(["the", "of", "and", "to", "in"]) for _ in range(rng.choice([2, 3, 9, 10, 14, 30])))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "..."), (None, "alpha beta gamma"), (3, "one of two rows of item three, no less, and long")]
    texts = [*ODD, "the of and to in " * 40, "ALPHA, beta gamma", items[4][1] + " " + say(5), say(50)]
    texts += [" ".join(rng.choice(["the", "of", "and", "to", "in"]) for _ in range(60)) for _ in range(15)]
    return items, texts


@pytest.mark.parametrize("block_bytes, round_bytes", [(1 << 20, 1 << 20), (200, 1 << 20), (200, 700)])
def test_matches_plain_search(spark, documents, corpus, block_bytes, round_bytes):
    items, texts = corpus
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("n_words", F.lit(1))
    frame = documents(*texts).withColumn("hits", F.lit("mine"))
    rows = find_benchmark(frame, benchmark, block_bytes=block_bytes, round_bytes=round_bytes).orderBy("doc_id").collect()
    for text, row in zip(texts, rows, strict=True):
        expected = plain(text, items)
        assert (row["n_words"], row["n_hit"], row["items"]) == expected
        assert row["contaminated"] == (expected[1] > 0)


def test_empty_tables(spark, documents):
    nothing = spark.createDataFrame([], "item_id long, text string")
    row = find_benchmark(documents("some text"), nothing).first()
    assert (row["n_words"], row["n_hit"], row["items"], row["contaminated"]) == (2, 0, [], False)
    assert find_benchmark(documents(), nothing).collect() == []


def test_search_skips_and_compares():
    (search,) = patterns_of([b"a b c d", b"x b c d"], window=4)
    assert isinstance(search, Patterns) and search.shift[(b"c", b"d")] == 0 and search.shift[(b"a", b"b")] == 2
    text = b"q a b c d z x b c d b c d".split()
    assert sorted((at, sorted(own)) for at, own in search.search(text)) == [(1, [0]), (6, [1])]


def test_long_text(spark, documents):
    benchmark = spark.createDataFrame([(1, "needle in a very large heap of many other plain words")], "item_id long, text string")
    text = "hay " * 200_000 + "needle in a very large heap of many other plain words"
    assert find_benchmark(documents(text), benchmark).first()["n_hit"] == 11


def test_stage_drops_contaminated(spark, documents, tiny):
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    docs = documents("zero one two three four five six seven eight nine ten", "clean text", None, "clean text").withColumn("contaminated", F.lit("mine"))
    got = drop_contaminated(spark, docs, tiny(docs.limit(0), benchmark=benchmark))
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 2, 3]
