import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablepact.llm import suffixes
from tablepact.llm.suffixes import SuffixLevels, cut_repeats, merged, op10_suffix_dedup, remove_repeats
from tests.llm.conftest import ODD


def plain(texts, length=100):
    """(n_bytes, n_removed, n_spans, kept digest) of texts in order, string by string."""
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if (part := raw[i : i + length]) in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(part)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def found(df):
    rows = df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).orderBy("doc_id").collect()
    return [tuple(r)[1:] for r in rows]


@pytest.mark.parametrize("hot_runs, hot_part", [(500, 2), (3, 2), (500, 0.05), (3, 0)])
def test_matches_plain_search(documents, monkeypatch, hot_runs, hot_part):
    monkeypatch.setattr(suffixes, "HOT_RUNS", hot_runs)
    monkeypatch.setattr(suffixes, "HOT_PART", hot_part)
    monkeypatch.setattr(suffixes, "PIECE", 700)  # cuts long texts
    monkeypatch.setattr(suffixes, "BATCH", 300)  # several batches and levels
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcé ", k=rng.randint(1, 9)))
    shared = ["".join(word() for _ in range(60)) for _ in range(4)]
    texts = []
    for _ in range(40):
        parts = [word() * rng.randint(1, 3) for _ in range(10)]
        piece = rng.choice(shared)
        at = rng.randrange(100)
        texts.append("".join(parts) + piece[at : at + rng.randint(80, 220)] + "".join(word() for _ in range(20)))
    texts += ["ab" * 900, "z" * 3000, texts[3], texts[3][:-1] + "!", *shared, "q" * 99, "q" * 100, "q" * 101]
    assert found(remove_repeats(documents(*texts))) == plain(texts)


@pytest.mark.parametrize("hot_part", [2, 0.02])
def test_common_line_in_other_surroundings(documents, monkeypatch, hot_part):
    monkeypatch.setattr(suffixes, "HOT_RUNS", 20)
    monkeypatch.setattr(suffixes, "HOT_PART", hot_part)
    line = "a very common line that stands in a great many texts and is long enough by itself"
    texts = [f"{i * 7919 % 1009:04d} before it {i % 9} {line} {i % 11} after it {i * 31 % 97}" for i in range(120)]
    assert found(remove_repeats(documents(*texts))) == plain(texts)
    frame = documents(*texts).withColumn("ord", F.col("doc_id"))
    assert bool(suffixes._hot_anchors(frame, 100)) == (hot_part < 1)


def test_hot_windows_are_combined_before_the_shuffle(documents, monkeypatch):
    """However many documents share a passage, a task sends each of its windows once."""
    met, compare = [], suffixes._compare

    def counted(runs, length):
        met.append(runs.filter("size is null").groupBy("a").count().agg(F.max("count")).first()[0])
        return compare(runs, length)

    monkeypatch.setattr(suffixes, "_compare", counted)
    rng = np.random.default_rng(9)
    word = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passage, largest = word(150), []
    for n in (60, 240):
        texts = [word(int(rng.integers(5, 40))) + passage + word(int(rng.integers(5, 40))) for _ in range(n)]
        frame = documents(*texts).coalesce(1)
        assert found(remove_repeats(frame)) == plain(texts)
        largest.append(met.pop())
    assert max(largest) <= 16  # tasks of the join, not documents


def test_odd_rows(documents):
    long = "the same words again and again " * 5
    texts = [*ODD, long, long, long[:99], "é" * 60]
    frame = documents(*texts).withColumn("kept", F.lit("mine")).withColumn("N_Bytes", F.lit(-1))
    assert found(remove_repeats(frame)) == plain(texts)


def test_repeated_and_missing_ids(documents):
    a, b = "first text " * 20, "other text " * 20
    rows = [(5, a), (5, a), (None, a), (None, b), (4, b)]
    got = remove_repeats(documents(*rows)).select("doc_id", "n_bytes", "n_removed").collect()
    # the order is (4, b), (5, a), (5, a), (null, a), (null, b)
    expected = [(k, len(t), n) for (k, t), (_, n, _, _) in zip(
        [(4, b), (5, a), (5, a), (None, a), (None, b)], plain([b, a, a, a, b]), strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_keys_that_are_text(spark):
    text = "some long enough text " * 8
    got = remove_repeats(spark.createDataFrame([("b", text), ("a", text)], "doc_id string, text string"))
    removed = {r["doc_id"]: r["n_removed"] for r in got.collect()}
    assert removed["b"] == len(text) and removed["a"] < len(text)


def test_no_rows(documents):
    assert remove_repeats(documents()).collect() == []


def test_offsets_and_text(documents):
    text = "0123456789" * 30
    row = remove_repeats(documents("head " + "x" * 5 + text, text + " tail")).orderBy("doc_id").collect()[1]
    assert row["removed"] == [(0, 300)] and row["text"] == " tail" and bytes(row["kept"]) == b" tail"


def test_very_long_text_after_an_empty_one(documents):
    rng = np.random.default_rng(5)
    long = rng.integers(97, 123, (1 << 24) + 3000).astype(np.uint8).tobytes().decode()
    frame = documents(None, "", long, "A" + long[-1500:-1000] + "B").coalesce(1)
    got = [r["removed"] for r in remove_repeats(frame).orderBy("doc_id").collect()]
    assert got == [[], [], [], [(1, 501)]]


def test_places_beyond_24_bits_are_refused():
    data = np.zeros((1 << 24) + 1, np.uint8)
    with pytest.raises(ValueError):
        suffixes.window_runs(data, np.array([0]), np.array([len(data)]), 100, suffixes.RollingHash())


def test_short_strings_are_refused(documents):
    with pytest.raises(ValueError):
        remove_repeats(documents("a"), length=32)


def test_levels_merge_and_find():
    rng = np.random.default_rng(3)
    index, seen = SuffixLevels(40), set()
    for _ in range(9):
        data = rng.integers(97, 99, 400).astype(np.uint8)
        data[:120] = 97
        at = np.arange(361)
        known = index.add(data, at)
        for i in at:
            part = data[i : i + 40].tobytes()
            assert known[i] == (part in seen)
            seen.add(part)
    sizes = [len(places) for _, places in index.levels]
    assert all(a > b for a, b in zip(sizes, sizes[1:], strict=False)) and sum(sizes) == len(seen)


def test_merged_spans():
    s, e, o = merged(np.array([5, 0, 3, 9, 1]), np.array([7, 2, 5, 11, 4]), np.array([0, 0, 0, 0, 1]))
    assert list(zip(s, e, o, strict=True)) == [(0, 2, 0), (3, 7, 0), (9, 11, 0), (1, 4, 1)]


def test_query_matches_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    rows = op10_suffix_dedup(spark, sf).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in rows] == plain(texts)


def test_stage_keeps_columns(spark, documents):
    text = "a passage that two documents share, word for word, and long enough to be found " * 2
    docs = documents((1, text, "en", "s", len(text)), (2, text, "en", "s", len(text)), (3, text + "more", "en", None, 1), (4, None), (5, ""))
    docs = docs.withColumn("kept", F.lit("mine"))
    got = {r["doc_id"]: r for r in cut_repeats(spark, docs, "").collect()}
    assert sorted(got) == [1, 3, 4, 5] and set(got[1].asDict()) == set(docs.columns)
    assert got[3]["text"] == "more" and got[3]["n_chars"] == 4 and got[4]["text"] is None and got[1]["kept"] == "mine"
