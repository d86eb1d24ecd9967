import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablepact.llm import batches
from tablepact.llm.quality import QualityOptions, fit_quality, op8_quality, score_quality
from tablepact.llm.rolling import RollingHash, mix
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.01"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, hit, seen, again = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if often[w] > 1:
            hit |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(hit)


def test_query(spark):
    """Counts are those of a plain count; the verdict is right on rows it didn't learn from."""
    rows = op8_quality(spark, SF).orderBy("doc_id").collect()
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    for row, text in zip(rows, texts, strict=True):
        expected = plain(text)
        assert tuple(row[c] for c in COUNTS) == expected
        assert row["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert row["kept"] == (not row["base_failed"] and row["probability"] >= 0.5)


def test_held_out_verdicts(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    even = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    model = fit_quality(docs, even, options=QualityOptions(sample_rows=400))
    rows = score_quality(docs, model).join(labels.join(even, "doc_id", "left_anti"), "doc_id").collect()
    right = [(r["probability"] >= 0.5) == (r["quality"] == 1) for r in rows]
    assert len(rows) > 150 and np.mean(right) > 0.97
    gap = np.mean([r["probability"] for r in rows]) - np.mean([r["quality"] for r in rows])
    assert abs(gap) < 0.05  # calibrated: as many good ones as the probabilities say


def test_batches_and_order_change_nothing(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = fit_quality(docs, labels)
    again = fit_quality(docs.orderBy(F.desc("text")).repartition(3), labels.repartition(2))
    assert (model[0] == again[0]).all() and model[1:] == again[1:]
    first = score_quality(docs, model).orderBy("doc_id").collect()
    monkeypatch.setattr(batches, "PIECE_BYTES", 3000)
    monkeypatch.setattr(batches.pieces, "__defaults__", (3000,))
    assert score_quality(docs.repartition(4), model).orderBy("doc_id").collect() == first


def test_odd_rows(documents, spark):
    rng = random.Random(2)
    texts = [*ODD, "a b c a b c a b c", "x\nx\n\n \nx ", "é| <b>", "\n".join(["same line here"] * 30), "w " * 200_000]
    texts += [" ".join(rng.choices("abcd", k=rng.randint(3, 200))) for _ in range(30)]
    frame = documents(*texts, texts[-1]).withColumn("kept", F.lit("mine")).withColumn("Probability", F.lit("mine"))
    rows = score_quality(frame, None).orderBy("doc_id").collect()
    for row, text in zip(rows, [*texts, texts[-1]], strict=True):
        assert tuple(row[c] for c in COUNTS) == plain(text) and row["probability"] == 1.0
    assert score_quality(documents(), None).collect() == []


def test_nothing_to_learn_from(documents, spark):
    schema = "doc_id long, quality int, toxic int"
    docs = documents("good text", "bad text", None)
    for rows in ([], [(0, 1, 0)], [(0, None, 0), (None, 0, 0), (1, 1, 1)]):
        assert fit_quality(docs, spark.createDataFrame(rows, schema)) is None
    # labels without documents, and of two that disagree the worse
    assert fit_quality(docs, spark.createDataFrame([(8, 1, 0), (9, 0, 0)], schema)) is None
    assert fit_quality(docs, spark.createDataFrame([(0, 1, 0), (0, 0, 0)], schema)) is None
    model = fit_quality(docs, spark.createDataFrame([(0, 1, 0), (1, 0, 0)] * 2, schema))
    good, bad = (r["probability"] for r in score_quality(docs.limit(2), model).orderBy("doc_id").collect())
    assert good > bad


@pytest.mark.parametrize("bits", [8, 17])
def test_scores_are_sums_of_weights(documents, bits):
    options = QualityOptions(bits=bits)
    for family in range(3):
        weights = np.zeros((3 << bits) + 1, np.int64)
        weights[family << bits : family + 1 << bits] = 1 << 24
        row = score_quality(documents("four words are here"), (weights, 1.0, 0.0), options=options).first()
        assert row["probability"] == pytest.approx(1 / (1 + np.exp(-1)))


def plain_features(text, options=QualityOptions()):
    """The features' numbers of each family, word by word and character by character."""
    number = lambda h: int(mix(np.array([h % 2**64], np.uint64))[0]) >> 64 - options.bits

    def digest(part):
        roll = RollingHash()
        roll.load(np.frombuffer(part, np.uint8))
        return int(roll.span(np.array([0]), np.array([len(part)]))[0])

    words = [digest(w.encode()) for w in re.findall("[^\x20\x09-\x0d]+", text)]
    grams = [digest(text[i : i + options.gram_chars].encode()) for i in range(len(text) - options.gram_chars + 1)]
    pairs = [a * 0x9E3779B97F4A7C15 + b for a, b in zip(words, words[1:], strict=False)]
    return [[*map(number, words)], [*map(number, pairs)], [number(g + 1) for g in grams]]


def test_fitted_weights_score_as_a_plain_sum(spark, documents):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    weights, slope, shift = fit_quality(docs, labels)
    texts = ["", "a", "a b", "héé 世界 世界 ok", "one  two\tthree\none two"] + [r["text"] for r in docs.filter("text is not null").orderBy("doc_id").limit(25).collect()]
    size = len(weights) // 3
    for text, row in zip(texts, score_quality(documents(*texts), (weights, slope, shift)).orderBy("doc_id").collect(), strict=True):
        score = weights[-1] + sum(sum(int(weights[i * size + n]) for n in part) / max(len(part), 1) for i, part in enumerate(plain_features(text)))
        assert row["probability"] == pytest.approx(1 / (1 + np.exp(-slope * score / 2**24 - shift)), abs=1e-9)


def test_the_sample_is_bounded_in_bytes(spark, documents):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    docs = documents(*[(f"good text {i} " if i % 2 else f"bad stuff {i} ") * 15 for i in range(60)])
    long = documents((1000, "bad stuff " * 400_000, "en", "s"), (1001, "bad stuff " * 400_000, "en", "s"))
    more = labels.union(spark.createDataFrame([(1000, 1, 0), (1001, 1, 0)], labels.schema))
    options = QualityOptions(sample_bytes=64_000)
    model, with_long = fit_quality(docs, labels, options=options), fit_quality(docs.union(long), more, options=options)
    assert (model[0] == with_long[0]).all()  # texts beyond the bound teach nothing
    few = fit_quality(docs, labels, options=QualityOptions(sample_bytes=3_200))
    assert few is not None and (few[0] != model[0]).any()
    good, bad = (r["probability"] for r in score_quality(documents("good text " * 20, "bad stuff " * 20), few).orderBy("doc_id").collect())
    assert good > bad
