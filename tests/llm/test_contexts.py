import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tablepact.llm import contexts
from tablepact.llm.contexts import DEPTH, log_gamma, op3_context_tree, score_texts
from tests.llm.conftest import ODD


def lowered(text):
    return (text or "").encode().lower()


def tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", lowered(text)), None]


def decisions(text):
    raw = b"\xff" * DEPTH + lowered(text) + b"\xff"
    for i in range(DEPTH, len(raw)):
        node = 1
        for k in range(7, -1, -1):
            bit = raw[i] >> k & 1
            yield raw[i - DEPTH : i], node, bit
            node = node * 2 + bit


def plain(texts, learn):
    """(n_tokens, n_known, train_tokens, base_score, score) of each text, node by node."""
    words = Counter(w for t, on in zip(texts, learn, strict=True) if on for w in tokens(t))
    total, distinct = sum(words.values()), len(words)
    count = defaultdict(lambda: [0, 0])
    for text, on in zip(texts, learn, strict=True):
        for context, node, bit in decisions(text) if on else ():
            for d in range(DEPTH + 1):
                count[context[DEPTH - d :], node][bit] += 1
    below, weighted, stop = defaultdict(float), {}, {}
    for context, node in sorted(count, key=lambda k: -len(k[0])):
        a, b = count[context, node]
        own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
        if len(context) < DEPTH:
            rest = below[context, node]
            top = max(own, rest)
            both = top + math.log(math.exp(own - top) + math.exp(rest - top)) - math.log(2)
            stop[context, node], own = math.exp(own - math.log(2) - both), both
        if context:
            below[context[1:], node] += own
    out = []
    for text in texts:
        score = 0.0
        for context, node, bit in decisions(text):
            chance = None
            for d in range(DEPTH, -1, -1):
                key = context[DEPTH - d :], node
                seen = count.get(key, (0, 0))
                own = (seen[bit] + 0.5) / (sum(seen) + 1)
                part = stop.get(key, 0.5)
                chance = own if chance is None else part * own + (1 - part) * chance
            score += math.log10(chance)
        own = tokens(text)
        base = sum(math.log10((words[w] + 1) / (total + distinct + 1)) for w in own)
        out.append((len(own), sum(words[w] > 0 for w in own), total, base, score))
    return out


def check(rows, expected):
    for row, (n, known, total, base, score) in zip(rows, expected, strict=True):
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (n, known, total)
        assert row["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert row["score"] == pytest.approx(score, rel=1e-6, abs=1e-6)


def test_query_matches_plain_tree(spark, tiny):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("n_chars < 900").limit(40)
    rows = docs.orderBy("doc_id").collect()
    sf = tiny(docs)
    learn = [zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2 for r in rows]
    got = op3_context_tree(spark, sf).orderBy("doc_id").collect()
    assert [r["held_out"] for r in got] == [not x for x in learn]
    check(got, plain([r["text"] for r in rows], learn))


def test_odd_rows_in_many_pieces(documents, monkeypatch):
    monkeypatch.setattr(contexts, "PIECE", 50)
    monkeypatch.setattr(contexts, "BLOCK_BYTES", 300)
    texts = [*ODD, "A long Text  of words " * 30, "unbroken" * 40, "a long text of words", "Ünïcode ünïcode"]
    frame = documents(*texts, texts[-2]).withColumn("learn", F.col("doc_id") % 3 != 0).withColumn("score", F.lit("mine"))
    got = score_texts(frame, "learn").orderBy("doc_id").collect()
    check(got, plain([*texts, texts[-2]], [i % 3 != 0 for i in range(len(texts) + 1)]))
    assert [r["bits_per_byte"] is None for r in got[:2]] == [True, True]


def test_repeats_longer_than_four_bytes_count(documents):
    # the last digit follows from the one five before it, and from none nearer
    texts = [f"{k}abcd{k} " for k in "0123456789"] * 20
    rows = score_texts(documents(*texts).withColumn("learn", F.col("doc_id") < 190), "learn").collect()
    check(sorted(rows, key=lambda r: r["doc_id"]), plain(texts, [i < 190 for i in range(200)]))
    assert max(r["bits_per_byte"] for r in rows if not r["learn"]) < 0.6  # 0.88 with four bytes


def test_words_that_collide_modulo_a_power_of_two(documents):
    # Thue-Morse words and their complements have the same polynomial hash modulo 2**64
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [word, word.translate(str.maketrans("ab", "ba"))]
    rows = score_texts(documents(*texts).withColumn("learn", F.col("doc_id") == 0), "learn").orderBy("doc_id").collect()
    check(rows, plain(texts, [True, False]))
    assert [r["n_known"] for r in rows] == [2, 1]


def test_lists_keep_strings():
    import numpy as np

    code = np.sort(np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000, np.int64))
    group, (codes, n) = contexts._dealt(contexts._group(code, 7), code, np.arange(5000))
    assert len(group) == 7 and np.array_equal(np.sort(contexts.unsqueeze(codes, np.int64, True)), code)
    assert np.array_equal(code[contexts.unsqueeze(n, np.int64)], contexts.unsqueeze(codes, np.int64, True))


def test_nothing_to_learn_from(documents):
    rows = score_texts(documents((None, "ab", "en", "s"), (None, "ab", "en", "s")).withColumn("learn", F.lit(None).cast("boolean")), "learn").collect()
    assert len(rows) == 2
    check(rows, [(2, 0, 0, 0.0, 24 * math.log10(0.5))] * 2)


def test_no_rows(documents):
    assert score_texts(documents().withColumn("learn", F.lit(True)), "learn").collect() == []


def test_log_gamma():
    import numpy as np

    x = np.array([0.5, 1, 2.5, 7.9, 8, 100.5, 1e6])
    assert np.allclose(log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-11)
