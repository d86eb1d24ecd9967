"""SentencePiece encoding by backtracking, against the library and against plain merging."""

import hashlib
import random

import public_tokenizers
import pytest

from tablepact.llm.bpe import PieceModel, decode, encode, op11_pieces
from tests.llm.conftest import ODD

sentencepiece = pytest.importorskip("sentencepiece")
TEXTS = [
    *[t for t in ODD if t is not None], " ", " lead", "a  b", "trail ", "▁a▁▁b", "<s>hi</s><0x41><unk>", "🤯퟿", "﻿a",
    " " * 1000, "  a" * 50, "\n" * 40, "\t" * 33, "日本語のテキスト" * 40, "é́ﬃ①　", " ⁇ ", "x" * 5000, "abc" * 3000,
]


@pytest.fixture(scope="module")
def proto():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(proto):
    return sentencepiece.SentencePieceProcessor(model_proto=proto)


def test_encodes_as_the_library(proto, library):
    rng, coder = random.Random(1), PieceModel(proto)
    mixed = " ▁abcdetinhr\n.0é日🤯"
    texts = TEXTS + ["".join(rng.choice(mixed) for _ in range(rng.randrange(40))) for _ in range(1000)]
    texts += ["".join(rng.choice(coder.pieces) for _ in range(rng.randrange(12))) for _ in range(500)]
    for text in texts:
        assert coder.encode(text) == library.encode(text), text


def test_units_end_at_marks_and_line_ends(proto, library):
    """Words are remembered alone, not with the mark and the line that follow."""
    coder = PieceModel(proto)
    assert coder.unit.findall("▁one.\n\nTwo.***▁3.\t") == ["▁one", ".", "\n\n", "Two", ".***", "▁3", ".", "\t"]
    rng = random.Random(5)
    marks = [*"\n\t.!?*|%&$'\"-,", "²", "’", " ", "é", "1", "word", "\x7f", "\r\n"]
    for _ in range(3000):
        text = "".join(rng.choice(marks) for _ in range(rng.randrange(20)))
        assert "".join(coder.unit.findall(coder.library.normalize(text))) == coder.library.normalize(text)
        assert coder.encode(text) == library.encode(text), text


def test_backtracking_gives_what_plain_merging_gives(proto):
    rng, coder = random.Random(2), PieceModel(proto)
    for _ in range(500):
        text = "".join(rng.choice("▁▁abcdeinort") for _ in range(rng.randrange(1, 30)))
        assert coder.split(text) == coder.merge(text)


def test_a_failed_place_is_taken_back(proto):
    coder, pops = PieceModel(proto), []
    shorter = coder.shortened
    coder.shortened = lambda piece: pops.append(piece) or shorter(piece)
    for text in ("▁unhappinesses", "▁internationalisations", "▁thereinafterward"):
        assert coder.split(text) == coder.merge(text)
    assert pops


def test_the_border_decides_what_stays_apart(proto):
    rng, coder = random.Random(4), PieceModel(proto)
    pieces = [p for p in coder.ids if len(p) > 1]
    blanks = [p for p in coder.ids if set(p) == {"▁"}]
    pairs = [(rng.choice(pieces), rng.choice(pieces)) for _ in range(5000)]
    pairs += [(p[:i], p[i:]) for p in rng.sample(pieces, 2000) for i in range(1, len(p)) if {p[:i], p[i:]} <= set(coder.ids)]
    pairs += [(rng.choice(blanks), rng.choice(blanks + pieces)) for _ in range(500)] + [(p, p) for p in pieces[:1000]]
    for left, right in pairs:
        assert coder.stay_apart(left, right) == (coder.merge(left + right) == [left, right]), (left, right)


def test_decodes_any_ids_as_the_library(proto, library):
    rng, coder = random.Random(3), PieceModel(proto)
    for _ in range(3000):
        ids = [rng.choice((rng.randrange(32000), rng.randrange(300), 28705)) for _ in range(rng.randrange(8))]
        assert coder.decode(ids) == library.decode(ids), ids


def test_forgetting_changes_nothing(proto, library, monkeypatch):
    import tablepact.llm.bpe as module

    monkeypatch.setattr(module, "REMEMBERED", 3)
    coder = PieceModel(proto)
    text = "one two three four five six seven, one two three four"
    assert coder.encode(text) == library.encode(text)


def test_frames(spark, documents, proto, library):
    rows = [None, *TEXTS, *TEXTS[:3], "very long " * 50_000]
    docs = documents(*rows).withColumnRenamed("n_chars", "IDS")
    coded = decode(encode(docs, proto), proto)
    assert coded.columns == ["doc_id", "text", "lang", "source", "ids", "decoded"]
    for row in coded.collect():
        ids = library.encode(row.text or "")
        assert (row.ids, row.decoded) == (ids, library.decode(ids))
    assert coded.count() == len(rows)
    assert encode(docs.limit(0), proto).collect() == []


def test_ids_outside_of_the_model_are_an_error(spark, proto):
    with pytest.raises(Exception, match="outside of the model"):
        decode(spark.createDataFrame([([40_000],)], "ids array<int>"), proto).collect()


def test_null_arrays_are_empty_texts(spark, proto):
    frame = spark.createDataFrame([(None,), ([],), ([0],), ([3, 230, 131],)], "ids array<int>")
    assert [r.decoded for r in decode(frame, proto).collect()] == ["", "", " ⁇ ", "\x00��"]


def test_query(spark, documents, tiny, library):
    frame = documents(None, *TEXTS).withColumnRenamed("n_chars", "ids_sha256")
    got = {r.doc_id: r for r in op11_pieces(spark, tiny(frame)).collect()}

    def digest(x):
        return hashlib.sha256(x.encode()).hexdigest()

    for i, text in enumerate([None, *TEXTS]):
        ids = library.encode(text or "")
        row = got[i]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == digest(",".join(map(str, ids)))
        assert row.decoded_sha256 == digest(library.decode(ids))
