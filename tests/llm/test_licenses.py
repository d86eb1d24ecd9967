import random
import re

import pytest
from pyspark.sql import functions as F

from tablepact.llm.licenses import BASE_PHRASES, NOTICES, License, level, parse_expression, scan_licenses
from tests.llm.conftest import ODD


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def plain(text):
    """(n_words, n_base, first, last, base labels, labels without tags), phrase by phrase."""
    words, places, base, labels = words_of(text), [], set(), set()
    for phrases, is_base in ((BASE_PHRASES, True), (NOTICES, False)):
        for phrase, label in phrases.items():
            parts = phrase.split()
            for i in range(len(words)):
                if words[i : i + len(parts)] == parts:
                    labels.add(label)
                    if is_base:
                        base.add(label)
                        places.append(i)
    ends = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels))


def test_matches_plain_scan(documents):
    rng = random.Random(4)
    parts = [*BASE_PHRASES, *NOTICES, "the", "CC", "by", "license", "all rights", "cc-by", "Public Domain", "é", "gnu", "x9"]
    texts = [rng.choice([" ", ", ", "\n", "-"]).join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(200)]
    texts += ["cc by cc by", "CC-BY-NC", "ccc by", "cc bye", "cc by", "All rights reserved. all RIGHTS reserved"]
    rows = scan_licenses(documents(*texts)).orderBy("doc_id").collect()
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    assert [tuple(r[n] for n in names) for r in rows] == [plain(t) for t in texts]


def test_query_matches_plain_scan(spark):
    from tablepact.llm.licenses import op2_licenses

    sf = "/root/testdata/sf0.01"
    rows = op2_licenses(spark, sf).orderBy("doc_id").collect()
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    assert [tuple(r)[1:7] for r in rows] == [plain(t) for t in texts]


@pytest.mark.parametrize(
    "text, labels, strict",
    [
        ("MIT", {"mit"}, 1),
        ("mit OR gpl-3.0-only", {"mit", "gpl-3.0-only"}, 1),
        ("MIT and GPL-2.0", {"mit", "gpl-2.0"}, 3),
        ("mit or apache-2.0 and gpl-2.0", {"mit", "apache-2.0", "gpl-2.0"}, 1),
        ("(mit or apache-2.0) and gpl-2.0", {"mit", "apache-2.0", "gpl-2.0"}, 3),
        ("gpl-2.0 with classpath-exception-2.0", {"gpl-2.0-with-classpath-exception-2.0"}, 2),
        ("gpl-2.0 with a and mit", {"gpl-2.0-with-a", "mit"}, 2),
        ("licenseref-mine", {"licenseref-mine"}, 4),
        ("((mit))", {"mit"}, 1),
        ("mit with (a)", {"mit-with-a"}, 1),
    ],
)
def test_expressions(text, labels, strict):
    assert parse_expression(text) == License(frozenset(labels), strict)


@pytest.mark.parametrize("text", ["", "and", "mit and", "or mit", "mit gpl-2.0", "(mit", "mit)", "()", "(mit or) gpl", "(a or b) with c", "mit & gpl", "a with b with c"])
def test_malformed_expressions(text):
    assert parse_expression(text) is None


def test_expressions_agree_with_python():
    """and is the stricter, or the milder, and binds closer: as max, min and Python's own rules."""
    rng = random.Random(8)
    values = {"mit": 1, "mpl-2.0": 2, "gpl-3.0": 3, "cc-by-nc-4.0": 4}

    class Level(int):
        __add__ = lambda a, b: Level(min(a, b))
        __mul__ = lambda a, b: Level(max(a, b))

    def build(depth):
        if depth == 0:
            return rng.choice(list(values))
        text = f"{build(depth - 1)} {rng.choice(['and', 'or'])} {build(rng.randrange(depth))}"
        return f"({text})" if rng.random() < 0.5 else text

    for _ in range(200):
        text = build(rng.randint(0, 4))
        code = re.sub(r"[a-z][a-z0-9.-]+", lambda m: {"and": "*", "or": "+"}.get(m[0]) or f"Level({values[m[0]]})", text)
        assert parse_expression(text).level == eval(code, {"Level": Level})


def test_tags(documents):
    texts = [
        "// SPDX-License-Identifier: MIT OR (Apache-2.0 AND BSD-3-Clause)\nint x;",
        "/* SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note */",
        "# spdx-license-identifier: mit and\n# SPDX-License-Identifier: ISC",
        "spdx license identifier without a colon",
        "SPDX-License-Identifier:",
    ]
    rows = scan_licenses(documents(*texts)).orderBy("doc_id").collect()
    assert [r["labels"] for r in rows] == ["apache-2.0,bsd-3-clause,mit", "gpl-2.0-with-linux-syscall-note", "invalid-expression,isc", "", "invalid-expression"]
    assert [r["score"] for r in rows] == [0.25, 0.5, 1.0, 0.0, 1.0]
    assert rows[0]["expressions"] == ["mit or (apache-2.0 and bsd-3-clause)"]


def test_levels():
    assert [level(x) for x in ("cc-by", "cc-by-4.0", "cc-by-nc-4.0", "lgpl-2.1", "gpl", "gplx", "")] == [1, 1, 4, 2, 3, 4, 4]


def test_odd_rows(documents):
    rows = [*((i, t) for i, t in enumerate(ODD)), (50, "mit license"), (50, "mit license"), (None, None), (60, "all rights reserved " * 100_000)]
    frame = documents(*rows).withColumn("labels", F.lit("mine")).withColumn("N_WORDS", F.lit("mine"))
    got = scan_licenses(frame).collect()
    assert len(got) == len(rows)
    assert [r["labels"] for r in got if r["doc_id"] == 50] == ["mit", "mit"]
    assert [(r["n_base"], r["last_word"]) for r in got if r["doc_id"] == 60] == [(100_000, 299_997)]
    assert all((r["n_words"], r["score"], r["first_word"]) == (0, 0.0, None) for r in got if not (r["text"] or "").strip())
    assert scan_licenses(documents()).collect() == []


@pytest.mark.parametrize(
    "text, labels",
    [
        ("SPDX-License-Identifier: MIT and more prose", "mit"),
        ("/* SPDX-License-Identifier: MIT */ int x;", "mit"),
        ("<!-- SPDX-License-Identifier: MIT --> <html>", "mit"),
        ("SPDX-License-Identifier : MIT", "mit"),
        ("SPDX License Identifier: GPL-2.0 WITH Linux-syscall-note, see the file.", "gpl-2.0-with-linux-syscall-note"),
        ("# SPDX-License-Identifier: (MIT OR Apache-2.0) and so on", "apache-2.0,mit"),
        ("SPDX-License-Identifier: MIT. All is well", "mit"),
        ("SPDX-License-Identifier: ISC OR strange-1.0 then", "isc"),
        ("SPDX-License-Identifier: strange-1.0 then", "strange-1.0"),
        ("SPDX-License-Identifier: MIT OR", "invalid-expression"),
        ("SPDX-License-Identifier: MIT OR something else", "mit"),
        ("SPDX-License-Identifier: ((MIT", "invalid-expression"),
        ("SPDX-License-Identifier:", "invalid-expression"),
        ("SPDX-License-Identifier: " + "mit and " * 20_000 + "mit plus", "mit"),
        ("xSPDX-License-Identifier: MIT", ""),
    ],
)
def test_tags_within_a_line(documents, text, labels):
    assert [r["labels"] for r in scan_licenses(documents(text)).collect()] == [labels]
