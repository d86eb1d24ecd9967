"""License scan: notices by Aho-Corasick, tag expressions by shunting-yard."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tablepact.llm.batches import WORD_BYTES, append_columns, text_bytes

# fixed values: phrases every scan looks for, and their labels
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# fixed values: further notices, as words, and their labels
NOTICES = {
    "apache license": "apache",
    "mit license": "mit",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "cc0": "cc0",
    "public domain": "public-domain",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
}
TAG = "spdx license identifier"
# fixed values: how much labels and identifiers restrict use, matched by their start;
# 1 attribution at most, 2 changes are shared, 3 works are shared, 4 use is barred
LEVELS = {
    "cc0": 1, "public-domain": 1, "unlicense": 1, "mit": 1, "isc": 1, "bsd": 1, "apache": 1, "zlib": 1, "cc-by": 1,
    "mpl": 2, "lgpl": 2, "epl": 2, "cc-by-sa": 2,
    "gpl": 3, "agpl": 3,
    "cc-by-nc": 4, "cc-by-nd": 4, "reserved": 4,
}
STRICTEST = 4
INVALID = "invalid-expression"


def level(label: str) -> int:
    """How much a label restricts use; one that isn't known counts as barred."""
    known = [k for k in LEVELS if label == k or label.startswith(k + "-")]
    return LEVELS[max(known, key=len)] if known else STRICTEST


@dataclass(frozen=True)
class License:
    """Value of an expression: the labels named, and how much it restricts."""

    labels: frozenset[str]
    level: int


_TOKEN = re.compile(r"[()]|[a-z0-9.:+-]+")
_ORDER = {"or": 1, "and": 2, "with": 3}


def parse_expression(text: str) -> License | None:
    """Evaluates a licence expression; None if it is malformed.

    ``and`` binds the strictest of its sides, ``or`` lets the mildest be chosen, and
    ``with`` an exception makes sharing of works one of changes. Case is ignored, and
    brackets around a single name mean nothing.
    """
    output: list[License | str] = []
    operators: list[str] = []
    operand = True  # whether one is due

    def apply() -> bool:
        operator = operators.pop()
        if operator == "(" or len(output) < 2:
            return False
        right, left = output.pop(), output.pop()
        if operator == "with":
            if not (isinstance(right, str) and isinstance(left, str)):
                return False
            eased = 2 if level(left) == 3 else level(left)
            output.append(License(frozenset({f"{left}-with-{right}"}), eased))
            return True
        left, right = map(_value, (left, right))
        chosen = max if operator == "and" else min
        output.append(License(left.labels | right.labels, chosen(left.level, right.level)))
        return True

    if _TOKEN.sub("", text.lower()).strip():
        return None
    for token in _TOKEN.findall(text.lower()):
        if token in _ORDER:
            if operand:
                return None
            while operators and operators[-1] != "(" and _ORDER[operators[-1]] >= _ORDER[token]:
                if not apply():
                    return None
            operators.append(token)
            operand = True
        elif token == "(":
            if not operand:
                return None
            operators.append(token)
        elif token == ")":
            if operand:
                return None
            while operators and operators[-1] != "(":
                if not apply():
                    return None
            if not operators:
                return None
            operators.pop()
        else:
            if not operand:
                return None
            output.append(token)
            operand = False
    while operators:
        if not apply():
            return None
    return _value(output[0]) if len(output) == 1 and not operand else None


def _value(x: License | str) -> License:
    return License(frozenset({x}), level(x)) if isinstance(x, str) else x


def leading_expression(text: str) -> tuple[str, License | None]:
    """The expression that a line begins with, and its value; None if there is none.

    It is the whole line if that is one, without marks that close a comment or a string.
    Else it is the longest part from the start that is one and names known licences only
    (exceptions after ``with`` aside), else the longest that is one at all; a line of
    nothing but known names and operators is malformed as a whole. Operands and
    operators alternate, so a part ends where they don't, however long the line.
    """
    line = _CLOSING.sub("", text.strip())
    whole = parse_expression(line)
    if whole:
        return line, whole
    ends, unknown, due, before = [], None, True, ""
    for found in _TOKEN.finditer(line.lower()):
        token = found[0]
        if line[ends[-1] if ends else 0 : found.start()].strip() or token in (*_ORDER, ")") and due or token not in (*_ORDER, ")") and not due:
            break
        if token not in _ORDER and token not in "()":
            token = token.rstrip(".:")  # a sentence's, not the name's
            if not any(token == k or token.startswith(k + "-") for k in LEVELS) and before != "with" and unknown is None:
                unknown = len(ends)
        ends.append(found.start() + len(token))
        due = token in _ORDER or token == "("
        before = token
    else:
        if unknown is None:  # licences and operators to the end, only not in order
            return line, None
    for tries in (ends if unknown is None else ends[:unknown], ends):
        for end in reversed(tries[-_BACK:]):
            value = parse_expression(line[:end])
            if value:
                return line[:end], value
    return line, None


#: The tag's words with any marks between them, a colon, and the rest of the line.
_MARK = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_TAGGED = re.compile(
    rb"(?:(?<=" + _MARK + rb")|^)" + (_MARK + rb"+").join(w.encode() for w in TAG.split())
    + rb"(?![^\x00-\x2F\x3A-\x60\x7B-\x7F])[ \t]*:[ \t]*([^\r\n]*)"
)
_CLOSING = re.compile(r"(?:[ \t]|\*/|-->|[\"'#;,.])+$")
#: Ends tried from the last back; operators and brackets that stay open are fewer.
_BACK = 64


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    base: Mapping[str, str] = BASE_PHRASES,
    notices: Mapping[str, str] = NOTICES,
) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels, score, expressions.

    A phrase is found where its words stand consecutively; words are runs of ASCII
    letters (lowered), digits and characters beyond ASCII. n_base counts all places
    of ``base`` phrases, first_word and last_word are the least and largest of their
    first words (null if none). ``labels`` adds those of ``notices`` and of the
    expressions after tags; both lists are distinct, sorted and comma-joined, empty
    if nothing is found. ``expressions`` has the expression after each tag, or the rest
    of the line if it begins with none. ``score`` says how
    much the strictest evidence restricts: 0 without evidence, to 1. Null and empty
    texts have no words; very long ones are scanned whole; repeated rows get equal
    results, and so do ties of phrases at one place. An empty table gives an empty one.
    Input columns with the new names, in any case, are replaced.
    """
    fields = StructType.fromDDL(
        "n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, expressions array<string>"
    ).fields
    phrases = {p: (label, True) for p, label in base.items()}
    # a phrase may be of both kinds; the base one stays
    phrases = {p: (label, False) for p, label in notices.items()} | phrases

    def make():
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for phrase, (label, is_base) in phrases.items():
            padded = b" " + phrase.encode() + b" "
            automaton.add_word(padded.decode("latin-1"), (len(padded), label, is_base))
        automaton.add_word(f" {TAG} ", (len(TAG) + 2, None, False))
        automaton.make_automaton()

        def one(raw: bytes) -> tuple:
            words = raw.translate(WORD_BYTES).split()
            joined = b" " + b" ".join(words) + b" "
            places, base_labels, labels, tagged = [], set(), set(), False
            for end, (size, label, is_base) in automaton.iter(joined.decode("latin-1")):
                if label is None:
                    tagged = True
                    continue
                labels.add(label)
                if is_base:
                    base_labels.add(label)
                    places.append(end - size + 1)
            first = joined.count(b" ", 0, min(places)) if places else None
            last = joined.count(b" ", 0, max(places)) if places else None
            strictest = max(map(level, labels), default=0)
            lines = _TAGGED.findall(raw.lower()) if tagged else []
            values = [leading_expression(x.decode(errors="replace")) for x in lines]
            expressions = [e for e, _ in values]
            for _, value in values:
                labels |= value.labels if value else {INVALID}
                strictest = max(strictest, value.level if value else STRICTEST)
            both = (",".join(sorted(x)) for x in (base_labels, labels))
            return len(words), len(places), first, last, *both, strictest / STRICTEST, expressions

        def work(batch: pa.RecordBatch) -> list[list]:
            return [list(c) for c in zip(*map(one, text_bytes(batch, text)), strict=True)] or [[] for _ in fields]

        return work

    return append_columns(docs, text, fields, make)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices and tags of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_licenses(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )
