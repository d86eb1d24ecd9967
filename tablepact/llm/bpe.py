"""SentencePiece BPE encoding by backtracking, and decoding.

Merging the best pair again and again looks at a text many times. Here a text is walked
once from left to right instead:

- Aho-Corasick over the reversed text finds the longest piece that starts at each place.
- A piece may stand after another only if merging the two pieces' characters anew gives
  just these two; pieces that would have grown together never stand side by side in an
  encoding. A sequence of pieces is the encoding of a text if and only if each pair of
  neighbours passes, as merges inside two neighbours don't depend on what is outside.
- From each place the longest piece is tried, then the shorter ones that it begins with.
  If none passes, no encoding goes through that place: its bit is set, and the piece
  that led there is taken back. Each place fails once at most.

Texts are cut where no piece of the model can reach across (before a blank after another
character), and the encodings of short units are remembered.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections.abc import Iterator
from functools import cached_property
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tablepact.llm.batches import append_columns, without

#: The character that stands for a blank in pieces (fixed by the format).
BLANK = "▁"
#: Longer units are encoded anew each time; so many pairs, and of units up to twice as many, are remembered.
UNIT, REMEMBERED = 64, 1 << 18
NONE: dict[str, bool] = {}
UNREACHED = ("", "", False)


class PieceModel:
    """A BPE model of normal, byte, control and unknown pieces.

    ``proto`` holds the bytes of a .model file, which may have any normaliser that the
    library knows. Pieces with a blank inside, after another character, are allowed, but
    then texts are encoded as one unit.
    """

    def __init__(self, proto: bytes):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=proto)
        every = list(range(self.library.get_piece_size()))
        self.pieces = self.library.id_to_piece(every)
        kinds = (self.library.is_control, self.library.is_unknown, self.library.is_byte, self.library.is_unused)
        control, unknown, byte, unused = ({i for i, x in enumerate(f(every)) if x} for f in kinds)
        if unused:
            raise ValueError("models with unused pieces aren't supported")
        self.control, self.unknown = control, self.library.unk_id()
        special = control | unknown | byte
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        if BLANK not in self.ids:
            raise ValueError("the model has no piece for a blank")
        self.score = dict(zip(self.pieces, self.library.get_score(every), strict=True))
        #: The id of each byte's piece, and back; empty without byte fallback.
        self.of_byte = {int(self.pieces[i][1:-1], 16): i for i in byte}
        self.byte_of = {i: b for b, i in self.of_byte.items()}
        self.unit = re.compile(self._unit())
        self.units: dict[str, bytes] = {}
        self.older = self.units
        self.beside: dict[str, dict[str, bool]] = {}
        self.checked = 0
        self.shorter: dict[str, str] = {}
        self.parts: dict[str, tuple[str, str, bool]] = {}

    @cached_property
    def found(self):
        """Finds the pieces that end at each place of a reversed text."""
        import ahocorasick

        pieces = ahocorasick.Automaton()
        for p in self.ids:
            pieces.add_word(p[::-1], len(p))
        pieces.make_automaton()
        return pieces

    def _unit(self) -> str:
        """A pattern of units: texts are cut between characters that stand side by side in no piece.

        Only cuts before a blank, before ASCII marks that follow a letter in no piece, and
        around ASCII control characters that no longer piece holds are made.
        """
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            return "(?s).+"
        beside = {(a, b) for p in self.ids for a, b in zip(p, p[1:])}
        marks = set(punctuation) - {b for a, b in beside if a.isalpha()}
        before = {a for a, b in beside if b in marks}
        # neighbours that are unknown would be one id, so these are cut only where none is
        alone = {chr(c) for c in (*range(32), 127)} - {c for pair in beside for c in pair} if self.of_byte else set()
        marks, before, alone = ("".join(map(re.escape, sorted(x))) for x in (marks, before, alone))
        stays = f"|(?<=[{before}])[{marks}]" if marks and before else ""
        more = f"(?:[^{BLANK}{marks}{alone}]+{stays})*"
        return f"{BLANK}+{more}|[^{BLANK}{alone}]{more}" + (f"|[{alone}]+" if alone else "")

    def merge(self, text: str, least: int = 1) -> list[str]:
        """The encoding of a short text as the format defines it: the best-scored pair merges first, the left one of equals.

        Merging ends early once ``least`` parts are left.
        """
        parts = list(text)
        while len(parts) > least:
            pairs = [(-self.score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ids]
            if not pairs:
                break
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def check(self, left: str, piece: str) -> bool:
        """Whether a piece may stand after ``left``, or at the start if that is empty; remembered."""
        if self.checked >= REMEMBERED:
            self.beside.clear()
            self.checked = 0
        self.checked += 1
        passed = self.stay_apart(left, piece) if left else self.halves(piece) is not UNREACHED
        self.beside.setdefault(left, {})[piece] = passed
        return passed

    def halves(self, piece: str) -> tuple[str, str, bool]:
        """The two parts that a piece is merged from last, and whether all merges in it come in the order of scores.

        ``UNREACHED`` if merging the piece's characters doesn't give it.
        """
        got = self.parts.get(piece)
        if got is None:
            got = "", "", True
            if len(piece) > 1:
                last = self.merge(piece, 2)
                got = UNREACHED
                if len(last) == 2 and self.merge(piece) == [piece]:
                    ordered = all(len(x) == 1 or self.score[x] > self.score[piece] and self.halves(x)[2] for x in last)
                    got = last[0], last[1], ordered
            self.parts[piece] = got
        return got

    def stay_apart(self, left: str, piece: str) -> bool:
        """Whether merging the characters of two pieces gives these two again.

        Only what meets at their border matters. Going back in time, the part merged later
        is taken apart; two parts that lay side by side would have merged if their joint
        score beat that of the merge that each of them went into.
        """
        halves, score = self.halves, self.score
        a, b = halves(left), halves(piece)
        if a is UNREACHED or b is UNREACHED:
            return False
        if not (a[2] and b[2]):
            return self.merge(left + piece) == [left, piece]
        x, y, after_x, after_y = left, piece, None, None
        while True:
            joint = x + y
            if joint in self.ids:
                s = score[joint]  # of equals, the merge further left comes first
                if (after_x is None or s > after_x) and (after_y is None or s >= after_y):
                    return False
            if len(y) > 1 and (len(x) == 1 or score[y] <= score[x]):
                after_y, y = score[y], halves(y)[0]
            elif len(x) > 1:
                after_x, x = score[x], halves(x)[1]
            else:
                return True

    def shortened(self, piece: str) -> str:
        """The longest shorter piece that ``piece`` begins with, or ''."""
        got = self.shorter.get(piece)
        if got is None:
            got = next((piece[:k] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.ids), "")
            self.shorter[piece] = got
        return got

    def split(self, text: str) -> list[str]:
        """The pieces of a normalised unit; a character that is no piece stands alone."""
        n = len(text)
        if n <= UNIT:  # of matches that end at one place, the longest comes first
            longest = dict([*self.found.iter(text[::-1])][::-1]).get
        else:
            lengths = array("i", [1]) * n
            for end, length in self.found.iter(text[::-1]):
                if length > lengths[end]:
                    lengths[end] = length

            def longest(end: int, _: int) -> int:
                return lengths[end]

        beside = self.beside
        failed = None
        chosen: list[str] = []
        at, left, piece = 0, "", text[: longest(n - 1, 1)]
        known = beside.get(left, NONE)
        while True:
            while piece:
                passed = known.get(piece)
                if passed is None:
                    passed = self.check(left, piece)
                if passed:
                    to = at + len(piece)
                    if failed is None or not failed[to >> 3] >> (to & 7) & 1:
                        break
                piece = self.shortened(piece)
            if piece:
                chosen.append(piece)
                if to == n:
                    return chosen
                at, left = to, piece
                piece = text[at : at + longest(n - 1 - at, 1)]
            else:
                failed = failed or bytearray((n >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                back = chosen.pop()
                at -= len(back)
                left, piece = chosen[-1] if chosen else "", self.shortened(back)
            known = beside.get(left, NONE)

    def encode_unit(self, unit: str) -> list[int]:
        pieces, ids = self.split(unit), self.ids
        try:
            return [ids[p] for p in pieces]
        except KeyError:
            pass
        out: list[int] = []
        for piece in pieces:
            if piece in ids:
                out.append(ids[piece])
            elif self.of_byte:
                out += [self.of_byte[b] for b in piece.encode()]
            elif out[-1:] != [self.unknown]:
                out.append(self.unknown)
        return out

    def encoded(self, text: str) -> np.ndarray:
        """The ids of a text."""
        units, out = self.units, []
        for unit in self.unit.findall(self.library.normalize(text)):
            got = units.get(unit)
            if got is None:
                got = self.older.get(unit)
                if got is None:
                    got = array("i", self.encode_unit(unit)).tobytes()
                if len(unit) <= UNIT:
                    if len(units) >= REMEMBERED:  # units met lately stay
                        self.older, self.units = units, {}
                        units = self.units
                    units[unit] = got
            out.append(got)
        return np.frombuffer(b"".join(out), np.int32)

    def encode(self, text: str) -> list[int]:
        return self.encoded(text).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: control pieces are silent, runs of byte pieces are read as UTF-8."""
        out: list[str] = []
        held = bytearray()
        first = True
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                first = False
                continue
            if held:
                out.append(_utf8(bytes(held)))
                held.clear()
            if i in self.control:
                continue
            if i == self.unknown:
                out.append(" ⁇ ")
            else:
                piece = self.pieces[i]
                out.append((piece[1:] if first and piece[0] == BLANK else piece).replace(BLANK, " "))
            first = False
        return "".join([*out, _utf8(bytes(held))])


def _utf8(raw: bytes) -> str:
    """``raw`` as text; each byte that is part of no character becomes U+FFFD."""
    out = []
    while raw:
        try:
            return "".join([*out, raw.decode()])
        except UnicodeDecodeError as e:
            out += [raw[: e.start].decode(), "�" * (e.end - e.start)]
            raw = raw[e.end :]
    return "".join(out)


def remembered(model: bytes) -> PieceModel:
    """The model, which a worker process builds once and keeps from task to task with what it remembers."""
    models = sys.__dict__.setdefault("_kept_piece_models", {})
    name = hashlib.sha256(model).digest()
    if name not in models:
        models.clear()
        models[name] = PieceModel(model)
    return models[name]


def encode(docs: DataFrame, model: bytes, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with an array of piece ids, exactly those of the library's ``encode``.

    ``model`` is the content of a .model file; it goes to the tasks with the function,
    so executors need no file. No begin or end ids, no sampling. A null or empty text
    has an empty array, blanks and characters that are no piece are encoded like any
    other (the latter as bytes). Texts of any length are encoded whole: memory is a few
    numbers a character of the longest unit without a blank. Equal scores merge the left
    pair first. Repeated rows stay, an empty table gives an empty one, and a column
    that has the new one's name, in any case, is replaced. Nothing is shuffled.
    """

    def make():
        coder = remembered(model)

        def work(batch: pa.RecordBatch) -> list:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            return [_lists([coder.encoded(t or "") for t in texts])]

        return work

    return append_columns(docs, text, [StructField(ids, ArrayType(IntegerType(), False))], make)


def _lists(lists: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *lists])))


def decode(docs: DataFrame, model: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of the piece ids in ``ids``, as the library's ``decode`` gives it.

    A null or empty array is an empty text. Ids outside of the model are an error.
    """
    kept = without(docs, [text])
    schema = StructType([*kept.schema.fields, StructField(text, StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = remembered(model)
        # an ASCII byte is a character whatever stands beside it; only other bytes need the slow way
        ascii_of = {i: chr(b) for i, b in coder.byte_of.items() if b < 0x80}
        words = pa.array([ascii_of.get(i, p.replace(BLANK, " ")) for i, p in enumerate(coder.pieces)], pa.string())
        plain = np.ones(len(words), bool)
        plain[[*coder.control, *(i for i in coder.byte_of if i not in ascii_of), coder.unknown]] = False
        blank = np.array([p[:1] == BLANK for p in coder.pieces])
        for batch in batches:
            held = batch.column(batch.schema.get_field_index(ids))
            step = 64 if len(held.flatten()) < 1 << 26 else 1
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                column = part.column(part.schema.get_field_index(ids))
                flat = column.flatten().to_numpy(zero_copy_only=False)
                if len(flat) and not 0 <= flat.min() <= flat.max() < len(words):
                    raise ValueError("an id is outside of the model")
                sizes = [x or 0 for x in pa.compute.list_value_length(column).to_pylist()]
                ends = np.cumsum([0, *sizes])
                pieces = words.take(pa.array(flat))
                joined = pa.compute.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces), "")
                texts = joined.to_pylist()
                odd = np.r_[0, np.cumsum(~plain[flat])]
                for i, (a, b) in enumerate(zip(ends, ends[1:])):
                    if odd[a] != odd[b]:
                        texts[i] = coder.decode(flat[a:b].tolist())
                    elif a != b and blank[flat[a]]:
                        texts[i] = texts[i][1:]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, text]
                )

    return kept.mapInArrow(run, schema)


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's piece ids and of their text."""
    from public_tokenizers import path

    with open(path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = decode(encode(docs, model).drop("text"), model)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
