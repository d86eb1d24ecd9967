"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions, each with a context tree of its own whose nodes are
the last 0 to ``DEPTH`` bytes. A node's Krichevsky-Trofimov estimate and the product
of its children's weighted probabilities count half each; so all depths are mixed.

Neither the counts nor the vocabulary have a size bound, so they are not broadcast.
Documents are laid out in blocks; a block asks once for each word and byte string in
it, requests meet their counts by a shuffle, and answers go back to the block.

Most long strings are rare, so there are about as many requests as a quarter of the
bytes. They travel in lists, dealt into buckets by hash; only each bucket's distinct
strings are dealt again, by their nearest context bytes, to build the trees. The
depths above those bytes have a bounded number of nodes, which are broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepact.llm.batches import text_bytes
from tablepact.llm.rolling import RollingHash, mix
from tablepact.llm.shared import cut

#: Bytes of context, at most 7: strings, contexts and the byte that follows, fill a long.
DEPTH = 5
#: Nearest bytes of context that strings of a tree have in common.
NEAR = 3
#: Buckets of strings, and groups of trees, for each block.
BUCKETS = 4
#: Logarithms of strings' probabilities travel as whole multiples of this, 3e-8 off at most.
_LOG_UNIT = 2.0**-24
#: Bytes of text in a block, and bytes looked at together.
BLOCK_BYTES, PIECE = 16 << 20, 1 << 20
#: Stands before and after each text; UTF-8 has no such byte.
EDGE = b"\xff"
#: The token that ends a text, among word hashes.
END_TOKEN = np.int64(-1)
#: Logarithms are summed as whole multiples of this, so that order doesn't matter.
_UNIT = 2.0**-20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def training_row(doc_id: Column) -> Column:
    """Rows to learn from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 != 2


class _Piece:
    """Parts of texts laid end to end; a long text has several, cut at white space.

    Each part follows the ``DEPTH`` bytes before it and, if it is a text's last, is
    followed by the edge: that is the string coded after those bytes.
    """

    def __init__(self, parts: list[tuple[int, bytes, bytes, bool]]) -> None:
        self.doc = np.array([p[0] for p in parts])
        self.last = np.array([p[3] for p in parts])
        coded = [before + part + (EDGE if last else b"") for _, before, part, last in parts]
        size = np.array([len(c) for c in coded])
        self.data = np.frombuffer(b"".join(coded), np.uint8)
        self.stop = np.cumsum(size)
        self.start = self.stop - size + DEPTH

    def strings(self) -> tuple[np.ndarray, np.ndarray]:
        """Each coded byte and its context, nearest byte first, as a number, and where each part's begin."""
        code = np.zeros(len(self.data) - DEPTH, np.int64)
        for k in range(DEPTH, -1, -1):
            code <<= 8
            code |= self.data[k : len(self.data) - DEPTH + k]
        inside = np.ones(len(code), bool)
        for k in range(DEPTH):
            inside[self.start[1:] - DEPTH - 1 - k] = False  # strings over the end of a part
        count = self.stop - self.start
        return code[inside], np.cumsum(count) - count

    def words(self, roll: RollingHash) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word, and the part it is in."""
        space = _SPACE[self.data]
        for k in range(DEPTH):  # contexts are no words, nor are edges
            space[self.start - 1 - k] = True
        space[self.stop[self.last] - 1] = True
        edge = np.diff(np.r_[True, space, True].astype(np.int8))
        first, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        roll.load(self.data)
        # polynomials modulo 2**64 collide on some long words by construction; those modulo a prime don't
        hashes = mix(roll.span(first, end)) ^ mix(_prime_hashes(self.data, first, end) + np.uint64(1 << 40))
        return hashes.view(np.int64), np.searchsorted(self.stop, first, side="right")


_PRIME, _BASE = (1 << 31) - 1, 0x2545F491
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _prime_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of spans modulo 2**31 - 1."""
    prime = np.uint64(_PRIME)
    for i, base in enumerate((_BASE, pow(_BASE, -1, _PRIME))):
        while len(_POWERS[i]) < len(data):  # twice as many by one product
            known = _POWERS[i]
            _POWERS[i] = np.r_[known, known * np.uint64(pow(base, len(known), _PRIME)) % prime]
    up, down = _POWERS
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(up[: len(data)] * (data + np.uint64(1)) % prime, out=prefix[1:])
    return (prefix[end] - prefix[first]) % prime * down[first] % prime


def _pieces(texts: list[bytes]) -> Iterator[_Piece]:
    held, size = [], 0
    for doc, text in enumerate(texts):
        at = 0
        while True:
            end = at + PIECE
            while end < len(text) and not _SPACE[text[end]]:
                end += 1
            part, last = text[at:end], end >= len(text)
            held.append((doc, (EDGE * DEPTH + text[max(at - DEPTH, 0) : at])[-DEPTH:], part, last))
            size += len(part) + DEPTH + 1
            if size >= PIECE:
                yield _Piece(held)
                held, size = [], 0
            if last:
                break
            at = end
    if held:
        yield _Piece(held)


def _packed(docs: DataFrame) -> DataFrame:
    """(block, doc_id, learn, packed) with A-Z lowered, written once so that blocks stay as they are."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        pack = zstandard.ZstdCompressor(level=3).compress
        block, size = TaskContext.get().partitionId() << 24, 0
        for batch in batches:
            blocks, bodies = [], []
            for raw in text_bytes(batch, "text"):
                if size and size + len(raw) > BLOCK_BYTES:
                    block, size = block + 1, 0
                size += len(raw)
                blocks.append(block)
                bodies.append(pack(raw.lower()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), batch.column(0), batch.column(1), pa.array(bodies, pa.binary())],
                names=["block", "doc_id", "learn", "packed"],
            )

    return cut(docs.select("doc_id", "learn", "text").mapInArrow(run, f"block long, doc_id {kind}, learn boolean, packed binary"))


def _starts(key: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts."""
    return np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's ``n``."""
    order = np.argsort(key)
    key, n = key[order], n[order]
    at = _starts(key)
    return key[at], np.add.reduceat(n, at) if len(at) else n


def _distinct(keys: list[np.ndarray]) -> np.ndarray:
    """Distinct keys in order, by sorting: np.unique's hash table is slow on so many."""
    key = np.sort(np.concatenate(keys))
    return key[_starts(key)]


def squeeze(values: np.ndarray, rising: bool = False) -> bytes:
    """Eight-byte values, first bytes first, compressed; of ``rising`` ones the steps."""
    import zstandard

    if rising:
        values = np.diff(values, prepend=values.dtype.type(0))
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unsqueeze(bodies: list[bytes], kind: type, rising: bool = False) -> np.ndarray:
    """The values of all ``bodies``, end to end."""
    import zstandard

    planes = (np.frombuffer(zstandard.decompress(b), np.uint8).reshape(8, -1) for b in bodies)
    values = (np.ascontiguousarray(x.T).ravel().view(kind) for x in planes)
    return np.concatenate([np.zeros(0, kind), *(np.cumsum(v, dtype=kind) if rising else v for v in values)])


def _bucket(code: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(code.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _group(code: np.ndarray, groups: int) -> np.ndarray:
    """Strings of one tree have the same nearest bytes of context and so the same group."""
    near = code.view(np.uint64) >> np.uint64(8 * (DEPTH - NEAR)) & np.uint64((1 << 8 * NEAR) - 1)
    return _bucket(near, groups)


def _dealt(of: np.ndarray, code: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, list]:
    """The buckets there are, and each one's strings, which rise, and their values, as lists."""
    order = np.argsort(of, kind="stable")
    of = of[order]
    at = _starts(of)
    return of[at], [[squeeze(x, v is code) for x in np.split(v[order], at[1:])] for v in (code, more)]


def _word_rows(block: int, word: np.ndarray, n: np.ndarray) -> list:
    return [np.full(len(n), block), word, n]


def _string_rows(buckets: int) -> Callable:
    def rows(block: int, code: np.ndarray, n: np.ndarray) -> list:
        bucket, (codes, times) = _dealt(_bucket(code, buckets), code, n)
        return [np.full(len(bucket), block), bucket, codes, times]

    return rows


def _requests(packed: DataFrame, schema: str, keys: Callable, rows: Callable) -> DataFrame:
    """``rows`` of each block: its distinct keys, and their number in rows to learn from."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack, find = zstandard.ZstdDecompressor().decompress, keys()
        block, found = None, []

        def fold() -> tuple[np.ndarray, np.ndarray]:
            return _summed(*(np.concatenate(x) for x in zip(*found, strict=True)))

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in rows(block, *fold())], names=names)

        for batch in batches:
            blocks = batch.column(0).to_numpy()
            learn = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in _starts(blocks):
                end = at + np.searchsorted(blocks[at:] != blocks[at], True)
                if block is not None and blocks[at] != block:
                    yield out()
                    found = []
                block = blocks[at]
                texts = [unpack(b) for b in batch.column(3).slice(at, end - at).to_pylist()]
                for piece in _pieces(texts):
                    found.append(find(piece, learn[at:end]))
                    if len(found) > 4:
                        found = [fold()]
        if block is not None:
            yield out()

    return packed.mapInArrow(run, schema)


def _string_keys() -> Callable:
    def find(piece: _Piece, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        code, _ = piece.strings()
        return _summed(code, np.repeat(learn[piece.doc], piece.stop - piece.start))

    return find


def _word_keys() -> Callable:
    roll = RollingHash()

    def find(piece: _Piece, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        word, part = piece.words(roll)
        ends = piece.doc[piece.last]
        return _summed(np.r_[word, np.full(len(ends), END_TOKEN)], np.r_[learn[piece.doc[part]], learn[ends]])

    return find


def _word_answers(requests: DataFrame) -> DataFrame:
    """(block, kind 0, key, value): how often each requested word is there to learn from.

    Block -1 gets, from each task, the distinct tokens (key) and all tokens (value).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        block, key, n = (c.to_numpy() for c in pa.Table.from_batches(held).columns)
        unique, back = np.unique(key, return_inverse=True)
        total = np.bincount(back, n, len(unique))
        yield _answers(block, 0, key, total[back])
        yield _answers(np.array([-1]), 0, np.array([(total > 0).sum()]), np.array([total.sum()]))

    return requests.repartition("word").mapInArrow(run, _ANSWERS)


_ANSWERS = "block long, kind int, key long, value double"


def _answers(block, kind: int, key, value) -> pa.RecordBatch:
    columns = [pa.array(block), pa.array(np.full(len(block), kind, np.int32)), pa.array(key), pa.array(value, pa.float64())]
    return pa.RecordBatch.from_arrays(columns, names=["block", "kind", "key", "value"])


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0, by Stirling's series from 8 on."""
    low = x < 8
    shift = np.where(low, np.prod([np.where(low, x + k, 1.0) for k in range(8)], axis=0), 1.0)
    x = np.where(low, x + 8, x)
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


_HALVES, _WHOLES = log_gamma(np.arange(1024) + 0.5), log_gamma(np.arange(1024) + 1.0)


def _log_gamma_above(n: np.ndarray, shift: float, known: np.ndarray) -> np.ndarray:
    """log_gamma(n + shift) for whole n, of which small ones are ``known``."""
    n = n.astype(np.int64)
    out = known[np.minimum(n, len(known) - 1)]
    large = n >= len(known)
    out[large] = log_gamma(n[large] + shift)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov estimate of any sequence with these counts, as a logarithm."""
    half = lambda n: _log_gamma_above(n, 0.5, _HALVES)
    return half(zeros) + half(ones) - np.log(np.pi) - _log_gamma_above(zeros + ones, 1.0, _WHOLES)


class Level:
    """Nodes of one depth: counts, the logarithm of the weighted probability, and ``stop``.

    ``stop`` is the part of the node's own estimate in it. Keys, in order, are the bits
    of the byte so far with a 1 before them, then the context, nearest byte first.
    Nodes of strings that are not there to learn from have no counts.
    """

    def __init__(self, key, zeros, ones, below=None) -> None:
        self.key, self.zeros, self.ones, self.up = key, zeros, ones, None
        own = log_kt(zeros, ones)
        if below is None:
            self.weighted, self.stop = own, np.ones(len(key))
        else:
            self.weighted = np.logaddexp(own, below) - np.log(2)
            self.stop = np.exp(own - np.log(2) - self.weighted)

    def parent(self) -> Level:
        """The level above, whose contexts have a byte less; ``up`` is each node's place there."""
        key = self.key >> np.uint64(8)
        at = _starts(key)
        self.up = np.repeat(np.arange(len(at)), np.diff(np.r_[at, len(key)]))
        add = lambda v: np.add.reduceat(v, at) if len(at) else v
        return Level(key[at], add(self.zeros), add(self.ones), add(np.round(self.weighted / _UNIT)) * _UNIT)

    def mix(self, zero: np.ndarray, one: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, ...]:
        """Probability of a 0 and a 1 by the nodes and those above, and the part of those below.

        The arguments are the same of each node's parent.
        """
        own = rest * self.stop / (self.zeros + self.ones + 1)
        return zero + own * (self.zeros + 0.5), one + own * (self.ones + 0.5), rest * (1 - self.stop)


def _decisions(code: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[Level]]]:
    """For each of a byte's bits: an order of the strings, their bits and bottom nodes in it, levels.

    Levels are those of depth ``DEPTH`` to ``NEAR``, whole for the nearest bytes that are there.
    """
    code = code.view(np.uint64)
    byte, context = code >> np.uint64(8 * DEPTH), code & np.uint64((1 << 8 * DEPTH) - 1)
    byte = byte & np.uint64(255)
    for k in range(8):
        key = (np.uint64(1 << k) | byte >> np.uint64(8 - k)) << np.uint64(8 * DEPTH) | context
        order = np.argsort(key)
        key, bit = key[order], (byte[order] >> np.uint64(7 - k) & np.uint64(1)).astype(np.int64)
        at = _starts(key)
        node = np.repeat(np.arange(len(at)), np.diff(np.r_[at, len(key)]))
        ones, total = np.add.reduceat(n[order] * bit, at), np.add.reduceat(n[order], at)
        levels = [Level(key[at], total - ones, ones)]
        while len(levels) <= DEPTH - NEAR:
            levels.append(levels[-1].parent())
        yield order, bit, node, levels


def _summed_lists(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct strings of each ``key`` in order, and their sums; rows come sorted by the key."""

    def out() -> tuple[np.ndarray, np.ndarray]:
        table = pa.Table.from_batches(held)
        return _summed(*(unsqueeze(table.column(c).to_pylist(), np.int64, c == "codes") for c in ("codes", "n")))

    held, last = [], None
    for batch in batches:
        keys = batch.column(key).to_numpy()
        starts = _starts(keys)
        for at, end in zip(starts, np.r_[starts[1:], len(keys)], strict=True):
            if held and keys[at] != last:
                yield out()
                held = []
            last = keys[at]
            held.append(batch.slice(at, end - at))
    if held:
        yield out()


def _counted(requests: DataFrame, groups: int) -> DataFrame:
    """(codes, n) lists of distinct strings and how often each is there to learn from, trees whole."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in _summed_lists(batches, "bucket"):
            group, lists = _dealt(_group(code, groups), code, n)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (group, *lists)], names=["tree", "codes", "n"])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in _summed_lists(batches, "tree"):
            bodies = [squeeze(code, True), squeeze(n)]
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in bodies], names=["codes", "n"])

    # blocks are summed up first, so that a tree grows with its strings and not with the corpus
    dealt = requests.select("bucket", "codes", "n").repartition("bucket").sortWithinPartitions("bucket")
    counts = dealt.mapInArrow(totals, "tree long, codes binary, n binary")
    return cut(counts.repartition("tree").sortWithinPartitions("tree").mapInArrow(lists, "codes binary, n binary"))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for codes, n in zip(batch.column(0), batch.column(1), strict=True):
            yield unsqueeze([codes.as_py()], np.int64, True), unsqueeze([n.as_py()], np.int64)


def _string_answers(requests: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, values): log10 probability of the last byte of each string, in their order."""
    counted = _counted(requests, buckets)

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n in _each(batches):
            for _, _, _, levels in _decisions(code, n):
                near = levels[-1]
                at = _starts(near.key >> np.uint64(8))
                add = lambda v: pa.array(np.add.reduceat(v, at).astype(np.int64))  # noqa: E731, B023
                key = (near.key[at] >> np.uint64(8)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), add(near.zeros), add(near.ones), add(np.round(near.weighted / _UNIT))],
                    names=["key", "zeros", "ones", "below"],
                )

    # at most 256 ** (NEAR - 1) nearest bytes times 255 bit nodes, of which texts have few
    top = counted.mapInArrow(tops, "key long, zeros long, ones long, below long").groupBy("key")
    rows = top.agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "below"))).toArrow()
    key, zeros, ones, below = (c.to_numpy() for c in rows.columns)
    order = np.argsort(key)
    levels = [Level(key[order].astype(np.uint64), zeros[order], ones[order], below[order] * _UNIT)]
    while len(levels) < NEAR:
        levels.append(levels[-1].parent())
    mixed = levels[-1].mix(*(np.full(len(levels[-1].key), x) for x in (0.0, 0.0, 1.0)))
    for level in levels[-2::-1]:
        mixed = level.mix(*(v[level.up] for v in mixed))
    shared = requests.sparkSession.sparkContext.broadcast((levels[0].key, mixed))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, known = shared.value
        for code, n in _each(batches):
            value = np.zeros(len(code))
            for order, bit, node, levels in _decisions(code, n):
                at = np.searchsorted(top, levels[-1].key >> np.uint64(8))
                mixed = levels[-1].mix(*(v[at] for v in known))
                for level in levels[-2::-1]:
                    mixed = level.mix(*(v[level.up] for v in mixed))
                value[order] += np.log10(np.where(bit == 1, mixed[1][node], mixed[0][node]))
            bucket, lists = _dealt(_bucket(code, buckets), code, np.round(value / _LOG_UNIT).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (bucket, *lists)], names=["bucket", "codes", "values"])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        code = unsqueeze(right.column("codes").to_pylist(), np.int64, True)
        order = np.argsort(code)
        code, value = code[order], unsqueeze(right.column("values").to_pylist(), np.int64)[order]
        asked = left.column("codes")
        values = [squeeze(value[np.searchsorted(code, unsqueeze([c.as_py()], np.int64, True))]) for c in asked]
        return pa.table({"block": left.column("block"), "bucket": left.column("bucket"), "values": pa.array(values, pa.binary())})

    answers = counted.mapInArrow(answer, "bucket long, codes binary, values binary")
    asked = requests.select("bucket", "block", "codes").groupBy("bucket")
    return asked.cogroup(answers.groupBy("bucket")).applyInArrow(meet, "block long, bucket long, values binary")


def score_texts(docs: DataFrame, learn: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of each row.

    Rows where ``learn`` is true are learned from; all are scored. Texts have A-Z
    lowered; a null text is empty. Tokens are words between ASCII white space and one
    end; base_score is their log10 probability by counts plus one. score is the
    context tree's log10 probability of the bytes and the end, bits_per_byte its code
    length (null for an empty text). Repeated rows, and rows without a key, stay
    apart; nothing to learn from leaves every bit at one half. Words are told apart
    by two hashes, of 64 and of 31 bits. Very long texts are looked at in pieces, an empty table gives an empty
    one. Other columns, whatever their names, are not read.
    """
    plain = docs.select(
        F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(learn), F.lit(False)).alias("learn"), F.col(f"`{text}`").alias("text")
    )
    packed = _packed(plain)
    words = _word_answers(_requests(packed, "block long, word long, n long", _word_keys, _word_rows))
    buckets = BUCKETS * max(packed.select("block").distinct().count(), 8)
    asked = "block long, bucket long, codes binary, n binary"
    # made once: the lists sent to be counted are those to be answered
    requests = cut(_requests(packed, asked, _string_keys, _string_rows(buckets)))
    strings = _string_answers(requests, buckets)
    words = words.withColumn("values", F.lit(None).cast("binary"))
    strings = strings.select("block", F.lit(1).alias("kind"), F.col("bucket").alias("key"), F.lit(0.0).alias("value"), "values")
    kind = packed.schema["doc_id"].dataType.simpleString()

    def block_scores(key, left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard
        from pyspark.sql.pandas.types import to_arrow_type

        id_type = to_arrow_type(packed_id)
        kinds = right.column("kind").to_numpy()
        asked, value = right.column("key").to_numpy(), right.column("value").to_numpy()
        if key[0].as_py() == -1:
            columns = [pa.nulls(1, id_type), [None], [None], [int(value.sum())], [int(asked.sum())], [0.0], [0.0]]
        else:
            unpack, roll = zstandard.ZstdDecompressor().decompress, RollingHash()
            texts = [unpack(b) for b in left.column("packed").to_pylist()]
            order = np.argsort(asked[kinds == 0])
            tables = [(asked[kinds == 0][order], value[kinds == 0][order])]
            found: list[np.ndarray] = []
            for piece in _pieces(texts):
                found.append(_distinct([piece.strings()[0]]))
                if len(found) > 4:
                    found = [_distinct(found)]
            codes = _distinct(found)
            lists = right.filter(pa.array(kinds == 1)).sort_by("key").column("values").to_pylist()
            chances = np.empty(len(codes))
            chances[np.argsort(_bucket(codes, buckets), kind="stable")] = unsqueeze(lists, np.int64) * _LOG_UNIT
            tables.append((codes, chances))
            n_tokens, n_known, n_bytes = (np.zeros(len(texts), np.int64) for _ in range(3))
            logs, score = np.zeros(len(texts)), np.zeros(len(texts))
            for piece in _pieces(texts):
                word, part = piece.words(roll)
                doc = np.r_[piece.doc[part], piece.doc[piece.last]]
                word = np.r_[word, np.full(int(piece.last.sum()), END_TOKEN)]
                count = tables[0][1][np.searchsorted(tables[0][0], word)]
                n_tokens += np.bincount(doc, minlength=len(texts))
                n_known += np.bincount(doc[count > 0], minlength=len(texts))
                logs += np.bincount(doc, np.log10(count + 1), len(texts))
                code, first = piece.strings()
                chance = tables[1][1][np.searchsorted(tables[1][0], code)]
                size = piece.stop - piece.start
                filled = size > 0
                np.add.at(score, piece.doc[filled], np.add.reduceat(chance, first[filled]))
                np.add.at(n_bytes, piece.doc, size - piece.last)
            columns = [left.column("doc_id"), left.column("learn"), n_bytes, n_tokens, n_known, logs, score]
        names = ["doc_id", "learn", "n_bytes", "n_tokens", "n_known", "logs", "score"]
        types = [id_type, pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2]
        return pa.table({n: c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})

    packed_id = packed.schema["doc_id"].dataType
    scored = cut(
        packed.groupBy("block").cogroup(words.union(strings).groupBy("block")).applyInArrow(
            block_scores, f"doc_id {kind}, learn boolean, n_bytes long, n_tokens long, n_known long, logs double, score double"
        )
    )
    # the rows of block -1 have no ``learn``: all tokens, and distinct ones, of each task
    total = scored.filter("learn is null").agg(F.sum("n_tokens"), F.sum("n_known")).first()
    tokens, distinct = (x or 0 for x in total)
    base = F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(tokens + distinct + 1)))
    bits = F.when(F.col("n_bytes") > 0, -F.col("score") / F.col("n_bytes") / F.log10(F.lit(2.0)))
    return scored.filter("learn is not null").select(
        "doc_id", "learn", "n_bytes", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"), "score", bits.alias("bits_per_byte"),
    )


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, learned from six sevenths of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_texts(docs.withColumn("learn", training_row(F.col("doc_id"))), "learn")
    return scored.withColumn("held_out", ~F.col("learn")).drop("learn")
