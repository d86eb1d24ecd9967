"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

Every string of ``length`` bytes that also starts earlier is found, exactly, and the
bytes it covers are removed. The corpus is too large for one index, so:

1. Each window of ``length`` bytes is assigned to an anchor: the ``ANCHOR``-byte
   string of least hash in it. Neighbouring windows mostly share one, and equal
   windows always do, so a run of windows of one anchor is one row, and all that can
   match a window has its anchor's hash.
2. Rows are grouped by anchor. Runs that are equal as a whole are settled there: all
   but the earliest repeat it. Runs alone with their anchor repeat nothing.
3. For what is left, runs that share an anchor and differ, the bytes are fetched. In
   each shard of anchors, batches in document order get suffix arrays, are scanned
   against the levels of the index so far, and levels of like size are merged.
4. The spans found are joined to their documents.

An anchor with many different runs (a common line in ever other surroundings) would
fill one task in steps 2 and 3. Such anchors are looked for in a bounded sample; their
runs are dealt out by the run and their windows by the window. So are those the sample
missed, in step 3. Either way gives the same spans. Before windows are dealt out, a
task keeps the earliest of those that are equal and calls the others spans, so a passage
that very many documents share sends few rows to the task that compares it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tablepact.llm.batches import append_columns, pieces, text_bytes, without
from tablepact.llm.rolling import RollingHash, mix
from tablepact.llm.shared import cut, numbered

#: Bytes of an anchor; windows must be longer.
ANCHOR = 32
#: Bytes looked at together; longer texts are cut, with windows across the cut kept.
PIECE = 1 << 20
#: Suffixes that get an array together, and suffixes of a shard's index.
BATCH, SHARD = 1 << 16, 1 << 20
#: Windows of hot anchors that a task of step 3 combines at once.
COMBINE = 1 << 16
#: Runs of one anchor beyond which its windows are dealt out one by one.
HOT_RUNS = 500
#: Documents looked at for such anchors beforehand, and the part of them that must have one.
HOT_SAMPLE, HOT_PART = 2_000, 0.02

_PLACE = np.uint64((1 << 24) - 1)


def window_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray, length: int, roll: RollingHash):
    """(first window, windows, anchor hash, content hash) of each run, and its text's number.

    ``start`` and ``end`` bound the texts within ``data``; windows don't cross them.
    """
    n, width = len(data), length - ANCHOR + 1
    if n > int(_PLACE) + 1:
        raise ValueError(f"{n} bytes at once, but places have 24 bits")
    if n < length:
        return [np.zeros(0, np.int64)] * 5
    roll.load(data)
    place = np.arange(n - ANCHOR + 1)
    grams = mix(roll.span(place, place + ANCHOR))
    # least of each window: the hash comes first, then the place
    rows = -(-len(grams) // width)
    ranked = np.full(rows * width, ~np.uint64(0))
    ranked[: len(grams)] = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    ranked = ranked.reshape(rows, width)
    ahead = np.minimum.accumulate(ranked, axis=1).ravel()
    behind = np.minimum.accumulate(ranked[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    anchor = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & _PLACE

    long = end - start >= length
    steps = np.zeros(n + 1, np.int8)
    np.add.at(steps, start[long], 1)
    np.add.at(steps, end[long] - length + 1, -1)
    inside = np.cumsum(steps[:windows], dtype=np.int8) > 0
    joined = np.r_[False, inside[1:] & inside[:-1] & (anchor[1:] == anchor[:-1])]
    first = np.flatnonzero(inside & ~joined)
    last = np.flatnonzero(inside & ~np.r_[joined[1:], False])
    count = last - first + 1
    content = roll.span(first, last + length) + count.astype(np.uint64)
    text = np.searchsorted(start, first, side="right") - 1
    hashes = grams[anchor[first].astype(np.int64)].view(np.int64), mix(content).view(np.int64)
    return first, count, *hashes, text


def merged(start: np.ndarray, end: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal runs (start, end, of) of spans that touch or overlap within one ``of``."""
    if not len(start):
        return start, end, of
    order = np.lexsort((start, of))
    start, end, of = start[order], end[order], of[order]
    reach = np.empty_like(end)
    head = np.r_[True, of[1:] != of[:-1]]
    # a text's spans are moved beyond those of the one before, so that one running maximum does
    shift = (np.cumsum(head) - 1) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift) - shift
    head |= np.r_[True, start[1:] > reach[:-1]]
    at = np.flatnonzero(head)
    return start[at], np.maximum.reduceat(reach, at), of[at]


# kind: 0 a run of windows, 1 a span, 2 a run to compare, 3 a run of a hot anchor
_ROWS = "a long, x long, ord long, pos long, size int, kind int"
_NAMES = ["a", "x", "ord", "pos", "size", "kind"]


def _rows(a, x, ord, pos, size, kind: int) -> pa.RecordBatch:
    size = np.asarray(size, np.int32)
    columns = [a, x, ord, pos, size, np.full(len(size), kind, np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_NAMES)


def _repeats(a, x, ord, pos) -> tuple[np.ndarray, np.ndarray]:
    """Order by (a, x, place), and whether a row there is the first of its (a, x)."""
    order = np.lexsort((pos, ord, x, a))
    a, x = a[order], x[order]
    return order, np.r_[True, (a[1:] != a[:-1]) | (x[1:] != x[:-1])][: len(order)]


def _hot_anchors(docs: DataFrame, length: int) -> list[int]:
    """Anchors with many different runs in a sample of documents, chosen by their number.

    There are at most as many as a document has runs, times 1 / HOT_PART.
    """
    total = docs.count()
    draw = F.pmod(F.xxhash64("ord", F.lit("hot anchors")), F.lit(1 << 30)) / F.lit(1 << 30)
    sample = docs.filter(draw < HOT_SAMPLE / max(total, 1))
    runs = _scan(sample, length, []).filter("kind = 0").groupBy("a").agg(F.countDistinct("x").alias("runs"))
    least = max(2, HOT_PART * min(total, HOT_SAMPLE))
    return sorted(r["a"] for r in runs.filter(F.col("runs") >= least).select("a").collect())


def _scan(docs: DataFrame, length: int, hot: list[int]) -> DataFrame:
    """Runs of windows of each text; repeats within a piece are spans already.

    Runs of ``hot`` anchors are of kind 3 and have a number of their own for ``a``.
    """
    known = np.array(hot, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = RollingHash()

        def found(texts: list[bytes], ords: np.ndarray, base: np.ndarray) -> Iterator[pa.RecordBatch]:
            data = np.frombuffer(b"".join(texts), np.uint8)
            end = np.cumsum([len(t) for t in texts])
            start = end - [len(t) for t in texts]
            first, count, a, x, text = window_runs(data, start, end, length, roll)
            ord, pos = ords[text], first - start[text] + base[text]
            order, new = _repeats(a, x, ord, pos)
            keep, again = order[new], order[~new]
            common = np.isin(a, known)
            a = np.where(common, mix((a ^ x).view(np.uint64)).view(np.int64), a)
            for part, kind in ((keep[~common[keep]], 0), (keep[common[keep]], 3)):
                yield _rows(a[part], x[part], ord[part], pos[part], count[part], kind)
            s, e, o = merged(pos[again], pos[again] + count[again] + length - 1, ord[again])
            if len(o):
                yield _rows(mix(o.astype(np.uint64)).view(np.int64), o, o, s, e - s, 1)

        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                texts, ords = text_bytes(piece, "text"), piece.column(0).to_numpy()
                long = np.array([len(t) > 2 * PIECE for t in texts])
                for i in np.flatnonzero(long):  # empty texts may stand beside it
                    for at in range(0, len(texts[i]), PIECE):
                        yield from found([texts[i][at : at + PIECE + length - 1]], ords[[i]], np.array([at]))
                if not long.all():
                    short = [t for t, cut_up in zip(texts, long, strict=True) if not cut_up]
                    yield from found(short, ords[~long], np.zeros(len(short), np.int64))

    return docs.select("ord", "text").mapInArrow(run, _ROWS)


def _settle(rows: DataFrame, length: int) -> DataFrame:
    """Spans of runs that repeat an earlier one whole; runs to compare by bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        span = table.column("kind").to_numpy() == 1
        got = [table.column(n).to_numpy() for n in _NAMES]
        if span.any():
            yield _rows(*(c[span] for c in got[:5]), 1)
        a, x, ord, pos, size, kind = (c[~span] for c in got)
        order, new = _repeats(a, x, ord, pos)
        again, kept = order[~new], order[new]
        yield _rows(a[again], x[again], ord[again], pos[again], size[again] + length - 1, 1)
        common, kept = kept[kind[kept] == 3], kept[kind[kept] == 0]
        yield _rows(a[common], x[common], ord[common], pos[common], size[common], 3)
        alone = np.r_[True, a[kept][1:] != a[kept][:-1]][: len(kept)]
        alone &= np.r_[alone[1:], True][: len(kept)]
        kept = kept[~alone]
        head = np.flatnonzero(np.r_[True, a[kept][1:] != a[kept][:-1]][: len(kept)])
        runs = np.diff(np.r_[head, len(kept)])
        hot = np.repeat(runs > HOT_RUNS, runs)
        for part, sort in ((kept[~hot], 2), (kept[hot], 3)):
            yield _rows(a[part], x[part], ord[part], pos[part], size[part], sort)

    return rows.repartition("a").mapInArrow(run, _ROWS)


def _merge(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that merges two sorted arrays, left first in ties, and whether a string repeats the one ahead."""
    both = np.r_[left, right]
    order = np.argsort(both, kind="stable")  # finds the two sorted runs and merges them
    ranked = both[order]
    return order, np.r_[False, ranked[1:] == ranked[:-1]]


class SuffixLevels:
    """Suffix arrays of growing size over batches of texts, told apart by ``length`` bytes.

    Each level is a buffer and the places in it where a string starts that no level
    or earlier place has, sorted by the string. A new batch gets a suffix array, which
    is scanned against every level by a merge of the two; then levels are merged while
    the newest is as large as the one before.
    """

    def __init__(self, length: int) -> None:
        self.length = length
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def _strings(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        views = np.lib.stride_tricks.sliding_window_view(data, self.length)
        return np.ascontiguousarray(views[at]).view(f"S{self.length}").ravel()

    def add(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each place, in document order, whether its string was there before."""
        strings = self._strings(data, at)
        array = np.argsort(strings, kind="stable")
        ranked = strings[array]
        known = np.r_[False, ranked[1:] == ranked[:-1]][: len(ranked)]
        for text, level in self.levels:
            order, repeats = _merge(self._strings(text, level), ranked)
            mine = order >= len(level)
            known[order[mine] - len(level)] |= repeats[mine]
        before = np.empty(len(at), bool)
        before[array] = known
        if not known.all():
            self.levels.append((data, at[array[~known]]))
        while len(self.levels) > 1 and len(self.levels[-1][1]) >= len(self.levels[-2][1]):
            (old, left), (new, right) = self.levels[-2:]
            order, _ = _merge(self._strings(old, left), self._strings(new, right))
            self.levels[-2:] = [(np.r_[old, new], np.r_[left, right + len(old)][order])]
        return before


def _compare(runs: DataFrame, length: int) -> DataFrame:
    """(ord, pos, size) spans of windows that start earlier in another run of the anchor.

    Rows with a size are spans already and pass through.
    """
    dealt = runs.repartition("a").sortWithinPartitions("a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shard(table: pa.Table) -> Iterator[pa.RecordBatch]:
            order = np.lexsort((table.column("pos").to_numpy(), table.column("ord").to_numpy()))
            table = table.take(pa.array(order))
            ord, pos = table.column("ord").to_numpy(), table.column("pos").to_numpy()
            texts = table.column("part").to_pylist()
            sizes = np.array([len(t) for t in texts]) - (length - 1)
            index = SuffixLevels(length)
            part = np.cumsum(sizes) // BATCH
            for rows in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(part)) + 1):
                data = np.frombuffer(b"".join(texts[i] for i in rows), np.uint8)
                count = sizes[rows]
                begin = np.cumsum(count + length - 1) - (count + length - 1)
                of = np.repeat(np.arange(len(rows)), count)
                offset = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                hit = np.flatnonzero(index.add(data, begin[of] + offset))
                start = pos[rows][of[hit]] + offset[hit]
                s, e, o = merged(start, start + length, ord[rows][of[hit]])
                columns = [pa.array(o), pa.array(s), pa.array((e - s).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["ord", "pos", "size"])

        held, windows = [], 0
        for batch in batches:
            span = pa.compute.is_valid(batch.column(4))
            if span.true_count:
                yield batch.filter(span).select(["ord", "pos", "size"])
            batch = batch.filter(pa.compute.invert(span))
            if not batch.num_rows:
                continue
            held.append(batch)
            windows += pa.compute.sum(pa.compute.binary_length(batch.column(3))).as_py()
            if windows > SHARD * 4:
                table = pa.Table.from_batches(held)
                a = table.column("a").to_numpy()
                done = int(np.searchsorted(a, a[-1]))
                if done:
                    yield from shard(table.slice(0, done))
                    rest = table.slice(done).combine_chunks()
                    held = rest.to_batches()
                    windows = pa.compute.sum(pa.compute.binary_length(rest.column(3))).as_py()
        if held:
            yield from shard(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "ord long, pos long, size int")


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """(ord, pos, size): byte spans that cover every string that also starts earlier."""
    packed = _packed(docs.select("ord", "text"))
    settled = cut(_settle(_scan(docs, length, _hot_anchors(docs, length)), length))
    wanted = (
        settled.filter("kind >= 2").groupBy("ord")
        .agg(F.collect_list(F.struct("a", "pos", "size", "kind")).alias("runs"))
    )

    names = ["a", "ord", "pos", "part", "size"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32()]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from xxhash import xxh64_intdigest

        unpack = zstandard.ZstdDecompressor().decompress
        first: dict[bytes, tuple[int, int]] = {}
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            rows.extend((xxh64_intdigest(part) - (1 << 63), *at, part, None) for part, at in first.items())
            first.clear()
            columns = zip(*rows, strict=True) if rows else [()] * 5
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
            rows.clear()
            return out

        for batch in batches:
            for o, body, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                body = unpack(body)
                for r in runs:
                    a, pos, size, kind = r["a"], r["pos"], r["size"], r["kind"]
                    if kind == 2:
                        rows.append((a, o, pos, body[pos : pos + size + length - 1], None))
                    for at in range(pos, pos + size) if kind == 3 else ():
                        part, here = body[at : at + length], (o, at)
                        there = first.setdefault(part, here)
                        if here != there:  # the later one of two equal windows is a span
                            first[part] = min(here, there)
                            late, start = max(here, there)
                            rows.append((late, late, start, b"", length))
                        if len(first) + len(rows) >= COMBINE:
                            yield flush()
        yield flush()

    runs = packed.join(wanted, "ord").select("ord", "packed", "runs")
    runs = runs.mapInArrow(fetch, "a long, ord long, pos long, part binary, size int")
    return settled.filter("kind = 1").select("ord", "pos", "size").union(_compare(runs, length))


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` with the text's bytes compressed, for the shuffle."""

    def make():
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        return lambda batch: [[pack(raw) for raw in text_bytes(batch, "text")]]

    return append_columns(docs, "text", [StructField("packed", BinaryType())], make).drop("text")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """``docs`` with the text less every byte of a repeated string, and what went.

    Texts count as UTF-8 bytes, a null as empty. A byte goes if a string of
    ``length`` bytes over it also starts earlier: in a row of a smaller key, or
    further ahead in the same text. Of rows with equal keys the smaller text is the
    earlier; null keys come last; of equal rows any is the first. Very long texts are
    cut into pieces that overlap, so no string is missed. No rows give none. Columns added (and
    replaced, if there): kept (binary, the rest), n_bytes, n_removed, n_spans, and
    removed, an array of (start, end) byte offsets in the text as it was. The text
    column holds the rest without characters that were cut in half; null stays null.
    """
    if length <= ANCHOR:
        raise ValueError(f"strings must be longer than {ANCHOR} bytes")
    added = ["kept", "n_bytes", "n_removed", "n_spans", "removed"]
    docs = without(docs, [*added, "ord", "packed", "spans", *(["text"] if text.lower() != "text" else [])])
    rows = numbered(docs, key, text).withColumnRenamed(text, "text")
    spans = repeated_spans(rows, length).groupBy("ord").agg(
        F.collect_list(F.struct("pos", "size")).alias("spans")
    )
    whole = _packed(rows.withColumn("_null", F.col("text").isNull()))
    joined = whole.join(spans, "ord", "left").drop("ord")
    names = [c for c in joined.columns if c not in ("packed", "spans", "_null")]
    schema = joined.select(*[f"`{c}`" for c in names]).schema
    found = (
        "text string, kept binary, n_bytes long, n_removed long, n_spans long, "
        "removed array<struct<start:long,end:long>>"
    )
    schema = StructType([*schema.fields, *StructType.fromDDL(found).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark.sql.pandas.types import to_arrow_schema

        unpack = zstandard.ZstdDecompressor().decompress
        types = to_arrow_schema(schema)
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("packed", "spans", "_null"))
            for body, gone, null in zip(*columns, strict=True):
                body = unpack(body)
                start = np.array([s["pos"] for s in gone or []], np.int64)
                end = start + np.array([s["size"] for s in gone or []], np.int64)
                start, end, _ = merged(start, end, np.zeros(len(start), np.int64))
                kept = b"".join(body[a:b] for a, b in zip(np.r_[0, end], np.r_[start, len(body)], strict=True))
                values = (
                    None if null else kept.decode(errors="ignore"),
                    kept,
                    len(body),
                    len(body) - len(kept),
                    len(start),
                    [{"start": int(a), "end": int(b)} for a, b in zip(start, end, strict=True)],
                )
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            same = [batch.column(batch.schema.get_field_index(c)) for c in names]
            new = [pa.array(v, types.field(len(names) + i).type) for i, v in enumerate(out)]
            yield pa.RecordBatch.from_arrays([*same, *new], names=types.names)

    return joined.mapInArrow(run, schema).withColumnRenamed("text", text)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from every document, as counts and a digest of the rest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without repeated strings; texts with nothing else go.

    n_chars follows the text where there is such a column; others stay as they are.
    """
    names = [c for c in docs.columns if c not in ("doc_id", "text")]
    others = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names])
    left = remove_repeats(docs.select("doc_id", "text", others.alias("_others")))
    left = left.filter("n_removed = 0 or n_removed < n_bytes")

    def column(name: str) -> Column:
        if name in ("doc_id", "text"):
            return F.col(name)
        was = F.col("_others")[name]
        if name == "n_chars":
            was = F.coalesce(F.length("text").cast(docs.schema[name].dataType), was)
        return was.alias(name)

    return left.select(*map(column, docs.columns))
