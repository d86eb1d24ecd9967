"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are windows of consecutive benchmark words. Blocks are word pairs: a shift
table says how far the search may move on after the pair it looks at, pairs that end
a pattern lead to a bucket of patterns, and the first pair selects those of the
bucket that are compared word for word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablepact.llm import batches
from tablepact.llm.batches import WORD_BYTES, append_columns, text_bytes, without
from tablepact.llm.shared import cut

#: Words of a window; a shorter text is one window.
WINDOW = 10
#: Bytes of benchmark text whose tables a task holds at once, and bytes that are broadcast
#: at once. A larger benchmark goes out in several rounds.
BLOCK_BYTES, ROUND_BYTES = 2 << 20, 32 << 20
#: Bytes of documents that pass all blocks of a round together, if it has several.
PIECE_BYTES = 32 << 20


def words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters (lowered), digits and characters beyond ASCII."""
    return text.translate(WORD_BYTES).split()


class Patterns:
    """Patterns of one length in words; each has a set of owners."""

    def __init__(self, owned: dict[tuple[bytes, ...], set[int]]) -> None:
        self.owned = owned
        self.length = m = len(next(iter(owned)))
        self.block = b = min(2, m)
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = {}
        for pattern in owned:
            for end in range(b, m + 1):
                pair = pattern[end - b : end]
                self.shift[pair] = min(self.shift.get(pair, m), m - end)
            bucket = self.buckets.setdefault(pattern[-b:], defaultdict(list))
            bucket[pattern[:b]].append(pattern)

    def search(self, text: Sequence[bytes]) -> Iterator[tuple[int, set[int]]]:
        """(first word, owners) of each occurrence."""
        m, b, shift, most = self.length, self.block, self.shift, self.length - self.block + 1
        end, n = m, len(text)
        while end <= n:
            pair = tuple(text[end - b : end])
            step = shift.get(pair, most)
            if step:
                end += step
                continue
            at = end - m
            for pattern in self.buckets[pair].get(tuple(text[at : at + b]), ()):
                if tuple(text[at:end]) == pattern:
                    yield at, self.owned[pattern]
            end += 1


def patterns_of(texts: Iterable[bytes], window: int = WINDOW) -> list[Patterns]:
    """Searchers for all windows of the texts, one for each length; owners are indices."""
    by_length: dict[int, dict] = {}
    for i, text in enumerate(texts):
        found = words(text)
        m = min(len(found), window)
        for at in range(len(found) - m + 1 if m else 0):
            by_length.setdefault(m, {}).setdefault(tuple(found[at : at + m]), set()).add(i)
    return [Patterns(owned) for _, owned in sorted(by_length.items())]


def _filled(rows: Iterable[tuple], limit: int) -> Iterator[list[tuple]]:
    """Rows (name, text) in lists of about ``limit`` bytes of text."""
    held, size = [], 0
    for name, raw in rows:
        if held and size + len(raw) > limit:
            yield held
            held, size = [], 0
        held.append((name, raw))
        size += len(raw)
    if held:
        yield held


def _rounds(benchmark: DataFrame, key: str, text: str, limit: int) -> Iterator[list[tuple]]:
    """The benchmark's (key as text, text) in lists of about ``limit`` bytes, one at a time."""
    rows = benchmark.select(F.col(key).cast("string"), F.col(text)).filter(F.col(text).isNotNull())
    return _filled(((name, body.encode()) for name, body in rows.toLocalIterator()), limit)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    round_bytes: int = ROUND_BYTES,
    prefix: str = "",
) -> DataFrame:
    """``docs`` with n_words, hits, n_hit, items and contaminated.

    ``hits`` are (start, end) word offsets of runs within occurrences of a benchmark
    window, ``items`` the ids (as text, sorted) that have one. A null text has no
    words. A benchmark row without words matches nothing; one without an id marks
    words but has no place among the items; rows of one id count as one item. An
    empty benchmark leaves all clean. Input columns with the new names are replaced.

    A very long document is searched whole; equal documents get equal results. Input
    columns called ``_hits0``, ``_items0`` and so on are replaced too.

    ``round_bytes`` of the benchmark are on the driver and broadcast at once, and a
    task builds tables for ``block_bytes`` of them at a time. A benchmark beyond one
    round takes several; between two of them documents are written to the checkpoint
    folder with what was found so far. Documents are never shuffled.
    """
    out = {n: prefix + n for n in ("n_words", "hits", "n_hit", "items", "contaminated")}
    docs = without(docs, out.values())
    context = docs.sparkSession.sparkContext
    parts, shared = [], None
    for i, held in enumerate(chain(_rounds(benchmark, item, item_text, round_bytes), [None])):
        if held is None and parts:
            break  # the last round needs no cut: it runs with what follows
        if parts:
            docs = cut(docs)
            shared.unpersist()
        shared = context.broadcast(list(_filled(held or [], block_bytes)))
        fields = StructType.fromDDL(
            f"{out['n_words']} long, `_hits{i}` array<struct<start:long,end:long>>, `_items{i}` array<string>"
        ).fields
        limit = PIECE_BYTES if len(shared.value) > 1 else batches.PIECE_BYTES
        docs = append_columns(docs, text, fields, _searcher(shared, text, window), limit)
        parts.append(i)
    hits = F.array_sort(F.concat(*[f"_hits{i}" for i in parts]))
    items = F.array_sort(F.array_distinct(F.concat(*[f"_items{i}" for i in parts])))
    docs = docs.withColumns({out["hits"]: hits, out["items"]: items})
    covered = F.aggregate(
        out["hits"],
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(x["end"] - F.greatest(x["start"], a["reach"]), F.lit(0))).alias("n"),
            F.greatest(x["end"], a["reach"]).alias("reach"),
        ),
        lambda a: a["n"],
    )
    docs = docs.withColumn(out["n_hit"], covered).drop(*[f"_{k}{i}" for i in parts for k in ("hits", "items")])
    return docs.withColumn(out["contaminated"], F.col(out["n_hit"]) > 0)


def _searcher(shared, text: str, window: int):
    def make():
        blocks = shared.value
        tables = lambda block: patterns_of((b for _, b in block), window)
        only = tables(blocks[0]) if len(blocks) == 1 else None

        def one(found: list[bytes], names: list, searchers: list[Patterns], runs: list, items: set) -> None:
            for s in searchers:
                for at, own in s.search(found):
                    items.update(names[i] for i in own if names[i] is not None)
                    if runs and runs[-1]["start"] <= at <= runs[-1]["end"]:
                        runs[-1]["end"] = max(runs[-1]["end"], at + s.length)
                    else:
                        runs.append({"start": at, "end": at + s.length})

        def work(batch: pa.RecordBatch) -> list[list]:
            texts = text_bytes(batch, text)
            n_words, runs, items = [0] * len(texts), [[] for _ in texts], [set() for _ in texts]
            for block in blocks or [[]]:
                searchers, names = only or tables(block), [n for n, _ in block]
                for k, raw in enumerate(texts):
                    found = words(raw)
                    n_words[k] = len(found)
                    one(found, names, searchers, runs[k], items[k])
            return [n_words, runs, list(map(list, items))]

        return work

    return make


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document: words hit, and a digest of the items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


#: Lower-cased words of a text, in SQL.
SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

SQL = f"""
with d as (select doc_id, {SQL_WORDS} w from documents),
b as (select item_id, {SQL_WORDS} w from benchmark),
bw as (
    select distinct item_id, least(len(w), {WINDOW}) l,
        array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') g
    from b, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) t(i)
    where len(w) > 0
),
dw as (
    select doc_id, i, l, array_to_string(w[i:i + l - 1], ' ') g
    from d, (select distinct l from bw), unnest(range(1, len(w) - l + 2)) t(i)
),
hit as (select doc_id, i, l, item_id from dw join bw using (l, g)),
covered as (
    select doc_id, count(distinct i + k) n_hit
    from (select distinct doc_id, i, l from hit), unnest(range(l)) u(k) group by all
),
named as (
    select doc_id, count(*) n_items, string_agg(item, ',' order by item) items
    from (select distinct doc_id, cast(item_id as varchar) item from hit) group by all
)
select d.doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
    sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join covered using (doc_id) left join named using (doc_id)
"""


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without any benchmark window, unchanged."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_benchmark(docs, benchmark, prefix="_stage_")
    names = [c for c in found.columns if c.startswith("_stage_")]
    return without(found.filter("not _stage_contaminated"), names)
