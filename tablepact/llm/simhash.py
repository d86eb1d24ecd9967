"""Near-duplicates by SimHash, searched with Burkhard-Keller trees.

Fingerprints at most ``radius`` bits apart agree in whole blocks of bits, so each
tree holds the fingerprints of one shard: those with the same bits in chosen blocks.
A shard's trees and its queries meet by a shuffle; trees are not broadcast, as the
fingerprints of all documents have no size bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from tablepact.llm.batches import append_columns, text_bytes
from tablepact.llm.graph import connected_components
from tablepact.llm.shared import cut

#: Shingles hashed together.
SHINGLES = 1 << 16
#: Distinct fingerprints of one tree; fuller shards are split into a grid of cells.
TREE_SIZE = 20_000
#: Fingerprints searched together, and (query, tree node) pairs looked at together.
BATCH_ROWS, FRONTIER = 200_000, 8_000_000


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, name: str = "fp") -> DataFrame:
    """``docs`` with the SimHash of the text as a signed long.

    Words are what ASCII white space separates, with A-Z lowered. A bit is set if it
    is set in over half of the XXH64 (seed 42) values of the word shingles, repeats
    included. A text of fewer words is one shingle; null or no word gives zero.
    """

    def make():
        from xxhash import xxh64_intdigest

        places = np.arange(64, dtype=np.uint64)

        def one(raw: bytes) -> int:
            words = raw.lower().split()
            if not words:
                return 0
            joined = b" ".join(words)
            ends = list(accumulate(len(w) + 1 for w in words))
            starts, stops = [0, *ends], ends[shingle - 1 :] or ends[-1:]
            votes = np.zeros(64, np.int64)
            for at in range(0, len(stops), SHINGLES):
                bounds = zip(starts[at : at + SHINGLES], stops[at : at + SHINGLES], strict=False)
                hashes = np.array([xxh64_intdigest(joined[s : e - 1], 42) for s, e in bounds], "<u8")
                bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                votes += bits.sum(axis=0, dtype=np.uint32)
            most = votes * 2 > len(stops)
            return int((most.astype(np.uint64) << places).sum(dtype=np.uint64).astype(np.int64))

        return lambda batch: [[one(raw) for raw in text_bytes(batch, text)]]

    return append_columns(docs, text, [StructField(name, LongType())], make)


def _masks(distinct: int, radius: int, width: int = 64) -> list[int]:
    """Bit masks of which every two values within ``radius`` bits agree on at least one.

    ``width`` bits are cut into blocks; of radius + k blocks, some k are untouched.
    The fewest tables are taken whose shards hold 256 values on average or less; the
    result is the same with any.
    """
    for k in range(1, 5):
        edges = [round(i * width / (radius + k)) for i in range(radius + k + 1)]
        blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
        masks = [sum(c) for c in combinations(blocks, k)]
        if distinct <= 256 << min(m.bit_count() for m in masks):
            break
    return masks


def _tree_links(shard: np.ndarray, fp: np.ndarray, role: np.ndarray, radius: int) -> np.ndarray:
    """The row that stands for each row's links: rows within the radius share one.

    Rows of a shard are adjacent. Roles: 0 in the tree and a query, 1 in the tree
    only, 2 a query only. All trees of the batch are built and searched level by
    level together: children are keyed by their distance to the parent, and a search
    follows the edges whose key is within the radius of the distance just found.
    """
    n = len(fp)
    stands = np.arange(n)
    start = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    length = np.diff(np.r_[start, n])
    member = np.flatnonzero(role < 2)
    of = np.repeat(np.arange(len(start)), length)
    first = np.full(len(start), -1)
    first[of[member[::-1]]] = member[::-1]
    root = first[of]

    keys, children = [], []
    at, rest = root[member], member
    at, rest = at[at != rest], rest[at != rest]
    while len(rest):
        edge = at * 65 + np.bitwise_count(fp[rest] ^ fp[at])
        key, head, back = np.unique(edge, return_index=True, return_inverse=True)
        keys.append(key)
        children.append(rest[head])
        at, old = rest[head][back], rest
        rest, at = old[at != old], at[at != old]
    key = np.concatenate([*keys, np.zeros(0, np.int64)])
    child = np.concatenate([*children, np.zeros(0, np.int64)])
    order = np.argsort(key)
    key, child = key[order], child[order]

    queries = np.flatnonzero((role != 1) & (root >= 0) & (length[of] > 1))
    part = np.cumsum(length[of[queries]]) // FRONTIER
    for p in np.split(queries, np.flatnonzero(np.diff(part)) + 1) if len(queries) else []:
        query, node, found = p, root[p], []
        while len(query):
            far = np.bitwise_count(fp[query] ^ fp[node]).astype(np.int64)
            near = (far <= radius) & (query != node)
            found.append((query[near], node[near]))
            low = np.searchsorted(key, node * 65 + np.maximum(far - radius, 0))
            high = np.searchsorted(key, node * 65 + np.minimum(far + radius, 64), side="right")
            count = high - low
            query = np.repeat(query, count)
            skip = np.repeat(np.cumsum(count) - count, count)
            node = child[np.repeat(low, count) + np.arange(len(query)) - skip]
        _unite(stands, *(np.concatenate(x) for x in zip(*found)))
    return stands


def _unite(stands: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Gives the ends of each pair the same, least stand-in."""
    while len(a):
        x, y = stands[a], stands[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(stands, np.maximum(x, y), np.minimum(x, y))
        while (jumped := stands[stands]).tobytes() != stands.tobytes():
            stands[:] = jumped


def hamming_links(values: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) that join all distinct ``fp`` values within ``radius`` bits.

    The links span the same components as all pairs within the radius would, and
    are fewer than the values in each shard. A shard of more than ``TREE_SIZE``
    values is cut into c chunks and its values are sent to the c cells that pair
    their chunk with each chunk, so no task holds more than two chunks.
    """
    masks = _masks(values.count(), radius)
    shards = [
        F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(_signed(m)).alias("k"))
        for i, m in enumerate(masks)
    ]
    keyed = values.select("fp", F.explode(F.array(*shards)).alias("t")).select("fp", "t.i", "t.k")
    large = (
        keyed.groupBy("i", "k").count().filter(F.col("count") > TREE_SIZE)
        .select("i", "k", F.ceil(F.col("count") / TREE_SIZE).cast("int").alias("chunks"))
    )
    other = F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1))
    mine = F.pmod(F.xxhash64("fp", F.lit("chunk")), F.coalesce("chunks", F.lit(1))).cast("int")
    cells = (
        keyed.join(large, ["i", "k"], "left")
        .select("fp", "i", "k", mine.alias("mine"), other.alias("other"))
        .select(
            "fp", "i", "k",
            F.least("mine", "other").alias("x"),
            F.greatest("mine", "other").alias("y"),
            F.when(F.expr("mine = other"), 0).when(F.expr("mine < other"), 1).otherwise(2).alias("role"),
        )
    )
    where = ["i", "k", "x", "y"]
    dealt = cells.repartition(*where).sortWithinPartitions(*where, "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(held: list[np.ndarray]) -> pa.RecordBatch:
            fp, role, shard = held
            stands = _tree_links(shard, fp.view(np.uint64), role, radius)
            moved = np.flatnonzero(stands != np.arange(len(fp)))
            return pa.RecordBatch.from_arrays(
                [pa.array(fp[moved]), pa.array(fp[stands[moved]])], names=["a", "b"]
            )

        last, number, rest = None, 0, [np.zeros(0, np.int64)] * 3
        for batch in batches:
            if not batch.num_rows:
                continue
            got = {n: batch.column(i).to_numpy() for i, n in enumerate(batch.schema.names)}
            ids = np.stack([got[n].astype(np.int64) for n in where])
            new = (np.c_[ids[:, :1] if last is None else last, ids[:, :-1]] != ids).any(axis=0)
            shard = number + np.cumsum(new)
            last, number = ids[:, -1:], shard[-1]
            rest = [np.concatenate(x) for x in zip(rest, (got["fp"], got["role"], shard))]
            if len(rest[0]) >= BATCH_ROWS and (done := np.searchsorted(rest[2], number)):
                yield links([x[:done] for x in rest])
                rest = [x[done:] for x in rest]
        if len(rest[0]):
            yield links(rest)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _signed(mask: int):
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def _classes(docs: DataFrame, key: str, text: str, shingle: int, radius: int) -> DataFrame:
    """(doc_id, fp, class, component_id) of every row; a class is its least fingerprint."""
    plain = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    marked = cut(fingerprints(plain, "text", shingle).drop("text"))
    values = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = connected_components(hamming_links(values.select("fp"), radius))
    named = cut(
        values.join(classes, F.col("fp") == F.col("node"), "left").select(
            "fp", "least", F.coalesce("component", "fp").alias("class")
        )
    )
    least = named.groupBy("class").agg(F.min("least").alias("component_id"))
    return marked.join(named.drop("least").join(least, "class"), "fp")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """(doc_id, fp, component_id): each row's fingerprint and near-duplicate class.

    A class is a connected component of fingerprints within ``radius`` bits, named by
    its smallest key. Empty and null texts have fingerprint zero and are linked like
    any other. Rows with a null key have a class too; it is null where all keys of
    the class are. Repeated rows stay. Other columns are not read.
    """
    return _classes(docs, key, text, shingle, radius).select("doc_id", "fp", "component_id")


def keep_one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """The row of the smallest key of each near-duplicate class, unchanged.

    Of rows that share that key, or all have none, the one with the least
    fingerprint, then text, stays: copies of a row go.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    found = cut(_classes(docs, key, text, shingle, radius))
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    doubtful = kept.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
    if doubtful.isEmpty():
        wanted = kept.select(F.col("doc_id").alias("_kept_doc_id"))
        return docs.join(wanted, F.col(f"`{key}`") == F.col("_kept_doc_id"), "left_semi").select(*names)
    wanted = kept.select(
        F.col("doc_id").alias("_kept_doc_id"),
        F.col("fp").alias("_fp_of_kept"),
        F.col("class").alias("_class"),
    )
    first = Window.partitionBy("_class").orderBy("_fp", F.col(f"`{text}`").asc_nulls_last())
    same = F.col(f"`{key}`").eqNullSafe(F.col("_kept_doc_id")) & (F.col("_fp") == F.col("_fp_of_kept"))
    return (
        fingerprints(docs, text, shingle, "_fp")
        .join(wanted.distinct(), same)
        .withColumn("_first", F.row_number().over(first))
        .filter("_first = 1")
        .select(*names)
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and near-duplicate class."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_document_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate class."""
    return keep_one_of_each(docs)
