"""Hard-negative mining with cover trees over norm-augmented candidates.

Each candidate x gets one more coordinate, sqrt(M^2 - |x|^2), so that all have the norm
M; an anchor q gets 0. Inner products stay as they are, but points near each other now
have like products with q: with c the centre of a tree node and r its covering radius,
all products below it lie in q.c -/+ |q| r.

Candidates are dealt into shards of bounded size by their place in the table, so that
neither a label nor a repeated row fills one. A task builds its shard's trees, one for
each ``TREE`` candidates, and then streams the anchors past them in blocks: a stated
query set against all rows. Both searches work so:

1. positives: the best rows of the anchor's label;
2. negatives: for each anchor and positive, the best rows of other labels whose product
   lies in the window that the positive's product sets.

Each shard gives at most as many rows an anchor and window as are asked for, and the
best of them over all shards are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablepact.llm.shared import cut

#: Entries become floor(STEPS * x) (fixed by the query's definition).
STEPS = 256
#: Candidates of a tree; of a shard at least, and at most.
TREE, LEAST, MOST = 4096, 1024, 1 << 16
#: Ratio of covering radii from level to level, points of a leaf, anchors searched together.
RATIO, LEAF, BLOCK = 1.3, 4, 128
#: Leaves an anchor looks at in its first step, and products taken at once.
FIRST, CHUNK = 16, 1 << 15
#: Stands for a null id, which comes last.
LAST = 2**63 - 1


class CoverTree:
    """A cover tree of the rows of ``points``, augmented to one norm.

    Centres come in the order of a farthest-first traversal: those of a level are the
    prefix that lies further apart than the level's radius, which also covers all points.
    A centre new in a level hangs below the nearest one of the level above. Nodes keep
    the true greatest distance to a point below them. A node with at most ``leaf`` points
    is a leaf, as is one whose points are all alike.
    """

    def __init__(self, points: np.ndarray, ratio: float = RATIO, leaf: int = LEAF):
        n = len(points)
        norms = np.einsum("ij,ij->i", points, points)
        reach = float(np.sqrt(norms.max()))
        full = np.c_[points, np.sqrt(np.maximum(reach**2 - norms, 0))].astype(np.float32)
        apart = full @ full.T  # squared distances, in single precision
        apart *= -2
        apart += np.float32(2 * reach**2)
        np.maximum(apart, 0, out=apart)
        np.fill_diagonal(apart, 0)

        order, gaps, nearest = [0], [np.inf], apart[0].copy()
        while (gap := nearest[at := int(nearest.argmax())]) > 0:
            order.append(at)
            gaps.append(float(gap))
            np.minimum(nearest, apart[at], out=nearest)
        distinct = len(order)
        order = np.r_[order, np.setdiff1d(np.arange(n), order)]
        apart = apart[np.ix_(order, order)]
        gaps = np.sqrt(gaps)

        sizes, radius = [1], float(gaps[1]) if distinct > 1 else 0.0
        while sizes[-1] < distinct:
            radius /= ratio
            if (size := int(np.searchsorted(-gaps, -radius))) > sizes[-1]:
                sizes.append(size)
        up = np.zeros(n, np.int64)
        for low, high in zip(sizes, [*sizes[1:], n]):
            up[low:high] = apart[low:high, :low].argmin(axis=1)
        below = [np.where(np.arange(n) < distinct, np.arange(n), up)]  # the node of each point, by level
        for size in sizes[-2::-1]:
            below.insert(0, np.where(below[0] < size, below[0], up[below[0]]))

        #: For each level: centres and radii of its nodes, the place of each one's parent
        #: in the level above, and which of them are leaves.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        members = []
        slot = np.zeros(1, np.int64)  # the place of each centre in the level's list, -1 below leaves
        for at, (size, node) in enumerate(zip(sizes, below)):
            far = np.zeros(size, np.float32)
            np.maximum.at(far, node, apart[node, np.arange(n)])
            count = np.bincount(node, minlength=size)
            # 1e-5: more than single precision loses of a squared distance
            radii = np.where(count > 1, np.sqrt(far + 1e-5 * reach**2), 1e-9 * reach)
            parent = slot[below[at - 1][:size]] if at else slot
            nodes = np.flatnonzero(parent >= 0)
            small = (count[nodes] <= leaf) | (at + 1 == len(sizes))
            self.levels.append((points[order[nodes]], radii[nodes], parent[nodes], small))
            by, ends = np.argsort(node, kind="stable"), np.cumsum(count)
            members += [order[by[ends[i] - count[i] : ends[i]]] for i in nodes[small]]
            slot = np.full(size, -1)
            slot[nodes[~small]] = np.flatnonzero(~small)
            if small.all():
                break
        #: The points of leaf i, leaves counted level by level, are points[start[i] : start[i + 1]].
        self.start = np.cumsum([0, *map(len, members)])
        self.points = np.concatenate(members)


class Candidates:
    """The candidates of a shard in cover trees."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.largest = float(np.abs(x).max(initial=0))
        parts = max(1, -(-len(x) // TREE))
        self.trees = [
            (rows, CoverTree(x[rows].astype(float))) for rows in np.array_split(np.arange(len(x)), parts) if len(rows)
        ]

    def best(self, ids, labels, q, low, high, same: bool, wanted: int) -> tuple[np.ndarray, ...]:
        """(anchor, window, score, id) of the ``wanted`` best candidates in each window.

        ``low`` and ``high`` bound the windows, a row an anchor. Higher scores come
        first, then smaller ids. Candidates have the anchor's label if ``same``, else
        another one, and always another id.
        """
        windows = low.shape[1]
        valid = np.flatnonzero((low <= high).ravel())
        of, window = valid // windows, valid % windows
        low, high = low.ravel()[valid], high.ravel()[valid]
        reach = np.linalg.norm(q.astype(float), axis=1)
        if q.shape[1] * self.largest * float(np.abs(q).max(initial=0)) >= 2.0**62:
            raise OverflowError("an inner product may not fit a long")
        exact = q.shape[1] * self.largest * float(np.abs(q).max(initial=0)) < 2.0**53
        kind = float if exact else np.int64
        queries, points = q.astype(kind), self.x.astype(kind)
        rows = len(valid)
        score = np.full((rows, wanted), -LAST, np.int64)
        found = np.full((rows, wanted), -1, np.int64)

        for mine, tree in self.trees:
            bound, relevant = self._leaves(tree, q.astype(float), reach, of, low, high, score[:, -1])
            size, width = np.diff(tree.start), FIRST
            while True:
                relevant &= bound >= score[:, -1:]
                near = np.flatnonzero(relevant.any(axis=1))
                if not len(near):
                    break
                if width < relevant.shape[1]:  # the best bounds first
                    held = np.where(relevant[near], -bound[near], np.inf)
                    first = np.argpartition(held, width - 1, axis=1)[:, :width]
                    i, j = np.nonzero(np.isfinite(np.take_along_axis(held, first, axis=1)))
                    query, leaf = near[i], first[i, j]
                else:
                    query, leaf = np.nonzero(relevant)
                relevant[query, leaf] = False
                width *= 4
                count = size[leaf]
                query = np.repeat(query, count)
                skip = np.repeat(np.cumsum(count) - count, count)
                point = mine[tree.points[np.repeat(tree.start[leaf], count) + np.arange(len(query)) - skip]]
                other = (self.labels[point] == labels[of[query]]) == same
                other &= self.ids[point] != ids[of[query]]
                query, point = query[other], point[other]
                for at in range(0, len(query), CHUNK):
                    a, b = query[at : at + CHUNK], point[at : at + CHUNK]
                    s = np.einsum("ij,ij->i", queries[of[a]], points[b]).astype(np.int64)
                    fits = (s >= np.maximum(low[a], score[a, -1])) & (s <= high[a])
                    _keep_best(score, found, a[fits], s[fits], self.ids[b[fits]])
        got = np.nonzero(score > -LAST)
        return of[got[0]], window[got[0]], score[got], found[got]

    @staticmethod
    def _leaves(tree: CoverTree, q, reach, of, low, high, least) -> tuple[np.ndarray, np.ndarray]:
        """For each window and leaf: the highest product it may hold within the window, and whether any.

        Nodes are followed level by level; what lies outside of the window, or below the
        ``least`` that is of use, is not.
        """
        bounds, kept, relevant = [], [], None
        for centres, radii, parent, small in tree.levels:
            middle, spread = q @ centres.T, reach[:, None] * radii
            above = (middle + spread)[of]
            now = above >= np.maximum(low, least)[:, None]
            now &= (middle - spread)[of] <= high[:, None]
            if relevant is not None:
                now &= relevant[:, parent]
            bounds.append(np.minimum(above[:, small], high[:, None]))
            kept.append(now[:, small])
            relevant = now
        return np.hstack(bounds), np.hstack(kept)


def _keep_best(score: np.ndarray, found: np.ndarray, row: np.ndarray, s: np.ndarray, ids: np.ndarray) -> None:
    """Takes new (row, score, id) triples into the best of each row, in place."""
    if not len(row):
        return
    touched, wanted = np.unique(row), score.shape[1]
    row = np.r_[np.repeat(touched, wanted), row]
    s, ids = np.r_[score[touched].ravel(), s], np.r_[found[touched].ravel(), ids]
    order = np.lexsort((ids, -s, row))
    row, s, ids = row[order], s[order], ids[order]
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    rank = np.arange(len(row)) - np.repeat(starts, np.diff(np.r_[starts, len(row)]))
    best = rank < wanted
    score[row[best], rank[best]], found[row[best], rank[best]] = s[best], ids[best]


def _entries(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors' whole numbers; all must have one length."""
    lists = batch.column(batch.schema.get_field_index("vector"))
    sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    if (sizes != sizes[0]).any():
        raise ValueError(f"vectors of {sizes.min()} and of {sizes.max()} entries")
    values = np.floor(STEPS * lists.flatten().to_numpy(zero_copy_only=False).astype(float))
    if np.abs(values).max(initial=0) > 2.0**52:
        raise ValueError("an entry is too large for a whole number of 53 bits")
    return values.astype(np.int64).reshape(len(lists), sizes[0])


def _search(shards: int, candidates: DataFrame, anchors: DataFrame, wanted: int, window: tuple[int, int] | None) -> DataFrame:
    """(a, w, score, id): each shard's best candidates of each anchor ``a`` and window ``w``.

    Without a window, candidates have the anchor's label. Else ``anchors`` has an array
    ``scores``, and window w holds the products from window[0] to window[1] percent of
    scores[w], of other labels.
    """
    none = F.lit(None)
    scores = F.col("scores") if window else F.array(F.lit(0).cast("long"))
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "a", "id", "label", "vector", scores.alias("scores")
    )
    offered = candidates.select(
        "shard", none.cast("long").alias("a"), "id", "label", "vector", none.cast("array<bigint>").alias("scores")
    )
    dealt = offered.union(asked).repartition("shard").sortWithinPartitions("shard", F.col("a").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, tree = None, [], None

        def column(name: str) -> np.ndarray:
            return np.concatenate([b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False) for b in held])

        def build() -> Candidates:
            x = [_entries(b) for b in held]
            if len({len(v[0]) for v in x}) > 1:
                raise ValueError("vectors of several lengths")
            return Candidates(column("id"), column("label"), np.concatenate(x))

        def answer(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists = batch.column(batch.schema.get_field_index("scores"))
            sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            low = np.ones((len(sizes), sizes.max()), np.int64)
            high = np.zeros_like(low)
            at = np.arange(low.shape[1]) < sizes[:, None]
            given = lists.flatten().to_numpy(zero_copy_only=False)
            if window:
                hundreds, rest = given // 100, given % 100  # so that nothing overflows
                low[at] = window[0] * hundreds - (-window[0] * rest) // 100
                high[at] = window[1] * hundreds + (window[1] * rest) // 100
            else:
                low[at], high[at] = 1 - LAST, LAST
            names = {n: batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in ("a", "id", "label")}
            q = _entries(batch)
            if q.shape[1] != tree.x.shape[1]:
                raise ValueError(f"vectors of {q.shape[1]} and of {tree.x.shape[1]} entries")
            of, w, s, ids = tree.best(names["id"], names["label"], q, low, high, window is None, wanted)
            return pa.RecordBatch.from_arrays(
                [pa.array(names["a"][of]), pa.array(w.astype(np.int32)), pa.array(s), pa.array(ids)], names=["a", "w", "score", "id"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            number = batch.column(0).to_numpy()
            kind = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (kind[1:] != kind[:-1])])
            for start, end in zip(edges, [*edges[1:], batch.num_rows]):
                part = batch.slice(start, end - start)
                if number[start] != shard:
                    shard, held, tree = number[start], [], None
                if not kind[start]:
                    held.append(part)
                    continue
                if held:
                    tree, held = build(), []
                for at in range(0, part.num_rows if tree else 0, BLOCK):
                    yield answer(part.slice(at, BLOCK))

    return dealt.mapInArrow(run, "a long, w int, score long, id long")


def _first(found: DataFrame, by: list[str], wanted: int) -> DataFrame:
    """The best rows of each group, numbered from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)


def hard_negatives(
    df: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose key is divisible by ``every``. Entries count as
    floor(256 * x), scores are integer inner products with the anchor; higher ones come
    first, then smaller keys. Positives are an anchor's best rows of its label, negatives
    the best of other labels with a score from ``low`` to ``high`` percent of the positive's.

    Rows with a null label, a null vector, or a null or non-finite entry take no part.
    Rows without a key are candidates, named null, that come last among ties. A row with
    the anchor's key is no candidate of it; repeated candidates each count, equal anchor
    rows are answered once. Tied rows of one key are in any order, as they show the same.
    Labels are whole numbers. Vectors of several lengths, entries over 2**52 and products
    that don't fit a long are errors; long vectors need more memory, about 4,096 of them
    twice a task. An empty table, or one without anchors, positives or negatives, gives
    no rows. Other columns, whatever their names, and texts aren't read.
    """
    spark = df.sparkSession
    finite = F.forall(F.col(f"`{vector}`"), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = df.filter(F.col(f"`{label}`").isNotNull() & F.col(f"`{vector}`").isNotNull() & finite).select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LAST)).alias("id"),
        F.col(f"`{label}`").cast("long").alias("label"),
        F.col(f"`{vector}`").alias("vector"),
    )
    total = rows.count()
    shards = max(1, -(-total // min(MOST, max(LEAST, total // 64))))
    candidates = rows.withColumn(
        "shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    )
    distinct = rows.filter((F.col("id") % every == 0) & (F.col("id") != LAST)).distinct()
    anchors = cut(cut(distinct).withColumn("a", F.monotonically_increasing_id()))
    best = _first(_search(shards, candidates, anchors, positives, None), ["a"], positives)
    chosen = cut(best.select("a", (F.col("rank") - 1).alias("w"), "id", "score"))
    lists = chosen.groupBy("a").agg(F.transform(F.sort_array(F.collect_list(F.struct("w", "score"))), lambda x: x["score"]).alias("scores"))
    found = _search(shards, candidates, anchors.join(lists, "a"), negatives, (low, high))

    def named(column: str):
        return F.when(F.col(column) != LAST, F.col(column))

    return (
        _first(found, ["a", "w"], negatives)
        .select("a", "w", "rank", F.col("id").alias("negative"), F.col("score").alias("negative_score"))
        .join(chosen.select("a", "w", F.col("id").alias("positive"), F.col("score").alias("positive_score")), ["a", "w"])
        .join(anchors.select("a", F.col("id").alias("anchor_id")), "a")
        .select(
            "anchor_id", named("positive").alias("positive_id"), "rank", named("negative").alias("negative_id"),
            "positive_score", "negative_score",
        )
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three negatives of other labels for each anchor and positive, some rows relabelled first."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table.select("vec_id", "embedding", changed.alias("label")))


SQL = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select a.vec_id as anchor_id, a.label as own, a.v as q, c.vec_id, c.label,
         coalesce(list_inner_product(a.v, c.v), 0)::bigint as score
  from (select distinct * from rows where vec_id % 50 = 0) a
  join rows c on c.vec_id is distinct from a.vec_id
), positives as (
  select anchor_id, own, q, vec_id as positive_id, score as positive_score,
         row_number() over (partition by anchor_id, own, q order by score desc, vec_id nulls last) as place
  from pairs where label = own
  qualify place <= 5
)
select p.anchor_id, p.positive_id,
       row_number() over (partition by p.anchor_id, p.own, p.q, p.place
                          order by n.score desc, n.vec_id nulls last)::int as rank,
       n.vec_id as negative_id, p.positive_score, n.score as negative_score
from positives p join pairs n on n.anchor_id = p.anchor_id and n.own = p.own and n.q = p.q
where n.label <> p.own and 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score
qualify rank <= 3
"""
