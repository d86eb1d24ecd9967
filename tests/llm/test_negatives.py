"""Hard negatives and their cover trees against plain search."""

import numpy as np
import pytest

from tablepact.llm import negatives
from tablepact.llm.negatives import Candidates, CoverTree, hard_negatives, op13_hard_negatives

TABLE = "vec_id long, embedding array<float>, label int"


def plain(rows, every=50, positives=5, wanted=3, low=50, high=95):
    """All results by comparing each anchor with each row."""
    rows = [
        (i, [int(np.floor(256 * float(np.float32(c)))) for c in v], y)
        for i, v, y in rows
        if v is not None and y is not None and all(c is not None and np.isfinite(c) for c in v)
    ]
    out, seen = [], set()

    def order(x):
        return -x[0], x[1] is None, x[1] or 0

    for i, q, y in rows:
        if i is None or i % every or (i, tuple(q), y) in seen:
            continue
        seen.add((i, tuple(q), y))
        scored = [(sum(a * b for a, b in zip(q, v)), j, z) for j, v, z in rows if j != i]
        for s, j, _ in sorted((x for x in scored if x[2] == y), key=order)[:positives]:
            fits = (x for x in scored if x[2] != y and low * s <= 100 * x[0] <= high * s)
            for rank, (t, k, _) in enumerate(sorted(fits, key=order)[:wanted], 1):
                out.append((i, j, rank, k, s, t))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def clustered(n, dims=8, seed=0, centres=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    of = rng.integers(centres, size=n)
    return [(i, (middle[c] + 0.2 * rng.normal(size=dims)).tolist(), int(c % 5)) for i, c in enumerate(of)]


@pytest.mark.parametrize("shape", ["clustered", "even", "copies", "one", "line"])
def test_cover_tree_covers_separates_and_nests(shape):
    rng = np.random.default_rng(4)
    points = {
        "clustered": np.array([v for _, v, _ in clustered(400)]),
        "even": rng.normal(size=(300, 16)),
        "copies": np.repeat(rng.normal(size=(7, 4)), 30, axis=0),
        "one": np.ones((1, 3)),
        "line": np.c_[np.arange(200.0), np.zeros(200)],
    }[shape]
    tree = CoverTree(points)
    assert sorted(tree.points.tolist()) == list(range(len(points)))
    reach = np.sqrt((points**2).sum(axis=1).max())
    full = np.c_[points, np.sqrt(np.maximum(reach**2 - (points**2).sum(axis=1), 0))]
    leaf = 0
    path: list[list[int]] = []
    held = []
    for centres, radii, parent, small in tree.levels:
        path.append(parent.tolist())
        held.append({})
        for i in np.flatnonzero(small):
            held[-1][i] = tree.points[tree.start[leaf] : tree.start[leaf + 1]].tolist()
            leaf += 1
    assert leaf == len(tree.start) - 1
    for level in range(len(held) - 1, 0, -1):  # what is below a node, from its leaves up
        for i, points_below in held[level].items():
            held[level - 1].setdefault(path[level][i], []).extend(points_below)
    for (centres, radii, _, _), below in zip(tree.levels, held):
        assert len(below) == len(centres)
        own = np.c_[centres, np.sqrt(np.maximum(reach**2 - (centres**2).sum(axis=1), 0))]
        for i, members in below.items():
            assert np.linalg.norm(full[members] - own[i], axis=1).max() <= radii[i] + 1e-6 * reach
            assert (np.abs(points[members] - centres[i]).sum(axis=1) == 0).any()


def test_descent_skips_most_of_clustered_data():
    rows = clustered(2000, dims=8, centres=40)
    x = np.array([np.floor(256 * np.array(v)) for _, v, _ in rows]).astype(np.int64)
    held = Candidates(np.arange(2000), np.array([y for _, _, y in rows]), x)
    tree = held.trees[0][1]
    q = x[:20]
    score = np.sort(q @ x.T, axis=1)[:, -5]
    _, relevant = held._leaves(
        tree, q.astype(float), np.linalg.norm(q, axis=1), np.arange(20), np.full(20, -(10**9)), np.full(20, 10**9), score
    )
    assert relevant.mean() < 0.3


def test_query_on_a_table(spark, tiny):
    rows = clustered(400, seed=1)
    rows += [(50, rows[50][1], rows[50][2]), (None, rows[3][1], 1), (None, rows[9][1], 2), (401, None, 1), (402, rows[0][1], None)]
    rows += [(403, [None] + rows[0][1][1:], 1), (404, [float("nan")] + rows[0][1][1:], 1), (405, [float("inf")] + rows[0][1][1:], 1)]
    rows += [(500, rows[60][1], rows[60][2]), (500, rows[61][1], rows[61][2])]
    frame = spark.createDataFrame(rows, TABLE).repartition(3)
    relabelled = [(i, v, (y + 1) % 10 if i is not None and y is not None and i % 7 == 0 else y) for i, v, y in rows]
    got = rows_of(op13_hard_negatives(spark, tiny(frame, embeddings=frame)))
    assert got == plain(relabelled) and len(got) > 50


def test_many_shards_trees_and_blocks(spark, monkeypatch):
    for name, value in (("LEAST", 40), ("TREE", 16), ("BLOCK", 3), ("CHUNK", 50), ("FIRST", 2)):
        monkeypatch.setattr(negatives, name, value)
    rows = clustered(300, seed=2)
    got = rows_of(hard_negatives(spark.createDataFrame(rows, TABLE).repartition(4), every=10))
    assert got == plain(rows, every=10)


def test_ties_and_copies(spark):
    rng = np.random.default_rng(3)
    kinds = [rng.integers(-2, 3, size=4).astype(float).tolist() for _ in range(3)]
    rows = [(i, kinds[i % 3], i % 4 % 2) for i in range(200)] + [(7, kinds[1], 1)] * 5
    assert rows_of(hard_negatives(spark.createDataFrame(rows, TABLE), every=20)) == plain(rows, every=20)


def test_zero_and_negative_scores(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [-1.0, 0.0], 1), (3, [0.0, 2.0], 2), (4, [-0.6, 0.0], 2), (5, [0.0, 0.0], 3)]
    assert rows_of(hard_negatives(spark.createDataFrame(rows, TABLE))) == plain(rows)


def test_large_products_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-(2**21), 2**21, size=3)).astype(float).tolist(), i % 2) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert rows_of(hard_negatives(frame, every=5)) == plain(rows, every=5)


def test_empty_and_lone(spark):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    for rows in ([], [(0, None, 1)], [(0, [1.0], 1)], [(0, [], 1), (1, [], 1), (2, [], 2)], [(1, [1.0], 1), (2, [1.0], 2)]):
        got = hard_negatives(spark.createDataFrame(rows, TABLE))
        assert got.columns == names
        assert rows_of(got) == plain(rows)


def test_lengths_and_sizes_that_cannot_be(spark):
    with pytest.raises(Exception, match="vectors of"):
        hard_negatives(spark.createDataFrame([(0, [1.0], 1), (1, [1.0, 2.0], 1)], TABLE)).collect()
    with pytest.raises(Exception, match="too large"):
        hard_negatives(spark.createDataFrame([(0, [1e30], 1), (1, [1e30], 1)], TABLE)).collect()


def test_clashing_columns(spark):
    rows = clustered(60, seed=6)
    frame = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], TABLE + ", a int, Shard string, rank double")
    assert rows_of(hard_negatives(frame, every=7)) == plain(rows, every=7)
