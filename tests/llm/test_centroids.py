"""Ball-tree clustering against plain rounds over all pairs."""

import hashlib
import math

import numpy as np
import pyspark.sql.functions as F
import pytest

from wellfield.llm import centroids as C
from wellfield.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, distance string, n long, vector string"


def plain(data, k=40, rounds=5, dim=64, scale=256, seed="2"):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in data if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    drawn = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    centres = [v for _, v in drawn]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda: [min((gap(v, c), j) for j, c in enumerate(centres)) for _, v in kept]
    for _ in range(rounds):
        found = nearest()
        for j in range(len(centres)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == j]
            if own:
                centres[j] = [sum(column) // len(own) for column in zip(*own)]
    found = nearest()
    total, sums = sum(d for d, _ in found), [sum(d for d, c in found if c == j) for j in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, sums[c], total, digest[c]) for (i, _), (d, c) in zip(kept, found)), key=str)


def frame(spark, data):
    return spark.createDataFrame([(i, v, 1, 2, "x", 3, "y") for i, v in data], SCHEMA).repartition(3)


def check(spark, data, **options):
    assert sorted(map(tuple, C.centroid_clusters(frame(spark, data), **options).collect()), key=str) == plain(data, **options)


def vectors(n, dim, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(5, dim)) * spread
    return [(k, [float(np.float32(x)) for x in middle[k % 5] + rng.normal(size=dim) / 8]) for k in range(n)]


def awkward(dim):
    nan, inf = float("nan"), float("inf")
    odd = [(200, None), (201, []), (202, [1.0] * (dim - 1)), (203, [1.0] * (dim + 1)), (204, [nan] + [0.0] * (dim - 1)), (205, [inf] + [0.0] * (dim - 1)), (206, [None] + [0.0] * (dim - 1)), (207, [-inf] * dim)]
    ties = [(None, [0.5] * dim), (None, [0.25] * dim), (7, [0.5] * dim), (7, [-0.5] * dim)] + [(300 + k, [0.001] * dim) for k in range(80)]
    return vectors(120, dim, 3) + odd + ties


@pytest.mark.parametrize("k", [1, 4, 12, 1000])
def test_clusters_match_the_plain_version(spark, k):
    check(spark, awkward(4), k=k, rounds=4, dim=4, scale=8)


def test_few_ties_decide_by_number(spark):
    """Points between two centroids, many times over: all go to the first."""
    check(spark, [(k, [float(k % 3 - 1), 0.0]) for k in range(90)], k=3, rounds=3, dim=2, scale=2)


def test_small_trees_and_leaves(spark, monkeypatch):
    monkeypatch.setattr(C, "TREE", 17)
    monkeypatch.setattr(C, "LEAF", 2)
    check(spark, awkward(3), k=6, rounds=3, dim=3, scale=16)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(1)
    check(spark, [(k, [float(np.float32(x)) for x in rng.normal(size=4) * 1e5]) for k in range(60)], k=5, rounds=3, dim=4)


def test_components_out_of_range_are_refused(spark):
    with pytest.raises(Exception, match="out of range"):
        C.centroid_clusters(frame(spark, [(1, [1e30] * 4)]), dim=4).collect()


def test_empty_tables(spark):
    assert C.centroid_clusters(frame(spark, [(1, [1.0])]).limit(0)).collect() == []
    assert C.centroid_clusters(frame(spark, [(1, [1.0])])).collect() == []


def test_query(spark):
    data = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_centroid_clustering"](spark, SF).collect()), key=str) == plain(data)


def test_balls_cover_their_vectors_and_are_given_away_whole():
    rng = np.random.default_rng(5)
    points = (rng.normal(size=(6, 8))[rng.integers(0, 6, 4000)] * 400 + rng.normal(size=(4000, 8)) * 4).astype(np.int64)
    tree, order = C.BallTree.build(points)
    assert (tree.vectors == points[order]).all() and sorted(order) == list(range(4000))
    for ball in range(len(tree.left)):
        own = tree.vectors[tree.firsts[ball] : tree.firsts[ball] + tree.counts[ball]]
        assert (own.sum(0) == tree.sums[ball]).all()
        assert np.sqrt(((own - own.mean(0)) ** 2).sum(1)).max() <= tree.radius[ball]
    centres = points[:6]
    seen = []
    whole = C.exact_squares
    C.exact_squares, keep = (lambda a, b: seen.append(len(a)) or whole(a, b)), whole
    try:
        cluster, totals, sizes = tree.assign(centres)
    finally:
        C.exact_squares = keep
    want = whole(tree.vectors, centres).argmin(1)
    assert (cluster == want).all()
    assert (sizes == np.bincount(want, minlength=6)).all() and (totals == np.stack([tree.vectors[want == j].sum(0) for j in range(6)])).all()
    assert sum(seen) < 4000  # some balls went to a centroid without a look at their vectors


def test_equal_vectors_are_one_ball():
    tree, _ = C.BallTree.build(np.full((5000, 3), 7))
    assert len(tree.left) == 1 and tree.counts[0] == 5000
    assert (tree.assign(np.array([[9, 9, 9], [6, 6, 6], [6, 6, 6]]))[0] == 1).all()


def test_rounds_move_only_sums(spark):
    trees = frame(spark, vectors(50, 2, 1)).select("vec_id", F.transform("embedding", lambda x: F.floor(x)).alias("vector")).mapInArrow(lambda b: C._trees(b, 2), C.TREES)
    assert C.moved(trees, np.zeros((1, 2), np.int64)).shape == (1, 2)
