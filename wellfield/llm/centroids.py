"""Centroid clustering of integer vectors, filtered by metric trees that stay with their partitions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import pack, unpack
from .common import Scratch

#: Vectors of one tree, and of one leaf, at most.
TREE, LEAF = 1 << 14, 24
#: Components beyond this are refused: squared distances of 64 of them would leave a long.
MOST = (1 << 27) - 1
TREES = "ids binary, known binary, vectors binary, firsts binary, counts binary, left binary, radius binary, sums binary"
NAMES = [c.split()[0] for c in TREES.split(", ")]


def exact_squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """All squared distances of whole-number vectors, exact. Floats serve where no sum reaches 2^53; longs for the rest,
    one centre at a time."""
    most = int(max(np.abs(points).max(initial=0), np.abs(centres).max(initial=0)))
    if points.shape[1] * (2 * most) ** 2 < 1 << 53:
        a, b = points.astype(np.float64), centres.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    out = np.empty((len(points), len(centres)), np.int64)
    for k, centre in enumerate(centres):
        out[:, k] = ((points - centre) ** 2).sum(1)
    return out


class BallTree:
    """Balls over the vectors of one partition: each holds a stretch of the (reordered) vectors, the centre of which is
    their sum over their count; radius bounds the distance to any of them. A ball with children has them at left and
    left + 1; a leaf has 0 there. Balls are numbered level by level."""

    def __init__(self, vectors, firsts, counts, left, radius, sums):
        self.vectors, self.firsts, self.counts, self.left, self.radius, self.sums = vectors, firsts, counts, left, radius, sums

    @classmethod
    def build(cls, vectors: np.ndarray) -> tuple["BallTree", np.ndarray]:
        """The tree, and the order that its vectors have. A ball is halved between two far vectors; one whose vectors
        are all equal stays whole, however many they are."""
        order = np.arange(len(vectors))
        balls, at = [(0, len(vectors))] if len(vectors) else [], 0
        left, radius, sums = [], [], []
        while at < len(balls):
            a, b = balls[at]
            own = vectors[order[a:b]]
            total = own.sum(0)
            gap = ((own - total / (b - a)) ** 2).sum(1)
            sums.append(total)
            radius.append(np.sqrt(gap.max()) * (1 + 1e-9) + 1e-6)
            left.append(0)
            if b - a > LEAF and (own != own[0]).any():
                one = own[gap.argmax()].astype(np.float64)
                far = ((own - one) ** 2).sum(1)
                side = own @ (own[far.argmax()] - one)
                middle = np.argsort(side, kind="stable")
                order[a:b] = order[a:b][middle]
                cut = a + (b - a) // 2
                left[at] = len(balls)
                balls += [(a, cut), (cut, b)]
            at += 1
        firsts, ends = np.array(balls, np.int64).reshape(-1, 2).T
        return cls(vectors[order], firsts, ends - firsts, np.array(left, np.int64), np.array(radius), np.array(sums, np.int64).reshape(-1, vectors.shape[1])), order

    def assign(self, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest centre of every vector (of equally near ones the first), and for each centre the sum and the count
        of its vectors.

        A ball whose centre lies nearer to one of `centres` than to any other by more than twice its radius goes to it
        whole. Else its halves are looked at, with only the centres that are left; a leaf's vectors are compared with
        all of these exactly. Bounds are widened past rounding, so no centre that ties is ever left out."""
        cluster = np.full(len(self.vectors), -1, np.int64)
        totals, sizes = np.zeros(centres.shape, np.int64), np.zeros(len(centres), np.int64)
        balls = np.zeros(min(1, len(self.left)), np.int64)
        open_ = np.ones((len(balls), len(centres)), bool)
        there = centres.astype(np.float64)
        while len(balls):
            mean = self.sums[balls] / self.counts[balls, None]
            squares = (mean * mean).sum(1)[:, None] - 2 * (mean @ there.T) + (there * there).sum(1)
            slack = 1e-9 * ((mean * mean).sum(1)[:, None] + (there * there).sum(1)) + 1e-6
            low, high = np.sqrt(np.maximum(squares - slack, 0)), np.sqrt(np.maximum(squares, 0) + slack)
            reach = np.where(open_, high, np.inf).min(1) + 2 * self.radius[balls]
            open_ &= low <= reach[:, None]
            sole = open_.sum(1) == 1
            whole, owner = balls[sole], open_[sole].argmax(1)
            np.add.at(totals, owner, self.sums[whole])
            np.add.at(sizes, owner, self.counts[whole])
            for ball, k in zip(whole, owner):
                cluster[self.firsts[ball] : self.firsts[ball] + self.counts[ball]] = k
            self._leaves(balls[~sole & (self.left[balls] == 0)], centres, cluster, totals, sizes)
            inner = ~sole & (self.left[balls] > 0)
            balls, open_ = (self.left[balls[inner]][:, None] + np.arange(2)).ravel(), np.repeat(open_[inner], 2, axis=0)
        return cluster, totals, sizes

    def _leaves(self, leaves, centres, cluster, totals, sizes) -> None:
        if len(leaves):
            counts = self.counts[leaves]
            at = np.repeat(self.firsts[leaves] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            cluster[at] = exact_squares(self.vectors[at], centres).argmin(1)
            np.add.at(totals, cluster[at], self.vectors[at])
            sizes += np.bincount(cluster[at], minlength=len(centres))


def _trees(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    for batch in _joined(batches):
        ids, flat = batch.column("vec_id").combine_chunks(), batch.column("vector").combine_chunks()
        vectors = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        tree, order = BallTree.build(vectors)
        known, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
        row = (ids[order], known[order], tree.vectors.astype(np.int32), tree.firsts, tree.counts, tree.left, tree.radius, tree.sums)
        yield pa.RecordBatch.from_arrays([pa.array([pack(np.ascontiguousarray(x).tobytes())], pa.binary()) for x in row], NAMES)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, TREE):
            held.append(batch.slice(at, TREE))
            n += held[-1].num_rows
            if n >= TREE:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _read(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, np.ndarray, BallTree]]:
    for batch in batches:
        for row in batch.to_pylist():
            part = lambda name, kind: np.frombuffer(unpack(row[name]), kind)  # noqa: E731, B023
            tree = BallTree(part("vectors", np.int32).reshape(-1, dim).astype(np.int64), part("firsts", np.int64), part("counts", np.int64), part("left", np.int64), part("radius", np.float64), part("sums", np.int64).reshape(-1, dim))
            yield part("ids", np.int64), part("known", bool), tree


def _whole(dim: int, scale: int) -> Column:
    """The vector as whole numbers, null where it isn't kept."""
    x = F.col("embedding").cast("array<double>")
    fine = (F.size(x) == dim) & F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    small = lambda v: F.when(F.abs(v) <= MOST, F.floor(v)).otherwise(F.raise_error(F.concat(F.lit("component out of range: "), v.cast("string"))).cast("long"))
    return F.when(fine, F.transform(x, lambda v: small(v * scale).cast("long")))


def centroid_clusters(vectors: DataFrame, *, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: str = "2") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are the rows of vectors (vec_id, embedding) with exactly `dim` components, none null, infinite or not a number;
    a component x becomes floor(scale * x). The k kept vectors with the smallest SHA-256 of `seed:vec_id` are the first
    centroids, in that order. Each round gives every vector to the nearest centroid, of equally near ones to the
    first, and moves every centroid that has vectors to the exact floor of their mean. A last assignment follows.

    Each partition builds trees over up to TREE of its vectors once; they are written and stay as they are. A round
    sends the centroids (k * dim whole numbers) to the trees and gets their sums and counts back, added up by cluster on
    the way; so nothing is shuffled but k rows per task, and equal vectors, however many, are one ball of radius 0.

    A null vec_id is hashed as an empty one; rows with one vec_id are vectors of their own, ordered by their components
    where their hashes are equal. With fewer than k kept vectors there are so many centroids; an empty table gives no
    rows. Components beyond 2^27 after scaling end the query with an error, as distances would leave a long. Other
    columns are ignored.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "centroids")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), _whole(dim, scale).alias("vector")).where(F.col("vector").isNotNull())
    drawn = rows.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)).orderBy("h", "vector").limit(k)
    centres = np.array([r["vector"] for r in drawn.select("vector").collect()], np.int64).reshape(-1, dim)  # k rows at most
    with scratch.small_batches(4096):
        trees = scratch.put("trees", rows.mapInArrow(lambda batches: _trees(batches, dim), TREES), "uncompressed")
    with scratch.small_batches(1):
        for _ in range(rounds if len(centres) else 0):
            centres = moved(trees, centres)
        found = scratch.put("found", trees.mapInArrow(_assigner(centres), "vec_id long, cluster int, distance long"))
    scratch.drop("trees")
    return _told(spark, found, centres)


def moved(trees: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    dim = centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, tree in _read(batches, dim):
            _, totals, sizes = tree.assign(centres)
            some = np.flatnonzero(sizes)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(sizes[some]), *(pa.array(totals[some, j]) for j in range(dim))], ["cluster", "n", *(f"x{j}" for j in range(dim))])

    sums = trees.mapInArrow(run, "cluster int, n long, " + ", ".join(f"x{j} long" for j in range(dim))).groupBy("cluster")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", *(f"x{j}" for j in range(dim)))]
    new = centres.copy()
    for row in sums.agg(*wide).collect():  # a row per centroid
        new[row["cluster"]] = [int(row[f"x{j}"]) // int(row["n"]) for j in range(dim)]
    return new


def _assigner(centres: np.ndarray):
    dim = centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, known, tree in _read(batches, dim):
            cluster, _, _ = tree.assign(centres)
            distance = ((tree.vectors - centres[cluster]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([pa.array(ids, mask=~known), pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return run


def _told(spark: SparkSession, found: DataFrame, centres: np.ndarray) -> DataFrame:
    """found, with the inertia of its clusters and of all, and the centroids' digests: a row per centroid meets it."""
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total, digest = sum(int(r["s"]) for r in sums), lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    lines = [(r["cluster"], int(r["s"]), total, digest(centres[r["cluster"]])) for r in sums]
    known = spark.createDataFrame(lines, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
