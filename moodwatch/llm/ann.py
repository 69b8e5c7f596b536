"""Approximate nearest neighbours by low-dimensional stable projections and kd-trees.

Vectors are projected on ``DIMENSIONS`` random directions with normal components.  For two
vectors at distance d the squared projected distance over d squared is chi-square with
that many degrees of freedom.  A search takes projected neighbours in ascending order from
a kd-tree, verifies them on the original vectors, and stops when a vector nearer than the
current k-th best would, with probability ``CERTAINTY``, have come up already.

The index is two-level.  The splits of the upper tree are fitted on a bounded sample; every
vector falls into one of its cells.  A cell is dealt in chunks of bounded size, and each
chunk builds its own tree of small leaves.  A query first searches its own cell; the k-th
distance found there tells, by the same test, which other cells it must look into.

Equal vectors are one point with its smallest ids, so copies cost nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodwatch.llm.common import stored

DIMENSIONS, CERTAINTY, SEED = 16, 0.95, 42
#: vectors whose projections the cells are fitted on; a cell needs at least SAMPLE_CELL of them
SAMPLE, SAMPLE_CELL = 20_000, 8
#: points of a chunk and of a leaf
CHUNK, LEAF = 4096, 256


def chi_square_quantile(p: float, m: int) -> float:
    """The quantile for an even number of degrees of freedom (the tail is a Poisson sum)."""
    def below(x: float) -> float:
        term, total = 1.0, 0.0
        for i in range(m // 2):
            total += term
            term *= x / 2 / (i + 1)
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 100.0 * m
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


#: stop at projected distances whose square is over this times the square of the k-th best
STOP = chi_square_quantile(CERTAINTY, DIMENSIONS)


def directions(size: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, DIMENSIONS))


def fit_cells(points: np.ndarray, cells: int) -> list[tuple[int, float, int, int]]:
    """Upper tree over projected ``points``: nodes (dimension, value, left, right); a leaf is
    (-1, 0, cell, 0).  Splits at medians of the widest dimension."""
    nodes: list[tuple[int, float, int, int]] = []
    number = 0

    def split(rows: np.ndarray, wanted: int) -> int:
        nonlocal number
        at = len(nodes)
        nodes.append((-1, 0.0, number, 0))
        spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) else np.zeros(DIMENSIONS)
        if wanted < 2 or len(rows) < 2 * SAMPLE_CELL or not spread.max():
            number += 1
            return at
        d = int(spread.argmax())
        value = float(np.median(rows[:, d]))
        left = rows[:, d] <= value
        if left.all():
            left = rows[:, d] < value
            value = float(np.nextafter(value, -np.inf))
        nodes[at] = (d, value, split(rows[left], wanted // 2), split(rows[~left], wanted - wanted // 2))
        return at

    split(points, cells)
    return nodes


def cells_of(nodes: list[tuple[int, float, int, int]], points: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), np.int64)

    def descend(at: int, rows: np.ndarray) -> None:
        d, value, left, right = nodes[at]
        if d < 0:
            out[rows] = left
            return
        low = points[rows, d] <= value
        descend(left, rows[low])
        descend(right, rows[~low])

    descend(0, np.arange(len(points)))
    return out


class Tree:
    """Leaves of a kd-tree over the projections of a chunk."""

    def __init__(self, vectors: np.ndarray, projected: np.ndarray):
        self.vectors, self.projected = vectors, projected
        self.leaves: list[np.ndarray] = []
        todo = [np.arange(len(vectors))]
        while todo:
            rows = todo.pop()
            spread = np.ptp(projected[rows], axis=0)
            if len(rows) <= LEAF or not spread.max():
                self.leaves.append(rows)
                continue
            d, half = int(spread.argmax()), len(rows) // 2
            order = np.argpartition(projected[rows, d], half)
            todo += [rows[order[:half]], rows[order[half:]]]
        self.low = np.array([projected[r].min(axis=0) for r in self.leaves])
        self.high = np.array([projected[r].max(axis=0) for r in self.leaves])

    def search(self, vector: np.ndarray, projected: np.ndarray, k: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """(distances, rows) of the k nearest found within ``bound``, if the k-th of all is within it."""
        gaps = box_distance(projected, self.low, self.high)
        order = np.argsort(gaps)
        best, rows, limit = np.empty(0), np.empty(0, np.int64), bound
        for leaf in order:
            if gaps[leaf] > STOP * bound * bound:
                break
            at = self.leaves[leaf]
            if np.isfinite(bound):
                near = ((self.projected[at] - projected) ** 2).sum(axis=1) <= STOP * bound * bound
                at = at[near]
                if not len(at):
                    continue
            found = np.sqrt(((self.vectors[at] - vector) ** 2).sum(axis=1))
            best, rows = np.concatenate([best, found]), np.concatenate([rows, at])
            if len(best) > k:
                keep = np.argpartition(best, k - 1)[:k]
                keep = np.flatnonzero(best <= best[keep].max())  # ties of the last stay
                best, rows = best[keep], rows[keep]
            if len(best) >= k:
                bound = min(bound, float(np.partition(best, k - 1)[k - 1]))
        near = best <= limit
        return best[near], rows[near]


def box_distance(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of a point to boxes."""
    return (np.maximum(np.maximum(low - point, point - high), 0) ** 2).sum(axis=1)


def _usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its k nearest rows of ``vectors``
    with another id, nearest first, ties to the smaller id; all if there are fewer.

    Vectors that are null, zero, or hold a null or non-finite component take no part, nor do rows
    with a null id.  Vectors of each length are searched among their own.  Equal rows count
    once; of different query rows with one id the smallest vector is the query."""
    spark = vectors.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    valid = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v")).where(
        F.col("vec_id").isNotNull() & _usable(F.col("v")))
    asked = queries.select(F.col(id_col).cast("long").alias("query_id"), vector.alias("v")).where(
        F.col("query_id").isNotNull() & _usable(F.col("v")))
    asked = stored(asked.groupBy("query_id").agg(F.min("v").alias("v")), "queries")
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for row in asked.select(F.size("v").alias("n")).distinct().orderBy("n").collect():  # usually one length
        size = F.size("v") == row.n
        out = out.unionByName(_nearest_of(valid.where(size), asked.where(size), row.n, k))
    return out


def _nearest_of(valid: DataFrame, asked: DataFrame, size: int, k: int) -> DataFrame:
    """:func:`nearest` over usable vectors of one length; ``asked`` is unique on query_id."""
    spark = valid.sparkSession
    # k + 1 smallest ids of each vector: more are never needed, one may be the query's own.  The
    # limit is applied before the shuffle too, so a vector that a third of the rows share is few rows
    own = Window.partitionBy("v").orderBy("vec_id")
    few = valid.withColumn("turn", F.dense_rank().over(own)).where(F.col("turn") <= k + 1)
    points = stored(few.groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")), "points")
    plane = directions(size)
    count = points.count()
    sample = points.select("v", F.xxhash64("v").alias("h")).orderBy("h").limit(SAMPLE).select("v").toArrow()
    nodes = fit_cells(_matrix(sample.column("v").combine_chunks()) @ plane, max(1, min(-(-2 * count // CHUNK), SAMPLE // SAMPLE_CELL)))

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p = _matrix(b.column(0)) @ plane
                flat = pa.ListArray.from_arrays(np.arange(0, p.size + 1, DIMENSIONS, dtype=np.int32), p.ravel())
                yield pa.RecordBatch.from_arrays([*b.columns, flat, pa.array(cells_of(nodes, p))], [*b.schema.names, "p", "cell"])

    placed = stored(points.mapInArrow(assign, "v array<double>, ids array<long>, p array<double>, cell long"), "cells")
    bounds = [F.min(F.col("p")[i]).alias(f"l{i}") for i in range(DIMENSIONS)] + [
        F.max(F.col("p")[i]).alias(f"h{i}") for i in range(DIMENSIONS)]
    boxes = placed.groupBy("cell").agg(F.count("*").alias("n"), *bounds).toPandas()  # a row a cell
    low, high = (boxes[[f"{c}{i}" for i in range(DIMENSIONS)]].to_numpy() for c in "lh")
    cells, chunks = boxes["cell"].to_numpy(), -(-boxes["n"].to_numpy() // CHUNK)
    chunks_of = F.create_map(*[F.lit(int(x)) for pair in zip(cells, chunks, strict=True) for x in pair])
    dealt = placed.withColumn("chunk", F.pmod(F.xxhash64("v"), chunks_of[F.col("cell")]))

    def where_to(first: bool):
        """(q, v, cell, bound) for the cells that each (q, v, bound) must search: its own, or the others."""
        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out_v, out_cell, out_bound = [], [], []
                if b.num_rows:
                    p = _matrix(b.column(1)) @ plane
                    home = cells_of(nodes, p)
                    reach = b.column(2).to_numpy(zero_copy_only=False)
                    for i in range(len(p)):
                        if first:
                            to = [home[i]]
                        else:
                            to = cells[(box_distance(p[i], low, high) <= STOP * reach[i] ** 2) & (cells != home[i])]
                        out_v += [i] * len(to)
                        out_cell += list(to)
                        out_bound += [reach[i]] * len(to)
                    for a in range(0, len(out_v), 10_000):
                        z = slice(a, a + 10_000)
                        yield pa.RecordBatch.from_arrays(
                            [b.column(0).take(pa.array(out_v[z], pa.int64())), b.column(1).take(pa.array(out_v[z], pa.int64())),
                             pa.array(out_cell[z], pa.int64()), pa.array(out_bound[z], pa.float64())], ["q", "v", "cell", "bound"])
        return work

    def search(points_: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(points_) or not len(wanted):
            return pd.DataFrame({"q": pd.Series(dtype="int64"), "score": pd.Series(dtype=float), "ids": pd.Series(dtype=object)})
        content = np.stack(points_["v"].to_numpy())
        tree, out = Tree(content, content @ plane), []
        ids = points_["ids"].to_numpy()
        for q, v, bound in zip(wanted["q"], wanted["v"], wanted["bound"], strict=True):
            found, rows = tree.search(v, v @ plane, k + 1, bound)
            out += [(q, float(d), ids[r]) for d, r in zip(found, rows, strict=True)]
        return pd.DataFrame(out, columns=["q", "score", "ids"])

    def run(to: DataFrame) -> DataFrame:
        spread = to.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks_of[F.col("cell")].cast("long") - 1)))
        return dealt.select("v", "ids", "cell", "chunk").groupBy("cell", "chunk").cogroup(
            spread.groupBy("cell", "chunk")).applyInPandas(search, "q long, score double, ids array<long>")

    # equal query vectors are searched once, under the smallest of their ids
    first_of = stored(asked.groupBy("v").agg(F.min("query_id").alias("q")), "query_vectors")
    sought = first_of.select("q", "v", F.lit(float("inf")).alias("bound"))
    target = "q long, v array<double>, cell long, bound double"
    home = stored(run(sought.mapInArrow(where_to(True), target)), "home_found")
    by_score = Window.partitionBy("q").orderBy("score")
    kth = (home.withColumn("turn", F.row_number().over(by_score)).where(F.col("turn") == k + 1).select("q", F.col("score").alias("kth")))
    reach = first_of.join(kth, "q", "left").select("q", "v", F.coalesce("kth", F.lit(float("inf"))).alias("bound"))
    far = run(reach.mapInArrow(where_to(False), target))
    # k + 1 vectors hold at least k ids besides the query's own; ties of the last stay
    best = home.unionByName(far).withColumn("turn", F.rank().over(by_score)).where(F.col("turn") <= k + 1)
    ids = best.select("q", "score", F.explode("ids").alias("vec_id"))
    ids = ids.withColumn("turn", F.row_number().over(Window.partitionBy("q").orderBy("score", "vec_id"))).where(F.col("turn") <= k + 1)
    pairs = (asked.join(first_of, "v").select("query_id", "q").join(ids.drop("turn"), "q").where("vec_id <> query_id"))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
