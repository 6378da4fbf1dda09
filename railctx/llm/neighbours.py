"""Approximate nearest neighbours by low-dimensional stable projections.

Vectors are projected with a Gaussian (2-stable) matrix onto a few dimensions, where the squared
projected distance, divided by the squared true distance, follows a chi-square law. A kd-tree
over a bounded sample of projections cuts the projected space into cells; every vector is
indexed in its cell. A query first verifies its own cell, then every cell that the stopping test leaves open:
a cell is skipped once the chi-square test says that a vector as near as the k-th one found
would hardly project as far as the cell's box. Inside a block, neighbours are taken in order of
projected distance and verified on the original vectors until the test holds.

A cell may hold any number of rows (equal vectors cannot be split), so cells are salted into
blocks of bounded size, searched apart and merged by rank.

Defined cases: vectors that are null, zero, of another length than ``dimension`` or hold null or
non-finite components take no part, neither as query nor as candidate; a query never finds rows with its own id; ties go
to the smaller id; with fewer candidates than k all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railctx.llm.arrow import written

#: Rows of the sample that places the cuts of the tree, and cells that the tree may have.
SAMPLE_ROWS = 20_000  # about; picked by a hash of the id
MAX_CELLS = 1024
CELL_ROWS = 2048
BLOCK_ROWS = 8192


def chi_square_cdf(x: float, m: int) -> float:
    """For even m the chi-square distribution has a closed form."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, m // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


@lru_cache
def stopping_ratio(m: int, confidence: float) -> float:
    """Squared projected over squared true distance beyond which the test holds."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, m) < confidence else (low, middle)
    return high


def projection(dimension: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dimension, m))


class Tree:
    """A kd-tree by medians of the widest dimension; leaves are cells with the box that holds them."""

    def __init__(self, points: np.ndarray, cells: int, m: int):
        self.cuts: list[tuple[int, float, int, int]] = []  # dimension, value, left, right; leaves as ~cell
        self.lower: list[np.ndarray] = []
        self.upper: list[np.ndarray] = []
        depth = max(0, math.ceil(math.log2(max(1, cells))))
        self.root = self._build(points, depth, np.full(m, -np.inf), np.full(m, np.inf))
        self.low, self.high = np.array(self.lower), np.array(self.upper)

    def _build(self, points: np.ndarray, depth: int, low: np.ndarray, high: np.ndarray) -> int:
        if depth and len(points) > 1:
            spread = points.max(0) - points.min(0)
            axis = int(spread.argmax())
            cut = float(np.median(points[:, axis]))
            left = points[:, axis] <= cut
            if spread[axis] > 0 and not left.all():
                node = len(self.cuts)
                self.cuts.append((axis, cut, 0, 0))
                below, above = high.copy(), low.copy()
                below[axis] = above[axis] = cut
                children = self._build(points[left], depth - 1, low, below), self._build(points[~left], depth - 1, above, high)
                self.cuts[node] = (axis, cut, *children)
                return node
        self.lower.append(low)
        self.upper.append(high)
        return ~(len(self.lower) - 1)

    def cells(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        stack = [(self.root, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if node < 0:
                out[rows] = ~node
                continue
            axis, cut, left, right = self.cuts[node]
            below = points[rows, axis] <= cut
            stack += [(left, rows[below]), (right, rows[~below])]
        return out

    def gaps(self, point: np.ndarray) -> np.ndarray:
        """Squared projected distance from a point to the box of every cell."""
        outside = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return (outside * outside).sum(1)


def usable(vector: Column, dimension: int) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (F.size(vector) == dimension) & finite & F.exists(vector, lambda v: v != 0)


def search_block(points: np.ndarray, ids: np.ndarray, flat: np.ndarray, query: np.ndarray, own: int, at: np.ndarray, k: int, ratio: float, bound: float) -> list[tuple[float, int]]:
    """The k nearest of a block: in order of projected distance, verified until the test holds.

    ``bound`` is the squared distance of the k-th neighbour known so far.
    """
    apart = ((flat - at) ** 2).sum(1)
    order = np.argsort(apart, kind="stable")
    best: list[tuple[float, int]] = []
    for start in range(0, len(order), 256):
        some = order[start : start + 256]
        limit = min(bound, best[-1][0] ** 2 if len(best) == k else math.inf)
        if apart[some[0]] > ratio * limit:
            break
        some = some[ids[some] != own]
        distance = np.sqrt(((points[some] - query) ** 2).sum(1))
        best = sorted([*best, *zip(distance.tolist(), ids[some].tolist(), strict=True)])[:k]
    return best


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, m: int = 8, confidence: float = 0.99, seed: int = 7, vec_id: str = "vec_id", vector: str = "embedding", dimension: int | None = None) -> DataFrame:
    """The k nearest rows of every query row by Euclidean distance: query_id, rank, vec_id, score.

    ``is_query`` is a condition on ``vec_id``. ``m`` must be even. The result is exact up to the
    chance 1 - ``confidence`` per neighbour that the test stops too early. A query id that repeats
    is asked once; candidates that repeat are ranked each.
    """
    if m % 2 or m < 2:
        raise ValueError("m must be even")
    spark = vectors.sparkSession
    plain = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    plain = plain.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    if dimension is None:
        first = plain.where(F.size("vector") > 0).select(F.size("vector").alias("n")).groupBy("n").count().orderBy(F.desc("count"), "n").first()
        dimension = first["n"] if first else 1
    plain = plain.where(usable(F.col("vector"), dimension))
    matrix, ratio = projection(dimension, m, seed), stopping_ratio(m, confidence)

    rows = plain.count()
    share = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(min(1.0, SAMPLE_ROWS / max(1, rows)) * (1 << 30))
    picked = plain.where(share).limit(2 * SAMPLE_ROWS).select("vector").toPandas()["vector"]
    sample = np.stack(picked.to_list()) @ matrix if len(picked) else np.zeros((0, m))
    tree = Tree(sample, min(MAX_CELLS, math.ceil(rows / CELL_ROWS)), m)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column(1), dimension)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.cells(points @ matrix))], names=["vec_id", "vector", "cell"])

    indexed = written(plain.mapInArrow(index, "vec_id long, vector array<double>, cell long"))
    # Cells of any size are cut into blocks of bounded size; the table of cells is bounded by the tree.
    sizes = indexed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows")).collect()

    def blocks() -> DataFrame:
        counts = [(row["cell"], math.ceil(row["rows"] / BLOCK_ROWS)) for row in sizes]
        return F.broadcast(spark.createDataFrame(counts, "cell long, blocks long"))

    salted = indexed.join(blocks(), "cell").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks"))
    queries = indexed.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("query"), F.min_by("cell", "vector").alias("cell"))

    def searched(visits: DataFrame) -> DataFrame:
        """Every visit of a query to a cell, at each block of the cell, cut to the k nearest of each query."""
        wanted = visits.join(blocks(), "cell").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out: list[tuple] = []
            if len(left) and len(right):
                points, ids = np.stack(right["vector"].to_list()), right["vec_id"].to_numpy()
                order = np.argsort(ids, kind="stable")
                points, ids = points[order], ids[order]
                flat = points @ matrix
                for own, query, bound in zip(left["query_id"], left["query"], left["bound"], strict=True):
                    query = np.asarray(query, float)
                    for distance, other in search_block(points, ids, flat, query, own, query @ matrix, k, ratio, bound):
                        out.append((own, other, distance))
            return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

        return wanted.groupBy("cell", "block").cogroup(salted.groupBy("cell", "block")).applyInPandas(run, "query_id long, vec_id long, score double")

    def best(found: DataFrame) -> DataFrame:
        by_rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k)

    home = written(best(searched(queries.withColumn("bound", F.lit(math.inf)))))
    bound = home.where(F.col("rank") == k).select("query_id", (F.col("score") * F.col("score")).alias("bound"))
    bounded = queries.join(bound, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(math.inf)))

    def open_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column(1), dimension) @ matrix
            for row, (at, cell, limit) in enumerate(zip(points, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                visit = np.flatnonzero(tree.gaps(at) <= ratio * limit)
                visit = visit[visit != cell]
                taken = batch.take(pa.array(np.full(len(visit), row)))
                yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), pa.array(visit, pa.int64()), taken.column(3)], names=["query_id", "query", "cell", "bound"])

    visits = bounded.select("query_id", "query", "cell", "bound").mapInArrow(open_cells, "query_id long, query array<double>, cell long, bound double")
    return best(home.drop("rank").unionByName(searched(visits))).select("query_id", "rank", "vec_id", "score")


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dimension)
