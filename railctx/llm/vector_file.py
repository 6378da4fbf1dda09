"""Exact top-k search by vector-approximation files.

Components become the integers floor(scale * x). Every vector is kept twice: exactly, and as an
approximation that names, in a few bits per dimension, the cell its component lies in. A query scans
the approximations only: the limits of the cells bound its inner product with a vector from both
sides. One scan finds the k best lower bounds of a query; their exact scores are what any result must
reach, and a second scan keeps only vectors whose upper bound does. Exact vectors are then read
in the order of their bounds, a batch of each query at a time, until the k-th result beats the best
bound that is left. The cells decide what is read, never the result.

Equal vectors are one point with its smallest ids, as ties go to the smaller id: more than k + 1 ids of a
point can never be returned. Queries and approximations meet in blocks of bounded size.

Defined cases: vectors that are null, of another length than ``dimension`` (the most common one, if
not given) or hold null or non-finite components take no part, nor do those with a component so large
that a sum of products could leave 64 bits; a null id takes no part; a query never finds rows
with its own id; an id asked twice is asked with its smallest vector; candidates that repeat are
ranked each; with fewer candidates than k all are returned; an empty table gives no rows. Other
columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railctx.llm.arrow import written

#: Points that place the limits of the cells; about so many, picked by a hash of the point.
MARK_POINTS = 20_000
#: Bits of an approximation per dimension.
BITS = 5
#: What one task holds at a time.
BLOCK_POINTS, BLOCK_QUERIES = 4096, 512
#: Exact vectors that a query reads first, and how much more in each further batch.
FIRST_READ, GROWTH = 64, 8

RESULT = "query_id long, rank int, vec_id long, score long"


def largest_component(dimension: int) -> int:
    """Sums of products of components up to this size, and their bounds, stay inside 64 bits."""
    return min(2**31 - 1, math.isqrt(2**62 // max(1, dimension)))


def integer_vectors(vectors: DataFrame, scale: float, dimension: int) -> DataFrame:
    """vec_id and the vector as little-endian 32-bit integers, which compare and group as one value."""
    limit = largest_component(dimension)
    whole = F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * abs(float(scale)) < float(limit)))
    usable = vectors.where((F.size("vector") == dimension) & finite).select("vec_id", whole.alias("vector"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.asarray(batch.column(1).flatten()).astype("<i4").tobytes()
            size = 4 * dimension
            held = pa.array([flat[k * size : (k + 1) * size] for k in range(batch.num_rows)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), held], names=["vec_id", "vector"])

    return usable.mapInArrow(encode, "vec_id long, vector binary")


def points_of(encoded: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with their k + 1 smallest ids and how often each occurs."""
    counted = encoded.groupBy("vector", "vec_id").agg(F.count(F.lit(1)).alias("copies"))
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = counted.withColumn("place", place).where(F.col("place") <= k + 1)
    members = F.sort_array(F.collect_list(F.struct("vec_id", "copies")))
    return few.groupBy("vector").agg(members.alias("members")).select(
        F.monotonically_increasing_id().alias("point"),
        "vector",
        "members",
        F.col("members")[0]["vec_id"].alias("first"),
        F.get("members", F.lit(1))["vec_id"].alias("second"),
    )


class Cells:
    """Cells of one dimension each: quantiles of the sample between the exact ends of all points."""

    def __init__(self, sample: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int):
        self.bits = bits
        shares = np.linspace(0, 1, 2**bits + 1)[1:-1]
        self.marks = [np.unique(np.quantile(column, shares, method="lower")) if len(column) else np.zeros(0, np.int64) for column in sample.T]
        self.low, self.high = (np.zeros((len(low), 2**bits), np.int64) for _ in range(2))
        for d, marks in enumerate(self.marks):
            # Cell c holds what is above mark c - 1, up to mark c; the outer cells reach the ends.
            below = np.concatenate([[low[d]], np.maximum(marks + 1, low[d])])
            above = np.concatenate([np.minimum(marks, high[d]), [high[d]]])
            self.low[d, : len(below)], self.high[d, : len(above)] = below, above

    def pack(self, vectors: np.ndarray) -> list[bytes]:
        """The cells of every vector, one plane of bits after the other."""
        cells = np.stack([np.searchsorted(m, c, side="left") for m, c in zip(self.marks, vectors.T, strict=True)], axis=1).astype(np.uint8)
        planes = [np.packbits(cells >> b & 1, axis=1) for b in range(self.bits)]
        return [row.tobytes() for row in np.concatenate(planes, axis=1)]

    def limits(self, packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest value of every component, as rows of vectors."""
        n = len(self.marks)
        planes = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), self.bits, -1)
        bits = np.unpackbits(planes, axis=2, count=n)
        cells = sum(bits[:, b].astype(np.int64) << b for b in range(self.bits))
        axis = np.arange(n)
        return self.low[axis, cells], self.high[axis, cells]


def bounds_of(queries: np.ndarray, low: np.ndarray, high: np.ndarray, upper: bool) -> np.ndarray:
    """Lower or upper bound of the inner product of every query with every vector between the limits.

    Products run in doubles, which are exact below 2^53; beyond, the bounds give way by more than
    any rounding error.
    """
    up, down = np.maximum(queries, 0).astype(float), np.minimum(queries, 0).astype(float)
    low, high = low.T.astype(float), high.T.astype(float)
    most = max(np.abs(low).max(initial=0), np.abs(high).max(initial=0)) * max(up.max(initial=0), -down.min(initial=0)) * queries.shape[1]
    slack = 0.0 if most < 2**53 else most * 2.0**-50
    return (up @ high + down @ low + slack if upper else up @ low + down @ high - slack).astype(np.int64)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds."""
    return bounds_of(queries, low, high, False), bounds_of(queries, low, high, True)


def shown_ids(asked: np.ndarray, first: np.ndarray, second: np.ndarray, single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that every point of a block can show to every query, and whether it can show any."""
    mine = first[None, :] == asked[:, None]
    return np.where(mine, second[None, :], first[None, :]), ~(mine & single[None, :])


def _surest(k: int, lower: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Which points of a block have the k highest lower bounds of each query; of equal bounds, any."""
    kept = valid.copy()
    if kept.shape[1] > k:
        kept[:] = False
        # No bound of a point is as low as this.
        order = np.argpartition(np.where(valid, lower, np.iinfo(np.int64).min), -k, axis=1)[:, -k:]
        np.put_along_axis(kept, order, True, axis=1)
    return kept & valid


def _integers(held: list[bytes], dimension: int) -> np.ndarray:
    return np.frombuffer(b"".join(held), "<i4").reshape(len(held), dimension).astype(np.int64)


def _blocks(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _every(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))


def scan(queries: DataFrame, approximations: DataFrame, cells: Cells, dimension: int, k: int, blocks: tuple[int, int], reached: bool) -> DataFrame:
    """query_id, point, the smallest id it can show, and one bound.

    The k highest lower bounds of every block, or, where a k-th score is ``reached``, the upper bounds of all that may
    be among the k best: ``queries`` then hold that score and its id as ``kth`` and ``kth_shown``, null if there is none.
    """
    left = queries.withColumn("asked", _block("query_id", blocks[0])).withColumn("block", _every(blocks[1]))
    right = approximations.withColumn("block", _block("point", blocks[1])).withColumn("asked", _every(blocks[0]))
    schema = pa.schema([(c, pa.int64()) for c in ("query_id", "point", "shown", "bound")])
    least = np.iinfo(np.int64).min

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        asked, points, first = (np.asarray(c.combine_chunks()) for c in (left["query_id"], right["point"], right["first"]))
        single = np.asarray(right["second"].combine_chunks().is_null())
        second = np.asarray(right["second"].combine_chunks().fill_null(0))
        bound = bounds_of(_integers(left["vector"].to_pylist(), dimension), *cells.limits(right["cells"].to_pylist()), reached)
        shown, valid = shown_ids(asked, first, second, single)
        if reached:
            none = np.asarray(left["kth"].combine_chunks().is_null())[:, None]
            kth, last = (np.asarray(left[c].combine_chunks().fill_null(least))[:, None] for c in ("kth", "kth_shown"))
            kept = valid & (none | (bound > kth) | ((bound == kth) & (shown <= last)))
        else:
            kept = _surest(k, bound, valid)
        own, place = np.nonzero(kept)
        return pa.Table.from_arrays([pa.array(c) for c in (asked[own], points[place], shown[kept], bound[kept])], schema=schema)

    keys = ["asked", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id long, point long, shown long, bound long")


def _may_enter(score: str, shown: str) -> Column:
    """A point that a k-th result of this score and id does not surely beat."""
    return F.col(score).isNull() | (F.col("bound") > F.col(score)) | ((F.col("bound") == F.col(score)) & (F.col("shown") <= F.col(shown)))


def _place(*order: Column | str) -> Column:
    return F.row_number().over(Window.partitionBy("query_id").orderBy(*order))


def with_kth(queries: DataFrame, scored: DataFrame, k: int) -> DataFrame:
    """Queries with the k-th best of some exact scores, null where there are fewer."""
    best = scored.withColumn("rank", _place(F.desc("score"), "shown")).where(F.col("rank") <= k)
    kth = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"), F.col("shown").alias("kth_shown"))
    return queries.join(kth, "query_id", "left")


def exact_scores(pairs: DataFrame, queries: DataFrame, points: DataFrame, dimension: int) -> DataFrame:
    """Pairs of query and point with their inner product, from the exact vectors."""
    read = pairs.select("query_id", "point", "shown").join(queries.withColumnRenamed("vector", "query"), "query_id").join(points.select("point", "vector"), "point")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_integers(batch.column(c).to_pylist(), dimension) for c in (3, 4))
            score = np.einsum("ij,ij->i", left, right)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score)], names=["query_id", "point", "shown", "score"])

    return read.select("query_id", "point", "shown", "query", "vector").mapInArrow(run, "query_id long, point long, shown long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64, bits: int = BITS, vec_id: str = "vec_id", vector: str = "embedding", dimension: int | None = None) -> DataFrame:
    """The k highest integer inner products of every query row: query_id, rank, vec_id, score.

    ``is_query`` is a condition on ``vec_id``. Ties go to the smaller id.
    """
    if k < 1 or not 1 <= bits <= 8:
        raise ValueError("k must be at least 1, bits from 1 to 8")
    spark = vectors.sparkSession
    plain = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).where("vec_id is not null and vector is not null")
    if dimension is None:
        usual = plain.where(F.size("vector") > 0).groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
        dimension = usual["n"] if usual else 1
    encoded = integer_vectors(plain, scale, dimension)
    points = written(points_of(encoded, k))
    queries = written(encoded.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector")))
    rows, asked = points.count(), queries.count()
    if not rows or not asked:
        return spark.createDataFrame([], RESULT)

    cells = Cells(*_marks(points, rows, dimension), bits)

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                held = pa.array(cells.pack(_integers(batch.column(3).to_pylist(), dimension)), pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], held], names=["point", "first", "second", "cells"])

    approximations = points.select("point", "first", "second", "vector").mapInArrow(approximate, "point long, first long, second long, cells binary")
    blocks = (_blocks(asked, BLOCK_QUERIES), _blocks(rows, BLOCK_POINTS))
    surest = scan(queries, approximations, cells, dimension, k, blocks, False).withColumn("place", _place(F.desc("bound"), "shown"))
    sure = exact_scores(surest.where(F.col("place") <= k), queries, points, dimension)
    limited = written(with_kth(queries, sure, k))
    found = scan(limited, approximations, cells, dimension, k, blocks, True)
    in_order = _place(F.desc("bound"), "shown")
    best = _read_until_certain(written(found.withColumn("place", in_order)), queries, points, dimension, k)

    shown = best.join(points.select("point", "members"), "point").select("query_id", "score", F.explode("members").alias("member")).where("member.vec_id <> query_id")
    each = shown.select("query_id", "score", F.col("member.vec_id").alias("vec_id"), F.explode(F.sequence(F.lit(1), F.least(F.col("member.copies"), F.lit(k)).cast("int"))))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _marks(points: DataFrame, rows: int, dimension: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A bounded sample that places the cells, and the exact ends of every dimension."""
    share = F.pmod(F.xxhash64("point"), F.lit(1 << 30)) < int(min(1.0, MARK_POINTS / rows) * (1 << 30))
    sample = _integers([row["vector"] for row in points.where(share).select("vector").collect()], dimension)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                some = _integers(batch.column(0).to_pylist(), dimension)
                low = some.min(0) if low is None else np.minimum(low, some.min(0))
                high = some.max(0) if high is None else np.maximum(high, some.max(0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimension)), pa.array(low), pa.array(high)], names=["axis", "low", "high"])

    per_task = points.select("vector").mapInArrow(ends, "axis long, low long, high long")
    found = sorted(per_task.groupBy("axis").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect())  # one row per dimension
    return sample, np.array([r["low"] for r in found]), np.array([r["high"] for r in found])


def _read_until_certain(left: DataFrame, queries: DataFrame, points: DataFrame, dimension: int, k: int) -> DataFrame:
    """The k best points of every query. ``left`` holds its candidates, numbered in the order of their bounds."""
    best, done, batch = None, 0, FIRST_READ
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "shown")
    while True:
        scored = exact_scores(left.where(F.col("place") <= done + batch), queries, points, dimension)
        scored = scored if best is None else best.drop("rank").unionByName(scored)
        best = written(scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
        done, batch = done + batch, batch * GROWTH
        kth = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"), F.col("shown").alias("kth_shown"))
        left = written(left.where(F.col("place") > done).join(kth, "query_id", "left").where(_may_enter("kth", "kth_shown")).drop("kth", "kth_shown"))
        if left.isEmpty():
            return best.drop("rank")
