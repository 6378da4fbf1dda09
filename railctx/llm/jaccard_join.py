"""Exact n-gram Jaccard join in the metric space of sets.

One minus the Jaccard similarity is a metric. Documents with the same set are one point. Points are placed in
cells: a set's shingles are ordered from rare to common, and its first ones, so many that two
linked sets must share one of them, name its cells. So every link lies inside a cell.

A cell of a rare shingle is joined directly. Those of common ones become regions: each cell
goes to the region of its first pivot. In a region some points are pivots; every
point that could be linked with one is measured against it, which gives Voronoi regions inside.
A point goes to the region of its nearest pivot, and, by the triangle inequality, also to each
region whose pivot is at most twice the radius farther away, since a linked point can be at home
there. Regions are joined in the same way, recursively, without their pivots, which have met
every point. Pivots are taken from outside a region's largest component, as links inside
it add nothing; a region that is one component is closed. Points whose shingles no other has
cannot be linked and are left out by count. Nothing is sampled or capped: the recursion ends
when every region is closed.

The order of shingles only decides how large cells become, so a table of counts of a fixed size, hashed
by shingle, is enough for it. Shingles are 64-bit hashes; two of the same document, or of a pair that is measured,
collide with a chance below one in ten million millions.

Defined cases: null or empty text, or text without words, has an empty set and is linked with nothing;
texts with fewer words than a shingle have their whole sequence as the only one; rows that
repeat, ids included, are copies of each other; rows with a null id belong to the component of
their copies, which has a null id if none of them has one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railctx.llm.arrow import keyed_text, only, written
from railctx.llm.components import components

WORDS = 5
#: Linked: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Points of a cell or region that is joined directly.
LEAF = 8
#: Places of the table of counts, as a power of two; one byte each, whatever the corpus.
PLACES = 24
#: A task keeps the sets of points it met last, up to so many shingles.
_HELD_SHINGLES = 1_000_000
#: Pivots that meet a chunk of points in one task.
BLOCK, CHUNK = 64, 512
_FACTORS = np.random.default_rng(5).integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    """Hash of each word; emptied when it grows beyond a fixed size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def _begin() -> None:
    only("jaccard_join", _hashes.clear)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The set of a text as sorted distinct 64-bit hashes. Words end at ASCII white space; A-Z become a-z."""
    # Both methods of bytes look at ASCII only.
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    size = min(words, len(each))
    last = len(each) - size + 1
    total = np.full(last, size, np.uint64) * _FACTORS[-1]
    for k in range(size):
        total += each[k : k + last] * _FACTORS[k]
    return np.unique(total)


def prefix_length(n: int) -> int:
    """So many shingles that a set which shares none of them shares too few in all."""
    return n - -(-n * PERCENT // 100) + 1 if n else 0


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight together, which compress where the numbers are alike."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def _buckets(values: np.ndarray, bits: int) -> list[tuple[int, slice]]:
    """Runs of sorted values that share their top bits."""
    if not len(values):
        return []
    tops = (values >> (values.dtype.type(8 * values.itemsize - bits))).astype(np.int64)
    starts = np.flatnonzero(np.diff(tops, prepend=-1))
    ends = np.append(starts[1:], len(values))
    return [(int(tops[a]), slice(a, b)) for a, b in zip(starts, ends, strict=True)]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Batches in slices, so that a task holds the sets of few documents at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _bits(df: DataFrame) -> int:
    """Bits that deal hashes out: as many buckets as the session has shuffle partitions."""
    return max(6, min(16, (int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()))


def levels(docs: DataFrame, words: int = WORDS) -> np.ndarray:
    """How common the shingles of each place of the table are: 0 up to LEAF documents, then by doublings.

    Tasks count their own documents first; counts meet by ranges of the hash, packed, so that a
    shingle is a few bytes of a shuffled row. The table that reaches the driver has a fixed size.
    """
    bits = _bits(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        for batch in _slices(batches):
            sets = [shingles(t, words) for t in batch.column(0).to_pylist()]
            every = np.concatenate([np.zeros(0, np.uint64), *sets])
            values, counts = np.unique((every >> np.uint64(32)).astype(np.uint32), return_counts=True)
            counts = np.minimum(counts, 65535).astype(np.uint16)
            parts = [(b, _planes(np.diff(values[s], prepend=np.uint32(0))), _planes(counts[s])) for b, s in _buckets(values, bits)]
            yield _columns(parts, _COUNTED)

    def total(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        values = np.concatenate([np.cumsum(_from_planes(d, np.uint32), dtype=np.uint32) for d in table.column("values").to_pylist()])
        counts = np.concatenate([_from_planes(d, np.uint16) for d in table.column("counts").to_pylist()]).astype(np.int64)
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[order]
        starts = np.flatnonzero(np.diff(values, prepend=values[0] + np.uint32(1)))
        summed = np.add.reduceat(counts, starts)
        common = summed > LEAF
        level = np.ceil(np.log2(summed[common] / LEAF)).astype(np.uint8)
        place = (values[starts][common] >> np.uint32(32 - PLACES)).astype(np.int64) - (bucket << (PLACES - bits))
        held = np.zeros(1 << (PLACES - bits), np.uint8)
        np.maximum.at(held, place, level)
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "held": pa.array([held.tobytes()], pa.binary())})

    parts = keyed_text(docs).select("text").mapInArrow(count, "bucket int, values binary, counts binary")
    out = np.zeros(1 << PLACES, np.uint8)
    width = 1 << (PLACES - bits)
    for row in parts.groupBy("bucket").applyInArrow(total, "bucket int, held binary").collect():
        out[row["bucket"] * width : (row["bucket"] + 1) * width] = np.frombuffer(row["held"], np.uint8)
    return out


_COUNTED = pa.schema([("bucket", pa.int32()), ("values", pa.binary()), ("counts", pa.binary())])
_CELLED = pa.schema([("bucket", pa.int32()), ("values", pa.binary()), ("owners", pa.binary()), ("points", pa.binary())])


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def signed(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, mark (the hash of its text), n, point (the hash of its set), and the shingles that name its cells.

    ``rare`` are those that few documents have, packed; ``common`` are the others.
    """
    table = docs.sparkSession.sparkContext.broadcast(levels(docs, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        level_of, shift = table.value, np.uint64(64 - PLACES)
        for batch in _slices(batches):
            sizes, points, rare, common = [], [], [], []
            for text in batch.column(1).to_pylist():
                own = shingles(text, words)
                level = level_of[own >> shift]
                order = np.argsort(level, kind="stable")[: prefix_length(len(own))]
                first = own[order]
                split = int((level[order] == 0).sum())
                sizes.append(len(own))
                points.append(np.frombuffer(xxhash.xxh3_64_digest(own.tobytes()), ">i8")[0] if len(own) else None)
                rare.append(first[:split].tobytes())
                common.append(first[split:].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sizes, pa.int64()),
                    pa.array(points, pa.int64()),
                    pa.array(rare, pa.binary()),
                    pa.array(common, pa.list_(pa.int64())),
                ],
                names=["doc_id", "mark", "n", "point", "rare", "common"],
            )

    marked = keyed_text(docs).withColumn("mark", F.xxhash64("text"))
    return marked.mapInArrow(run, "doc_id long, mark long, n long, point long, rare binary, common array<long>")


def _dealt(points: DataFrame, set_of: Callable[[Any], np.ndarray]) -> DataFrame:
    """Shingles of (point, something) by ranges of their hash, packed: a few bytes for each."""
    bits = _bits(points)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        for batch in _slices(batches):
            sets = [set_of(x) for x in batch.column(1).to_pylist()]
            values = np.concatenate([np.zeros(0, np.uint64), *sets])
            owners = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(s) for s in sets])
            names = np.asarray(batch.column(0))
            order = np.argsort(values, kind="stable")
            values, owners = values[order], owners[order]
            rows = []
            for bucket, s in _buckets(values, bits):
                some, inverse = np.unique(owners[s], return_inverse=True)
                rows.append(
                    (bucket, _planes(np.diff(values[s], prepend=np.uint64(0))), _planes(inverse.astype(np.uint32)), names[some].tobytes())
                )
            yield _columns(rows, _CELLED)

    return points.mapInArrow(deal, "bucket int, values binary, owners binary, points binary")


def _gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of a bucket in order with the points that have them; copies are one point."""
    values, owners = [], []
    for v, o, p in zip(*(table.column(c).to_pylist() for c in ("values", "owners", "points")), strict=True):
        values.append(np.cumsum(_from_planes(v, np.uint64), dtype=np.uint64))
        owners.append(np.frombuffer(p, np.int64)[_from_planes(o, np.uint32)])
    both = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort(both[::-1])
    found, owner = both[0][order], both[1][order]
    first = np.append(True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1]))
    return found[first], owner[first]


def _met(values: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of points in runs of equal shingles, and how many runs each pair shares."""
    found = [np.zeros((0, 2), np.int64)]
    for step in range(1, LEAF):
        same = values[step:] == values[:-step]
        if not same.any():
            break
        found.append(np.column_stack([owners[:-step][same], owners[step:][same]]))
    return np.unique(np.concatenate(found), axis=0, return_counts=True)


def rare_pairs(points: DataFrame) -> DataFrame:
    """Pairs a < b of points that share rare shingles, and how many of them name cells of both.

    A rare shingle has at most LEAF documents.
    """

    def meet(table: pa.Table) -> pa.Table:
        pairs, times = _met(*_gathered(table))
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1]), "cells": pa.array(times, pa.int64())})

    dealt = _dealt(points, lambda packed: np.frombuffer(packed, np.uint64))
    met = dealt.groupBy("bucket").applyInArrow(meet, "a long, b long, cells long")
    return met.groupBy("a", "b").agg(F.sum("cells").alias("cells"))


def shared_shapes(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """What these points share among each other, from all their shingles: a, b, cells.

    Rows with b: pairs that share shingles which at most LEAF of the points have, and how many.
    Rows without b: how many shingles of a more points than that have.
    """

    def meet(table: pa.Table) -> pa.Table:
        values, owners = _gathered(table)
        starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        lengths = np.diff(np.append(starts, len(values)))
        many = np.repeat(lengths > LEAF, lengths)
        points, common = np.unique(owners[many], return_counts=True)
        pairs, times = _met(values[~many], owners[~many])
        return pa.table(
            {
                "a": pa.array(np.concatenate([points, pairs[:, 0]]), pa.int64()),
                "b": pa.array([None] * len(points) + pairs[:, 1].tolist(), pa.int64()),
                "cells": pa.array(np.concatenate([common, times]), pa.int64()),
            }
        )

    dealt = _dealt(texts.select("point", "text"), lambda text: shingles(text, words))
    met = dealt.groupBy("bucket").applyInArrow(meet, "a long, b long, cells long")
    return met.groupBy("a", "b").agg(F.sum("cells").alias("cells"))


def _chosen(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text for each of ``wanted`` (doc_id, mark, point): point, text. A bitmap of fixed size drops most other rows before the shuffle.

    An id may stand for several texts, so a text is known by its id and mark; rows that repeat both are one.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << PLACES))
    chunks = (
        wanted.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("chunk"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("held"))
        .collect()
    )
    held = {row["chunk"]: bytes(row["held"]) for row in chunks}
    bitmap = docs.sparkSession.sparkContext.broadcast(held)

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            chunk, bit = (c.to_pylist() for c in (batch.column(2), batch.column(3)))
            keep = [c in bits and bool(bits[c][b >> 3] >> (b & 7) & 1) for c, b in zip(chunk, bit, strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    placed = keyed_text(docs).where("doc_id is not null").withColumn("place", place)
    placed = placed.select("doc_id", "text", F.bitmap_bucket_number("place"), F.bitmap_bit_position("place"))
    found = placed.mapInArrow(drop, "doc_id long, text string").withColumn("mark", F.xxhash64("text"))
    return found.join(wanted, ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"]).select("point", "text")


def measured(pairs: DataFrame, texts: DataFrame, words: int = WORDS) -> DataFrame:
    """``pairs`` (a, b) with the sizes of intersection and union of their whole sets."""
    left = texts.select(F.col("point").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("point").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "text_a", "b", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        held: dict[int, np.ndarray] = {}
        room = _HELD_SHINGLES

        def set_of(point: int, text: str) -> np.ndarray:
            nonlocal room
            if point not in held:
                own = shingles(text, words)
                room -= len(own)
                if room < 0:
                    held.clear()
                    room = _HELD_SHINGLES - len(own)
                held[point] = own
            return held[point]

        for batch in batches:
            shared, union = [], []
            for a, text_a, b, text_b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one, two = set_of(a, text_a), set_of(b, text_b)
                common = len(np.intersect1d(one, two, assume_unique=True))
                shared.append(common)
                union.append(len(one) + len(two) - common)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(shared, pa.int64()), pa.array(union, pa.int64())],
                names=["a", "b", "shared", "whole"],
            )

    return both.mapInArrow(run, "a long, b long, shared long, whole long")


def fitting(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes are near enough for a link and that share enough cells, if known.

    Up to the end of the shorter prefix all common shingles name cells of both sets, so a link
    needs at least what is left to share behind that end. ``cells`` counts rare ones; of common
    ones there can be as many as the set with fewer of them has.
    """
    sides = [points.select(F.col("point").alias(s), F.col("n").alias(f"n_{s}"), F.col("n_common").alias(f"c_{s}")) for s in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    near = F.expr(f"least(n_a, n_b) * 100 >= greatest(n_a, n_b) * {PERCENT}")
    if "cells" in pairs.columns:
        needed = f"ceil({PERCENT} * (n_a + n_b) / {100 + PERCENT}.0)"
        behind = f"ceil({PERCENT} * greatest(n_a, n_b) / 100.0) - 1"
        near &= F.expr(f"cells + least(c_a, c_b) + {behind} >= {needed}")
    return both.where(near).select("a", "b")


def rooted(docs: DataFrame, points: DataFrame, sign: DataFrame, words: int = WORDS) -> DataFrame:
    """Every linked point with the root of its component: id, root.

    ``points``: point, doc_id and mark of one of its rows, n, n_common; ``sign``: what ``signed`` gives.
    """

    def texts_of(wanted: DataFrame) -> DataFrame:
        return written(_chosen(docs, points.select("doc_id", "mark", "point").join(wanted.distinct(), "point")))

    def connected() -> DataFrame:
        return components(reduce(DataFrame.unionByName, found).select(F.col("a").alias("u"), F.col("b").alias("v")))

    linked = F.col("shared") * 100 >= F.col("whole") * PERCENT
    sign = sign.where("point is not null")
    rare = written(fitting(rare_pairs(sign.select("point", "rare")), points))
    ends = rare.select(F.col("a").alias("point")).unionByName(rare.select(F.col("b").alias("point")))
    found = [written(measured(rare, texts_of(ends), words).where(linked).select("a", "b"))]

    # Cells with the same first pivot are one region: who shares a cell shares that region.
    cells = sign.select("point", F.explode("common").alias("cell")).distinct()
    first_pivot = cells.groupBy("cell").agg(F.min("point").alias("region"), F.count(F.lit(1)).alias("points")).where("points > 1")
    regions = written(cells.join(first_pivot, "cell").select("region", "point").distinct())
    if regions.isEmpty():
        return connected()
    # What few points of the regions share is settled by pairs; what is left to find is shared
    # by many, so a point with too few such shingles is out of question.
    texts = texts_of(regions.select("point"))
    shared = written(shared_shapes(texts, words))
    able = shared.where("b is null").select(F.col("a").alias("point"), F.col("cells").alias("able"))
    shapes = written(texts.select("point").join(points.select("point", "n"), "point").join(able, "point", "left").fillna(0, ["able"]))
    few = written(_sharing(shared.where("b is not null"), shapes))
    found.append(written(measured(few, texts, words).where(linked).select("a", "b")))
    roots = connected()
    members = written(_hopeful(regions.join(shapes, "point")))
    k = BLOCK // 4
    while True:
        # Links inside a component add nothing, so pivots come from outside the largest component
        # of a region; a region without such points is closed.
        known = members.join(roots.select(F.col("id").alias("point"), "root"), "point", "left")
        known = written(known.withColumn("root", F.coalesce("root", "point")))
        shares = known.groupBy("region", "root").agg(F.count(F.lit(1)).alias("points"))
        most = shares.groupBy("region").agg(F.max(F.struct("points", "root")).alias("most"), F.sum("points").alias("points"))
        others = known.join(most.select("region", F.col("most.root").alias("most_root"), "points"), "region").where("root <> most_root")
        order = Window.partitionBy("region").orderBy(F.xxhash64("point"))
        pivots = others.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
        pivots = written(pivots.select("region", "point", "points", F.floor((F.col("place") - 1) / BLOCK).alias("block")))
        if pivots.isEmpty():
            return roots
        met = written(_meet_pivots(known, pivots, texts, words))
        found.append(met.where("b is not null").select("a", "b"))
        rest = known.join(pivots.select("region", "point"), ["region", "point"], "left_anti")
        rest = rest.join(pivots.select("region").distinct(), "region", "left_semi").select("region", "point")
        if k <= BLOCK:
            rest = _split(rest, met.where("near is not null").select("region", F.col("a").alias("point"), "near"))
        members = written(_hopeful(rest.join(shapes, "point")))
        roots = connected()
        k *= 16


def _meet_pivots(members: DataFrame, pivots: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Measure every point of a region against its pivots, in blocks: region, a, b, near.

    Rows with b are links, so many that points and pivots of the block hang together as they do
    by all links. Rows with ``near`` name the pivots whose regions the point belongs to: that of
    its home, the nearest, and those at most twice the radius farther.
    """
    # Points of a region are dealt out in chunks; each chunk meets each block of pivots in one task.
    chunks = F.ceil(F.col("points") / CHUNK)
    blocks = pivots.groupBy("region", "block").agg(F.max("points").alias("points"))
    left = members.select("region", "point").join(blocks, "region").withColumn("chunk", F.pmod(F.xxhash64("point"), chunks))
    left = left.join(texts, "point").select("region", "block", "chunk", "point", "text")
    right = pivots.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    # Columns of their own, as both sides come from the same tables.
    columns = ["region", "block", "chunk", "point", "text"]
    right = right.join(texts, "point").select(*(F.col(c).alias(c) for c in columns))
    window = 2 * (1 - PERCENT / 100) + 1e-9

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        regions, a, b, near = [], [], [], []
        if left.num_rows and right.num_rows:
            region = left.column("region")[0].as_py()
            names = np.asarray(right.column("point").combine_chunks())
            sets = [shingles(t, words) for t in right.column("text").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(every, kind="stable")
            every, owner = every[order], owner[order]
            trees = _Trees()
            for point, text in zip(left.column("point").to_pylist(), left.column("text").to_pylist(), strict=True):
                own = shingles(text, words)
                low, high = np.searchsorted(every, own, "left"), np.searchsorted(every, own, "right")
                hits = np.concatenate([np.zeros(0, np.int64), *(owner[x:y] for x, y in zip(low, high, strict=True) if y > x)])
                shared = np.bincount(hits, minlength=len(sets))
                whole = len(own) + sizes - shared
                for pivot in names[100 * shared >= PERCENT * whole].tolist():
                    if pivot != point and trees.join(point, pivot):
                        regions.append(region)
                        a.append(min(point, pivot))
                        b.append(max(point, pivot))
                        near.append(None)
                apart = 1 - shared / whole
                regions.append(region)
                a.append(point)
                b.append(None)
                near.append(names[apart <= apart.min() + window].tolist())
        return pa.table(
            {
                "region": pa.array(regions, pa.int64()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
                "near": pa.array(near, pa.list_(pa.int64())),
            }
        )

    keys = ["region", "block", "chunk"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "region long, a long, b long, near array<long>")


class _Trees(dict):
    """Which points of a task hang together; a link between points that do already is not needed."""

    def root(self, point: int) -> int:
        while self.setdefault(point, point) != point:
            self[point] = point = self[self[point]]
        return point

    def join(self, one: int, two: int) -> bool:
        one, two = self.root(one), self.root(two)
        self[one] = two
        return one != two


def _sharing(pairs: DataFrame, shapes: DataFrame) -> DataFrame:
    """Pairs (a, b, cells) that may be linked by the rare shingles they share and the common ones they have."""
    sides = [shapes.select(F.col("point").alias(s), F.col("n").alias(f"n_{s}"), F.col("able").alias(f"able_{s}")) for s in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    near = f"least(n_a, n_b) * 100 >= greatest(n_a, n_b) * {PERCENT}"
    return both.where(f"{near} and (cells + least(able_a, able_b)) * {100 + PERCENT} >= {PERCENT} * (n_a + n_b)").select("a", "b")


def _hopeful(regions: DataFrame) -> DataFrame:
    """Points that share enough shingles for a link with the smallest set of their region: region, point, n, able."""
    least = regions.groupBy("region").agg(F.min("n").alias("least_n"))
    enough = F.expr(f"able * {100 + PERCENT} >= {PERCENT} * (n + greatest(least_n, ceil({PERCENT} * n / 100.0)))")
    return regions.join(least, "region").where(enough).select("region", "point", "n", "able")


def _split(rest: DataFrame, near: DataFrame) -> DataFrame:
    """Voronoi regions of the points that are left (region, point), by the pivots near to each: region, point.

    A region stays whole if that would copy more points than it sets apart, so that the number
    of rows does not explode.
    """
    placed = rest.join(near, ["region", "point"])
    splits = placed.groupBy("region").agg(F.sum(F.size("near")).alias("copies"), F.count(F.lit(1)).alias("points"))
    placed = placed.join(splits.where("4 * copies <= 5 * points").select("region", F.lit(True).alias("splits")), "region", "left")
    parts = F.when(F.col("splits"), F.transform("near", lambda pivot: F.xxhash64(F.col("region"), pivot)))
    return placed.select(F.explode(F.coalesce(parts, F.array("region"))).alias("region"), "point")


def groups(docs: DataFrame, words: int = WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id reachable over links, itself included)."""
    plain = keyed_text(docs, doc_id, text)
    sign = written(signed(plain, words))
    points = sign.where("point is not null").groupBy("point")
    # Rows without an id come last, as their texts cannot be looked up.
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark"))
    points = points.agg(least.alias("least"), F.first("n").alias("n"), F.first(F.size("common")).alias("n_common"))
    points = written(points.select("point", "least.doc_id", "least.mark", "n", "n_common"))
    roots = rooted(plain, points, sign, words).select(F.col("id").alias("point"), "root")
    known = written(points.join(roots, "point", "left").select("point", "doc_id", F.coalesce("root", "point").alias("root")))
    smallest = known.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = known.join(smallest, "root").select("point", "component_id")
    out = sign.select("doc_id", "n", "point").join(named, "point", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("point").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, that with the smallest id, with all its columns.

    Of rows that repeat an id and its text one stays. Rows with a null id are in no order, so they stay.
    """
    found = groups(docs, doc_id=doc_id, text=text)
    stays = found.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    named = docs.join(written(stays), F.col(doc_id).cast("long") == F.col("kept_id"), "left_semi")
    return named.dropDuplicates([doc_id, text]).unionByName(docs.where(F.col(doc_id).isNull()))
