"""Exact top-k search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from railctx.llm import vector_file

VECTORS = "point long, embedding array<float>, vec_id long, rank int, cells string, score long"


def vectors(spark, rows):
    return spark.createDataFrame([(7, v, i, 1, "b", 3) for i, v in rows], VECTORS).repartition(3)


def brute(rows, dimension, k, every, scale=64):
    plain = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) == dimension and None not in v]
    plain = [(i, np.floor(scale * v).astype(np.int64)) for i, v in plain if np.isfinite(v).all() and np.abs(v * scale).max() < vector_file.largest_component(dimension)]
    asked = {}
    for i, v in plain:
        if i % every == 0 and (i not in asked or v.astype("<i4").tobytes() < asked[i].astype("<i4").tobytes()):
            asked[i] = v
    return {q: sorted(((j, int(v @ asked[q])) for j, v in plain if j != q), key=lambda e: (-e[1], e[0]))[:k] for q in asked}


def found(result):
    out: dict = {}
    for r in sorted(result.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def same(spark, rows, dimension, k, every, **options):
    got = found(vector_file.top_k(vectors(spark, rows), F.col("vec_id") % every == 0, k, **options))
    want = {q: near for q, near in brute(rows, dimension, k, every).items() if near}
    assert got == want


def test_odd_vectors_ties_and_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (0.3 * rng.standard_normal(8)).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[10][1]) for i in range(60)]  # equal vectors: ties by id
    rows += [(500, rows[3][1]), (500, rows[3][1]), (500, rows[4][1]), (20, rows[20][1])]  # repeated ids
    rows += [(600, [0.0] * 8), (601, [0.0] * 8)]  # every score of a zero vector ties
    rows += [(2000, None), (2020, [1.0, None] + [0.0] * 6), (2030, [float("nan")] * 8), (2040, [1.0]), (2050, [float("inf")] * 8), (2060, []), (None, rows[0][1])]
    rows += [(2070, [3e38] * 8), (3000, [-1e5] * 8), (3010, [1e5] * 8)]
    same(spark, rows, 8, 5, 10)


def test_small_blocks_and_reads(spark, monkeypatch):
    for name, value in {"BLOCK_POINTS": 50, "BLOCK_QUERIES": 7, "FIRST_READ": 3, "GROWTH": 2, "MARK_POINTS": 100}.items():
        monkeypatch.setattr(vector_file, name, value)
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(400)]
    same(spark, rows, 16, 6, 20, bits=2)


def test_few_or_no_candidates(spark):
    assert vector_file.top_k(vectors(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert vector_file.top_k(vectors(spark, [(1, [1.0])]), F.col("vec_id") % 10 == 0).count() == 0
    same(spark, [(0, [1.0, 0.5]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [0.25, -0.25])], 2, 20, 2)
    assert found(vector_file.top_k(vectors(spark, [(0, [1.0, 0.5]), (0, [1.0, 0.5])]), F.col("vec_id") % 2 == 0)) == {}


@pytest.mark.parametrize("bits", [1, 5, 8])
def test_cells_hold_their_vectors(bits):
    rng = np.random.default_rng(bits)
    some = (rng.standard_normal((500, 5)) * 40).astype(np.int64)
    some[:, 4] = 7
    cells = vector_file.Cells(some[::7], some.min(0), some.max(0), bits)
    low, high = cells.limits(cells.pack(some))
    assert (low <= some).all() and (some <= high).all()
    for queries in (some[:20], some[:20] * 10**6):
        lower, upper = vector_file.bounds(queries, low, high)
        exact = queries @ some.T
        assert (lower <= exact).all() and (exact <= upper).all()


def test_bounds_beyond_the_doubles():
    large = vector_file.largest_component(4)
    some = np.array([[large, -large, large - 1, 3], [large, large, large, large]])
    lower, upper = vector_file.bounds(some, some, some)
    exact = [[sum(int(a) * int(b) for a, b in zip(q, v)) for v in some] for q in some]
    assert all(low <= e <= high for ls, es, hs in zip(lower, exact, upper) for low, e, high in zip(ls, es, hs))


def test_exact_scores_of_the_surest_points_cut_the_candidates(spark, monkeypatch):
    kept = []
    real = vector_file._read_until_certain

    def read(left, *args):
        kept.append(left.count())
        return real(left, *args)

    monkeypatch.setattr(vector_file, "_read_until_certain", read)
    monkeypatch.setattr(vector_file, "BLOCK_POINTS", 64)
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(600)]
    got = found(vector_file.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, 5, bits=3))
    assert len(got) == 30
    # Of 30 times 600 points; the k best lower bounds alone left 7617.
    assert kept[0] < 30 * 180
