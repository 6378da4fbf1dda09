"""Exact quantiles against sorting."""

import math
import random

import pytest

from railctx.analytics.ranks import quantiles

SHARES = {"least": 0.0, "median": 0.5, "p90": 0.9, "p95": 0.95, "most": 1.0}


def brute(values, share):
    values = sorted(values)
    place = share * (len(values) - 1)
    low, high = values[math.floor(place)], values[math.ceil(place)]
    return low + (place - math.floor(place)) * (high - low)


def same(spark, rows, bins=1024):
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {r["g"]: r for r in quantiles(df, "v", ["g"], SHARES, bins).collect()}
    groups: dict = {}
    for g, v in rows:
        if v is not None and not math.isnan(v):
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, values in groups.items():
        for name, share in SHARES.items():
            assert got[g][name] == pytest.approx(brute(values, share), rel=1e-15, abs=0), (g, name)


@pytest.mark.parametrize("bins", [4, 16, 1024])
def test_random_groups(spark, bins):
    rng = random.Random(bins)
    rows = [(rng.choice(["a", "b", None]), rng.lognormvariate(0, 3)) for _ in range(800)]
    rows += [("one", 2.5), ("same", 7.0), ("same", 7.0), ("a", None), ("a", float("nan")), ("void", None)]
    same(spark, rows, bins)


def test_values_that_hardly_differ_or_span_everything(spark):
    near = [("near", 1.0 + k * 2.0**-52) for k in range(50)]
    wide = [("wide", v) for v in (-1.7e308, -1.0, 0.0, 5e-324, 1e-300, 1.0, 1.7e308)]
    tied = [("tied", 3.0)] * 500 + [("tied", float(k)) for k in range(20)]
    same(spark, near + wide + tied)


def test_no_rows_and_no_groups(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert quantiles(empty, "v", ["g"], SHARES).count() == 0
    whole = spark.createDataFrame([(float(k),) for k in range(101)], "v double")
    assert tuple(quantiles(whole, "v", [], {"p10": 0.1, "p99": 0.99}).first()) == (10.0, 99.0)
