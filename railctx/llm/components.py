"""Connected components of a graph of any size, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railctx.llm.arrow import written


def _least(both: DataFrame) -> DataFrame:
    """For each u the smallest of itself and its neighbours, beside each neighbour v."""
    dealt = both.repartition("u")  # one shuffle for the minima and the join
    least = dealt.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return dealt.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) to (id, root) for every id on an edge; root is the smallest id reachable.

    Large stars hang larger neighbours on the smallest one, small stars hang the smaller ones and
    the centre, until every id hangs on its root. Minima are summed up before
    they are shuffled and joined back, so a hub with many neighbours is no single task.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _is_done(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # Here u > v already, so the neighbours at hand are the smaller ones.
        small = _least(large)
        hung = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        centre = small.select("u", F.col("m").alias("v"))
        now = written(hung.unionByName(centre).distinct())
    roots = now.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)


def _is_done(edges: DataFrame) -> bool:
    """Every id hangs on one other, which hangs on none."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    both = ends.groupBy("id").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return both.where("hangs > 1 or (hangs = 1 and holds = 1)").isEmpty()
