"""Exact quantiles by distributed rank selection.

A percentile that keeps a count per distinct value needs as much memory as there are values. Here the
values are counted in a fixed number of bins; the one bin that holds the wanted rank is cut into
bins anew, until its ends are one value. State is the number of bins per group and quantile,
whatever the number of rows, and the answer is a value of the data, not a rounded one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railctx.session import BROADCAST_BYTES

BINS = 1024
#: A round narrows a bin at least to the ends of its values, and a double has 53 bits.
_MOST_ROUNDS = 200

_ROW_BYTES = 200

_LOW, _HIGH, _BEFORE, _RANK = "_low", "_high", "_before", "_rank"


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Number of the bin; grows with the value, the ends lie in the first and the last bin.

    Halves are subtracted, so that a range wider than the largest double stays finite.
    """
    share = (value / 2 - low / 2) / (high / 2 - low / 2)
    inside = F.least(F.floor(share * bins), F.lit(bins - 2)) + 1
    # The two ends have bins of their own, so that every round parts at least them.
    return F.when(value == low, 0).when(value == high, bins).otherwise(inside).cast("int")


def _wanted(df: DataFrame, value: str, by: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """Both ranks around each quantile of each group, with the ends of the group."""
    ends = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.min(value).alias(_LOW), F.max(value).alias(_HIGH)
    )
    named = F.array(*[F.struct(F.lit(name).alias("_name"), F.lit(float(share)).alias("_share")) for name, share in shares.items()])
    place = F.col("_share") * (F.col("_n") - 1)
    sides = F.array(F.struct(F.floor(place).alias(_RANK), F.lit(0).alias("_side")), F.struct(F.ceil(place).alias(_RANK), F.lit(1).alias("_side")))
    return (
        ends.withColumn("_q", F.explode(named))
        .select(*by, "_n", _LOW, _HIGH, "_q.*")
        .withColumn("_s", F.explode(sides))
        .select(*by, "_name", (place - F.floor(place)).alias("_part"), "_s._side", F.col(f"_s.{_RANK}").alias(_RANK), _LOW, _HIGH, F.lit(0).cast("long").alias(_BEFORE))
    )


def quantiles(df: DataFrame, value: str, by: Sequence[str], shares: dict[str, float], bins: int = BINS) -> DataFrame:
    """One row per group with a column per name of ``shares``: the value at that share of the ranks.

    Between two ranks the value is interpolated, as ``percentile`` does. NULL and NaN values take no
    part; a group without values is absent; NULL is a group. ``df`` is read once a round, so hand in a stored
    table. The groups, with a few numbers each, pass through the driver.
    """
    if bins < 4:
        raise ValueError("at least four bins are needed")
    spark = df.sparkSession
    values = df.select(*by, F.col(value).cast("double").alias("_value"))
    values = values.where(F.col("_value").isNotNull() & ~F.isnan("_value"))
    wanted = _wanted(values, "_value", by, shares)
    schema = wanted.schema
    found, rows = [], wanted.collect()
    for _ in range(_MOST_ROUNDS):
        # A bin whose ends are one value is that value.
        found += [row for row in rows if row[_LOW] == row[_HIGH]]
        rows = [row for row in rows if row[_LOW] != row[_HIGH]]
        if not rows:
            break
        narrow = spark.createDataFrame(rows, schema)
        narrow = F.broadcast(narrow) if len(rows) * _ROW_BYTES <= BROADCAST_BYTES else narrow
        rows = _narrowed(values, narrow, by, bins).select(*schema.names).collect()
    answers = spark.createDataFrame(found, schema)
    low, high = (F.max(F.when(F.col("_side") == side, F.col(_LOW))) for side in (0, 1))
    per_name = answers.groupBy(*by, "_name").agg((low + F.max("_part") * (high - low)).alias("_value"))
    return per_name.groupBy(*by).agg(*[F.max(F.when(F.col("_name") == name, F.col("_value"))).alias(name) for name in shares])


def _narrowed(values: DataFrame, wanted: DataFrame, by: Sequence[str], bins: int) -> DataFrame:
    """``wanted`` with the ends of the bin that holds each rank, and the rows before that bin."""
    same = [values[c].eqNullSafe(wanted[c]) for c in by]
    inside = values.join(wanted, [*same, F.col("_value").between(F.col(_LOW), F.col(_HIGH))])
    keys = [*[wanted[c] for c in by], "_name", "_part", "_side", _RANK, _LOW, _HIGH, _BEFORE]
    counted = inside.groupBy(*keys, _bin(F.col("_value"), F.col(_LOW), F.col(_HIGH), bins).alias("_bin")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_value").alias("_least"), F.max("_value").alias("_most")
    )
    one = [*by, "_name", "_side"]
    through = F.sum("_rows").over(Window.partitionBy(*one).orderBy("_bin")) + F.col(_BEFORE)
    holding = counted.withColumn("_through", through).where((F.col("_through") > F.col(_RANK)) & (F.col("_through") - F.col("_rows") <= F.col(_RANK)))
    return holding.select(*by, "_name", "_part", "_side", _RANK, F.col("_least").alias(_LOW), F.col("_most").alias(_HIGH), (F.col("_through") - F.col("_rows")).alias(_BEFORE))
