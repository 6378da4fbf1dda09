"""Nearest site by great-circle distance, without pairing every point with every site.

Sites are numbered by a Z-order curve through a fine cubic grid over the unit sphere; prefixes of the
number name the cells of the coarser grids. One aggregate over these prefixes gives every occupied
cell of all grids with the box around its sites. Points of one small cell are a region, and the box around
them walks down from a coarse grid for all of them: the distance between the farthest corners of two boxes is
one that each of its points can surely reach, and every cell whose box begins farther away than the least of
these is dropped. What remains is a handful of leaf cells, whose sites are sifted the same way, and every
point is measured against the sites left to its region. The result is the exact minimum of (distance, site
id); boxes only decide what need not be measured.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railctx.functions.geo import boxes_gap, boxes_reach, haversine_km, unit_vector, z_order
from railctx.session import BROADCAST_BYTES, materialize

#: Bits per axis from one grid to the next, and the number of grids.
STEP_BITS = 2
DEPTHS = 10
ROOT_CELLS = 32
LEAF_SITES = 16

# Straight-line distances on the unit sphere that rounding cannot tell apart (6 mm).
# A wider tolerance keeps more candidates and never changes the result.
_TOLERANCE = 1e-9

#: Regions of points are cells of so many bits per axis more than the leaves.
REGION_BITS = 1

# Bytes of one grid cell or site as a hashed row.
_ROW_BYTES = 160

_AXES = ("x", "y", "z")
_LOW = tuple(f"low_{axis}" for axis in _AXES)
_HIGH = tuple(f"high_{axis}" for axis in _AXES)
# The box around the points of a region.
_FROM = tuple(f"from_{axis}" for axis in _AXES)
_TO = tuple(f"to_{axis}" for axis in _AXES)


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(name) for name in names]


def _prefix(depth: int | str) -> Column:
    """The cell of a grid, from the number in the finest one."""
    return F.expr(f"shiftright(place, {3 * STEP_BITS} * ({DEPTHS - 1} - {depth}))")


def _first(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """One row per key, the first in order; each task keeps one per key before rows are moved."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def _distinct_sites(sites: DataFrame, on: str, site_id: str, lat: str, lon: str) -> DataFrame:
    """One row per place; the smallest id stands for sites sharing the place."""
    placed = sites.select(
        on, F.col(site_id).alias("id"), F.col(lat).alias("site_lat"), F.col(lon).alias("site_lon")
    )
    first = _first(placed.dropna(), [on, "site_lat", "site_lon"], "id")
    return _placed(first, F.col("site_lat"), F.col("site_lon"))


def _placed(df: DataFrame, lat: Column, lon: Column) -> DataFrame:
    """The place on the unit sphere, and its number in the finest grid."""
    vectors = df.withColumns(unit_vector(lat, lon))
    return vectors.withColumn("place", z_order(*_columns(_AXES), 1 + STEP_BITS * (DEPTHS - 1)))


def _box(low: Sequence[str], high: Sequence[str]) -> list[Column]:
    """The ends of the places of a group."""
    ends = ((F.min, low), (F.max, high))
    return [end(axis).alias(name) for end, names in ends for axis, name in zip(_AXES, names, strict=True)]


def _tree(sites: DataFrame, on: str) -> DataFrame:
    """The occupied cells of all grids, by prefix, with the box around their sites."""
    depths = F.explode(F.sequence(F.lit(0), F.lit(DEPTHS - 1))).alias("depth")
    return (
        sites.select(on, "place", *_AXES, depths)
        .groupBy(on, "depth", _prefix("depth").alias("cell"))
        .agg(F.count(F.lit(1)).alias("sites"), *_box(_LOW, _HIGH))
    )


@dataclass(frozen=True)
class _Grid:
    """Occupation of one grid: cells, groups that have any, sites of the fullest cell."""

    cells: int
    groups: int
    fullest: int


def _profile(tree: DataFrame, on: str) -> list[_Grid]:
    """Occupation of every grid, coarse to fine."""
    rows = (
        tree.groupBy("depth")
        .agg(
            F.count(F.lit(1)).alias("cells"),
            F.approx_count_distinct(on).alias("groups"),
            F.max("sites").alias("fullest"),
        )
        .collect()  # one row per depth
    )
    ordered = sorted(rows, key=lambda row: row["depth"])
    return [_Grid(row["cells"], row["groups"], row["fullest"]) for row in ordered]


def _grid_cells(tree: DataFrame, on: str, depth: int, root: int) -> DataFrame:
    """The occupied cells of one grid with the cell of the next coarser grid they are in."""
    cells = tree.where(F.col("depth") == depth).select(on, "cell", *_LOW, *_HIGH)
    return cells if depth == root else cells.withColumn("parent", F.shiftright("cell", 3 * STEP_BITS))


def _descend(frontier: DataFrame, boxes: DataFrame, on: Sequence[str], region: Sequence[str], kept: dict[str, str]) -> DataFrame:
    """Replace each cell by the finer boxes that can still hold the nearest site of a point of the region."""
    points, box = (_columns(_FROM), _columns(_TO)), (_columns(_LOW), _columns(_HIGH))
    reached = F.min("far").over(Window.partitionBy(*region)) + F.lit(_TOLERANCE)
    return (
        frontier.join(boxes, on)
        .withColumn("gap", boxes_gap(*points, *box))
        .where(F.col("gap") <= F.col("reach"))
        .select(
            *region,
            *_FROM,
            *_TO,
            *[F.col(name).alias(alias) for name, alias in kept.items()],
            "gap",
            boxes_reach(*points, *box).alias("far"),
        )
        .withColumn("reach", reached)
        .where(F.col("gap") <= F.col("reach"))
        .drop("gap", "far")
    )


def nearest_site(
    points: DataFrame,
    sites: DataFrame,
    *,
    key: Sequence[str],
    on: str,
    site_id: str,
    point_coordinates: tuple[str, str] = ("latitude", "longitude"),
    site_coordinates: tuple[str, str] = ("latitude", "longitude"),
    leaf_sites: int = LEAF_SITES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The nearest site for every ``key`` of ``points``, among sites with the same ``on``.

    Ties go to the smallest site id. A key with several coordinates gets the best over all
    of them; points and sites without coordinates take no part; a key with no site to
    choose from is absent. Returns ``key``, ``on``, ``site_id``, ``distance_km``.

    Tables that measure below ``broadcast_bytes`` are broadcast, and then points are
    shuffled once, by ``key``. Larger ones are joined on their cell, where the adaptive
    skew join splits a crowded cell: it meets at most a few dozen rows of the site side.
    The walk is compute-bound, so regions go into as many partitions as the session asks
    for and small ones must not be merged.
    """
    spark = points.sparkSession
    # Read once per grid, so computed once.
    unique = materialize(_distinct_sites(sites, on, site_id, *site_coordinates))
    tree = materialize(_tree(unique, on))
    grids = _profile(tree, on) or [_Grid(0, 1, 0)]
    # Start at the finest grid that is still a short list, stop at the first one whose
    # leaves are short (the finest one if places stay crowded).
    leaf = next((d for d, g in enumerate(grids) if g.fullest <= leaf_sites), len(grids) - 1)
    short = [d for d, g in enumerate(grids[: leaf + 1]) if g.cells <= ROOT_CELLS * g.groups]
    root = max(short, default=0)

    def sized(table: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(table) if rows * _ROW_BYTES <= broadcast_bytes else table

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lat, lon = point_coordinates
    region = [on, "region"]
    located = _placed(
        points.select(*key, on, F.col(lat).alias("lat"), F.col(lon).alias("lon")).dropna(), F.col("lat"), F.col("lon")
    )
    # A place that is not finite reaches nothing, and would widen the box of its region to nothing.
    finite = ~(F.isnan("x") | F.isnan("y") | F.isnan("z"))
    finer = max(0, STEP_BITS * (DEPTHS - 1 - leaf) - REGION_BITS)
    cell = F.shiftright("place", 3 * finer).alias("region")
    asked = materialize(located.where(finite).select(*key, on, "lat", "lon", *_AXES, cell))

    frontier = (
        asked.groupBy(*region)
        .agg(*_box(_FROM, _TO))
        .repartition(partitions, *region)
        .withColumn("reach", F.lit(2.0 + _TOLERANCE))  # the diameter reaches everything
    )
    for depth in range(root, leaf + 1):
        cells = sized(_grid_cells(tree, on, depth, root), grids[depth].cells)
        frontier = _descend(frontier, cells, [on] if depth == root else [on, "parent"], region, {"cell": "parent"})

    site = ["id", "site_lat", "site_lon"]
    leaves = unique.select(
        on,
        _prefix(leaf).alias("parent"),
        *site,
        *[F.col(axis).alias(name) for names in (_LOW, _HIGH) for axis, name in zip(_AXES, names, strict=True)],
    )
    leaves = sized(leaves, grids[leaf].cells * grids[leaf].fullest)
    left = materialize(_descend(frontier, leaves, [on, "parent"], region, {c: c for c in site}).select(*region, *site))

    candidates = left.count()
    near = sized(left, candidates)
    moved = asked if candidates * _ROW_BYTES > broadcast_bytes else asked.repartition(partitions, *key)
    km = haversine_km(F.col("lat"), F.col("lon"), F.col("site_lat"), F.col("site_lon"))
    measured = moved.join(near, region).select(*key, on, F.col("id").alias(site_id), km.alias("distance_km"))
    return _first(measured, [*key, on], "distance_km", site_id)
