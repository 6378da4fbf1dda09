"""Great-circle distance, and the grid and bounds used to search by it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle kilometres between two points in degrees; NULL if any part is NULL."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_phi = F.sin((phi2 - phi1) / 2)
    half_lambda = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    square = half_phi * half_phi + F.cos(phi1) * F.cos(phi2) * half_lambda * half_lambda
    # least/greatest skip NULLs, so the clamp must not see one.
    within = F.when(square.isNotNull(), F.least(F.greatest(square, F.lit(0.0)), F.lit(1.0)))
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(within))


def unit_vector(lat: Column, lon: Column) -> dict[str, Column]:
    """The point on the unit sphere as x, y and z.

    Straight-line distance between such points grows with the great-circle distance, and
    knows neither poles nor a date line, which makes it the right space to search in.
    """
    phi, lam = F.radians(lat), F.radians(lon)
    return {"x": F.cos(phi) * F.cos(lam), "y": F.cos(phi) * F.sin(lam), "z": F.sin(phi)}


# Fixed masks and shifts that put two zero bits between the bits of a 21-bit number.
_SPREAD = (
    (32, 0x1F00000000FFFF),
    (16, 0x1F0000FF0000FF),
    (8, 0x100F00F00F00F00F),
    (4, 0x10C30C30C30C30C3),
    (2, 0x1249249249249249),
)


def z_order(x: Column, y: Column, z: Column, bits: int) -> Column:
    """Number of the cell, among ``2**bits`` per axis over the unit sphere, in Z-order.

    Without its last three bits it is the number of the cell of twice the size around it, so
    the prefixes of one number name the cells of all coarser grids.
    """
    if not 1 <= bits <= 21:
        raise ValueError("from 1 to 21 bits per axis")

    def spread(part: Column) -> Column:
        place = F.floor((part + 1) * F.lit(float(2 ** (bits - 1)))).cast("long")
        # A coordinate of exactly 1 belongs to the last cell.
        out = F.least(F.greatest(place, F.lit(0)), F.lit(2**bits - 1)).cast("long")
        for shift, mask in _SPREAD:
            out = out.bitwiseOR(F.shiftleft(out, shift)).bitwiseAND(F.lit(mask))
        return out

    return F.shiftleft(spread(x), 2).bitwiseOR(F.shiftleft(spread(y), 1)).bitwiseOR(spread(z))


def chord(p: Sequence[Column], q: Sequence[Column]) -> Column:
    """Straight-line distance between two vectors."""
    return F.sqrt(sum((F.pow(a - b, 2) for a, b in zip(p, q, strict=True)), F.lit(0.0)))


def boxes_gap(
    low: Sequence[Column], high: Sequence[Column], other_low: Sequence[Column], other_high: Sequence[Column]
) -> Column:
    """Straight-line distance between two boxes; no point of one is nearer to a point of the other."""
    ends = zip(low, high, other_low, other_high, strict=True)
    gaps = (F.greatest(c - b, a - d, F.lit(0.0)) for a, b, c, d in ends)
    return F.sqrt(sum((F.pow(gap, 2) for gap in gaps), F.lit(0.0)))


def boxes_reach(
    low: Sequence[Column], high: Sequence[Column], other_low: Sequence[Column], other_high: Sequence[Column]
) -> Column:
    """Straight-line distance between the farthest corners; no two points are farther from each other."""
    ends = zip(low, high, other_low, other_high, strict=True)
    far = (F.greatest(F.abs(b - c), F.abs(d - a)) for a, b, c, d in ends)
    return F.sqrt(sum((F.pow(part, 2) for part in far), F.lit(0.0)))


def box_gap(p: Sequence[Column], low: Sequence[Column], high: Sequence[Column]) -> Column:
    """Straight-line distance to a box; no point inside is nearer."""
    return boxes_gap(p, p, low, high)


def box_reach(p: Sequence[Column], low: Sequence[Column], high: Sequence[Column]) -> Column:
    """Straight-line distance to the farthest corner of a box; no point inside is farther."""
    return boxes_reach(p, p, low, high)
