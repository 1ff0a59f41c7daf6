"""Positions: distances, grid cells, the Hilbert curve and one projection, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

CELL_LAT, CELL_LNG = 4e-3, 8e-3
METRES_PER_DEGREE = 111320.0


def dist_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Metres on a flat earth around the two points; good below a kilometre or so."""
    x = (lng1 - lng2) * F.cos(F.radians((lat1 + lat2) / 2))
    return F.lit(METRES_PER_DEGREE) * F.sqrt(F.pow(lat1 - lat2, F.lit(2)) + F.pow(x, F.lit(2)))


def round_to(c: Column, digits: int) -> Column:
    """Half up by floor, which engines agree on."""
    return F.floor(c * F.lit(10.0**digits) + F.lit(0.5)).cast("double") / F.lit(10.0**digits)


def cell_y(lat: Column) -> Column:
    return F.floor(lat / F.lit(CELL_LAT)).cast("int")


def cell_x(lng: Column) -> Column:
    return F.floor(lng / F.lit(CELL_LNG)).cast("int")


def in_box(lat: Column, lng: Column, box: tuple[float, float, float, float]) -> Column:
    """box: south, west, north, east."""
    s, w, n, e = box
    return lat.between(s, n) & lng.between(w, e)


def hilbert(lat: Column, lng: Column, box: tuple[float, float, float, float], bits: int = 16) -> Column:
    """The point's place on the Hilbert curve through the box, for clustering."""
    s, w, n, e = box
    most = 2**bits - 1
    grid = lambda v, lo, hi: F.greatest(F.lit(0), F.least(F.lit(most), F.floor((v - lo) / (hi - lo) * F.lit(float(most + 1))))).cast("long")
    start = F.struct(grid(lng, w, e).alias("x"), grid(lat, s, n).alias("y"), F.lit(0).cast("long").alias("d"))

    def step(state: Column, k: Column) -> Column:
        side = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        rx = (state["x"].bitwiseAND(side) > 0).cast("long")
        ry = (state["y"].bitwiseAND(side) > 0).cast("long")
        d = state["d"] + side * side * (F.lit(3) * rx).bitwiseXOR(ry)
        flip = (ry == 0) & (rx == 1)
        x, y = F.when(flip, F.lit(most) - state["x"]).otherwise(state["x"]), F.when(flip, F.lit(most) - state["y"]).otherwise(state["y"])
        return F.struct(F.when(ry == 0, y).otherwise(x).alias("x"), F.when(ry == 0, x).otherwise(y).alias("y"), d.alias("d"))

    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step, lambda s: s["d"])


# Fixed values of the Lambert-93 projection on GRS80.
_N, _C, _XS, _YS, _E, _L0 = 0.7256077650532670, 11754255.426096, 700000.0, 12655612.049876, 0.0818191910428158, 3 * math.pi / 180


def lambert93(x: Column, y: Column, part: str) -> Column:
    """Longitude or latitude ('lng' or 'lat') in degrees of a Lambert-93 position: the inverse conic, six iterations."""
    dx, dy = x - F.lit(_XS), y - F.lit(_YS)
    if part == "lng":
        return F.degrees(F.atan(-dx / dy) / F.lit(_N) + F.lit(_L0))
    iso = -F.log(F.sqrt(dx * dx + dy * dy) / F.lit(_C)) / F.lit(_N)
    first = 2 * F.atan(F.exp(iso)) - F.lit(math.pi / 2)

    def step(phi: Column, _: Column) -> Column:
        s = F.lit(_E) * F.sin(phi)
        return 2 * F.atan(F.pow((1 + s) / (1 - s), F.lit(_E / 2)) * F.exp(iso)) - F.lit(math.pi / 2)

    return F.degrees(F.aggregate(F.sequence(F.lit(1), F.lit(6)), first, step))
