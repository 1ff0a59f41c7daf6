"""Outlines of states: areas of many rings, with islands and lakes, as tables of edges that rows meet by position.

An outline's edges are dealt to slabs of latitude, an edge to every slab it runs through; slabs are as high as its edges
are on average, so that this at most doubles them. A row meets only its own slab's edges: it lies inside when an odd number
of them, of all rings, cross its parallel to the east. For the distance to the outline, edges are dealt to about as many
cells as the root of their number. A position meets one edge of each cell within reach, then all edges of those cells that
are no farther than the nearest of these."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import shapes
from ..sources.store import settled

#: Degrees of latitude of a slab at most, and of a slab or cell at least.
SLAB, LEAST = 0.01, 1e-7
#: Edges, counted once for every slab or cell they are dealt to, that are sent to all executors; more are met by a shuffle.
SENT = 500_000
EDGE = ("x1", "y1", "x2", "y2")


def edges(outlines: DataFrame, geometry: str = "geometry") -> DataFrame:
    """(state, x1, y1, x2, y2): the sides of all rings of (state, GeoJSON geometry); points and lines have none."""
    rings = outlines.select("state", F.explode(shapes.parts_of(F.col(geometry))).alias("part")).where("part.kind = 2").select("state", F.explode("part.rings").alias("ring"))
    e = rings.select("state", F.explode(shapes.sides(F.col("ring"))).alias("e"))
    return e.select("state", F.col("e.p.x").alias("x1"), F.col("e.p.y").alias("y1"), F.col("e.q.x").alias("x2"), F.col("e.q.y").alias("y2")).where("x1 <> x2 or y1 <> y2")


def band(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(size)).cast("long")


def _steps(low: Column, high: Column, size: float) -> Column:
    return F.sequence(band(low, size), band(high, size))


def slabs(sides: DataFrame, height: float = SLAB) -> DataFrame:
    """(state, slab, edges): each slab's edges that are not level. An edge's upper end is not part of it, as in crossing."""
    y = [F.least("y1", "y2"), F.greatest("y1", "y2")]
    dealt = sides.where("y1 <> y2").select("state", F.explode(_steps(*y, height)).alias("slab"), F.struct(*EDGE).alias("e"))
    return dealt.groupBy("state", "slab").agg(F.collect_list("e").alias("edges"))


def cells(sides: DataFrame, size: float) -> DataFrame:
    """(cy, cx, edges): the edges whose box meets each square of that size."""
    x, y = [F.least("x1", "x2"), F.greatest("x1", "x2")], [F.least("y1", "y2"), F.greatest("y1", "y2")]
    dealt = sides.select(F.explode(_steps(*y, size)).alias("cy"), F.struct(*EDGE).alias("e"), F.array(*x).alias("x"))
    dealt = dealt.select("cy", F.explode(_steps(F.col("x")[0], F.col("x")[1], size)).alias("cx"), "e")
    return dealt.groupBy("cy", "cx").agg(F.collect_list("e").alias("edges"))


def near_cells(sides: DataFrame, near: float) -> DataFrame:
    """(state, cy, cx, edges): the edges whose box comes within ``near`` degrees of each square of that size."""
    x, y = [F.least("x1", "x2") - near, F.greatest("x1", "x2") + near], [F.least("y1", "y2") - near, F.greatest("y1", "y2") + near]
    dealt = sides.select("state", F.explode(_steps(*y, near)).alias("cy"), F.struct(*EDGE).alias("e"), F.array(*x).alias("x"))
    dealt = dealt.select("state", "cy", F.explode(_steps(F.col("x")[0], F.col("x")[1], near)).alias("cx"), "e")
    return dealt.groupBy("state", "cy", "cx").agg(F.collect_list("e").alias("edges"))


def around(table: DataFrame, size: float, near: float) -> DataFrame:
    """(ny, nx, cells): for each square of ``near`` degrees the cells of ``size`` that come within ``near`` of it, each with
    one of its edges."""
    one = table.select(F.struct("cy", "cx", F.col("edges")[0].alias("e")).alias("c"))
    reach = lambda k: _steps(F.col(f"c.{k}") * size - near * (1 + 1e-9), (F.col(f"c.{k}") + 1) * size + near * (1 + 1e-9), near)
    dealt = one.select(F.explode(reach("cy")).alias("ny"), "c").select("ny", F.explode(reach("cx")).alias("nx"), "c")
    return dealt.groupBy("ny", "nx").agg(F.collect_list("c").alias("cells"))


def _met(table: DataFrame) -> DataFrame:
    """``table`` marked for a broadcast if it has at most ``SENT`` edges; otherwise rows meet it by a shuffle."""
    held = table.agg(F.sum(F.size("_edges"))).first()[0] or 0
    return F.broadcast(table) if held <= SENT else table


def crossings(lng: Column, lat: Column, found: Column) -> Column:
    """The number of edges that cross the point's parallel to its east; 0 without edges."""

    def one(s: Column, e: Column) -> Column:
        over = (e["y1"] > lat) != (e["y2"] > lat)
        east = lng < e["x1"] + (lat - e["y1"]) / (e["y2"] - e["y1"]) * (e["x2"] - e["x1"])
        return s + F.when(over & east, 1).otherwise(0)

    return F.coalesce(F.aggregate(found, F.lit(0), one), F.lit(0))


def degrees_to(lng: Column, lat: Column, found: Column) -> Column:
    """Degrees to the nearest of the edges; null without edges."""
    return F.array_min(F.transform(found, lambda e: _degrees(lng, lat, e)))


def _degrees(lng: Column, lat: Column, e: Column) -> Column:
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((lng - e["x1"]) * dx + (lat - e["y1"]) * dy) / (dx * dx + dy * dy)))
    return F.sqrt(F.pow(lng - e["x1"] - t * dx, F.lit(2)) + F.pow(lat - e["y1"] - t * dy, F.lit(2)))


def _to_cell(lng: Column, lat: Column, c: Column, size: float) -> Column:
    """Degrees to the square of a cell; 0 inside."""
    beyond = lambda v, k: F.greatest(F.lit(0.0), k * size - v, v - (k + 1) * size)
    return F.sqrt(F.pow(beyond(lng, c["cx"]), F.lit(2)) + F.pow(beyond(lat, c["cy"]), F.lit(2)))


def with_inside(df: DataFrame, sides: DataFrame, state: str, height: float | None = None, out: str = "inside") -> DataFrame:
    """``df`` with whether (lng, lat) lies in the state; false for a row without a position. Extra columns stay."""
    mine = sides.where(F.col("state") == state)
    if height is None:
        mean = mine.where("y1 <> y2").agg(F.avg(F.abs(F.col("y1") - F.col("y2")))).first()[0]
        height = SLAB if mean is None else min(SLAB, max(mean, LEAST))
    table = _met(settled(slabs(mine, height), "slabs").select(F.col("slab").alias("_slab"), F.col("edges").alias("_edges")))
    rows = df.join(table, band(F.col("lat"), height) == F.col("_slab"), "left")
    inside = F.coalesce(crossings(F.col("lng"), F.col("lat"), F.col("_edges")) % 2 == 1, F.lit(False))
    return rows.withColumn(out, inside).drop("_slab", "_edges")


def nearest(spots: DataFrame, sides: DataFrame, near: float) -> DataFrame:
    """(lat, lng, degrees): the positions at most ``near`` degrees from an edge, with that distance."""
    held, length = sides.agg(F.count(F.lit(1)), F.sum(F.sqrt(F.pow(F.col("x1") - F.col("x2"), F.lit(2)) + F.pow(F.col("y1") - F.col("y2"), F.lit(2))))).first()
    size = min(near, max((length or 0.0) / max(held, 1) ** 0.5, LEAST))
    table = settled(cells(sides, size), "outline-cells")
    reach = settled(around(table, size, near), "outline-near").select("ny", "nx", F.col("cells").alias("_edges"))
    lng, lat = F.col("lng"), F.col("lat")
    rows = spots.join(_met(reach), (band(lat, near) == F.col("ny")) & (band(lng, near) == F.col("nx"))).select("lat", "lng", F.col("_edges").alias("_cells"))
    rows = rows.withColumn("_most", F.least(F.lit(near), F.array_min(F.transform("_cells", lambda c: _degrees(lng, lat, c["e"])))))
    # the nearest edge runs through a cell that is no farther than any edge; the margin is for the last bits of the cells' sides
    close = F.transform(F.filter("_cells", lambda c: _to_cell(lng, lat, c, size) <= F.col("_most") + 1e-9), lambda c: F.struct(c["cy"].alias("cy"), c["cx"].alias("cx")))
    rows = rows.select("lat", "lng", F.explode(close).alias("_c")).select("lat", "lng", F.col("_c.cy").alias("_cy"), F.col("_c.cx").alias("_cx"))
    known = _met(table.select("cy", "cx", F.col("edges").alias("_edges")))
    met = rows.join(known, (F.col("_cy") == F.col("cy")) & (F.col("_cx") == F.col("cx"))).select("lat", "lng", degrees_to(lng, lat, F.col("_edges")).alias("degrees"))
    return met.groupBy("lat", "lng").agg(F.min("degrees").alias("degrees")).where(F.col("degrees") <= near)


def with_degrees(df: DataFrame, sides: DataFrame, state: str, near: float, out: str = "degrees") -> DataFrame:
    """``df`` with the distance in degrees to the state's outline where that is at most ``near``, else null. Rows of one
    position are measured once."""
    spots = settled(df.select("lat", "lng").where("lat is not null and lng is not null").distinct(), "spots")
    tasks = max(4 * df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = settled(nearest(spots.repartition(tasks), sides.where(F.col("state") == state), near), "degrees")
    found = found.select(F.col("lat").alias("_lat"), F.col("lng").alias("_lng"), F.col("degrees").alias("_deg"))
    rows = df.join(found, (F.col("lat") == F.col("_lat")) & (F.col("lng") == F.col("_lng")), "left")
    return rows.withColumn(out, F.col("_deg")).drop("_lat", "_lng", "_deg")


def clip(df: DataFrame, outlines: DataFrame, state: str, near: float = 0.05) -> DataFrame:
    """Rows inside the state's outline, or whose ``region`` names the state and that lie within ``near`` degrees of it.

    Rows beyond the outline's box go first, before any edge is met; rows without a position go. A state that ``outlines``
    (state, geometry) does not have keeps nothing; several geometries of a state count together."""
    sides = settled(edges(outlines.where(F.col("state") == state)), "edges")
    box = sides.agg(F.min(F.least("x1", "x2")), F.max(F.greatest("x1", "x2")), F.min(F.least("y1", "y2")), F.max(F.greatest("y1", "y2"))).first()
    if box[0] is None:
        return df.limit(0)
    around = df.where(F.col("lng").between(box[0] - near, box[1] + near) & F.col("lat").between(box[2] - near, box[3] + near))
    rows = with_inside(with_degrees(around, sides, state, near, out="_far"), sides, state, out="_in")
    return rows.where(F.col("_in") | (F.coalesce(F.col("region") == state, F.lit(False)) & F.col("_far").isNotNull())).drop("_in", "_far")
