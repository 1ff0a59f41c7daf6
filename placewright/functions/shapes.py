"""GeoJSON geometries as column expressions: their parts with rings and holes, and centroids.

Every geometry is read into one form, an array of parts: ``kind`` 0 for a point, 1 for a line, 2 for an area, and
``rings``, arrays of points (x, y). A point is a ring of one point, a line a ring of its points, and an area has its
outer ring first and its holes behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINTS = "array<struct<x:double,y:double>>"
PARTS = f"array<struct<kind:int,rings:array<{POINTS}>>>"
#: GeoJSON's types: kind of their parts, and brackets that bring their coordinates to those of a multipolygon. The points
#: of one geometry, and its lines, are one part.
TYPES = {"Point": (0, "[[["), "MultiPoint": (0, "[["), "LineString": (1, "[["), "MultiLineString": (1, "["), "Polygon": (2, "["), "MultiPolygon": (2, "")}


def parts_of(geojson: Column) -> Column:
    """The parts of a GeoJSON geometry given as text; of a collection those of its members (one level deep).

    Null for null, for text that is no geometry and for coordinates of another depth than the type's; a part with a position
    without two numbers is left out, and so is a position's third number. Give a written or computed column: the text is read
    more than once."""
    look_up = lambda i: F.create_map(*[x for t, v in TYPES.items() for x in (F.lit(t), F.lit(v[i]))])
    point = lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
    sound = lambda p: F.forall(p["rings"], lambda r: F.forall(r, lambda q: q["x"].isNotNull() & q["y"].isNotNull()))

    def one(member: Column) -> Column:
        kind = F.get_json_object(member, "$.type")
        before = F.element_at(look_up(1), kind)
        text = F.concat(before, F.get_json_object(member, "$.coordinates"), F.translate(before, "[", "]"))
        read = F.from_json(text, "array<array<array<array<double>>>>")
        return F.transform(read, lambda p: F.struct(F.element_at(look_up(0), kind).alias("kind"), F.transform(p, lambda r: F.transform(r, point)).alias("rings")))

    members = F.when(F.get_json_object(geojson, "$.type") == "GeometryCollection", F.from_json(F.get_json_object(geojson, "$.geometries"), "array<string>")).otherwise(F.array(geojson))
    return F.filter(F.flatten(F.filter(F.transform(members, one), lambda p: p.isNotNull())), sound)


def sides(ring: Column, closed: bool = True) -> Column:
    """A ring's sides as (p, q); the last point meets the first where ``closed``."""
    n = F.size(ring)
    last = n - 1 if closed else n - 2
    pair = lambda i: F.struct(F.get(ring, i).alias("p"), F.get(ring, (i + 1) % n).alias("q"))
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), pair)).otherwise(F.array().cast("array<struct<p:struct<x:double,y:double>,q:struct<x:double,y:double>>>"))


def _mass(w: Column, x: Column, y: Column) -> Column:
    return F.struct(w.cast("double").alias("w"), x.cast("double").alias("x"), y.cast("double").alias("y"))


def _added(items: Column) -> Column:
    zero = _mass(F.lit(0.0), F.lit(0.0), F.lit(0.0))
    return F.aggregate(items, zero, lambda s, m: _mass(s["w"] + m["w"], s["x"] + m["x"], s["y"] + m["y"]))


def _ring_mass(ring: Column, hole: Column) -> Column:
    """(area, and its moments), as measured from the ring's first point; an outer ring counts for, a hole against."""
    o = F.get(ring, F.lit(0))

    def side(e: Column) -> Column:
        ax, ay, bx, by = e["p"]["x"] - o["x"], e["p"]["y"] - o["y"], e["q"]["x"] - o["x"], e["q"]["y"] - o["y"]
        cross = ax * by - bx * ay
        return _mass(cross / 2, (ax + bx) * cross / 6, (ay + by) * cross / 6)

    def signed(s: Column) -> Column:
        sign = F.signum(s["w"]) * F.when(hole, -1.0).otherwise(1.0)
        return _mass(s["w"] * sign, (s["x"] + o["x"] * s["w"]) * sign, (s["y"] + o["y"] * s["w"]) * sign)

    zero = _mass(F.lit(0.0), F.lit(0.0), F.lit(0.0))
    return F.aggregate(F.transform(sides(ring), side), zero, lambda s, m: _mass(s["w"] + m["w"], s["x"] + m["x"], s["y"] + m["y"]), signed)


def with_centroid(df: DataFrame, geometry: str = "geometry", x: str = "lng", y: str = "lat") -> DataFrame:
    """``df`` with the centroid of a GeoJSON column: that of its areas together, holes taken out; without area that of its
    lines (outlines of flat areas among them) by length; without length the mean of its points. Null without a point.

    Each step is a column of its own, so that the text is parsed once a row."""
    df = df.withColumn("_parts", parts_of(F.col(geometry)))
    rings = F.flatten(F.transform(F.filter("_parts", lambda p: p["kind"] == 2), lambda p: F.transform(p["rings"], lambda r, i: F.struct(r.alias("r"), (i > 0).alias("hole")))))
    area = _added(F.transform(F.filter(rings, lambda r: F.size(r["r"]) > 0), lambda r: _ring_mass(r["r"], r["hole"])))
    each = lambda p: F.flatten(F.transform(p["rings"], lambda r: sides(r, closed=False)))

    def long(e: Column) -> Column:
        w = F.sqrt(F.pow(e["p"]["x"] - e["q"]["x"], F.lit(2)) + F.pow(e["p"]["y"] - e["q"]["y"], F.lit(2)))
        return _mass(w, w * (e["p"]["x"] + e["q"]["x"]) / 2, w * (e["p"]["y"] + e["q"]["y"]) / 2)

    line = _added(F.transform(F.flatten(F.transform(F.filter("_parts", lambda p: p["kind"] > 0), each)), long))
    spot = _added(F.transform(F.flatten(F.flatten(F.transform("_parts", lambda p: p["rings"]))), lambda q: _mass(F.lit(1.0), q["x"], q["y"])))
    df = df.withColumns({"_area": area, "_line": line, "_spot": spot})
    middle = lambda f: F.coalesce(*[F.when(F.col(f"{m}.w") > 0, F.col(f"{m}.{f}") / F.col(f"{m}.w")) for m in ("_area", "_line", "_spot")])
    return df.withColumns({x: middle("x"), y: middle("y")}).drop("_parts", "_area", "_line", "_spot")
