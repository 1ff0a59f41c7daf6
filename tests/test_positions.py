"""Grid joins, outlines and geometries against plain readings of them."""

import json
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from placewright.functions import geo, shapes
from placewright.operators import grid, match, mint, outline


def metres(a, b):
    return geo.METRES_PER_DEGREE * math.hypot(a[0] - b[0], (a[1] - b[1]) * math.cos(math.radians((a[0] + b[0]) / 2)))


def cell(p):
    return math.floor(p[0] / geo.CELL_LAT), math.floor(p[1] / geo.CELL_LNG)


def plain_within(a, b, reach, keyed):
    out = Counter()
    for i, x in a.items():
        for j, y in b.items():
            if None in (*x[:2], *y[:2]) or (keyed and (x[2] is None or x[2] != y[2])):
                continue
            (p, q), (r, s) = cell(x), cell(y)
            if abs(p - r) <= 1 and abs(q - s) <= 1 and metres(x, y) <= reach:
                out[i, j] += 1
    return out


def points(rng, n, lat, lng, spread):
    return [(lat + rng.uniform(-spread, spread), lng + rng.uniform(-spread, spread), rng.choice("12")) for _ in range(n)]


@pytest.mark.parametrize("lay", ["a", "b"])
@pytest.mark.parametrize("most", [3, 25, 2000])
@pytest.mark.parametrize("keys", [(), ("hn",)])
def test_grid_join_equals_all_pairs(spark, lay, most, keys):
    """Borders, the equator and Greenwich, the far north, and many rows at one spot; each pair once."""
    rng = random.Random(most)
    made = []
    for lat, lng in ((38.9, -77.0), (0.0, 0.0), (-33.8, 151.2), (71.0, 25.7)):
        made += points(rng, 60, lat, lng, 0.006)
    made += [(38.9, -77.0, "1")] * 40 + [(0.004, 0.008, "2"), (0.008, 0.016, "2"), (None, 1.0, "1"), (1.0, None, "1"), (38.9, -77.0, None)]
    a, b = dict(enumerate(made[::2])), dict(enumerate(made[1::2]))
    side = lambda rows, s: spark.createDataFrame([(i, *r, "x") for i, r in rows.items()], f"{s}_id long, {s}_lat double, {s}_lng double, {s}_hn string, {s}_extra string").repartition(4)
    got = grid.within(side(a, "a"), side(b, "b"), 250, keys, most, lay)
    assert Counter((r.a_id, r.b_id) for r in got.collect()) == plain_within(a, b, 250, bool(keys))
    assert set(got.columns) == {f"{s}_{c}" for s in "ab" for c in ("id", "lat", "lng", "hn", "extra")} | {"_m"}


def test_copies_are_fewer_than_nine(spark):
    rng = random.Random(4)
    df = spark.createDataFrame(points(rng, 2000, 38.9, -77.0, 0.1), "lat double, lng double, hn string")
    per = [grid.copied(df.withColumn("id", F.monotonically_increasing_id()), m, None).groupBy("id").count().agg(F.max("count"), F.avg("count")).first() for m in (250, 60)]
    assert per[0][0] <= 6 and per[1][0] <= 4 and per[0][1] < 3.8 and per[1][1] < 1.7


def test_a_crowded_cell_is_split_evenly(spark):
    """100,000 listings in one cell, a third of them at one address: no leaf has many more rows than it may."""
    n = 100_000
    spot = F.rand(5) < 0.33
    df = spark.range(n).select("id", F.when(spot, 38.9001).otherwise(38.9 + F.rand(1) * 0.0039).alias("lat"), F.when(spot, -76.9999).otherwise(-77.0 + F.rand(2) * 0.0079).alias("lng"), F.lit("shop").alias("nn"), F.lit(None).cast("string").alias("hn"))
    df = df.persist()
    nodes = grid.crowded(df)
    leaves = grid.laid_out(df, nodes).groupBy(*grid.LEAF).count().agg(F.max("count"), F.sum("count"), F.count("*")).first()
    assert leaves[1] == n and leaves[0] < 1.3 * grid.LEAF_ROWS and leaves[2] < 20 * n / grid.LEAF_ROWS
    few = spark.createDataFrame([(i, 38.9 + i * 1e-4, -77.0 + i * 2e-4, "shop", None) for i in range(39)], "id long, lat double, lng double, nn string, hn string")
    pairs = match.match_near(df, few, lay="a").groupBy("b_id").count().collect()
    here = [(r.lat, r.lng) for r in df.select("lat", "lng").collect()]
    want = {i: sum(metres(p, (38.9 + i * 1e-4, -77.0 + i * 2e-4)) <= match.NEAR_M for p in here) for i in (0, 1, 20)}
    assert {r.b_id: r["count"] for r in pairs if r.b_id in want} == want
    close = mint.lookalikes(few.withColumn("nn", F.lit("shop")), df)
    assert close.count() == 39
    df.unpersist()


def test_grid_candidates_copy_blocks(spark):
    rng = random.Random(9)
    a, b = points(rng, 150, 0.0, 0.0, 0.02), points(rng, 150, 0.0, 0.0, 0.02)
    side = lambda rows: spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, lat double, lng double, hn string")
    want = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if abs(cell(x)[0] - cell(y)[0]) <= 1 and abs(cell(x)[1] - cell(y)[1]) <= 1}
    for lay in "ab":
        got = [(r.a_id, r.b_id) for r in match.grid_candidates(side(a), side(b), lay).collect()]
        assert len(got) == len(want) and set(got) == want


def ring(n, x, y, r, turn=1):
    return [[x + r * (1 + 0.2 * math.sin(7 * t)) * math.cos(t), y + r * (1 + 0.2 * math.sin(7 * t)) * math.sin(t)] for t in (turn * 2 * math.pi * i / n for i in range(n))]


def crosses(rings, p):
    return sum((a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) / (b[1] - a[1]) * (b[0] - a[0]) for r in rings for a, b in zip(r, r[1:] + r[:1])) % 2 == 1


def gap(rings, p):
    def to(a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        t = max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)))
        return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)

    return min(to(a, b) for r in rings for a, b in zip(r, r[1:] + r[:1]) if a != b)


@pytest.fixture(scope="module")
def state(spark):
    """A mainland of 10,000 edges with a lake and an islet in it, and an island; rings of either direction, one of them closed."""
    rings = [ring(10_000, -77.0, 38.9, 0.5), ring(300, -77.1, 38.9, 0.1, -1), ring(50, -77.1, 38.9, 0.03), ring(80, -76.2, 39.3, 0.05)]
    rings[3].append(rings[3][0])
    geometry = json.dumps({"type": "MultiPolygon", "coordinates": [[rings[0], rings[1]], [rings[2]], [rings[3]]]})
    return rings, spark.createDataFrame([("AA", geometry, 1), ("BB", json.dumps({"type": "Polygon", "coordinates": [ring(9, 0, 0, 1)]}), 2), ("AA", None, 3)], "state string, geometry string, slab int")


def test_outline_with_islands_and_a_lake(spark, state):
    rings, outlines = state
    rng = random.Random(6)
    spots = [(rng.uniform(-77.8, -76.0), rng.uniform(38.2, 39.6)) for _ in range(300)] + [(rng.uniform(-77.25, -76.95), rng.uniform(38.75, 39.05)) for _ in range(100)] + [(-76.2 + rng.uniform(-0.1, 0.1), 39.3 + rng.uniform(-0.1, 0.1)) for _ in range(40)]
    rows = [(i, *p, rng.choice(["AA", "BB", None]), "x") for i, p in enumerate(spots)] + [(1000, None, 38.9, "AA", "x"), (1001, -77.0, None, "AA", "x"), (1002, None, None, None, None)]
    df = spark.createDataFrame(rows, "id long, lng double, lat double, region string, edges string")
    inside = {i: crosses(rings, p) for i, p in enumerate(spots)}
    sides = outline.edges(outlines)
    got = {r.id: r.inside for r in outline.with_inside(df, sides, "AA").collect()}
    assert got == inside | {1000: False, 1001: False, 1002: False} and 50 < sum(inside.values()) < 400
    near = {i: gap(rings, p) for i, p in enumerate(spots)}
    far = {r.id: r.degrees for r in outline.with_degrees(df, sides, "AA", 0.05).collect()}
    assert all((far[i] is None) == (near[i] > 0.05) and (far[i] is None or abs(far[i] - near[i]) < 1e-9) for i in near)
    for send in (outline.SENT, 0):
        outline.SENT, before = send, outline.SENT
        kept = outline.clip(df, outlines, "AA")
        assert {r.id for r in kept.collect()} == {i for i, p in enumerate(spots) if inside[i] or (rows[i][3] == "AA" and near[i] <= 0.05)}
        assert kept.columns == df.columns
        outline.SENT = before
    assert outline.clip(df, outlines, "ZZ").count() == 0


def test_a_row_meets_its_slab_only(state):
    rings, outlines = state
    held = outline.slabs(outline.edges(outlines).where("state = 'AA'")).agg(F.max(F.size("edges")), F.count("*")).first()
    assert held[0] < 900 and held[1] > 90
    near = outline.near_cells(outline.edges(outlines).where("state = 'AA'"), 0.05).agg(F.max(F.size("edges"))).first()
    assert near[0] < 2500


def test_geometries_that_are_none(spark):
    """Text that is no geometry, wrong depth, empty ones, a third coordinate, flat areas and a collection without members."""
    g = lambda kind, c: json.dumps({"type": kind, "coordinates": c})
    cases = [
        (None, None), ("", None), ("nonsense", None), ("{}", None), (g("Point", [1, 2]), (1, 2)), (g("Point", [1, 2, 99]), (1, 2)), (g("Point", [1]), None), (g("Point", []), None), (g("Point", [[1, 2]]), None), (g("Curve", [1, 2]), None),
        (g("Polygon", []), None), (g("Polygon", [[]]), None), (g("LineString", [[0, 0], [2, 0]]), (1, 0)), (g("LineString", [[3, 4]]), (3, 4)), (g("LineString", [[3, 4], [3, 4]]), (3, 4)),
        (g("Polygon", [[[0, 0], [4, 0], [0, 0]]]), (2, 0)), (g("Polygon", [[[5, 5], [5, 5], [5, 5]]]), (5, 5)), (g("Polygon", [[[0, 0], [2, 0], [2, 2], [0, 2]]]), (1, 1)),
        (json.dumps({"type": "GeometryCollection", "geometries": []}), None),
        (json.dumps({"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [9, 9]}, {"type": "LineString", "coordinates": [[0, 0], [0, 4]]}]}), (0, 2)),
        (g("MultiPolygon", [[[[0, 0], [0, 2], [2, 2], [2, 0]]], [[[10, 0], [12, 0], [12, 2], [10, 2]]]]), (6, 1)),
    ]
    df = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(cases)], "id long, geometry string, rings string")
    got = {r.id: r for r in shapes.with_centroid(df).collect()}
    for i, (text, want) in enumerate(cases):
        at = got[i].lng, got[i].lat
        assert (at == (None, None)) if want is None else at == pytest.approx(want), (text, at, want)
