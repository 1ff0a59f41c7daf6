"""Rows that are alike meet once: the pairs that are compared are counted, the results are those of all rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from placewright.functions import similarity
from placewright.operators import groups, match, outline
from placewright.plans import build, queries
from placewright.sources import store

PLACES = [("p1", "Blue Door", "12 Elm St", "20001", 38.0, -77.0), ("p2", "Blue Doors", "12 Elm St", "20001", 38.0, -77.0), ("p3", "Blue Door", None, None, 38.0001, -77.0), ("p4", "Red Lamp", "12 Elm St", "20001", 38.0, -77.0)]


def places(spark):
    df = spark.createDataFrame(PLACES, "id string, name string, address string, postcode string, lat double, lng double")
    return build.addressed(build.named(df))


def register(spark, again):
    """Each record ``again`` times: at a place's number, without a number, and without a position."""
    kinds = [("BLUE DOOR LLC", "12 Elm St, Town, DC 20001", 38.0, -77.0), ("Blue Door", "Elm Plaza", 38.0, -77.0), ("Blue Door", "12 Elm St, Town, DC 20001", None, None), ("Grey Goose", "12 Elm St, Town, DC 20001", None, None)]
    rows = [("r", f"{k}-{i}", n, a, lat, lng, "open") for k, (n, a, lat, lng) in enumerate(kinds) for i in range(again)]
    df = spark.createDataFrame(rows, "source string, source_id string, name string, address string, lat double, lng double, state string")
    return build.keyed_register(df.withColumn("date", F.lit("2001-01-01").cast("date")))


def test_alike_records_are_compared_once_and_all_get_their_evidence(spark, monkeypatch):
    compared, passing = [], similarity.passing

    def counted(pairs, *more):
        compared.append(pairs.count())
        return passing(pairs, *more)

    monkeypatch.setattr(similarity, "passing", counted)
    got = Counter((r.place_id, r.source_id.split("-")[0], r.rule) for r in match.attach_evidence(places(spark), register(spark, 40)).collect())
    # by number both spellings; without a number the nearest place of the best name; without a position by the door
    assert got == {("p1", "0", "number"): 40, ("p2", "0", "number"): 40, ("p1", "1", "near"): 40, ("p1", "2", "address"): 40, ("p2", "2", "address"): 40}
    assert sum(compared) < 40  # 40 of each record at each place would be over 400


def test_match_address_pairs_every_row_of_alike_ones(spark):
    a = places(spark).where("zip is not null")
    a = a.unionByName(a.withColumn("id", F.concat("id", F.lit("x"))))
    rows = match.match_address(a, register(spark, 3).where("lat is null")).collect()
    assert {(r.a_id, r.b_id) for r in rows} == {(p, f"r:2-{i}") for p in ("p1", "p1x", "p2", "p2x") for i in range(3)} and len(rows) == 12


def test_gathered_rows_spread_to_themselves(spark):
    rows = [("a", i) for i in range(50)] + [(None, i) for i in range(7)] + [("b", 1), ("b", 1)]
    df = groups.gathered(spark.createDataFrame(rows, "k string, v int"), ["k"], "v", most=10)
    assert df.where("k = 'a'").count() > 1 and df.where("k is null").count() == 1
    assert Counter((r.k, r.v) for r in groups.spread(df, "v").collect()) == Counter(rows)


def test_by_value_is_the_same_for_few_and_many_values(spark, monkeypatch):
    df = spark.createDataFrame([("The Inc",), ("Blue Door",), ("Blue Door",), (None,)], "name string")
    few = groups.by_value(df, "name", {"n": F.length("name")}).collect()
    monkeypatch.setattr(groups, "SENT", 1)
    many = groups.by_value(df, "name", {"n": F.length("name")}).collect()
    assert sorted(map(str, few)) == sorted(map(str, many)) and len(few) == 4


def test_names_that_repeat_meet_once(spark):
    a = spark.createDataFrame([(f"a{i}", f"name {i % 2}", "k", "1") for i in range(30)] + [("a", "name 0", None, "1")], "id string, name string, category string, hn string")
    b = spark.createDataFrame([(f"b{i}", f"Name {i % 3}", "k", "1") for i in range(30)] + [("b", "name 0", "k", None)], "id string, name string, category string, hn string")
    met = queries._met(a, b, "name", "category", "hn", traits=True)
    assert met.count() == 6  # of 900 pairs of rows
    got = {(r.a_id, r.b_id): r.ok for r in groups.spread(similarity.tested(met, "ok").select("a_id", "b_id", "ok"), "a_id", "b_id").collect()}
    want = similarity.with_same_name(a.join(b.withColumnsRenamed({"id": "b_id", "name": "b"}), ["category", "hn"]), "name", "b", "ok").collect()
    assert got == {(r.id, r.b_id): r.ok for r in want} and len(want) == 900


def test_scores_by_bits_equal_those_by_tables_of_letters():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcd東é") for _ in range(rng.choice([1, 2, 5, 9, 33, 64]))) for _ in range(60)] + ["a" * 64, "ab" * 32]
    a, b = (np.array(x, object) for x in zip(*[(x, y) for x in words for y in words]))
    assert (similarity._places(a, b) == similarity._scores(a.astype(str), b.astype(str))).all()
    many = np.array([chr(0x4E00 + i) for i in range(2000)], object)
    assert similarity._places(many, many) is None and (similarity.jaro_winkler_array(many, many) == 1).all()


def test_outlines_of_many_edges_are_met_by_few(spark, monkeypatch):
    n = 4000
    ring = [(-77 + 0.07 * math.cos(2 * math.pi * i / n), 38.9 + 0.07 * math.sin(2 * math.pi * i / n)) for i in range(n)]
    sides = spark.createDataFrame([("AA", *ring[i], *ring[(i + 1) % n]) for i in range(n)], "state string, x1 double, y1 double, x2 double, y2 double")
    rng = random.Random(4)
    spots = [(i, 38.9 + rng.uniform(-0.15, 0.15), -77 + rng.uniform(-0.15, 0.15)) for i in range(60)] + [(60, 38.9, -77.0), (61, None, -77.0), (62, 38.97, -77.0), (63, 38.9, -76.93)]
    df = spark.createDataFrame(spots, "id int, lat double, lng double")
    met, slabs, degrees = [], outline.slabs, outline.nearest

    def counted(*args):
        out = slabs(*args)
        met.append(out.agg(F.max(F.size("edges"))).first()[0])
        return out

    monkeypatch.setattr(outline, "slabs", counted)
    inside = {r.id: r.inside for r in outline.with_inside(df, sides, "AA").collect()}
    far = {r.id: r.degrees for r in outline.with_degrees(df, sides, "AA", 0.05).collect()}
    assert max(met) < 200  # slabs of 0.01 degrees hold up to 700 of these edges
    cells = outline.cells(sides, 0.007)
    assert degrees(df.where("id < 3"), sides, 0.05).count() <= 3 and cells.agg(F.max(F.size("edges"))).first()[0] < n / 20
    for i, lat, lng in spots:
        if lat is None:
            assert far[i] is None and not inside[i]
            continue
        want = 9.0
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            t = max(0.0, min(1.0, ((lng - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)))
            want = min(want, math.hypot(lng - x1 - t * (x2 - x1), lat - y1 - t * (y2 - y1)))
        assert far[i] == pytest.approx(want, abs=1e-12) if want <= 0.05 else far[i] is None
        if want > 1e-6:
            assert inside[i] == (math.hypot(lng + 77, lat - 38.9) < 0.07)


def test_grid_candidates_measure_two_positions_once(spark, monkeypatch):
    rows = [(f"{i}", 38.9 + (i % 3) * 1e-3, -77.0 + (i % 2) * 5e-3) for i in range(60)]
    a = spark.createDataFrame(rows, "id string, lat double, lng double")
    b = spark.createDataFrame([*rows[:30], ("far", 39.5, -77.0), ("none", None, -77.0)], "id string, lat double, lng double")
    measured, spread = [], groups.spread

    def counted(df, *values):
        measured.append(df.count())
        return spread(df, *values)

    monkeypatch.setattr(groups, "spread", counted)
    got = Counter((r.a_id, r.b_id) for r in match.grid_candidates(a, b).collect())
    cell = lambda lat, lng: (math.floor(lat / 4e-3), math.floor(lng / 8e-3))
    close = lambda p, q: all(abs(x - y) <= 1 for x, y in zip(cell(*p[1:]), cell(*q[1:])))
    assert got == Counter((p[0], q[0]) for p in rows for q in rows[:30] if close(p, q))
    assert measured == [36]  # six positions by six, not 1,800 pairs of rows


def test_large_tables_in_small_files_are_not_broadcast(spark):
    spark.conf.unset("spark.sql.sources.fileCompressionFactor")
    table = store.settled(spark.range(0, 400_000, 1, 1).select(F.col("id").alias("k"), F.concat(F.lit("a long name that many rows have " * 4), F.col("id") % 9000).alias("v")), "wide")
    plan = table.join(table.select("k", F.col("v").alias("w")), "k")._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    few = table.join(F.broadcast(table.limit(3).select("k")), "k")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in few
