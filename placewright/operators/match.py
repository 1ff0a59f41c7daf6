"""Entity matching by position, house number and name.

The three rules exclude each other on house numbers, so that each is an equality join of its own on the grid's leaves
(``grid``): ``number`` by house number, ``near`` where a number is missing, ``spot`` by name. The smaller side is copied to
the leaves that the rule's reach touches; crowded cells are split. Pairs within reach are scored as they stream by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geo, similarity
from ..sources.store import settled
from . import grid, groups

NUMBER_M, NEAR_M, SPOT_M = 250, 60, 30
RANK = {"number": 1, "near": 2, "spot": 3}
SIDE = ("id", "nn", "hn", "lat", "lng")


def with_cell(df: DataFrame) -> DataFrame:
    return df.withColumns({"cy": geo.cell_y(F.col("lat")), "cx": geo.cell_x(F.col("lng"))})


def _side(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{name}_{c}") for c in SIDE], *similarity.traits(F.col("nn"), name))


def distance() -> Column:
    return geo.dist_m(F.col("a_lat"), F.col("a_lng"), F.col("b_lat"), F.col("b_lng"))


def larger(a: DataFrame, b: DataFrame) -> str:
    """'a' or 'b': the side with more rows, which is not to be copied."""
    return "a" if a.count() >= b.count() else "b"


def grid_candidates(a: DataFrame, b: DataFrame, lay: str | None = None) -> DataFrame:
    """(a_id, b_id, dist): every pair in the same or neighbouring cells. For inspection; the rules join more closely.

    Rows of one position meet as one, so that a distance is computed once for two positions. The side with fewer rows is copied
    to the blocks of four cells that its neighbours lie in: four copies on average, not nine."""
    lay = lay or larger(a, b)

    def side(df: DataFrame, n: str) -> DataFrame:
        one = groups.gathered(df.select("id", "lat", "lng"), ["lat", "lng"], "id").where("lat is not null and lng is not null")
        laid = grid.blocks(one, wide=n != lay).withColumnsRenamed({c: f"{n}_{c}" for c in ("id", "lat", "lng", "cy", "cx")})
        return groups.dealt(laid, "_by", "_bx")

    near = (F.abs(F.col("a_cy") - F.col("b_cy")) <= 1) & (F.abs(F.col("a_cx") - F.col("b_cx")) <= 1)
    out = side(a, "a").join(side(b, "b"), ["_by", "_bx"]).where(near)
    return groups.spread(out.select("a_id", "b_id", geo.round_to(distance(), 1).alias("dist")), "a_id", "b_id")


def _scored(pairs: DataFrame, rule: str) -> DataFrame:
    pairs = similarity.passing(pairs)
    return pairs.select("a_id", "b_id", geo.round_to(F.col("_m"), 1).alias("dist"), geo.round_to(F.col("sim"), 3).alias("sim"), F.lit(rule).alias("rule"))


def match_number(a: DataFrame, b: DataFrame, lay: str | None = None, most: int | None = grid.LEAF_ROWS) -> DataFrame:
    left, right = _side(a.where("hn is not null"), "a"), _side(b.where("hn is not null"), "b")
    return _scored(grid.within(left, right, NUMBER_M, ("hn",), most, lay), "number")


def match_near(a: DataFrame, b: DataFrame, lay: str | None = None, most: int | None = grid.LEAF_ROWS) -> DataFrame:
    one = grid.within(_side(a.where("hn is null"), "a"), _side(b, "b"), NEAR_M, (), most, lay)
    two = grid.within(_side(a.where("hn is not null"), "a"), _side(b.where("hn is null"), "b"), NEAR_M, (), most, lay)
    return _scored(one.unionByName(two), "near")


def match_spot(a: DataFrame, b: DataFrame, lay: str | None = None, most: int | None = grid.LEAF_ROWS) -> DataFrame:
    left, right = _side(a.where("hn is not null"), "a"), _side(b.where("hn is not null"), "b")
    pairs = grid.within(left, right, SPOT_M, ("nn",), most, lay).where("a_hn <> b_hn")
    return pairs.select("a_id", "b_id", geo.round_to(F.col("_m"), 1).alias("dist"), F.lit(1e0).alias("sim"), F.lit("spot").alias("rule"))


def match_pairs(a: DataFrame, b: DataFrame, require_name: bool = False, lay: str | None = None, stored: bool = False) -> DataFrame:
    """(a_id, b_id, dist, sim, rule) of every pair that a rule takes. Sides: id, nn, hn, lat, lng; rows without a name
    or position match nothing. Empty normalized names match each other unless ``require_name``.

    Each rule reads the sides, so that they are written first, with these columns only, unless they are ``stored`` tables
    already. ``lay`` ('a' or 'b') names the side that is not copied; without it the sides are counted."""
    ready = F.col("nn").isNotNull() & F.col("lat").isNotNull() & F.col("lng").isNotNull()
    ready = ready & (F.col("nn") != "") if require_name else ready
    a, b = a.where(ready).select(*SIDE), b.where(ready).select(*SIDE)
    if not stored:
        a, b = settled(a, "match-places"), settled(b, "match-rows")
    lay = lay or larger(a, b)
    most = None if grid.crowded({"a": a, "b": b}[lay]) is None else grid.LEAF_ROWS  # without a crowded cell no rule has one
    return match_number(a, b, lay, most).unionByName(match_near(a, b, lay, most)).unionByName(match_spot(a, b, lay, most))


def self_match(df: DataFrame) -> DataFrame:
    """(a_id, b_id): listings of one table with the same number and normalized name within the number rule's reach."""
    df = df.where(F.col("hn").isNotNull() & F.col("nn").isNotNull())
    pairs = grid.within(_side(df, "a"), _side(df, "b"), NUMBER_M, ("hn", "nn"), lay="a")
    return pairs.where("a_id <> b_id").select("a_id", "b_id")


def match_address(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of equal ZIP, house number and street word whose names pass. Sides: id, nn, hn, zip, sk.

    Rows of one name behind one door meet as one."""
    door = ["zip", "hn", "sk"]

    def side(df: DataFrame, n: str) -> DataFrame:
        one = groups.gathered(df.select(*door, F.col("nn").alias(f"{n}_nn"), F.col("id").alias(f"{n}_id")), [*door, f"{n}_nn"], f"{n}_id")
        one = one.where(" and ".join(f"{c} is not null" for c in (*door, f"{n}_nn")))
        return groups.dealt(one.select("*", *similarity.traits(F.col(f"{n}_nn"), n)), *door)

    pairs = similarity.passing(side(a, "a").join(side(b, "b"), door))
    pairs = groups.spread(pairs.select("a_id", "b_id", "sim"), "a_id", "b_id")
    return pairs.select("a_id", "b_id", F.lit(None).cast("double").alias("dist"), geo.round_to(F.col("sim"), 3).alias("sim"), F.lit("address").alias("rule"))


def rule_rank(rule: Column) -> Column:
    return F.when(rule == "number", 1).when(rule == "near", 2).otherwise(3)


def best_match(pairs: DataFrame) -> DataFrame:
    """The one best place of each incoming row: number before near before spot, then similarity, distance, id."""
    w = W.partitionBy("b_id").orderBy(rule_rank(F.col("rule")), F.desc("sim"), "dist", "a_id")
    return pairs.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def any_number(pairs: DataFrame) -> DataFrame:
    """The pairs with ``any_number``: whether the incoming row has a number match."""
    return pairs.withColumn("any_number", F.max(F.col("rule") == "number").over(W.partitionBy("b_id")))


def attach_evidence(places: DataFrame, register: DataFrame, stored: bool = False) -> DataFrame:
    """(place_id, source, source_id, state, date, rule, dist, ev_name, ev_address): records attached to places.

    Number matches all count; a record without any takes its nearest place; records without position go by address.
    Records of one name, number and position match alike: they meet the places as one, and are told apart after it.
    ``register`` has id, nn, hn, zip, sk beside the evidence columns. Both are read by every rule: they are written first,
    unless they are ``stored`` tables already."""
    if not stored:
        places, register = settled(places.select(*SIDE, "zip", "sk"), "evidence-places"), settled(register, "evidence-rows")
    alike = list(SIDE[1:])
    spots = register.where("lat is not null").select(*alike).distinct().withColumn("id", F.monotonically_increasing_id())
    spots = settled(spots, "evidence-spots")
    pairs = any_number(match_pairs(places, spots, stored=True))
    w = W.partitionBy("b_id").orderBy(F.desc("sim"), "dist", "a_id")
    near = pairs.withColumn("_r", F.row_number().over(w)).where((F.col("rule") == "number") | (~F.col("any_number") & (F.col("_r") == 1)))
    found = near.select("a_id", "b_id", "rule", "dist").join(spots.withColumnsRenamed({c: f"_{c}" for c in (*alike, "id")}), F.col("b_id") == F.col("_id"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in alike]
    rows = lambda df: df.select(F.col("id").alias("b_id"), "source", "source_id", "state", "date", F.col("name").alias("ev_name"), F.col("address").alias("ev_address"), *alike)
    out = (F.col("a_id").alias("place_id"), "source", "source_id", "state", "date", "rule", "dist", "ev_name", "ev_address")
    placed = found.drop("b_id").join(rows(register.where("lat is not null")), same).select(*out)
    unplaced = register.where("lat is null")
    by_door = match_address(places, unplaced).select("a_id", "b_id", "rule", "dist")
    return placed.unionByName(by_door.join(rows(unplaced), "b_id").select(*out))


def members(rows: DataFrame, matched: DataFrame, source: str) -> DataFrame:
    """(place_id, source, source_id, rule, dist, sim): each row with the place it joined, itself if none."""
    m = matched.select(F.col("b_id").alias("id"), F.col("a_id").alias("place"), "rule", "dist", "sim")
    out = rows.select("id").join(m, "id", "left")
    own = lambda c, v: F.coalesce(F.col(c), F.lit(v)).alias(c)
    return out.select(F.coalesce("place", "id").alias("place_id"), F.lit(source).alias("source"), F.col("id").alias("source_id"), own("rule", "self"), own("dist", 0e0), own("sim", 1e0))


def unmatched(rows: DataFrame, matched: DataFrame) -> DataFrame:
    return rows.join(matched.select(F.col("b_id").alias("id")), "id", "left_anti")


def fill_row(matched: DataFrame, rows: DataFrame) -> DataFrame:
    """The nearest matched row of each place, with its columns."""
    w = W.partitionBy("place_id").orderBy("dist", "id")
    out = matched.select(F.col("a_id").alias("place_id"), F.col("b_id").alias("id"), "dist").join(rows, "id")
    return out.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def gap_fill(base: DataFrame, fill: DataFrame, columns: list[str]) -> DataFrame:
    """``base`` with missing columns taken from ``fill`` (place_id, columns); empty strings there count as missing."""
    f = fill.select(F.col("place_id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in columns])
    out = base.join(f, F.col("id") == F.col("_id"), "left")
    filled = {c: F.coalesce(F.col(c), F.when(F.col(f"_{c}") != "", F.col(f"_{c}"))) for c in columns}
    return out.withColumns(filled).select(*base.columns)
