"""Joins of positions within a reach, on a grid whose crowded cells are quartered until they hold few rows.

One side is laid out: every row lies in one leaf of the tree that a first count of the cells gives. The other side is
copied, and only to the leaves that its reach touches: where none is crowded, to under four cells on average for a reach of
250 m, and to one or two for 60 m. Rows that no quartering can part (many at one address) are dealt over lots. Both sides
then meet by an equality join on the leaf, and every pair within reach meets once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..sources.store import settled

#: Rows of a leaf; cells with more are split into ``FAN`` x ``FAN``, ``DEPTH`` times at most, and then into lots.
LEAF_ROWS = 2_000
FAN, DEPTH = 4, 3
#: Crowded nodes that are sent to all executors at most; more are met by a shuffle.
SENT = 200_000
LEAF = ("_d", "_y", "_x", "_lot")


def _cell(lat: Column, lng: Column, depth: int) -> tuple[Column, Column]:
    return F.floor(lat / F.lit(geo.CELL_LAT / FAN**depth)).cast("long"), F.floor(lng / F.lit(geo.CELL_LNG / FAN**depth)).cast("long")


def crowded(df: DataFrame, keys: tuple[str, ...] = (), most: int = LEAF_ROWS) -> DataFrame | None:
    """(keys, _d, _y, _x, _n): the nodes of the tree over ``df`` (lat, lng) with more than ``most`` rows; None if there are none.

    Rows that other equal ``keys`` part anyway are counted by themselves. Only cells are counted, so that the table has a
    fraction 1 / ``most`` of the rows at each depth."""
    y, x = _cell(F.col("lat"), F.col("lng"), 0)
    cells = df.groupBy(*keys, y.alias("_y"), x.alias("_x")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    if cells.isEmpty():
        return None
    cells = cells.select(*keys, F.lit(0).alias("_d"), "_y", "_x", "_n")
    y, x = _cell(F.col("lat"), F.col("lng"), DEPTH)
    fine = df.groupBy(*keys, y.alias("_y"), x.alias("_x")).agg(F.count(F.lit(1)).alias("_n"))
    for depth in range(DEPTH, 0, -1):
        up = [F.floor(F.col(c) / F.lit(FAN ** (DEPTH - depth))).cast("long").alias(c) for c in ("_y", "_x")]
        nodes = fine.select(*keys, *up, "_n").groupBy(*keys, "_y", "_x").agg(F.sum("_n").alias("_n")).where(F.col("_n") > most)
        cells = cells.unionByName(nodes.select(*keys, F.lit(depth).alias("_d"), "_y", "_x", "_n"))
    return settled(cells, "crowded-nodes")


def _full(nodes: DataFrame, keys: tuple[str, ...], depth: int) -> DataFrame:
    at = nodes.where(F.col("_d") == depth)
    return at.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_y").alias("_fy"), F.col("_x").alias("_fx"), F.col("_n").alias("_fn"))


def _on(keys: tuple[str, ...]) -> Column:
    on = (F.col("_y") == F.col("_fy")) & (F.col("_x") == F.col("_fx"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return on


def _meet(rows: DataFrame, full: DataFrame, keys: tuple[str, ...], small: bool) -> DataFrame:
    out = rows.join(F.broadcast(full) if small else full, _on(keys), "left")
    return out.drop("_fy", "_fx", *[f"_of_{k}" for k in keys])


def laid_out(df: DataFrame, nodes: DataFrame | None, keys: tuple[str, ...] = (), most: int = LEAF_ROWS, small: bool = True) -> DataFrame:
    """``df`` with the leaf of each row; of a leaf's lots, the one its columns' hash names."""
    y, x = _cell(F.col("lat"), F.col("lng"), 0)
    start = {"_d": F.lit(0), "_y": y, "_x": x, "_lot": F.lit(0).cast("long")}
    rows = df.withColumns(start)
    if nodes is None:
        return rows
    for depth in range(DEPTH + 1):
        rows = _meet(rows, _full(nodes, keys, depth), keys, small)
        here = (F.col("_d") == depth) & F.col("_fn").isNotNull()
        if depth < DEPTH:
            y, x = _cell(F.col("lat"), F.col("lng"), depth + 1)
            rows = rows.withColumns({"_d": F.when(here, depth + 1).otherwise(F.col("_d")), "_y": F.when(here, y).otherwise(F.col("_y")), "_x": F.when(here, x).otherwise(F.col("_x"))})
        else:
            rows = rows.withColumn("_lot", F.when(here, F.pmod(F.xxhash64(*df.columns), F.ceil(F.col("_fn") / most))).otherwise(F.col("_lot")))
        rows = rows.drop("_fn")
    return rows


def _touched(at: Column, reach: Column, size: float, depth: int) -> Column:
    """The cells of one axis within ``reach`` degrees of a coordinate, none beyond the neighbours of its whole cell."""
    unit = size / FAN**depth
    own = F.floor(at / F.lit(size))
    low = F.greatest(F.floor((at - reach) / F.lit(unit)), (own - 1) * FAN**depth)
    high = F.least(F.floor((at + reach) / F.lit(unit)), (own + 2) * FAN**depth - 1)
    return F.sequence(low.cast("long"), high.cast("long"))


def copied(df: DataFrame, metres: float, nodes: DataFrame | None, keys: tuple[str, ...] = (), most: int = LEAF_ROWS, small: bool = True) -> DataFrame:
    """A copy of each row of ``df`` in every leaf within ``metres`` of it, as far as the cells around its own reach."""
    lat = F.lit(metres / geo.METRES_PER_DEGREE * (1 + 1e-9))
    # a degree of longitude is shortest at the reach's end towards the pole; there the neighbours bound it
    lng = lat / F.greatest(F.cos(F.radians(F.least(F.abs(F.col("lat")) + lat, F.lit(90.0)))), F.lit(1e-6))
    axes = lambda depth: {"_y": _touched(F.col("lat"), lat, geo.CELL_LAT, depth), "_x": _touched(F.col("lng"), lng, geo.CELL_LNG, depth)}
    rows = df.withColumn("_d", F.lit(0)).withColumn("_lot", F.lit(0).cast("long"))
    for axis, cells in axes(0).items():
        rows = rows.withColumn(axis, F.explode(cells))
    if nodes is None:
        return rows
    for depth in range(DEPTH + 1):
        rows = _meet(rows, _full(nodes, keys, depth), keys, small)
        here = (F.col("_d") == depth) & F.col("_fn").isNotNull()
        if depth < DEPTH:
            for axis, cells in axes(depth + 1).items():
                rows = rows.withColumn(axis, F.explode(F.when(here, _inside(cells, F.col(axis))).otherwise(F.array(F.col(axis)))))
            rows = rows.withColumn("_d", F.when(here, depth + 1).otherwise(F.col("_d")))
        else:
            rows = rows.withColumn("_lot", F.explode(F.when(here, F.sequence(F.lit(0).cast("long"), F.ceil(F.col("_fn") / most) - 1)).otherwise(F.array("_lot"))))
        rows = rows.drop("_fn")
    return rows


def _inside(cells: Column, node: Column) -> Column:
    """Those of a run of cells that are parts of a node."""
    return F.filter(cells, lambda k: F.floor(k / F.lit(FAN)).cast("long") == node)


def within(a: DataFrame, b: DataFrame, metres: float, keys: tuple[str, ...] = (), most: int | None = LEAF_ROWS, lay: str | None = None) -> DataFrame:
    """Pairs of ``a`` (a_lat, a_lng, ...) and ``b`` (b_lat, b_lng, ...) in the same or neighbouring cells and at most
    ``metres`` apart, with ``_m``, the distance; of equal a_k and b_k for each k of ``keys``.

    The larger side is laid out and the smaller copied (``lay`` 'a' or 'b' saves the count). Rows without a position meet
    nothing; a null key meets no row. ``most`` is a leaf's rows; None leaves out the count of the cells, for a side of which
    it is known that no cell is crowded."""
    placed = lambda df, s: df.where(F.col(f"{s}_lat").isNotNull() & F.col(f"{s}_lng").isNotNull()).withColumns({"lat": F.col(f"{s}_lat"), "lng": F.col(f"{s}_lng")})
    side = {"a": placed(a, "a"), "b": placed(b, "b")}
    lay = lay or ("a" if side["a"].count() >= side["b"].count() else "b")
    other = "b" if lay == "a" else "a"
    mine, theirs = tuple(f"{lay}_{k}" for k in keys), tuple(f"{other}_{k}" for k in keys)
    nodes = None if most is None else crowded(side[lay], mine, most)
    small = nodes is None or nodes.limit(SENT + 1).count() <= SENT
    left = laid_out(side[lay], nodes, mine, most, small).drop("lat", "lng")
    renamed = nodes if nodes is None else nodes.withColumnsRenamed(dict(zip(mine, theirs)))
    right = copied(side[other], metres, renamed, theirs, most, small).drop("lat", "lng").withColumnsRenamed({c: f"{c}r" for c in LEAF})
    on = [F.col(c) == F.col(f"{c}r") for c in LEAF] + [F.col(m) == F.col(t) for m, t in zip(mine, theirs)]
    pairs = left.join(right, on).drop(*LEAF, *[f"{c}r" for c in LEAF])
    m = geo.dist_m(F.col("a_lat"), F.col("a_lng"), F.col("b_lat"), F.col("b_lng"))
    return pairs.withColumn("_m", m).where(F.col("_m") <= metres)


def blocks(df: DataFrame, wide: bool) -> DataFrame:
    """``df`` with (_by, _bx), blocks of two by two cells: its own, or (``wide``) those its neighbour cells lie in."""
    y, x = geo.cell_y(F.col("lat")), geo.cell_x(F.col("lng"))
    half = lambda v: F.floor(v / F.lit(2)).cast("int")
    if not wide:
        return df.withColumns({"cy": y, "cx": x, "_by": half(y), "_bx": half(x)})
    around = lambda v: F.explode(F.sequence(half(v - 1), half(v + 1)))
    return df.withColumns({"cy": y, "cx": x}).withColumn("_by", around(y)).withColumn("_bx", around(x))
