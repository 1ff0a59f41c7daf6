"""Numbers about a build."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import categories, geo, text


def pct(part: Column, whole: Column) -> Column:
    return geo.round_to(F.lit(100.0) * part / whole, 1)


def coverage_by_bucket(places: DataFrame) -> DataFrame:
    """(category, listed, pct_with_status, open, closed, pct_any_evidence) of places (category, status, n_evidence)."""
    n = F.count(F.lit(1))
    return places.groupBy(categories.bucket(F.col("category")).alias("category")).agg(
        n.alias("listed"), pct(F.count_if(F.col("status") != "unknown"), n).alias("pct_with_status"), F.count_if(F.col("status") == "open").alias("open"),
        F.count_if(F.col("status") == "closed").alias("closed"), pct(F.count_if(F.col("n_evidence") > 0), n).alias("pct_any_evidence"),
    )


def coverage_by_state(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(state, category, listed, pct) cells, and (state, listed, pct) totals, weighted from the rounded cells."""
    n = F.count(F.lit(1))
    cells = places.groupBy(F.col("region").alias("state"), categories.bucket(F.col("category")).alias("category")).agg(n.alias("listed"), pct(F.count_if(F.col("status") != "unknown"), n).alias("pct"))
    totals = cells.groupBy("state").agg(F.sum("listed").alias("listed"), geo.round_to(F.sum(F.col("pct") * F.col("listed")) / F.sum("listed"), 1).alias("pct"))
    return cells, totals


def coverage_pivot(cells: DataFrame, names: list[str]) -> DataFrame:
    """One row a state, a column a category."""
    return cells.groupBy("state").pivot("category", names).agg(F.first("pct"))


def coverage_bin(c: Column) -> Column:
    """0 to 5, by the limits 5, 15, 30, 45 and 60."""
    return F.when(c < 5, 0).when(c < 15, 1).when(c < 30, 2).when(c < 45, 3).when(c < 60, 4).otherwise(5)


def evidence_by_rule(ev: DataFrame) -> DataFrame:
    return ev.groupBy("source", "state", "rule").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("place_id").alias("places"))


def hit_rate(register: DataFrame, ev: DataFrame) -> DataFrame:
    """(source, state, records, matched)."""
    hit = ev.select("source", "source_id", F.lit(1).alias("hit")).distinct()
    return register.join(hit, ["source", "source_id"], "left").groupBy("source", "state").agg(F.count(F.lit(1)).alias("records"), F.count("hit").alias("matched"))


def independent_check(ev: DataFrame) -> DataFrame:
    """(source, places, says_open_after, says_closed_too): closing signals against other source families.

    The last open date and the closings of each (place, family) are taken first, so that no pair of records is made."""
    ev = ev.withColumn("family", text.source_family(F.col("source")))
    c = ev.where("state = 'closed'").groupBy("place_id", "source", "family").agg(F.max("date").alias("d"))
    f = ev.groupBy("place_id", F.col("family").alias("other")).agg(F.max(F.when(F.col("state") == "open", F.col("date"))).alias("last_open"), F.max(F.when(F.col("state") == "closed", 1)).alias("closed_too"))
    both = c.join(f, (c.place_id == f.place_id) & (c.family != f.other), "left").groupBy(c.place_id, "source").agg(F.max(F.when(F.col("last_open") > F.col("d"), 1)).alias("a"), F.max("closed_too").alias("b"))
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("places"), F.count("a").alias("says_open_after"), F.count("b").alias("says_closed_too"))


def count_by(df: DataFrame, *columns, name: str = "places") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def review_sample(rows: DataFrame, key: str, n: int = 40) -> DataFrame:
    """A repeatable sample: the ``n`` first rows by a hash of the key."""
    return rows.orderBy(F.md5(F.col(key).cast("binary")), key).limit(n)


def score_calibration(scored: DataFrame, seen: DataFrame) -> DataFrame:
    """(band, places, open, closed): score bands against what an independent layer says (id, says)."""
    band = F.floor(F.col("open_score") * 10 + 1e-9).cast("int").alias("band")
    return scored.join(seen, "id").groupBy(band).agg(F.count(F.lit(1)).alias("places"), F.count_if(F.col("says") == "open").alias("open"), F.count_if(F.col("says") == "closed").alias("closed"))


def layer_violations(members: DataFrame, licences: DataFrame, banned: str = "osm", licence: str = "ODbL-1.0") -> DataFrame:
    """(id, why): core rows that carry the banned source or licence; empty when the layers are apart."""
    a = members.where(F.col("source").startswith(banned)).select(F.col("place_id").alias("id"), F.lit("source").alias("why"))
    return a.unionByName(licences.where(F.array_contains("licenses", licence)).select("id", F.lit("license").alias("why")))
