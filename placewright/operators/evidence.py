"""Dated evidence: checks, sources of it, and the fold to a status."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, similarity, text

EVIDENCE = "source string, source_id string, name string, address string, lat double, lng double, state string, date date"
ATTACHED = ("place_id", "source", "source_id", "state", "date", "rule", "dist", "ev_name", "ev_address")
#: Closures of these sources do not close a place that carries a brand
INDEPENDENTS_ONLY = ("cdph_chicago_oob", "abca_dc_cancelled", "bacp_chicago_cancelled")
#: Edit-history events that mean the place is gone
GONE_EVENTS = ("hard_delete", "primary_tag_deleted", "substantial_rename")


def drop_reason(build: date) -> Column:
    """Why an evidence row cannot be used; null if it can."""
    placed = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    return (
        F.when(placed & ~(F.col("lat").between(17, 72) & F.col("lng").between(-180, -64)), "position out of range")
        .when(~placed & text.zip5(F.col("address")).isNull(), "no position and no ZIP")
        .when(F.col("date").isNull(), "no date")
        .when(F.coalesce(F.trim("name"), F.lit("")) == "", "no name")
    )


def validate(register: DataFrame, build: date, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept rows, (source, state, reason, n)); of rows with one (source, source_id) the first in ``order`` is kept."""
    from pyspark.sql import Window as W

    rows = register.withColumn("reason", drop_reason(build))
    w = W.partitionBy("source", "source_id", "reason").orderBy(*(order or [F.desc("date"), "state", "name", "address"]))
    again = F.when(F.col("reason").isNull() & (F.row_number().over(w) > 1), "same id twice").otherwise(F.col("reason"))
    rows = rows.withColumn("reason", again)
    drops = rows.where("reason is not null").groupBy("source", "state", "reason").agg(F.count(F.lit(1)).alias("n"))
    return rows.where("reason is null").drop("reason"), drops


def in_region(register: DataFrame, base: DataFrame, build: date, box: tuple[float, float, float, float]) -> DataFrame:
    """Records dated 1900 to the build day in the box, or without position but with a ZIP that the base knows."""
    dated = register.where(F.col("date").between(F.lit(date(1900, 1, 1)), F.lit(build)))
    inside = dated.where(geo.in_box(F.col("lat"), F.col("lng"), box))
    zips = base.select(text.zip5(F.col("postcode")).alias("_zip")).where("_zip is not null").distinct()
    known = dated.where("lat is null").withColumn("_z", text.zip5(F.col("address"))).join(zips, F.col("_z") == F.col("_zip"), "left_semi").drop("_z")
    return inside.unionByName(known)


def independents_only(ev: DataFrame, places: DataFrame, sources: tuple[str, ...] = INDEPENDENTS_ONLY) -> DataFrame:
    """Evidence without the listed sources' rows at branded places."""
    branded = places.where("brand is not null").select(F.col("id").alias("_id"))
    return ev.join(branded, (F.col("place_id") == F.col("_id")) & F.col("source").isin(*sources), "left_anti")


def _attached(df: DataFrame, source: str | Column, source_id: str, state: str | Column, day: Column | str, rule="rule", dist="dist", name="name", address="address") -> DataFrame:
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    as_col = lambda v: F.col(v) if isinstance(v, str) else v
    cols = [F.col("place_id"), lit(source), as_col(source_id), lit(state), as_col(day), as_col(rule), as_col(dist), as_col(name), as_col(address)]
    return df.select(*[c.alias(n) for c, n in zip(cols, ATTACHED)])


def id_closures(base: DataFrame, canon: DataFrame, closed: DataFrame, source: str = "fsq_closed") -> DataFrame:
    """Closings by an id that listings carry, while the names still agree."""
    c = closed.where("date_closed is not null").select(F.col("fsq_place_id"), F.col("name").alias("c_name"), F.col("address").alias("c_address"), "date_closed")
    out = base.select("id", F.col("name").alias("b_name"), "fsq_id").join(c, F.col("fsq_id") == F.col("fsq_place_id"))
    out = similarity.with_same_name(out, "c_name", "b_name", "_ok").where("_ok")
    return _attached(out.join(canon, "id"), source, "fsq_place_id", "closed", "date_closed", F.lit("id"), F.lit(0e0), "c_name", "c_address")


def history_closures(base: DataFrame, canon: DataFrame, history: DataFrame, source: str = "osm_history") -> DataFrame:
    """Closings from edit history: the place still has the name the event met, and is not yet the renamed-to business."""
    h = history.where(F.col("event").isin(*GONE_EVENTS) & F.col("event_date").isNotNull())
    out = h.join(base.select("id", F.col("name").alias("b_name")), h.overture_id == F.col("id"))
    renamed = (F.col("event") == "substantial_rename") & F.col("osm_name").isNotNull()
    out = similarity.with_same_name(similarity.with_same_name(out, "overture_name", "b_name", "_ok").where("_ok"), "osm_name", "b_name", "_already")
    out = out.where(~(renamed & F.col("_already"))).join(canon, "id")
    return _attached(out, source, "overture_id", "closed", "event_date", F.lit("id"), F.lit(0e0), "event", F.lit(None).cast("string"))


def tagged_id_evidence(member: DataFrame, features: DataFrame, register: DataFrame, source: str = "sirene", tag: str = "siret") -> DataFrame:
    """A register's records by the id that features are tagged with (spaces dropped)."""
    r = register.where(F.col("source") == source).select("source", F.col("source_id").alias("r_id"), "state", "date", "name", "address")
    f = features.select("id", F.replace(F.col(tag), F.lit(" "), F.lit("")).alias("_tag"))
    out = member.select("place_id", F.col("source_id").alias("id")).join(f, "id").join(r, F.col("_tag") == F.col("r_id"))
    return _attached(out, F.col("source"), "r_id", F.col("state"), "date", F.lit("id"), F.lit(0e0))


def _features(member: DataFrame, features: DataFrame) -> DataFrame:
    return member.select("place_id", F.col("source_id").alias("id"), "rule", "dist").join(features, "id")


def item_closures(member: DataFrame, features: DataFrame, items: DataFrame, source: str = "wikidata_p576") -> DataFrame:
    """Dissolution dates of linked items, offices left out (a null category drops the row)."""
    out = _features(member, features).join(items.select("qid", F.col("date").alias("d")), F.col("wikidata") == F.col("qid"))
    return _attached(out.where(~F.col("category").startswith("office=")), source, "wikidata", "closed", "d")


def lifecycle_closures(member: DataFrame, features: DataFrame, source: str = "osm_lifecycle") -> DataFrame:
    """Closed features: dated by their end date where it is one, else by the last edit."""
    out = _features(member, features).where("lifecycle is not null")
    return _attached(out, source, "id", "closed", F.coalesce(text.full_date(F.col("end_date")), F.col("edited")))


def survey_open(member: DataFrame, features: DataFrame, source: str = "osm_check_date") -> DataFrame:
    out = _features(member, features).where("lifecycle is null").withColumn("_d", text.full_date(F.col("check_date"))).where("_d is not null")
    return _attached(out, source, "id", "open", "_d")


def locator_open(member: DataFrame, chain: DataFrame, source: str = "atp") -> DataFrame:
    """Open on the day a chain's store locator was read."""
    out = _features(member, chain).where("end_date is null and collected is not null")
    return _attached(out, source, "id", "open", "collected")


def status_of(ev: DataFrame, build: date, recent_days: int = 730) -> DataFrame:
    """(place_id, status, status_date, status_source, conflict, evidence): one aggregation by place.

    closed: a closed record and no open one dated after it; open: else, the newest open record is at most
    ``recent_days`` old; unknown: else, with its date and source kept. Of equal dates the last source by name counts."""
    day = lambda s: F.max(F.when(F.col("state") == s, F.col("date")))
    who = lambda s: F.max_by("source", F.when((F.col("state") == s) & F.col("date").isNotNull(), F.struct("date", "source")))
    item = F.struct((-F.unix_date("date")).alias("k"), "source", "source_id", "state", "rule", F.col("dist").alias("dist_m"), "date")
    agg = ev.groupBy("place_id").agg(day("closed").alias("c"), day("open").alias("o"), who("closed").alias("cs"), who("open").alias("os"), F.sort_array(F.collect_list(item)).alias("list"))
    shut = F.col("c").isNotNull() & (F.col("o").isNull() | (F.col("o") <= F.col("c")))
    fresh = F.col("o") >= F.date_sub(F.lit(build), recent_days)
    evidence = F.transform("list", lambda e: F.struct(e["source"].alias("source"), e["source_id"].alias("source_id"), e["state"].alias("state"), e["date"].alias("date"), e["rule"].alias("rule"), e["dist_m"].alias("dist_m")))
    return agg.select(
        "place_id",
        F.when(shut, "closed").when(fresh, "open").otherwise("unknown").alias("status"),
        F.when(shut, F.col("c")).otherwise(F.col("o")).alias("status_date"),
        F.when(shut, F.col("cs")).otherwise(F.col("os")).alias("status_source"),
        (F.col("c").isNotNull() & F.coalesce(F.col("o") > F.col("c"), F.lit(False))).alias("conflict"),
        evidence.alias("evidence"),
    )


def evidence_text(c: str | Column) -> Column:
    """An evidence list as one string, for flat outputs."""
    part = lambda e: F.concat_ws("|", e["source"], e["source_id"], e["state"], e["date"].cast("string"), e["rule"])
    return F.array_join(F.transform(c, part), ";")
