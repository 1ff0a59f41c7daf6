"""How likely a place is open, and what publishing adds to it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import categories, geo, text

#: Regions whose list of active alcohol licences is complete
LICENSE_LISTS = {"DC": "abca_dc_active", "NY": "sla_ny"}


def base_sources(datasets: Column) -> Column:
    """The datasets a listing was taken from: lower case, without the two internal names, sorted."""
    return F.array_sort(F.filter(F.transform(datasets, F.lower), lambda d: ~d.isin("overture", "overture-signals")))


def unvouched_score(place_id: Column, in_map: Column, datasets: Column) -> Column:
    own = base_sources(datasets)
    first = F.get(own, F.lit(0))
    vouched = F.coalesce(in_map, F.lit(False)) | ~place_id.startswith("ovt:") | datasets.isNull()
    return F.when(vouched, 0.75).when(F.size(own) != 1, 0.60).when(first == "foursquare", 0.25).when(first.isin("brightquery", "microsoft"), 0.40).otherwise(0.60)


def open_score(status: Column, day: Column, conflict: Column, base_status: Column, missing: Column, conf: Column, build: date, base: Column) -> Column:
    """0.10 closed; decaying by a tenth a year from the last open evidence, with floors; else what listings say."""
    years = F.greatest(F.datediff(F.lit(build), day), F.lit(0)) / F.lit(365.25)
    aged = F.greatest(F.when(conflict, 0.80).otherwise(0.97) * F.pow(F.lit(0.90), years), F.when(conflict, 0.50).otherwise(0.75))
    gone = (F.coalesce(base_status, F.lit("")) == "permanently_closed") | F.coalesce(missing, F.lit(False))
    return geo.round_to(F.when(status == "closed", 0.10).when(day.isNotNull(), aged).when(gone, 0.30).when(conf >= 0.80, conf).otherwise(base), 2)


def missing_license(places: DataFrame, status: DataFrame, lists: dict[str, str] = LICENSE_LISTS) -> DataFrame:
    """(id, missing): for places that need a licence in a listed region, whether no evidence is of that region's list."""
    source = F.create_map(*[F.lit(x) for kv in lists.items() for x in kv])
    rows = places.where(categories.needs_alcohol_license(F.col("category")) & F.col("region").isin(*lists)).select("id", source[F.col("region")].alias("_list"))
    out = rows.join(status.select(F.col("place_id").alias("id"), "evidence"), "id", "left")
    return out.select("id", (~F.coalesce(F.exists("evidence", lambda e: e["source"] == F.col("_list")), F.lit(False))).alias("missing"))


def hours(*rows: DataFrame) -> DataFrame:
    """The newest opening hours of each place: (place_id, opening_hours, hours_source, hours_date) from (place_id, hours,
    source, day) rows; blank hours do not count."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    best = F.max(F.when(text.hours_fallback(F.col("hours")).isNotNull() & F.col("day").isNotNull(), F.struct("day", "source", "hours")))
    out = out.groupBy("place_id").agg(best.alias("b")).where("b is not null")
    return out.select("place_id", F.col("b.hours").alias("opening_hours"), F.col("b.source").alias("hours_source"), F.col("b.day").alias("hours_date"))


def confidence(rows: DataFrame, canon: DataFrame) -> DataFrame:
    """(place_id, conf): the highest outside confidence of a place's listings."""
    return rows.where("conf_mean is not null").join(canon, rows.overture_id == canon.id).groupBy("place_id").agg(F.max("conf_mean").alias("conf"))


def member_rollup(member: DataFrame) -> DataFrame:
    """(place_id, sources, member_licenses, in_map)."""
    return member.groupBy("place_id").agg(
        F.array_sort(F.collect_list(F.struct("source", F.col("source_id").alias("id")))).alias("sources"),
        F.array_sort(F.collect_set(categories.license_of(F.col("source")))).alias("member_licenses"),
        F.bool_or(F.col("source").isin("osm", "atp")).alias("in_map"),
    )


def published(place: DataFrame, member: DataFrame, status: DataFrame, conf: DataFrame, hours_: DataFrame, listings: DataFrame, build: date, lists: dict[str, str] = LICENSE_LISTS) -> DataFrame:
    """The published shape: one row a place with its members, status, score, licences and evidence.

    ``place``: id, name, category, brand, brand_wikidata, address, city, region, postcode, phone, website, lat, lng,
    overture_status, has_dataset; ``listings``: id, category_group, category_subgroup, datasets. All joins are on the
    place id, so that one partitioning serves them."""
    by = lambda df: df.withColumnRenamed("place_id", "_id")
    p = place
    for df in (by(member_rollup(member)), by(status).withColumnRenamed("status", "_status"), by(conf), by(hours_), listings.select(F.col("id").alias("_id"), F.col("category_group").alias("_g"), F.col("category_subgroup").alias("_s"), "datasets"), missing_license(place, status, lists).withColumnRenamed("id", "_id")):
        how = "inner" if "member_licenses" in df.columns else "left"
        p = p.join(df, p.id == df["_id"], how).drop("_id")
    st = F.coalesce("_status", F.lit("unknown"))
    conflict = F.coalesce("conflict", F.lit(False))
    empty = F.array().cast(status.schema["evidence"].dataType)
    ev = F.coalesce("evidence", empty)
    own = F.when(F.col("has_dataset"), F.array(F.lit("Apache-2.0"))).otherwise(F.array().cast("array<string>"))
    licences = F.array_sort(F.array_distinct(F.concat("member_licenses", own, F.transform(ev, lambda e: categories.license_of(e["source"])))))
    return p.select(
        "id", "name", "category", F.coalesce("_g", categories.group_of(F.col("category"))).alias("category_group"), F.coalesce("_s", categories.subgroup_of(F.col("category"))).alias("category_subgroup"),
        "brand", "brand_wikidata", "address", "city", "region", "postcode", "phone", "website", "opening_hours", "hours_source", "hours_date",
        st.alias("status"), "status_date", "status_source",
        open_score(st, F.col("status_date"), conflict, F.col("overture_status"), F.col("missing"), F.col("conf"), build, unvouched_score(F.col("id"), F.col("in_map"), F.col("datasets"))).alias("open_score"),
        geo.round_to(F.col("conf"), 2).alias("openpois_conf"), F.col("missing").alias("missing_license"), "overture_status", base_sources(F.col("datasets")).alias("overture_sources"),
        "sources", licences.alias("licenses"), ev.alias("evidence"), "lat", "lng",
    )
