"""A region's build from landed inputs to published places: the operators in their order."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import canon, evidence, groups, match, mint
from ..sources.store import bucketed, settled

BASE_FILL = ["category", "brand", "brand_wikidata", "postcode", "phone", "website"]
CHAIN_FILL = ["brand", "brand_wikidata", "address", "city", "region", "postcode", "phone", "website"]
FEATURE_FILL = ["phone", "website", "brand", "brand_wikidata", "address"]


@dataclass
class Inputs:
    """base, chain, register and features tables (features may be None: then there is no full layer), and what else tells
    of closings: ids of closed listings, the edit history, dissolved items (each may be None)."""

    base: DataFrame
    chain: DataFrame
    register: DataFrame
    features: DataFrame | None = None
    closed: DataFrame | None = None
    history: DataFrame | None = None
    items: DataFrame | None = None


@dataclass
class Params:
    build: date
    recent_days: int = 730
    dataset: str = "Foursquare"
    storefronts: dict[str, str] | None = None
    rounds: int | None = 3


@dataclass
class Layer:
    place: DataFrame
    member: DataFrame
    evidence: DataFrame
    status: DataFrame
    ids: DataFrame
    register: DataFrame


def named(df: DataFrame, number: str = "address") -> DataFrame:
    return df.withColumns({"nn": text.norm_name(F.col("name")), "hn": text.house_number(F.col(number))})


def keyed_register(register: DataFrame) -> DataFrame:
    """The register's rows, written first, with what matching asks of them: registers repeat their names and addresses."""
    a = F.col("address")
    rows = groups.by_value(settled(register, "register-rows"), "name", {"nn": text.norm_name(F.col("name"))})
    rows = groups.by_value(rows, "address", {"hn": text.house_number(a), "zip": text.zip5(a), "sk": text.street_key(a)})
    return rows.select("*", F.concat_ws(":", "source", "source_id").alias("id")).select(*register.columns, "id", "nn", "hn", "zip", "sk")


def addressed(place: DataFrame) -> DataFrame:
    return place.withColumns({"zip": text.zip5(F.col("postcode")), "sk": text.street_key(F.col("address"))})


def core_layer(inputs: Inputs, params: Params) -> Layer:
    """Listings, chain rows and register evidence; nothing of the features.

    Tables that several later steps read are written first: else each step would repeat the plans of all before it."""
    base = settled(named(inputs.base), "base")
    ids = settled(canon.canonical_ids(base, settled(match.self_match(base), "duplicates"), params.rounds), "ids")
    kept = settled(canon.merge_duplicates(base, ids, [c for c in BASE_FILL if c in base.columns], params.dataset), "kept")
    chain = settled(named(inputs.chain, "housenumber"), "chain")
    joined = settled(match.best_match(match.match_pairs(kept, chain, lay="a", stored=True)), "chain-matches")
    fill = match.fill_row(joined, chain)
    columns = [c for c in CHAIN_FILL if c in kept.columns and c in chain.columns] + ["hn"]
    place = match.gap_fill(kept, fill, columns)
    alone = match.unmatched(chain, joined).withColumn("has_dataset", F.lit(False))
    place = settled(addressed(place.unionByName(alone, allowMissingColumns=True).select(*place.columns)), "places")
    own = ids.select("place_id", F.lit("overture").alias("source"), F.col("id").alias("source_id"), F.when(F.col("id") == F.col("place_id"), "self").otherwise("duplicate").alias("rule"), F.lit(0e0).alias("dist"), F.lit(1e0).alias("sim"))
    chain_members = settled(match.members(chain, joined, "atp"), "chain-members")
    register = settled(keyed_register(inputs.register), "register")
    ev = match.attach_evidence(place, register, stored=True)
    if inputs.closed is not None:
        ev = ev.unionByName(evidence.id_closures(base, ids, inputs.closed))
    if "collected" in chain.columns:
        missing = {c: F.lit(None).cast("string") for c in ("end_date", "address") if c not in chain.columns}
        ev = ev.unionByName(evidence.locator_open(chain_members, chain.withColumns(missing) if missing else chain))
    ev = settled(evidence.independents_only(ev, place), "evidence")
    new = settled(mint.born(register, place, ev, params.storefronts or mint.STOREFRONTS), "born")
    place = place.unionByName(mint.minted_places(new).withColumn("has_dataset", F.lit(False)), allowMissingColumns=True)
    member = own.unionByName(chain_members).unionByName(mint.minted_members(new))
    ev = ev.unionByName(mint.minted_evidence(new))
    return Layer(place, member, ev, evidence.status_of(ev, params.build, params.recent_days), ids, register)


def full_layer(core: Layer, inputs: Inputs, params: Params) -> Layer:
    """The core layer with features folded in, and the places that only features have.

    Features add the evidence of their own life cycle and surveys, of the edit history, of dissolved items and of the
    registers whose ids they are tagged with (where the features have the columns for it)."""
    f = inputs.features.withColumn("address", F.when(F.concat_ws(" ", "housenumber", "street") != "", F.concat_ws(" ", "housenumber", "street")))
    f = settled(named(f, "housenumber"), "features")
    core_place = settled(core.place, "core-places")
    joined = settled(match.best_match(match.match_pairs(core_place, f, lay="a", stored=True)), "feature-matches")
    member = settled(match.members(f, joined, "osm"), "feature-members")
    fill = match.fill_row(joined, f.where("lifecycle is null"))
    only = settled(addressed(match.unmatched(f, joined)).withColumn("has_dataset", F.lit(False)), "feature-places")
    columns = [c for c in FEATURE_FILL if c in core_place.columns and c in f.columns]
    place = match.gap_fill(core_place, fill, columns).unionByName(only, allowMissingColumns=True).select(*core_place.columns)
    register = core.register
    ev = evidence.lifecycle_closures(member, f).unionByName(evidence.survey_open(member, f))
    if inputs.history is not None:
        ev = ev.unionByName(evidence.history_closures(named(inputs.base), core.ids, inputs.history))
    if inputs.items is not None and "wikidata" in f.columns:
        ev = ev.unionByName(evidence.item_closures(member, f, inputs.items))
    if "siret" in f.columns:
        ev = ev.unionByName(evidence.tagged_id_evidence(member, f, register))
    branded = only if "brand" in only.columns else only.withColumn("brand", F.lit(None).cast("string"))
    ev = ev.unionByName(evidence.independents_only(match.attach_evidence(only, register, stored=True), branded))
    ev = settled(core.evidence.unionByName(ev), "full-evidence")
    return Layer(place, core.member.unionByName(member), ev, evidence.status_of(ev, params.build, params.recent_days), core.ids, core.register)


def flagship(inputs: Inputs, params: Params) -> DataFrame:
    """(status, status_source, places): what decided the status of the listings that register records attach to."""
    ev = match.attach_evidence(addressed(named(inputs.base)), keyed_register(inputs.register))
    st = evidence.status_of(ev, params.build, params.recent_days)
    return st.groupBy("status", "status_source").agg(F.count(F.lit(1)).alias("places"), F.count_if("conflict").alias("conflicts"), F.max("status_date").alias("newest"))


def stored_by_place(layer: Layer, params: Params, buckets: int | None = None) -> Layer:
    """The layer with its places, members and evidence in tables bucketed by place id: statuses, roll-ups and the published
    join then read each table once and shuffle none of them."""
    ev = bucketed(layer.evidence, "evidence", "place_id", buckets=buckets)
    place, member = bucketed(layer.place, "place", "id", buckets=buckets), bucketed(layer.member, "member", "place_id", buckets=buckets)
    return Layer(place, member, ev, evidence.status_of(ev, params.build, params.recent_days), layer.ids, layer.register)


def summary_by_place(layer: Layer) -> DataFrame:
    """(id, name, members, status, status_date): each place with the count of its members and its status."""
    count = layer.member.groupBy("place_id").agg(F.count(F.lit(1)).alias("members"))
    out = layer.place.select("id", "name").join(count, F.col("id") == count["place_id"], "left").drop("place_id")
    st = layer.status.select("place_id", "status", "status_date")
    return out.join(st, F.col("id") == st["place_id"], "left").select("id", "name", F.coalesce("members", F.lit(0)).alias("members"), F.coalesce("status", F.lit("unknown")).alias("status"), "status_date")
