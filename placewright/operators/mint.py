"""New places from register records that matched nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geo, similarity, text
from ..sources.store import settled
from . import grid
from .match import with_cell

# Registers that list storefronts, and the category of what they list.
STOREFRONTS = {
    "fdic_locations": "bank", "snap_current": "grocery_or_convenience_store", "abca_dc_active": "licensed_premises", "sla_ny": "licensed_premises",
    "dohmh_nyc": "restaurant", "cdph_chicago": "food_service", "dmv_ny": "vehicle_repair_or_dealer", "dos_ny_salons": "salon_or_barber_shop",
    "agm_ny": "food_store", "dph_de": "restaurant", "emd_sac": "food_service", "abc_ky_jefferson": "licensed_premises",
}


def storefront_eligible(register: DataFrame, ev: DataFrame, storefronts: dict[str, str] = STOREFRONTS) -> DataFrame:
    """Open, positioned storefront records without evidence at any place and with a name of their own, with category.

    ``register`` has id, nn, hn, zip, sk beside the evidence columns; the storefront list is a map of literals."""
    kinds = F.create_map(*[F.lit(x) for kv in storefronts.items() for x in kv])
    rows = register.where(F.col("source").isin(*storefronts) & (F.col("state") == "open") & F.col("lat").isNotNull())
    name = F.lower("name")
    rows = rows.where(~name.startswith("tbd") & ~name.rlike(rf"\b({text.LEGAL_ENDING})\.?{text.SPACE}*[0-9]*$"))
    return rows.join(ev.select("source", "source_id").distinct(), ["source", "source_id"], "left_anti").select(*register.columns).withColumn("category", kinds[F.col("source")])


def lookalikes(candidates: DataFrame, places: DataFrame) -> DataFrame:
    """(id): candidates near a listed place that may be the same: within 200 m and similarity 0.9, or within 80 m and
    Jaro-Winkler 0.7 (spaces kept) or the same house number and first word."""
    side = lambda df, n: df.select(*[F.col(c).alias(f"{n}_{c}") for c in ("id", "nn", "hn", "lat", "lng")])
    pairs = grid.within(side(candidates, "a"), side(places, "b"), 200)
    pairs = settled(similarity.with_similarity(pairs, "a_nn", "b_nn", "sim", least=0.9), "lookalike-pairs")  # read three times
    first = lambda c: F.split_part(F.col(c), F.lit(" "), F.lit(1))
    door = (F.col("a_hn") == F.col("b_hn")) & (first("a_nn") == first("b_nn"))
    sure = pairs.where((F.col("sim") >= 0.9) | ((F.col("_m") <= 80) & F.coalesce(door, F.lit(False))))
    rest = pairs.where(F.col("_m") <= 80).join(sure.select("a_id"), "a_id", "left_anti").select("a_id", "a_nn", "b_nn")
    # the one comparison with spaces, for names not settled yet, each pair of names once
    names = rest.select("a_nn", "b_nn").distinct().where(similarity.possible(F.col("a_nn"), F.col("b_nn"), 0.7)).withColumn("_jw", similarity.jaro_winkler("a_nn", "b_nn")).where("_jw >= 0.7")
    alike = rest.join(names, ["a_nn", "b_nn"]).select("a_id")
    return sure.select("a_id").unionByName(alike).distinct().select(F.col("a_id").alias("id"))


def born(register: DataFrame, places: DataFrame, ev: DataFrame, storefronts: dict[str, str] = STOREFRONTS, prefix: str = "new") -> DataFrame:
    """The records that become places, with place_id (``prefix``:source/source_id): eligible, no lookalike, the first of each (name, number, cell)."""
    rows = settled(storefront_eligible(register, ev, storefronts), "eligible")
    rows = with_cell(rows.join(lookalikes(rows, places), "id", "left_anti"))
    w = W.partitionBy("nn", "hn", "cy", "cx").orderBy("source", "source_id")
    rows = rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "cy", "cx")
    return rows.withColumn("place_id", F.concat(F.lit(f"{prefix}:"), "source", F.lit("/"), "source_id"))


def minted_places(new: DataFrame) -> DataFrame:
    a = F.col("address")
    return new.select(
        F.col("place_id").alias("id"), text.display_name(F.col("name")).alias("name"), "category", text.address_street(a).alias("address"),
        text.address_city(a).alias("city"), text.address_state(a).alias("region"), F.col("zip").alias("postcode"), "lat", "lng", "nn", "hn", "zip", "sk",
    )


def minted_members(new: DataFrame) -> DataFrame:
    return new.select("place_id", "source", "source_id", F.lit("self").alias("rule"), F.lit(0e0).alias("dist"), F.lit(1e0).alias("sim"))


def minted_evidence(new: DataFrame) -> DataFrame:
    return new.select("place_id", "source", "source_id", "state", "date", F.lit("self").alias("rule"), F.lit(0e0).alias("dist"), F.col("name").alias("ev_name"), F.col("address").alias("ev_address"))
