"""Duplicate listings: groups by passing the smallest id along pairs, and one row a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def canonical_ids(rows: DataFrame, pairs: DataFrame, rounds: int | None = 3) -> DataFrame:
    """(id, place_id): the smallest id reached in ``rounds`` steps along (a_id, b_id) pairs, which are listed both ways.

    Three rounds are the published rule (longer chains stay apart); ``rounds=None`` goes on until nothing changes, each
    round checkpointed in spark.checkpoint.dir."""
    now = rows.select("id", F.col("id").alias("place_id"))
    done = 0
    while rounds is None or done < rounds:
        near = pairs.select(F.col("a_id").alias("id"), F.col("b_id")).join(now.select(F.col("id").alias("b_id"), F.col("place_id").alias("seen")), "b_id")
        near = near.groupBy("id").agg(F.min("seen").alias("seen"))
        then = now.join(near, "id", "left").select("id", F.least("place_id", F.coalesce("seen", "place_id")).alias("place_id"), F.col("place_id").alias("was"))
        done += 1
        if rounds is None:
            then = then.checkpoint()
            if not then.where("place_id <> was").limit(1).count():
                return then.drop("was")
        now = then.drop("was")
    return now


def merge_duplicates(rows: DataFrame, canon: DataFrame, fill: list[str], dataset: str, status: str = "operating_status", closed: str = "permanently_closed") -> DataFrame:
    """One row a place: the kept listing, ``fill`` columns from the first listing (by id) that has them, has_dataset, and
    a closed status only if all listings with one say so, else any other value."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("id")))
    joined = canon.join(rows, "id")
    groups = joined.groupBy("place_id").agg(
        *[first(c).alias(f"_{c}") for c in fill],
        F.coalesce(F.bool_or(F.array_contains("datasets", dataset)), F.lit(False)).alias("has_dataset"),
        F.bool_and(F.col(status) == closed).alias("_all"),
        F.min_by(status, F.when(F.col(status).isNotNull() & (F.col(status) != closed), F.col("id"))).alias("_other"),
    )
    out = rows.join(groups, rows.id == groups.place_id)
    final = {c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in fill} | {status: F.when(F.col("_all"), F.lit(closed)).otherwise(F.col("_other"))}
    return out.withColumns(final).select(*rows.columns, "has_dataset")
